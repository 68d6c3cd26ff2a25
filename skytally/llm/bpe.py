"""Byte-level BPE encoding by batched merge rounds, and decoding by gathering token bytes.

Texts are cut into units that no merge can cross. The new units of a batch, each once, lie side by
side in one flat array of symbols. A round finds the rank of every adjacent pair by binary search
over the sorted pair keys, takes the lowest rank of each word, merges it everywhere in that word and
looks up again only the pairs beside a merge. Words without a pair left leave the array. Merging one
rank per word and round is what a merge at a time gives, because every merge makes a token of its
own and uses only tokens of earlier merges (checked when a vocabulary is loaded).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_50k.json"
UNITS_KEPT = 300_000      # units whose ids a worker remembers; only speed depends on it
CHUNK_CHARS = 1 << 20     # text handled at once, unless a single text is longer
NONE = np.iinfo(np.int32).max

# A space that follows and is followed by something else always begins a new word, so words can be told
# apart there. This finds other spaces.
LOOSE_SPACE = re.compile(r"\s | (?:\s|$)")
# Up to here every Unicode version sorts characters alike (tested one by one).
LATER_CHARACTER = re.compile(r"[^\x00-ɏ]")
# Fixed value: the pattern of the public vocabulary that splits text before its merges.
WORD = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


def byte_characters() -> list[str]:
    """The character by which a byte-level vocabulary writes each byte: itself where it can be seen."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(seen)]
    of = {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [of[b] for b in range(256)]


class Vocabulary:
    """Ids, merge ranks and token bytes of a byte-level BPE file, as arrays."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            model = json.load(source)
        # the library's own splitter says what kind of character a later one is
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        ids, merges = model["model"]["vocab"], model["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        characters = byte_characters()
        byte = {c: b for b, c in enumerate(characters)}
        self.of_byte = np.array([ids[c] for c in characters], np.int64)
        self.base = 1 + max([*ids.values(), *self.special.values()])
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left, right = (np.array([ids[p[i]] for p in pairs], np.int64) for i in (0, 1))
        self.product = np.array([ids["".join(p)] for p in pairs], np.int64)
        made = np.full(self.base, -1, np.int64)
        made[self.product] = np.arange(len(pairs))
        if len(np.unique(self.product)) < len(pairs) or (np.maximum(made[left], made[right]) >= np.arange(len(pairs))).any():
            raise ValueError("a merge uses a token of a later merge, or two merges make the same token")
        keys = left * self.base + right
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order.astype(np.int32)
        tokens = [b""] * self.base
        for token, i in ids.items():
            tokens[i] = bytes(byte[c] for c in token)
        for token, i in self.special.items():
            tokens[i] = token.encode()
        self.tokens = tokens
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.standing: dict[int, str] = {}

    def pair_ranks(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Merge ranks of the pairs that begin at ``at``; NONE at a word's end or without a merge."""
        out = np.full(len(at), NONE, np.int32)
        inside = at + 1 < len(symbols)
        inside[inside] = word[at[inside]] == word[at[inside] + 1]
        key = symbols[at[inside]] * self.base + symbols[at[inside] + 1]
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        out[inside] = np.where(self.keys[place] == key, self.rank[place], NONE)
        return out

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words side by side, how many ids each word has)."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        rank = self.pair_ranks(symbols, word, np.arange(len(symbols)))
        finished: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(word))))
            going = least < NONE
            if not going.all():
                finished.append((word[~going], symbols[~going]))
                symbols, word, rank, least = symbols[going], word[going], rank[going], least[going]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == least)
            # overlapping pairs (a, a), (a, a) follow one another: every second is merged, from the first on
            new = np.concatenate([[True], np.diff(at) > 1])
            at = at[(at - at[new][np.cumsum(new) - 1]) % 2 == 0]
            symbols[at] = self.product[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            at = np.cumsum(keep)[at] - 1
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            beside = np.concatenate([at, at[at > 0] - 1])
            rank[beside] = self.pair_ranks(symbols, word, beside)
        if not finished:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        word, symbols = (np.concatenate(c) for c in zip(*finished, strict=True))
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(words))

    def stand_in(self, character: int) -> str:
        """An early character of the same kind (letter, digit, space, other) as the library sees it."""
        if character not in self.standing:
            def joins(before: str) -> bool:
                return len(self.splitter.pre_tokenize_str(before + chr(character))) == 1
            self.standing[character] = next((s for before, s in (("a", "é"), ("1", "²"), (".", "§")) if joins(before)), "\xa0")
        return self.standing[character]

    def words(self, text: str) -> list[str]:
        """The words of a text; merges never cross their ends."""
        if not LATER_CHARACTER.search(text):
            return WORD.findall(text)
        plain = text.translate({ord(c): self.stand_in(ord(c)) for c in set(LATER_CHARACTER.findall(text))})
        out, at = [], 0
        for w in WORD.findall(plain):
            out.append(text[at:at + len(w)])
            at += len(w)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, one after another."""
        sizes = self.size[ids]
        place = np.repeat(self.begin[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        return self.bytes[place].tobytes()


class Encoder:
    """Encodes texts with a vocabulary and remembers the ids of units it has seen."""

    def __init__(self, vocabulary: Vocabulary, special: bool):
        self.vocabulary = vocabulary
        self.special = regex.compile("|".join(map(regex.escape, vocabulary.special))) if special and vocabulary.special else None
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)

    def plain_units(self, text: str) -> list[str]:
        if LOOSE_SPACE.search(text) or "\0" in text:
            return self.vocabulary.words(text)
        return text.replace(" ", "\0 ").split("\0")[text.startswith(" "):] if text else []

    def units(self, text: str) -> list[str]:
        """Parts of a text that are encoded each by itself: what stands between single spaces, else words."""
        if self.special is None or "<" not in text:
            return self.plain_units(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self.plain_units(text[at:m.start()])
            out.append(m.group())
            at = m.end()
        return out + self.plain_units(text[at:])

    def learn(self, units: Iterable[str]) -> None:
        """Encode units not seen before, all in the same merge rounds."""
        units = [u for u in units if u not in self.index]
        if not units:
            return
        word_of: dict[str, int] = {}
        parts, sizes, own = [], [], []
        for u in units:
            if self.special is not None and u in self.vocabulary.special:
                own.append((len(sizes), self.vocabulary.special[u]))
                sizes.append(0)
                continue
            found = self.vocabulary.words(u)
            parts += [word_of.setdefault(w, len(word_of)) for w in found]
            sizes.append(len(found))
        ids, count = self.vocabulary.merge([w.encode() for w in word_of])
        begin = np.cumsum(count) - count
        parts = np.array(parts, np.int64)
        ids = ids[spread(begin[parts], count[parts])].astype(np.int32)
        inner = np.concatenate([[0], np.cumsum(count[parts])])
        ends = inner[np.cumsum(np.array(sizes, np.int64))]
        count = np.diff(np.concatenate([[0], ends]))
        begin = ends - count
        if own:
            place, value = (np.array(c, np.int64) for c in zip(*own, strict=True))
            begin[place], count[place] = len(ids) + np.arange(len(own)), 1
            ids = np.concatenate([ids, value.astype(np.int32)])
        self.index.update(zip(units, range(len(self.begin), len(self.begin) + len(units)), strict=True))
        self.begin = np.concatenate([self.begin, begin + len(self.ids)])
        self.count = np.concatenate([self.count, count])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.index) > UNITS_KEPT:
            self.forget()
        units = [self.units(t) for t in texts]
        self.learn(set().union(*units))
        sizes = [len(u) for u in units]
        code = np.fromiter((self.index[x] for u in units for x in u), np.int64, sum(sizes))
        count = self.count[code]
        ids = self.ids[spread(self.begin[code], count)]
        ends = np.concatenate([[0], np.cumsum(count)])[np.cumsum(sizes, dtype=np.int64)]
        return np.split(ids, ends[:-1]) if texts else []


def spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Positions begin, begin + 1, ... of every stretch, one stretch after another."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=4)
def encoder(path: str, special: bool) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(vocabulary(path), special)


def chunks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about CHUNK_CHARS each; every row is in one."""
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        total += n
        if total >= CHUNK_CHARS or i == len(sizes) - 1:
            yield begin, i + 1
            begin, total = i + 1, 0


def public(name: str) -> str:
    """Path of a public vocabulary on this machine (looked up where the task runs)."""
    import public_tokenizers
    return public_tokenizers.path(name)


TOKENS = "doc_id long, n_tokens long, ids binary"


def encode_documents(documents: DataFrame, name: str = VOCABULARY, special: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row: ids of the whole text as little-endian unsigned 32-bit numbers.

    With ``special`` the strings of special tokens in a text are those tokens, as the tokenizers
    library has it; without, they are ordinary text. Null texts are empty and empty texts have no
    tokens. Repeated rows and rows with a null id each give their own row, an empty table none;
    other columns than doc_id and text are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(public(name), special)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            keys = batch.column("doc_id").cast(pa.int64())
            for a, b in chunks([len(t) for t in texts]):
                ids = own.encode(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [keys[a:b], pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())], names=["doc_id", "n_tokens", "ids"])

    return documents.select("doc_id", "text").mapInArrow(run, TOKENS)


def decode_documents(tokens: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """``tokens`` as ``encode_documents`` gives them, with the ``text`` they decode to.

    Special tokens are written out. Bytes that are no UTF-8 become replacement characters. Null
    ids are no ids: the text is empty.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(public(name))
        for batch in batches:
            texts = [own.decode(np.frombuffer(x or b"", "<u4").astype(np.int64)).decode("utf-8", "replace")
                     for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=["doc_id", "n_tokens", "ids", "text"])

    return tokens.select("doc_id", "n_tokens", "ids").mapInArrow(run, f"{TOKENS}, text string")


def round_trip(documents: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): documents encoded, and decoded again."""
    return decode_documents(encode_documents(documents, name), name).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
