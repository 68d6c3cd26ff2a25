"""Alignment of two tokenizers' tokens, computed once for each distinct text.

Documents are shuffled by their full text and counted. Every distinct text is then encoded by a
byte-level BPE (A, with a space before the text) and by a piece model (B, which adds that space
itself), and written as its token ids. Where a token of A and one of B end at the same byte they are
linked, and these places cut both into groups. Links are counted over the corpus with each text's
number of copies as their weight; what is measured of a text goes back to its documents by the
text's SHA-256.

The table of counts is bounded by the vocabularies, not by the corpus: of two tokens that end
together the shorter is the other's end, so there are at most as many pairs as the tokens of both
vocabularies have bytes (some 600,000 for the public ones). It is collected and broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.bpe import UNITS_KEPT, chunks, encoder, public, spread, vocabulary
from skytally.llm.common import stored

MARK = "▁"  # how a piece writes a space
BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
# A text that fills more than one document in this many is joined by broadcast: there are fewer such texts.
COMMON_SHARE = 1000

UNIT = re.compile(" +[^ ]*")


class Pieces:
    """A piece model that remembers the ids of what stands between spaces.

    No piece has its space mark behind another character (checked), so pieces never reach across
    the begin of a run of spaces and every such unit can be encoded by itself.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.tokens = [bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace(MARK, " ").encode() for i, n in enumerate(names)]
        self.size = np.array([len(t) for t in self.tokens], np.int64)
        self.apart = not any(MARK in n.lstrip(MARK) for n in names)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.begin, self.count, self.spelt = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def learn(self, units: Iterable[str]) -> None:
        """Encode units not seen before. Each begins with the space that the model adds."""
        units = [u for u in units if u not in self.index]
        if not units:
            return
        found = self.model.encode([u[1:] for u in units])
        # the model gives nothing for an empty text, but a lone space at a text's end is one piece
        found = [ids if u != " " else [self.model.piece_to_id(MARK)] for u, ids in zip(units, found, strict=True)]
        spelt = [b"".join(map(self.tokens.__getitem__, ids)) == u.encode() for u, ids in zip(units, found, strict=True)]
        count = np.fromiter(map(len, found), np.int64, len(found))
        self.index.update(zip(units, range(len(self.begin), len(self.begin) + len(units)), strict=True))
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(count) - count])
        self.count, self.spelt = np.concatenate([self.count, count]), np.concatenate([self.spelt, spelt])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), np.uint32, int(count.sum()))])

    def encode(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of texts that are not empty; None where a text's tokens do not spell it."""
        if len(self.index) > UNITS_KEPT:
            self.forget()
        whole = [not self.apart or MARK in t for t in texts]
        units = [[f" {t}"] if w else UNIT.findall(f" {t}") for t, w in zip(texts, whole, strict=True)]
        self.learn(set().union(*units))
        sizes = np.array([len(u) for u in units], np.int64)
        code = np.fromiter((self.index[x] for u in units for x in u), np.int64, int(sizes.sum()))
        count = self.count[code]
        ends = np.concatenate([[0], np.cumsum(count)])[np.cumsum(sizes)]
        wrong = np.concatenate([[0], np.cumsum(~self.spelt[code])])[np.concatenate([[0], np.cumsum(sizes)])]
        parts = np.split(self.flat[spread(self.begin[code], count)], ends[:-1])
        return [None if bad else ids for ids, bad in zip(parts, np.diff(wrong) > 0, strict=True)]


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """One model per Python worker."""
    return Pieces(path)


ENCODED = "text_key string, copies long, a_ids binary, b_ids binary"


def distinct_texts(documents: DataFrame) -> DataFrame:
    """Every different text that is neither null nor empty, with how many rows hold it."""
    return documents.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))


def encode_texts(texts: DataFrame, a_name: str = BYTE_LEVEL, b_name: str = PIECES) -> DataFrame:
    """(text_key, copies, a_ids, b_ids) of distinct texts: ids as little-endian unsigned 32-bit numbers.

    A text whose tokens, joined, are not a space and the text has no ids.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, other = encoder(public(a_name), False), pieces(public(b_name))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for first, last in chunks([len(t) for t in texts]):
                part = texts[first:last]
                # A has a token for every byte, so it spells any text
                rows = [(b"", b"") if b is None else (a.astype("<u4").tobytes(), b.astype("<u4").tobytes())
                        for a, b in zip(own.encode([" " + t for t in part]), other.encode(part), strict=True)]
                a_ids, b_ids = (pa.array(c, pa.binary()) for c in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("text_key")[first:last], batch.column("copies")[first:last], a_ids, b_ids],
                    names=["text_key", "copies", "a_ids", "b_ids"])

    return texts.select(F.sha2("text", 256).alias("text_key"), "copies", "text").mapInArrow(run, ENCODED)


class Alignment:
    """The tokens of some texts side by side, and where they end together."""

    def __init__(self, batch: pa.RecordBatch, a_sizes: np.ndarray, b_sizes: np.ndarray):
        def numbers(column: str) -> tuple[np.ndarray, np.ndarray]:
            held = batch.column(column).to_pylist()
            return np.frombuffer(b"".join(held), "<u4").astype(np.int64), np.array([len(x) // 4 for x in held], np.int64)

        (self.a, self.n_a), (self.b, self.n_b) = numbers("a_ids"), numbers("b_ids")
        # both sides of a text have the same bytes, so ends can be counted through all texts
        a_ends, self.b_ends = np.cumsum(a_sizes[self.a]), np.cumsum(b_sizes[self.b])
        place = np.searchsorted(self.b_ends, a_ends)
        self.a_linked = np.flatnonzero(self.b_ends[np.minimum(place, len(self.b) - 1)] == a_ends) if len(self.b) else place[:0]
        self.b_linked = place[self.a_linked]
        owner = np.repeat(np.arange(batch.num_rows), self.n_a)[self.a_linked]
        self.n_links = np.bincount(owner, minlength=batch.num_rows)
        self.link_ends = np.cumsum(self.n_links)

    def pairs(self) -> np.ndarray:
        """The linked ids, A's in the upper and B's in the lower half of a number."""
        return self.a[self.a_linked] << 32 | self.b[self.b_linked]

    def per_text(self, of_link: np.ndarray) -> np.ndarray:
        """Sum over the links of each text."""
        total = np.concatenate([[0], np.cumsum(of_link)])
        return total[self.link_ends] - total[self.link_ends - self.n_links]

    def groups(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text: the ids between one common end and the next."""
        def group(linked: np.ndarray, n: int) -> np.ndarray:
            ends = np.zeros(n, np.int64)
            ends[linked] = 1
            return np.cumsum(ends) - ends

        a_group, b_group = group(self.a_linked, len(self.a)), group(self.b_linked, len(self.b))
        # A's ids of a group come after all ids of earlier groups, B's after A's of the same group
        a_place = np.arange(len(self.a)) + np.concatenate([[0], self.b_linked + 1])[a_group]
        b_place = np.arange(len(self.b)) + (self.a_linked + 1)[b_group]
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        ids[a_place], ids[b_place] = 3 * self.a, 3 * self.b          # 0: a comma follows
        ids[a_place[self.a_linked]] += 1                              # 1: a bar
        ids[b_place[self.b_linked]] += 2                              # 2: a semicolon
        texts = list(map(spellings(3 * (1 + int(ids.max(initial=0)) // 3)).__getitem__, ids.tolist()))
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return [b"".join(texts[i:j])[:-1] for i, j in zip([0, *ends], ends, strict=False)]


@lru_cache(maxsize=1)
def all_spellings(n: int) -> list[bytes]:
    return [b"%d%c" % (i // 3, b",|;"[i % 3]) for i in range(n)]


def spellings(n: int) -> list[bytes]:
    """Every id with every sign behind it, for codes below n; rounded up, so that one list serves all."""
    return all_spellings(1 << max(n - 1, 1).bit_length())


def batch_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for first, last in chunks([len(x) for x in batch.column("a_ids").to_pylist()]):
        yield batch.slice(first, last - first)


PAIRS = "a_id int, b_id int, n long"


def count_pairs(encoded: DataFrame, a_name: str = BYTE_LEVEL, b_name: str = PIECES) -> DataFrame:
    """(a_id, b_id, n): how many links of the corpus hold each pair; a text counts once per copy.

    Every task adds up its own texts first, so it passes on each pair once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_sizes, b_sizes = vocabulary(public(a_name)).size, pieces(public(b_name)).size
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for part in batch_parts(batch):
                found = Alignment(part, a_sizes, b_sizes)
                weight = np.repeat(part.column("copies").to_numpy(), found.n_links)
                pairs, counts = summed(np.concatenate([pairs, found.pairs()]), np.concatenate([counts, weight]))
        yield pa.RecordBatch.from_arrays(
            [pa.array((pairs >> 32).astype(np.int32)), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)), pa.array(counts)],
            names=["a_id", "b_id", "n"])

    return encoded.select("copies", "a_ids", "b_ids").mapInArrow(run, PAIRS).groupBy("a_id", "b_id").agg(F.sum("n").alias("n"))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, with the sum of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


MEASURES = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long"


def measure_texts(encoded: DataFrame, pairs: DataFrame, a_name: str = BYTE_LEVEL, b_name: str = PIECES) -> DataFrame:
    """(text_key, copies, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each distinct text.

    ``n_best`` counts the links whose pair no other pair of the same B id outnumbers, ``count_sum``
    adds up the corpus-wide counts of all links. A text without ids has zeros and empty groups.
    """
    table = pairs.toArrow()  # bounded by the vocabularies, see above
    keys = table.column("a_id").to_numpy().astype(np.int64) << 32 | table.column("b_id").to_numpy()
    order = np.argsort(keys)
    keys, counts = keys[order], table.column("n").to_numpy()[order]
    highest = np.zeros(1 + int((keys & 0xFFFFFFFF).max(initial=0)), np.int64)
    np.maximum.at(highest, keys & 0xFFFFFFFF, counts)
    known = encoded.sparkSession.sparkContext.broadcast((keys, counts, counts == highest[keys & 0xFFFFFFFF]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_sizes, b_sizes = vocabulary(public(a_name)).size, pieces(public(b_name)).size
        keys, counts, best = known.value
        for batch in batches:
            for part in batch_parts(batch):
                found = Alignment(part, a_sizes, b_sizes)
                at = np.searchsorted(keys, found.pairs())
                columns = [found.n_a, found.n_b, found.n_links, found.n_links,
                           found.per_text(best[at].astype(np.int64)), found.per_text(counts[at])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("text_key"), part.column("copies"), *map(pa.array, columns),
                     pa.array(found.groups(), pa.binary()).cast(pa.string())],
                    names=["text_key", "copies", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    return encoded.mapInArrow(run, f"text_key string, copies long, {MEASURES}, groups string")


def to_documents(documents: DataFrame, measures: DataFrame) -> DataFrame:
    """doc_id and measures of every row of ``documents``; zeros and '' without text.

    A text that fills more than a thousandth of the rows is one of fewer than a thousand such
    texts, whatever the corpus, so these are broadcast and no key left for the shuffle is hot.
    """
    names = [c for c in measures.columns if c not in ("text_key", "copies")]
    total = measures.agg(F.sum("copies")).first()[0] or 0
    often = measures.where(F.col("copies") * COMMON_SHARE > total)
    found = F.struct(*names)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.when(F.col("text") != "", F.sha2("text", 256)).alias("text_key"))
    rows = rows.join(F.broadcast(often.select(F.col("text_key").alias("common_key"), found.alias("common"))),
                     F.col("text_key") == F.col("common_key"), "left")
    # rows that need no partner any more get keys of their own, spread over all partitions
    seek = F.when(F.col("common").isNull() & F.col("text_key").isNotNull(), F.col("text_key")).otherwise(
        F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string")))
    rare = measures.where(F.col("copies") * COMMON_SHARE <= total).select(F.col("text_key").alias("rare_key"), found.alias("rare"))
    rows = rows.withColumn("seek", seek).join(rare.hint("merge"), F.col("seek") == F.col("rare_key"), "left")
    one = F.coalesce("common", "rare")
    return rows.select("doc_id", *(
        F.coalesce(one[n], F.lit("" if t == "string" else 0).cast(t)).alias(n) for n, t in measures.select(*names).dtypes))


def align_documents(documents: DataFrame, a_name: str = BYTE_LEVEL, b_name: str = PIECES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    Null and empty texts, and texts that the tokens of either side do not spell out, have zeros
    and the empty string. Equal texts are encoded and aligned once and counted as often as they
    stand. Repeated rows and rows with a null id each give their row; an empty table gives none.
    Columns other than doc_id and text are not read.
    """
    encoded = stored(encode_texts(distinct_texts(documents), a_name, b_name), "alignment-tokens", compression="zstd")
    pairs = stored(count_pairs(encoded, a_name, b_name), "alignment-pairs")
    measures = measure_texts(encoded, pairs, a_name, b_name).withColumn(
        "groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups")
    return to_documents(documents, stored(measures, "alignment-measures"))
