"""Benchmark decontamination over a positional inverted index.

The index is a table of segments. A segment holds some documents, every term they use, and the
positions of each term, so an index of any size is a table of bounded rows and no posting list
ever crosses the network. Test items arrive in blocks of a checked size. In every segment each
window of an item starts from its rarest term; the lists of the others, shifted by their place
in the window, thin the candidates out until only phrase and proximity matches are left.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import as_bytes, split_words, stored

WINDOW = 10                    # words of a phrase; shorter items are one window
SLOP = 2                       # further words a proximity match may hold in between
SEGMENT_BYTES = 8 << 20        # text of a segment; one longer document is a segment of its own
BLOCK_BYTES = 4 << 20          # test text that is broadcast at once
PIECE_WORDS = 4096             # long items are cut into overlapping pieces

INDEX = ("segment string, doc_ids array<long>, n_words array<long>, terms binary, counts binary, "
         "steps binary, long_steps binary")
MATCH = "array<struct<item_id:long,start:long,end:long,near:boolean>>"


def build_index(documents: DataFrame) -> DataFrame:
    """Segments of the positional index, written to the shared folder.

    Reads doc_id and text. Documents without words stand in a segment without postings.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, number = TaskContext.get().partitionId(), 0
        ids, lengths, numbered, size = [], [], [], 0
        vocabulary: defaultdict[bytes, int] = defaultdict()
        vocabulary.default_factory = vocabulary.__len__

        def segment() -> pa.RecordBatch:
            term = np.concatenate([np.zeros(0, np.int32), *numbered])
            order = np.argsort(term, kind="stable")
            counts = np.bincount(term, minlength=len(vocabulary)).astype(np.int64)
            step = np.diff(order, prepend=0)
            first = np.cumsum(counts) - counts
            step[first[counts > 0]] = order[first[counts > 0]]
            short = np.minimum(step, 255)
            return pa.RecordBatch.from_pydict({
                "segment": pa.array([f"{part}-{number}"]),
                "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                "n_words": pa.array([lengths], pa.list_(pa.int64())),
                "terms": pa.array([b" ".join(vocabulary)], pa.binary()),
                "counts": pa.array([counts.astype("<u4").tobytes()], pa.binary()),
                "steps": pa.array([short.astype(np.uint8).tobytes()], pa.binary()),
                "long_steps": pa.array([step[step >= 255].astype("<u4").tobytes()], pa.binary()),
            })

        for batch in batches:
            keys = batch.column("doc_id").cast(pa.int64()).to_pylist()
            for key, text in zip(keys, as_bytes(batch.column("text")), strict=True):
                words = split_words(text)
                ids.append(key)
                lengths.append(len(words))
                numbered.append(np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words)))
                size += len(text)
                if size >= SEGMENT_BYTES:
                    yield segment()
                    ids, lengths, numbered, size, number = [], [], [], 0, number + 1
                    vocabulary.clear()
        if ids:
            yield segment()

    return stored(documents.select("doc_id", "text").mapInArrow(run, INDEX), "index")


class Segment:
    """Posting lists of one index row."""

    def __init__(self, row: dict):
        self.ids, self.lengths = row["doc_ids"], np.array(row["n_words"], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.number = {t: i for i, t in enumerate(row["terms"].split())}
        self.counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        self.steps = np.frombuffer(row["steps"], np.uint8)
        self.long_steps = np.frombuffer(row["long_steps"], "<u4")
        self.longs_before = np.cumsum(self.steps == 255) if len(self.steps) else np.zeros(0, np.int64)
        self.kept: dict[int, np.ndarray] = {}

    def postings(self, term: int) -> np.ndarray:
        """Word positions of a term, ascending, counted through the whole segment."""
        if term not in self.kept:
            a, b = self.first[term], self.first[term] + self.counts[term]
            step = self.steps[a:b].astype(np.int64)
            long = step == 255
            if long.any():
                since = self.longs_before[a - 1] if a else 0
                step[long] = self.long_steps[since:since + int(long.sum())]
            self.kept[term] = np.cumsum(step)
        return self.kept[term]


def near(postings: np.ndarray, at: np.ndarray, slop: int) -> np.ndarray:
    """Which places have a posting at most ``slop`` away."""
    i = np.searchsorted(postings, at - slop)
    return (i < len(postings)) & (postings[np.minimum(i, len(postings) - 1)] <= at + slop)


def match_window(segment: Segment, terms: list[int], slop: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end position of every place where the terms stand in order, ``slop`` words apart at most.

    From each place of the rarest term, terms before it are taken as late and terms after it as
    early as possible, so an exact phrase is found whenever there is one.
    """
    order = sorted(range(len(terms)), key=lambda i: (segment.counts[terms[i]], i))
    anchor = order[0]
    at = segment.postings(terms[anchor])
    for i in order[1:]:
        at = at[near(segment.postings(terms[i]), at + (i - anchor), slop)]
        if not len(at):
            return at, at
    low, high = at.copy(), at.copy()
    alive = np.ones(len(at), bool)
    for i in range(anchor + 1, len(terms)):
        p = segment.postings(terms[i])
        j = np.searchsorted(p, high, side="right")
        alive &= j < len(p)
        high = p[np.minimum(j, len(p) - 1)]
    for i in range(anchor - 1, -1, -1):
        p = segment.postings(terms[i])
        j = np.searchsorted(p, low, side="left") - 1
        alive &= j >= 0
        low = p[np.maximum(j, 0)]
    alive &= high - low < len(terms) + slop
    low, high = low[alive], high[alive] + 1
    doc = np.searchsorted(segment.starts, low, side="right") - 1
    inside = high <= segment.starts[doc] + segment.lengths[doc]
    return low[inside], high[inside]


def item_pieces(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, piece, words): lower-cased words of an item, cut into overlapping pieces."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            keys = batch.column("item_id").cast(pa.int64()).to_pylist()
            for key, text in zip(keys, as_bytes(batch.column("text")), strict=True):
                words = split_words(text)
                for k, i in enumerate(range(0, max(len(words) - window + 1, 1), PIECE_WORDS)):
                    if key is not None and words:
                        rows.append((key, k, b" ".join(words[i:i + PIECE_WORDS + window - 1])))
            keys, pieces, words = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(pieces, pa.int32()), pa.array(words, pa.binary())],
                names=["item_id", "piece", "words"])

    return benchmark.select("item_id", "text").mapInArrow(cut, "item_id long, piece int, words binary")


def find_matches(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """One row per document: doc_id, n_words and ``matches`` (item, first word, end word, near).

    Exact places of one item that overlap are one match; ``near`` marks proximity matches, which
    keep their own span. Items without words or id are never found; repeated items count once;
    repeated documents are matched each, those of null texts without words. An empty index gives
    no rows. A benchmark beyond BLOCK_BYTES is matched block by block; a block's matches are
    written and its windows released before the next is read, so one block is held at a time.
    """
    spark = index.sparkSession
    pieces = stored(item_pieces(benchmark, window), "items")
    size = pieces.agg(F.sum(F.length("words"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    found = None
    for b in range(blocks):
        block = pieces.where(F.pmod(F.xxhash64("item_id", "piece"), F.lit(blocks)) == b).distinct().collect()
        held = spark.sparkContext.broadcast(windows_of(block, window))
        part = match_block(index, held, slop)
        if blocks > 1:
            part = stored(part, "block-matches")
            held.destroy()
        found = part if found is None else found.unionByName(part)
    if blocks > 1:  # a document's matches are as many as its words and items allow
        found = (found.groupBy("segment", "ordinal", "doc_id", "n_words")
                 .agg(F.flatten(F.collect_list("matches")).alias("matches")))
    return found.drop("segment", "ordinal")


def windows_of(block: list, window: int) -> tuple[list[bytes], dict[tuple[int, ...], list[int]]]:
    """Vocabulary of a block, and the items of each different window (term numbers)."""
    number: dict[bytes, int] = {}
    windows: dict[tuple[int, ...], set[int]] = {}
    for row in block:
        terms = [number.setdefault(w, len(number)) for w in bytes(row["words"]).split()]
        for i in range(max(len(terms) - window + 1, 1)):
            windows.setdefault(tuple(terms[i:i + window]), set()).add(row["item_id"])
    return list(number), {w: sorted(items) for w, items in windows.items()}


def match_block(index: DataFrame, block, slop: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, windows = block.value
        for batch in batches:
            for row in batch.to_pylist():
                yield rows_of(row["segment"], Segment(row), vocabulary, windows)

    def rows_of(name: str, segment: Segment, vocabulary, windows) -> pa.RecordBatch:
        local = [segment.number.get(w, -1) for w in vocabulary]
        spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
        loose: set[tuple[int, int, int, int]] = set()
        for window, items in windows.items():
            terms = [local[t] for t in window]
            if min(terms) < 0:
                continue
            low, high = match_window(segment, terms, slop)
            if not len(low):
                continue
            docs = np.searchsorted(segment.starts, low, side="right") - 1
            base = segment.starts[docs]
            for d, a, e in zip(docs.tolist(), (low - base).tolist(), (high - base).tolist(), strict=True):
                for item in items:
                    if e - a == len(terms):
                        spans.setdefault((d, item), []).append((a, e))
                    else:
                        loose.add((d, item, a, e))
        matches: list[list[dict]] = [[] for _ in segment.ids]
        for (d, item), places in sorted(spans.items()):
            places.sort()
            begin, end = places[0]
            for a, e in places[1:]:
                if a > end:
                    matches[d].append({"item_id": item, "start": begin, "end": end, "near": False})
                    begin, end = a, e
                end = max(end, e)
            matches[d].append({"item_id": item, "start": begin, "end": end, "near": False})
        for d, item, a, e in sorted(loose):
            matches[d].append({"item_id": item, "start": a, "end": e, "near": True})
        n = len(matches)
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                                   ("near", pa.bool_())]))
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * n, pa.string()), pa.array(range(n), pa.int32()), pa.array(segment.ids, pa.int64()),
             pa.array(segment.lengths, pa.int64()), pa.array(matches, kind)],
            names=["segment", "ordinal", "doc_id", "n_words", "matches"])

    return index.mapInArrow(run, f"segment string, ordinal int, doc_id long, n_words long, matches {MATCH}")


def covered(spans: Column) -> Column:
    """Words inside at least one of the spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(
        F.array_sort(F.transform(spans, lambda m: F.struct(m["start"], m["end"]))), start,
        lambda acc, m: F.struct(
            (acc["n"] + F.greatest(m["end"] - F.greatest(m["start"], acc["end"]), F.lit(0))).alias("n"),
            F.greatest(acc["end"], m["end"]).alias("end")),
        lambda acc: acc["n"])


def contamination(matches: DataFrame) -> DataFrame:
    """Digest of ``find_matches``: words hit by exact phrases, the items, and proximity matches.

    ``n_near`` counts words that only proximity matches cover; they do not contaminate.
    """
    exact = F.filter("matches", lambda m: ~m["near"])
    items = F.array_sort(F.array_distinct(F.transform(exact, lambda m: m["item_id"].cast("string"))))
    return matches.select(
        "doc_id", "n_words", covered(exact).alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"), (F.size(exact) > 0).alias("contaminated"),
        (covered(F.col("matches")) - covered(exact)).alias("n_near"))
