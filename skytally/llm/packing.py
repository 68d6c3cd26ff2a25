"""Best-fit packing of token sequences by exact-complement hashing.

Only the histogram of piece lengths reaches the driver, at most one count per length. The plan
made from it says which lengths share a sequence and how often; it is as long as there are
different combinations, however many pieces there are. Pieces then find their place by their
rank among the pieces of their length, which every task counts for itself.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.common import stored

SIZE = 2048
END_ID = 0
VOCABULARY = "byte_bpe_50k"
# Both encoders split and merge these characters alike (tested one by one); others take the slower one.
ODD = re.compile(r"[^\x00-ɏ]|<\|")

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, local long"


@lru_cache(maxsize=2)
def encoders(vocabulary: str):
    """(reference encoder, fast encoder of the same ids), once per Python worker."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer
    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json")), fast


def encode(text: str, vocabulary: str = VOCABULARY) -> np.ndarray:
    """Token ids of a text and the closing id, as little-endian unsigned 32-bit numbers."""
    slow, fast = encoders(vocabulary)
    if ODD.search(text):
        ids = slow.encode(text, add_special_tokens=False).ids
    else:
        ids = fast.encode_to_numpy(text, disallowed_special=())
    return np.concatenate([np.asarray(ids, "<u4"), np.array([END_ID], "<u4")])


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all of full size but perhaps the first."""
    first = n % size or min(n, size)
    return [(0, first)] + [(i, size) for i in range(first, n, size)]


def pieces(documents: DataFrame, size: int = SIZE, vocabulary: str = VOCABULARY) -> DataFrame:
    """Every piece with the task that made it and its rank among the task's pieces of its length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in batches:
            rows = []
            keys = batch.column("doc_id").cast(pa.int64()).to_pylist()
            for key, text in zip(keys, batch.column("text").to_pylist(), strict=True):
                ids = encode(text or "", vocabulary)
                for k, (start, length) in enumerate(cut(len(ids), size)):
                    crc = zlib.crc32(ids[start:start + length].tobytes())
                    rows.append((key, k, start, length, crc, task, int(seen[length])))
                    seen[length] += 1
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "local"])

    return documents.select("doc_id", "text").mapInArrow(run, PIECE)


def plan_sequences(counts: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences) for pieces given as counts by length.

    From the longest length down, each looks up what fills its gap exactly: one length, then two,
    then three, as often as all of them are available. What is left goes, longest first, where it
    leaves the smallest gap.
    """
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plan: list[tuple[tuple[int, ...], int]] = []
    gaps: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def take(*lengths: int) -> None:
        n = min(int(left[x]) // lengths.count(x) for x in set(lengths))
        if n > 0:
            plan.append((lengths, n))
            for x in lengths:
                left[x] -= n

    take(size)
    for a in range(size - 1, 0, -1):
        gap = size - a
        if left[a]:
            take(a, gap)
        if left[a]:  # pairs: the index of sums to the gap is the histogram against itself reversed
            low = np.arange(1, gap // 2 + 1)
            for b in low[(left[low] > 0) & (left[gap - low] > 0)][::-1]:
                take(a, int(gap - b), int(b))
                if not left[a]:
                    break
        if left[a]:
            have = np.flatnonzero(left[1:gap - 1]) + 1
            for b in have[::-1]:
                rest = gap - int(b)
                low = np.arange(max(1, rest - int(b)), rest // 2 + 1)
                low = low[(left[low] > 0) & (left[rest - low] > 0)]
                for c in low[::-1]:
                    take(a, int(b), int(rest - c), int(c))
                    if not left[a]:
                        break
                if not left[a]:
                    break
    open_gaps = np.zeros(size + 1, bool)

    def keep(lengths: tuple[int, ...], n: int) -> None:
        gap = size - sum(lengths)
        gaps.setdefault(gap, []).append((lengths, n))
        open_gaps[gap] = True

    for a in range(size, 0, -1):
        n = int(left[a])
        while n:
            fits = np.flatnonzero(open_gaps[a:])
            if not len(fits):
                each = size // a
                if n >= each:
                    keep((a,) * each, n // each)
                if n % each:
                    keep((a,) * (n % each), 1)
                break
            gap = int(fits[0]) + a
            lengths, m = gaps[gap].pop()
            open_gaps[gap] = bool(gaps[gap])
            used = min(n, m)
            if m > used:
                keep(lengths, m - used)
            keep((*lengths, a), used)
            n -= used
    return plan + [x for found in gaps.values() for x in found]


def places(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, offset) in order of rank."""
    table: dict[int, list[tuple[int, int, int]]] = {}
    rank: dict[int, int] = {}
    sequence = 0
    for lengths, n in plan:
        offset = 0
        for x in lengths:
            table.setdefault(x, []).append((rank.get(x, 0), sequence, offset))
            rank[x] = rank.get(x, 0) + n
            offset += x
        sequence += n
    return {x: np.array(rows, np.int64) for x, rows in table.items()}


PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack(documents: DataFrame, size: int = SIZE, vocabulary: str = VOCABULARY) -> DataFrame:
    """Pack every document into sequences of at most ``size`` tokens.

    Reads doc_id and text; a null text is empty and still has its closing token. Documents longer
    than a sequence are cut, their first piece may be shorter. Repeated rows are packed each, rows
    with a null id too; an empty table gives no rows. Pieces are written once, so that ranks and
    plan hold whatever is computed again later.
    """
    cut_up = stored(pieces(documents, size, vocabulary), "pieces")
    per_task = cut_up.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(per_task.select("length", "task", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")),
                     "ranks")
    counts = {r["length"]: r["n"] for r in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = documents.sparkSession.sparkContext.broadcast(places(plan_sequences(counts, size)))
    # as many offsets as tasks times lengths: no bound to broadcast them by
    ranked = cut_up.join(offsets.drop("n").hint("merge"), ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("local") + F.col("ahead")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                own, rows = length == x, table.value[int(x)]
                row = rows[np.searchsorted(rows[:, 0], rank[own], side="right") - 1]
                sequence[own], offset[own] = row[:, 1] + rank[own] - row[:, 0], row[:, 2]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, PACKED)
