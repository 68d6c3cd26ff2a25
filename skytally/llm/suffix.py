"""Repeated long strings by a run-compressed Burrows-Wheeler index.

No task can hold an index of the whole corpus, so the corpus is dealt to small indexes such that
every repeat lies inside one of them. Each window of ``length`` bytes is assigned to the
smallest-hashed 24-byte string in it; equal windows have equal ones. The stretch of a text whose
windows share such an anchor goes to the anchor's group. Equal stretches of a group are settled by
their hash; of those that differ, one each is indexed:

* suffixes are sorted, the Burrows-Wheeler transform is cut into runs, and suffix positions are
  sampled at the first and last row of every run;
* the common prefix with the row above is computed only where a run begins, and with the row
  below only where one ends; streaming through the text, every other value is one less than at
  the position before (a row inside a run moves with its neighbour);
* the larger of both is the matching statistic of a position against the rest of its group.

Positions that reach ``length`` are marked. A group too large for one index counts its windows by
hash instead, which needs no group in one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import as_bytes, stored

GRAM = 24                 # bytes of an anchor
CHUNK_BYTES = 1 << 19     # text whose anchors are computed at once
GROUP_BYTES = 3 << 20     # different stretches of an anchor that one index takes
INDEX_BYTES = 1 << 20     # anchors' groups are indexed together up to this size
PACKED = 7                # symbols of nine bits in a 64-bit word
NO_ID = -(1 << 63)        # stands for a null doc_id in joins; texts are told apart by their hash

BYTE_VALUES = np.random.default_rng(7).integers(0, 1 << 63, 256, np.int64).astype(np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the 24 bytes from every position, by doubling: 1, 2, 4, 8, 16, then 16 + 8."""
    h, width, power, eight = BYTE_VALUES[data], 1, BASE, None
    while width < 16:
        if width == 8:
            eight, power8 = h, power
        h = h[:-width] * power + h[width:]
        width, power = 2 * width, power * power
    h = h[:-8] * power8 + eight[16:]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (width - span)], x[width - span:]) if width > span else x


def stretches(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(text number, anchor hash, start, end, whether several) of every stretch of the texts.

    A stretch covers all windows of its anchor; overlapping stretches of one anchor in a text
    are one, so no place of a text stands twice in a group. Only one made of several can hold
    repeats by itself. Ordered by text and anchor.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 5
    with np.errstate(over="ignore"):
        h = gram_hashes(data)
    place = np.arange(len(h), dtype=np.uint64)
    best = sliding_min((h >> np.uint64(32) << np.uint64(32)) | place, length - GRAM + 1)
    window = np.arange(len(best), dtype=np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)[:len(best)]
    inside = window + length <= ends[text]
    window, text = window[inside], text[inside]
    anchor = (best[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if not len(window):
        return (np.zeros(0, np.int64),) * 5
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    last = np.append(first[1:], len(window)) - 1
    text, key, start, end = text[first], h[anchor[first]].view(np.int64), window[first], window[last] + length
    order = np.lexsort((start, key, text))
    text, key, start, end = text[order], key[order], start[order], end[order]
    new = np.flatnonzero(np.concatenate(
        [[True], (text[1:] != text[:-1]) | (key[1:] != key[:-1]) | (start[1:] >= end[:-1])]))
    after = np.append(new[1:], len(text))
    end, several = end[after - 1], (after - new > 1).astype(np.int64)
    text, key, start = text[new], key[new], start[new]
    begin = (ends - sizes)[text]
    return text, key, start - begin, end - begin, several


ROW = "kind int, key long, hash long, doc long, mark long, start long, stop long, copies int"
NAMES = ["kind", "key", "hash", "doc", "mark", "start", "stop", "copies"]
COVERED, STRETCH, INDEXED, COUNTED, SEVERAL = 0, 1, 2, 3, 4


def rows_of(kind, key, hashes, doc, mark, start, stop, copies) -> pa.RecordBatch:
    n = len(key)
    kinds = np.full(n, kind, np.int32) if np.isscalar(kind) else kind
    return pa.RecordBatch.from_arrays(
        [pa.array(c) for c in (kinds, key, hashes, doc, mark, start, stop, copies.astype(np.int32))], names=NAMES)


def all_stretches(docs: DataFrame, length: int) -> DataFrame:
    """Stretches of all texts. Within a batch, equal ones are settled: all are covered, one goes on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column("doc").to_numpy(), batch.column("mark").to_numpy()
            texts = as_bytes(batch.column("text"))
            found, begin, size = [], 0, 0
            for i, t in enumerate(texts):
                size += len(t)
                if size >= CHUNK_BYTES or i == len(texts) - 1:
                    text, key, start, stop, several = stretches(texts[begin:i + 1], length)
                    text = text + begin
                    hashes = np.fromiter((xxhash.xxh3_64_intdigest(texts[a][b:c]) for a, b, c in zip(
                        text.tolist(), start.tolist(), stop.tolist(), strict=True)), np.uint64, len(text)).view(np.int64)
                    found.append((key, hashes, ids[text], marks[text], start, stop, several))
                    begin, size = i + 1, 0
            if not sum(len(f[0]) for f in found):
                continue
            cols = [np.concatenate(c) for c in zip(*found, strict=True)]
            order = np.lexsort((cols[1], cols[0]))
            key, hashes, doc, mark, start, stop, several = (c[order] for c in cols)
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (hashes[1:] != hashes[:-1])])
            count = np.diff(np.append(np.flatnonzero(new), len(key)))
            yield rows_of(np.where(several[new] > 0, SEVERAL, STRETCH).astype(np.int32), key[new], hashes[new], doc[new], mark[new], start[new], stop[new], count)
            twice = np.repeat(count > 1, count)
            if twice.any():  # dealt out by document, they only pass through the next step
                yield rows_of(COVERED, doc[twice] ^ start[twice], hashes[twice], doc[twice], mark[twice], start[twice],
                              stop[twice], np.ones(int(twice.sum()), np.int32))

    return docs.mapInArrow(run, ROW)


def settle_groups(rows: DataFrame) -> DataFrame:
    """Per anchor: what equals another stretch is covered; of different ones, one each goes on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def groups(cols: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
            kind, key, hashes, doc, mark, start, stop, copies = cols
            own = kind != COVERED
            if (~own).any():
                yield rows_of(COVERED, *(c[~own] for c in cols[1:]))
            if not own.any():
                return
            kind, key, hashes, doc, mark, start, stop, copies = (c[own] for c in cols)
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (hashes[1:] != hashes[:-1])])
            first = np.flatnonzero(new)
            count = np.add.reduceat(copies.astype(np.int64), first)
            rows = np.diff(np.append(first, len(key)))
            twice = np.repeat(count > 1, rows)
            if twice.any():
                yield rows_of(COVERED, key[twice], hashes[twice], doc[twice], mark[twice], start[twice], stop[twice], copies[twice])
            classes = np.flatnonzero(np.concatenate([[True], np.diff(key[first]) != 0]))
            per_key = np.diff(np.append(classes, len(first)))
            size = np.add.reduceat(stop[first] - start[first], classes)
            large = size > GROUP_BYTES
            kinds = np.repeat(np.where(large, COUNTED, INDEXED), per_key)
            unsettled = np.repeat(per_key > 1, per_key) | (kind[first] == SEVERAL) & (count == 1)
            if unsettled.any():
                at = first[unsettled]
                yield rows_of(kinds[unsettled].astype(np.int32), key[at], hashes[at], doc[at], mark[at], start[at], stop[at],
                              np.minimum(count[unsettled], 2))

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(tuple(batch.column(c).to_numpy() for c in NAMES))
            if held[0][1][0] != held[-1][1][-1]:
                cols = tuple(np.concatenate(c) for c in zip(*held, strict=True))
                cutoff = int(np.searchsorted(cols[1], cols[1][-1]))
                yield from groups(tuple(c[:cutoff] for c in cols))
                held = [tuple(c[cutoff:] for c in cols)]
        if held:
            yield from groups(tuple(np.concatenate(c) for c in zip(*held, strict=True)))

    return rows.repartition("key").sortWithinPartitions("key", "hash").mapInArrow(run, ROW)


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of some byte strings, kept apart by group.

    Suffixes end with their string and are compared within their group only. ``sa`` has their
    positions in order, ``heads`` and ``tails`` say where runs of equal preceding bytes begin and
    end; positions at both are the samples.
    """

    def __init__(self, strings: list[bytes], groups: list[int]):
        sizes = np.array([len(s) for s in strings], np.int64)
        self.begin = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(strings), np.uint8)
        n = self.n = len(data)
        owner = np.repeat(np.arange(len(strings)), sizes)
        self.rest = np.repeat(self.begin + sizes, sizes) - np.arange(n)   # bytes to the string's end
        self.group = np.unique(np.array(groups, np.int64), return_inverse=True)[1][owner]
        symbols = np.concatenate([data.astype(np.uint64) + np.uint64(1), np.zeros(PACKED, np.uint64)])
        self.word = np.zeros(n, np.uint64)
        for t in range(PACKED):
            self.word = (self.word << np.uint64(9)) | np.where(self.rest > t, symbols[t:t + n], np.uint64(0))
        self.sort()
        before = np.where(np.isin(np.arange(n), self.begin), -1 - np.arange(n), np.concatenate([[0], data[:-1]]))
        bwt, group = before[self.sa], self.group[self.sa]
        self.heads = np.concatenate([[True], (bwt[1:] != bwt[:-1]) | (group[1:] != group[:-1])])
        self.tails = np.concatenate([self.heads[1:], [True]])

    def sort(self) -> None:
        """Suffix order by doubling from words of seven bytes; equal suffixes keep text order."""
        order = np.lexsort((self.word, self.group))
        word, group = self.word[order], self.group[order]
        rank = np.empty(self.n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], (word[1:] != word[:-1]) | (group[1:] != group[:-1])]))
        width, longest = PACKED, int(self.rest.max())
        while width < longest and rank.max() < self.n - 1:
            follow = np.zeros(self.n, np.int64)
            follow[:-width] = np.where(self.rest[:-width] > width, rank[width:] + 1, 0)
            both = rank * (self.n + 1) + follow
            order = np.argsort(both)
            both = both[order]
            rank[order] = np.cumsum(np.concatenate([[0], both[1:] != both[:-1]]))
            width *= 2
        self.sa = np.argsort(rank * self.n + np.arange(self.n))

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes x and y, a word at a time."""
        out, active = np.zeros(len(x), np.int64), np.arange(len(x))
        x, y = x.copy(), y.copy()
        while len(active):
            a, b = self.word[x], self.word[y]
            same = (a == b) & (self.rest[x] > PACKED) & (self.rest[y] > PACKED)
            stop = ~same
            if stop.any():
                extra, going = np.zeros(int(stop.sum()), np.int64), np.ones(int(stop.sum()), bool)
                for t in range(PACKED - 1, -1, -1):
                    left = (a[stop] >> np.uint64(9 * t)) & np.uint64(511)
                    going &= (left == ((b[stop] >> np.uint64(9 * t)) & np.uint64(511))) & (left > 0)
                    extra += going
                out[active[stop]] += extra
            out[active[same]] += PACKED
            active, x, y = active[same], x[same] + PACKED, y[same] + PACKED
        return out

    def statistics(self) -> np.ndarray:
        """Longest match of every position with another place of its group, streamed from the samples."""
        place = np.arange(self.n)
        longest = np.zeros(self.n, np.int64)
        for rows, step in ((np.flatnonzero(self.heads), -1), (np.flatnonzero(self.tails), 1)):
            at, neighbour = self.sa[rows], rows + step
            real = (neighbour >= 0) & (neighbour < self.n)
            real[real] = self.group[self.sa[neighbour[real]]] == self.group[at[real]]
            value = np.zeros(self.n, np.int64)
            value[at[real]] = self.common(at[real], self.sa[neighbour[real]])
            sampled = np.zeros(self.n, np.int64)
            sampled[at] = at
            last = np.maximum.accumulate(sampled)
            longest = np.maximum(longest, value[last] - (place - last))
        return longest


def runs_of(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Bytes covered by windows at these ascending starts, as (start, end) runs."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > length) + 1
    return [(int(a[0]), int(a[-1]) + length) for a in np.split(starts, cuts)]


CONTENT = "kind int, key long, doc long, mark long, start long, copies int, content binary"
MARK = "doc long, mark long, start long, stop long"


def fetch_content(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The bytes of the stretches that need them; each text is read once for all of its stretches."""
    wanted = (found.where(F.col("kind").isin(INDEXED, COUNTED)).groupBy("doc", "mark")
              .agg(F.collect_list(F.struct("kind", "key", "start", "stop", "copies")).alias("parts")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for doc, mark, parts, text in zip(batch.column("doc").to_pylist(), batch.column("mark").to_pylist(),
                                              batch.column("parts").to_pylist(), as_bytes(batch.column("text")), strict=True):
                for p in parts:
                    out.append((p["kind"], p["key"], doc, mark, p["start"], p["copies"], text[p["start"]:p["stop"]]))
                    size += p["stop"] - p["start"]
                if size > 1 << 22:
                    yield batch_of(out)
                    out, size = [], 0
            yield batch_of(out)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        columns = list(zip(*out, strict=True)) or [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                          names=["kind", "key", "doc", "mark", "start", "copies", "content"])

    return docs.join(wanted, ["doc", "mark"]).mapInArrow(cut, CONTENT)


def index_groups(content: DataFrame, length: int) -> DataFrame:
    """Marks of stretches that match another of their group over ``length`` bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def mark() -> pa.RecordBatch:
            out = []
            flat = RunIndex([h[4] for h in held], [h[0] for h in held])
            reach = flat.statistics() >= length
            for (_, doc, known, start, text), begin in zip(held, flat.begin.tolist(), strict=True):
                own = np.flatnonzero(reach[begin:begin + len(text)])
                out += [(doc, known, start + a, start + b) for a, b in runs_of(own, length)]
            columns = list(zip(*out, strict=True)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc", "mark", "start", "stop"])

        for batch in batches:
            for key, doc, known, start, text in zip(*(batch.column(c).to_pylist() for c in (
                    "key", "doc", "mark", "start", "content")), strict=True):
                if held and size >= INDEX_BYTES and key != held[-1][0]:
                    yield mark()
                    held, size = [], 0
                held.append((key, doc, known, start, text))
                size += len(text)
        if held:
            yield mark()

    return (content.where(F.col("kind") == INDEXED).drop("kind").repartition("key")
            .sortWithinPartitions("key", "doc", "mark", "start").mapInArrow(run, MARK))


COUNTS = "bucket long, doc long, mark long, hashes binary, copies binary, docs binary, marks binary, starts binary"
STARTS = "doc long, mark long, starts binary"


def per_document(doc: np.ndarray, mark: np.ndarray, start: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Window starts of each document in one row; no starts give no rows."""
    if not len(doc):
        return
    order = np.lexsort((start, mark, doc))
    doc, mark, start = doc[order], mark[order], start[order]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])]))
    for a, b in zip(new, [*new[1:], len(doc)], strict=True):
        yield int(doc[a]), int(mark[a]), start[a:b].astype("<i8").tobytes()


def count_windows(content: DataFrame, length: int, total: int) -> DataFrame:
    """Repeated windows (as starts per document) of groups too large for an index.

    Windows are counted by anchor and hash. A batch counts its own first and passes each different
    window on once; windows travel packed, in as many buckets as ``total``, their number, asks for.
    """
    buckets = 1 + total // (1 << 19)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, hashes, counts = [], [], []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("content").to_pylist(), strict=True):
                n = len(text) - length + 1
                view = memoryview(text)
                seed = key & 0x7FFFFFFFFFFFFFFF
                hashes.append(np.fromiter((xxhash.xxh3_64_intdigest(view[i:i + length], seed) for i in range(n)), np.uint64, n))
                counts.append(n)
                keys.append(np.arange(n))
            h, n = np.concatenate(hashes), np.array(counts)
            doc, mark = (np.repeat(batch.column(c).to_numpy(), n) for c in ("doc", "mark"))
            start = np.repeat(batch.column("start").to_numpy(), n) + np.concatenate(keys)
            copies = np.repeat(batch.column("copies").to_numpy(), n).astype(np.int64)
            order = np.argsort(h, kind="stable")
            h, doc, mark, start, copies = h[order], doc[order], mark[order], start[order], copies[order]
            new = np.concatenate([[True], h[1:] != h[:-1]])
            first = np.flatnonzero(new)
            seen = np.add.reduceat(copies, first)
            own = np.repeat(seen > 1, np.diff(np.append(first, len(h))))
            rows = [(-1 - xxhash.xxh3_64_intdigest(b"%d" % d) % buckets, d, m, None, None, None, None, s) for d, m, s in per_document(doc[own], mark[own], start[own])]
            bucket = (h[first] % np.uint64(buckets)).astype(np.int64)
            for b in np.unique(bucket).tolist():
                at = first[bucket == b]
                rows.append((b, None, None, h[at].tobytes(), np.minimum(seen[bucket == b], 2).astype(np.uint8).tobytes(),
                             doc[at].tobytes(), mark[at].tobytes(), start[at].tobytes()))
            yield packed(rows)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        names = ["bucket", "doc", "mark", "hashes", "copies", "docs", "marks", "starts"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def count(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return table.select(["doc", "mark", "starts"])
        h, copies, doc, mark, start = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (
            ("hashes", np.uint64), ("copies", np.uint8), ("docs", np.int64), ("marks", np.int64), ("starts", np.int64)))
        order = np.argsort(h, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(h[order]) != 0]))
        seen = np.add.reduceat(copies[order].astype(np.int64), first)
        again = order[np.repeat(seen > 1, np.diff(np.append(first, len(h))))]
        rows = list(per_document(doc[again], mark[again], start[again]))
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(
            ("doc", "mark", "starts"), columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)})

    return (content.where(F.col("kind") == COUNTED).mapInArrow(windows, COUNTS)
            .groupBy("bucket").applyInArrow(count, STARTS))


def mark_repeats(documents: DataFrame, length: int = 200) -> DataFrame:
    """(doc, mark, start, stop, starts): bytes covered by repeated ``length``-byte strings.

    ``doc`` is the doc_id, ``mark`` a hash of the text; stretches of a document may overlap. A
    row has either start and stop, or ``starts``, packed 64-bit starts of repeated strings.
    """
    docs = keyed(documents)
    found = stored(settle_groups(all_stretches(docs, length)), "stretches")
    content = stored(fetch_content(found, docs), "content")
    total = found.where(F.col("kind") == COUNTED).agg(F.sum(F.col("stop") - F.col("start"))).first()[0] or 0
    marks = found.where(F.col("kind") == COVERED).select("doc", "mark", "start", "stop").union(index_groups(content, length))
    marks = marks.withColumn("starts", F.lit(None).cast("binary"))
    if not total:
        return marks
    return marks.unionByName(count_windows(content, length, total), allowMissingColumns=True)


def keyed(documents: DataFrame) -> DataFrame:
    """doc, mark and text: rows are told apart by id and text, equal rows are the same but counted each."""
    return documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64("text").alias("mark"), "text")


def remove_repeats(documents: DataFrame, length: int = 200) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept) of every row.

    Every byte inside a ``length``-byte string of UTF-8 that also starts anywhere else is removed,
    in the same document or another; matches never cross documents, and strings are judged on the
    input. ``spans`` are the removed runs, ``kept`` the remaining bytes. Null texts are empty.
    Repeated rows are copies of each other, so both are removed. An empty table gives no rows.
    """
    marks = stored(mark_repeats(documents, length), "marks")
    lists = marks.groupBy("doc", "mark").agg(
        F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "stop"))).alias("parts"),
        F.collect_list("starts").alias("starts"))
    kind = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
            "spans array<struct<start:long,stop:long>>, kept binary")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, parts, starts, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "parts", "starts")),
                                                as_bytes(batch.column("text")), strict=True):
                runs: list[list[int]] = []
                singles = np.unique(np.frombuffer(b"".join(starts or ()), "<i8"))
                for a, b in sorted([(p["start"], p["stop"]) for p in parts or ()] + runs_of(singles, length)):
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], b)
                    else:
                        runs.append([a, b])
                kept, at = [], 0
                for a, b in runs:
                    kept.append(text[at:a])
                    at = b
                kept = b"".join([*kept, text[at:]])
                out.append((doc, len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(),
                            [{"start": a, "stop": b} for a, b in runs], kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
                     pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.binary())
            columns = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    docs = keyed(documents).withColumn("doc_id", F.when(F.col("doc") != NO_ID, F.col("doc")))
    return (docs.join(lists, ["doc", "mark"], "left").select("doc_id", "parts", "starts", "text").mapInArrow(remove, kind))
