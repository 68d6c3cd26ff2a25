"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact intersection.

1. Equal shingle sets are one class, found by a 128-bit digest.
2. Shingles are ordered by a fixed-size sketch of their document counts, rarest first. Two sets
   similar enough share a shingle among the first of each (how many depends on both sizes), so
   every document goes to the tiles of its first shingles only. Passages, lines and texts that a
   large part of the corpus shares stand last and make no tiles of their own.
3. Small tiles give all pairs whose sizes and positions allow enough overlap. Large tiles are
   split by salt; each part, banded by size, is compared with its pivot, and the pivots with each
   other. Only for tiles whose documents these links leave in different components are the pairs
   across components compared too, in blocks, by bitmap. No link between components is lost, and
   no group emits all its pairs.
4. Bit counts of two bitmaps bound the overlap from above; what passes is intersected exactly,
   as sorted arrays made from the whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import as_bytes, components, stored

SKETCH_BITS = 21         # counters of shingle frequencies, whatever the size of the corpus
SKETCH_BLOCKS = 256
SMALL_TILE = 16          # entries of a tile that gives all its pairs
FLUSH_ROWS = 65_536      # entries whose tiles are compared at once
SALT_ROWS = 1024         # expected entries of a part of a large tile
BLOCK = 1024             # rows of a side when pairs across components are compared
MEMBERS = 64             # texts compared with one copy of a pivot's text

M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word to 64-bit hash; forgets all when it has seen very many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: bytes, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the different n-word shingles; of the whole sequence if it is shorter."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(n, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - k + 1 + i]
    return np.unique(mixed(out))


def bitmap(s: np.ndarray) -> bytes:
    """Bitmap of at least two bits per element, a power of two between 128 and 8192 bits."""
    bits = min(8192, max(128, 1 << (2 * len(s) - 1).bit_length()))
    out = np.zeros(bits, np.uint8)
    out[(s & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out).tobytes()


def folded(data: bytes, size: int) -> np.ndarray:
    """A bitmap folded to ``size`` bytes, as 64-bit words; bits keep their place modulo the size."""
    return np.bitwise_or.reduce(np.frombuffer(data, np.uint64).reshape(-1, size // 8), axis=0)


def needed(a, b, percent: int):
    """Least intersection of sets of these sizes that are similar enough."""
    return -(-percent * (a + b) // (100 + percent))


def may_overlap(a: np.ndarray, b: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Upper bound of the intersection from two arrays of bitmaps (rows of 64-bit words)."""
    only_left = np.bitwise_count(left & ~right).sum(-1, dtype=np.int64)
    only_right = np.bitwise_count(right & ~left).sum(-1, dtype=np.int64)
    return np.minimum(a - only_left, b - only_right)


def signatures(documents: DataFrame, n: int) -> DataFrame:
    """(doc_id, n_shingles, digest, bitmap) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t, n, hashes) for t in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array([bitmap(s) if len(s) else b"" for s in sets], pa.binary())],
                names=["doc_id", "n_shingles", "digest", "bitmap"])

    return documents.mapInArrow(run, "doc_id long, n_shingles long, digest binary, bitmap binary")


def bucket(s: np.ndarray) -> np.ndarray:
    return (mixed(s) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def sketch(documents: DataFrame, n: int) -> np.ndarray:
    """How many documents hold a shingle of each bucket: 2^21 counters, added up block by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, held, many = WordHashes(), np.zeros(1 << SKETCH_BITS, np.int64), [], 0
        for batch in batches:
            for t in as_bytes(batch.column("text")):
                held.append(bucket(shingles(t, n, hashes)).astype(np.int32))
                many += len(held[-1])
                if many > 2_000_000:
                    counts += np.bincount(np.concatenate(held), minlength=len(counts))
                    held, many = [], 0
        if held:
            counts += np.bincount(np.concatenate(held), minlength=len(counts))
        blocks = counts.reshape(SKETCH_BLOCKS, -1)
        used = np.flatnonzero(blocks.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)),
             pa.array([np.minimum(blocks[i], 65535).astype("<u2").tobytes() for i in used], pa.binary())],
            names=["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                part = np.frombuffer(counts, "<u2").astype(np.uint32)
                total[block] = total[block] + part if block in total else part
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([c.tobytes() for c in total.values()], pa.binary())],
            names=["block", "counts"])

    kind = "block int, counts binary"
    rows = documents.mapInArrow(run, kind).repartition("block").mapInArrow(add, kind).collect()
    counts = np.zeros((SKETCH_BLOCKS, (1 << SKETCH_BITS) // SKETCH_BLOCKS), np.uint32)
    for r in rows:
        counts[r["block"]] += np.frombuffer(bytes(r["counts"]), np.uint32)
    return counts.reshape(-1)


ENTRY = "key long, salt int, doc long, size int, position int"


def tile_entries(documents: DataFrame, n: int, percent: int, counts) -> DataFrame:
    """Where each document goes: its first shingles in the common order, with size and position.

    Of equal sets only the first in a task goes further; sets too small to be similar to a
    different one go nowhere.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        frequency = counts.value
        for batch in batches:
            parts = []
            for doc, text in zip(batch.column("doc_id").cast(pa.int64()).to_pylist(), as_bytes(batch.column("text")), strict=True):
                s = shingles(text, n, hashes)
                a = len(s)
                if doc is None or not a or 100 * a < percent * (a + 1) and 100 * (a - 1) < percent * a:
                    continue
                digest = xxhash.xxh3_128_digest(s.tobytes())
                if digest in seen:
                    continue
                seen.add(digest)
                often = frequency[bucket(s)]
                first = a - -(-percent * a // 100) + 1
                order = np.argsort(often, kind="stable")[:first]
                salts = 1 + often[order] // SALT_ROWS
                own = np.uint64(xxhash.xxh3_64_intdigest(doc.to_bytes(8, "little", signed=True)))
                parts.append((s[order].view(np.int64), ((own % salts.astype(np.uint64)).astype(np.int32) + (salts > 1)).astype(np.int32),
                              np.full(first, doc), np.full(first, a, np.int32), np.arange(1, first + 1, dtype=np.int32)))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)],
                                                 names=["key", "salt", "doc", "size", "position"])

    return documents.mapInArrow(run, ENTRY)


def allowed(size: np.ndarray, position: np.ndarray, size2, position2, percent: int) -> np.ndarray:
    """Whether entries of one shingle may belong to similar sets, by size and position."""
    o = needed(size, size2, percent)
    return (position <= size - o + 1) & (position2 <= size2 - o + 1)


def small_tile_pairs(tile, doc, size, position, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Different pairs of small tiles that may be similar; ``tile`` numbers the tiles, rows of one are adjacent."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for step in range(1, min(SMALL_TILE, len(tile))):
        i = np.flatnonzero(tile[:-step] == tile[step:])
        if not len(i):
            break
        j = i + step
        ok = allowed(size[i], position[i], size[j], position[j], percent) & (doc[i] != doc[j])
        left.append(doc[i[ok]])
        right.append(doc[j[ok]])
    a, b = np.concatenate(left), np.concatenate(right)
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[:len(a)]
    return a[new], b[new]


def tile_stars(doc, size, position, percent: int):
    """Links of each size band to its pivot, the document with the earliest position; and the pivots."""
    order = np.lexsort((doc, position, size))
    doc, size, position = doc[order], size[order], position[order]
    left, right, pivots, begin = [], [], [], 0
    while begin < len(doc):
        end = int(np.searchsorted(size, 100 * size[begin] // percent, side="right"))
        p = begin + int(np.lexsort((doc[begin:end], position[begin:end]))[0])
        band = slice(begin, end)
        ok = allowed(size[band], position[band], size[p], position[p], percent) & (doc[band] != doc[p])
        left.append(doc[band][ok])
        right.append(np.full(int(ok.sum()), doc[p]))
        pivots.append(order[p])
        begin = end
    return np.concatenate(left), np.concatenate(right), np.array(pivots, int)


# kind 0: candidate pair (doc, other); 1: entry of a large tile; 2: pivot of a part of a tile
FOUND = "kind int, key long, doc long, other long, size int, position int"


def compare_tiles(entries: DataFrame, percent: int, again: bool = False) -> DataFrame:
    """Candidate pairs of small tiles, star links, entries and pivots of large ones."""
    def rows(kind: int, key, doc, other=None, size=None, position=None) -> pa.RecordBatch:
        n = len(doc)
        zero = np.zeros(n, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, key, np.int64)), pa.array(doc),
             pa.array(zero if other is None else other), pa.array((zero if size is None else size).astype(np.int32)),
             pa.array((zero if position is None else position).astype(np.int32))],
            names=["kind", "key", "doc", "other", "size", "position"])

    def large_tile(key, salt, doc, size, position) -> Iterator[pa.RecordBatch]:
        a, b, pivots = tile_stars(doc, size, position, percent)
        yield rows(0, key, a, b)
        if not again:
            yield rows(1, key, doc, None, size, position)
        if salt:
            yield rows(2, key, doc[pivots], None, size[pivots], position[pivots])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            """Everything held but, while more may come, the tile at the end."""
            nonlocal held, many
            cols = [np.concatenate(c).astype(np.int64) for c in zip(*held, strict=True)]
            first = np.flatnonzero(np.concatenate([[True], (np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0)]))
            rows_each = np.diff(np.append(first, len(cols[0])))
            tile = np.repeat(np.arange(len(first)), rows_each)
            ready = np.ones(len(first), bool)
            ready[-1] = last
            small = ready & (rows_each <= SMALL_TILE) & (cols[1][first] == 0)
            own = small[tile] & (rows_each[tile] > 1)
            out = [rows(0, 0, *small_tile_pairs(tile[own], *(c[own] for c in cols[2:]), percent))]
            for k in np.flatnonzero(ready & ~small).tolist():
                part = slice(first[k], first[k] + rows_each[k])
                out += large_tile(cols[0][first[k]], cols[1][first[k]], *(c[part] for c in cols[2:]))
            out = [x for x in out if x.num_rows]
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
            held = [] if last else [tuple(c[first[-1]:] for c in cols)]
            many = 0 if last else int(rows_each[-1])

        grown = FLUSH_ROWS
        for batch in batches:
            if batch.num_rows:
                held.append(tuple(batch.column(c).to_numpy() for c in ("key", "salt", "doc", "size", "position")))
                many += batch.num_rows
            if many >= grown:
                yield from flush(False)
                grown = many + FLUSH_ROWS
        if held:
            yield from flush(True)

    return (entries.repartition("key", "salt").sortWithinPartitions("key", "salt")
            .mapInArrow(run, FOUND))


def bitmap_filter(pairs: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose bitmaps leave enough overlap possible."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("n", "m", "x", "y")), strict=True):
                size = min(len(x), len(y))
                keep.append(bool(may_overlap(n, m, folded(x, size), folded(y, size)) >= needed(n, m, percent)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = signs.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n"), F.col("bitmap").alias("x"))
    right = signs.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("m"), F.col("bitmap").alias("y"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def exact_links(pairs: DataFrame, documents: DataFrame, n: int, percent: int) -> DataFrame:
    """Of stored pairs (a, b), those whose shingle sets are similar enough.

    Texts go to the pairs in one join; a document that many are compared with (a) is copied once
    per ``MEMBERS`` of them, so no task gets all pairs of one document.
    """
    salts = stored(pairs.groupBy("a").count().select("a", (1 + F.col("count") / MEMBERS).cast("int").alias("salts")), "salts")
    salted = pairs.join(salts, "a").select("a", F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"), "b")
    wanted = (salts.select(F.col("a").alias("doc_id"), "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                           F.lit(0).alias("member"))
              .union(salted.select(F.col("b").alias("doc_id"), "a", "salt", F.lit(1).alias("member"))))
    texts = documents.join(wanted, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, group, pivot = WordHashes(), None, None
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "a", "salt", "member")]
            for doc, a, salt, member, text in zip(*columns, as_bytes(batch.column("text")), strict=True):
                s = shingles(text, n, hashes)
                if not member:
                    group, pivot = (a, salt), s
                elif group == (a, salt):
                    both = len(np.intersect1d(pivot, s, assume_unique=True))
                    if both and 100 * both >= percent * (len(pivot) + len(s) - both):
                        found.append((a, doc))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    return (texts.select("doc_id", "a", "salt", "member", "text").repartition("a", "salt")
            .sortWithinPartitions("a", "salt", "member").mapInArrow(run, "a long, b long"))


def pairs_across(large: DataFrame, known: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """Pairs in large tiles whose documents the links so far leave in different components.

    Blocks of a tile meet each other, and rows of a block's most common component meet only the
    others; positions, sizes and bitmaps must allow the overlap.
    """
    entries = stored(large.join(known, large.doc == known.id, "left").select(
        "key", "doc", "size", "position", F.coalesce("component", "doc").alias("component")), "tiles")
    mixed_keys = (entries.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
                  .where("lo <> hi").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    mixed_keys = stored(mixed_keys, "mixed")
    own = F.pmod(F.xxhash64("doc"), "blocks").cast("int")
    rows = (entries.join(mixed_keys, "key").join(signs.select(F.col("doc_id").alias("doc"), "bitmap"), "doc")
            .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own",
                    "doc", "size", "position", "component", "bitmap"))

    def block(key: tuple, table: pa.Table) -> pa.Table:
        _, lo, hi = (x.as_py() for x in key)
        doc, size, position, component, own = (
            table.column(c).to_numpy().astype(np.int64) for c in ("doc", "size", "position", "component", "own"))
        maps = table.column("bitmap").to_pylist()
        values, count = np.unique(component, return_counts=True)
        rare = np.flatnonzero(component != values[count.argmax()])
        left, right = [], []
        for i in rare.tolist():
            ok = (component != component[i]) & allowed(size, position, size[i], position[i], percent)
            if lo != hi:
                ok &= own != own[i]
            for j in np.flatnonzero(ok).tolist():
                width = min(len(maps[i]), len(maps[j]))
                if may_overlap(size[i], size[j], folded(maps[i], width), folded(maps[j], width)) >= needed(size[i], size[j], percent):
                    left.append(min(doc[i], doc[j]))
                    right.append(max(doc[i], doc[j]))
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return rows.groupBy("key", "lo", "hi").applyInArrow(block, "a long, b long").distinct()


def differing_ids(signs: DataFrame) -> bool:
    """Whether some doc_id stands on texts of different shingle sets."""
    differ = (F.min("digest") != F.max("digest")) | (F.min("n_shingles") != F.max("n_shingles"))
    return bool(signs.where("doc_id is not null").groupBy("doc_id").agg(differ.alias("differ")).where("differ").limit(1).count())


def similarity_classes(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Two documents are linked
    when 100 * intersection >= percent * union of their sets of n-word shingles. The component id
    is the smallest doc_id reachable by links. Null and empty texts have no shingles and no links;
    rows with a null doc_id neither; repeated doc_ids share a component, whatever their texts.
    ``n_links`` counts the links verified for the document, or for its text where texts of one id
    differ, not those that follow from equal sets. An empty table gives no rows.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signs = stored(signatures(docs, n), "signatures")
    if not differing_ids(signs):
        return linked_classes(docs, signs, n, percent)
    rows = stored(text_classes(docs, n, percent), "classes")
    firsts = rows.where("doc_id is not null").groupBy("component").agg(F.min("doc_id").alias("first"))
    same = rows.join(firsts, "component").where("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b")).distinct()
    known = components(stored(same, "same"))
    return (rows.join(known.withColumnRenamed("component", "known"), F.col("doc_id") == F.col("id"), "left")
            .select("doc_id", "n_shingles", F.coalesce("known", "doc_id").alias("component_id"), "n_links"))


def text_classes(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, row_key, n_shingles, component, n_links) of every row, each text of an id by itself.

    ``row_key`` is a hash of id and text, null with the id; ``component`` is the smallest reachable
    row_key.
    """
    keyed = docs.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")).alias("row_key"), "text")
    by_key = keyed.select(F.col("row_key").alias("doc_id"), "text")
    found = linked_classes(by_key, stored(signatures(by_key, n), "signatures"), n, percent)
    found = found.where("doc_id is not null").dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "key")   # equal rows
    without = signatures(docs.where("doc_id is null"), n).select(
        "doc_id", F.lit(None).cast("long").alias("row_key"), "n_shingles", F.lit(None).cast("long").alias("component"),
        F.lit(0).cast("long").alias("n_links"))
    return (keyed.where("doc_id is not null").select("doc_id", "row_key").join(found, F.col("row_key") == F.col("key"))
            .select("doc_id", "row_key", "n_shingles", F.col("component_id").alias("component"), "n_links").union(without))


def linked_classes(docs: DataFrame, signs: DataFrame, n: int, percent: int) -> DataFrame:
    """``similarity_classes`` where rows of one id have equal shingle sets."""
    spark = docs.sparkSession
    counts = spark.sparkContext.broadcast(sketch(docs, n))
    found = stored(compare_tiles(tile_entries(docs, n, percent, counts), percent), "tiles")
    pivots = found.where("kind = 2").select("key", F.lit(0).alias("salt"), "doc", "size", "position")
    more = stored(compare_tiles(pivots, percent, again=True), "pivots")

    def distinct_pairs(df: DataFrame) -> DataFrame:
        return df.where("kind = 0").select("doc", "other").distinct()

    # the pivot stays on the left, so that its text is shared by its links
    pairs = distinct_pairs(found).union(distinct_pairs(more)).distinct().select(F.col("other").alias("a"), F.col("doc").alias("b"))
    one_sign = signs.where("doc_id is not null and n_shingles > 0").dropDuplicates(["doc_id"])
    links = stored(exact_links(stored(bitmap_filter(pairs, one_sign, percent), "pairs"), docs, n, percent), "links")
    equal = stored(signs.where("n_shingles > 0 and doc_id is not null").groupBy("digest")
                   .agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "equal")
    copies = signs.join(equal, "digest").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    known = stored(components(links.union(copies)), "classes")
    across = stored(pairs_across(found.where("kind = 1"), known, one_sign, percent), "pairs")
    late = stored(exact_links(across, docs, n, percent), "links")
    if late.limit(1).count():
        known = stored(components(late.union(known.select(F.col("id").alias("a"), F.col("component").alias("b")))
                                  .union(links)), "classes")
    both = links.union(late).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    degree = both.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n_links"))
    marks = known.join(degree, "id", "full")
    return (signs.select("doc_id", "n_shingles").join(marks, F.col("doc_id") == F.col("id"), "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
