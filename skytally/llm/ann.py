"""Approximate nearest neighbours over balanced posting lists.

Centroids are fitted to a bounded sample, with a charge on crowded ones so that the lists stay
balanced. Every vector stands in the list of its nearest centroid and, near a boundary, in those
almost as near. Centroids, at most ``MAX_LISTS``, travel with a neighbour graph that tasks search
best first in memory; a query reads the lists whose centroid is within a ratio of the nearest.
Lists and their queries meet in blocks, so that neither a long list nor a sought-after one lands
in one task. Equal vectors are one point with its smallest ids, which is all that an answer needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.common import prepare, stored

SAMPLE_ROWS = 20_000      # vectors the centroids are fitted to
LIST_ROWS = 128           # vectors per list aimed at
MAX_LISTS = 2_048         # lists grow in blocks beyond
FIT_ROUNDS = 8
CROWDING = 0.3            # charge for a list twice the mean size, in mean squared distances
DEGREE = 24               # neighbours of a centroid in the graph
ENTRIES = 16              # centroids a search starts from
BEAM = 64                 # centroids a search keeps
REPLICAS = 4              # lists a vector may stand in
BOUNDARY = 1.08           # ... while their centroids are this many times as far as the nearest
LEAST_LISTS = 24          # lists a query reads at least
MOST_LISTS = 64           # width of the search; the ratio selects within
SEARCH_RATIO = 1.15
BLOCK = 1024              # vectors, and queries, that meet at once


def valid(df: DataFrame, ids: str, vectors: str) -> DataFrame:
    """(vec_id, vector) of rows that take part: finite, not zero, not null, of a known id."""
    v = F.col(vectors).cast("array<float>")
    fine = (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) \
        & F.exists(v, lambda x: x != 0)
    return df.where(F.col(ids).isNotNull() & F.col(vectors).isNotNull()).select(
        F.col(ids).cast("long").alias("vec_id"), v.alias("vector"), fine.alias("fine")).where("fine").drop("fine")


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)


def fit_centroids(sample: np.ndarray, n: int, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Balanced k-means: the charge on a list grows with its share in the round before."""
    rng = np.random.default_rng(0)
    n = min(n, len(sample))
    c = sample[rng.permutation(len(sample))[:n]].copy()
    charge = np.zeros(n, sample.dtype)
    for _ in range(rounds):
        owner = np.empty(len(sample), int)
        spread = 0.0
        for i in range(0, len(sample), 2048):
            d = squared(sample[i:i + 2048], c)
            owner[i:i + 2048] = (d + charge).argmin(1)
            spread += float(d.min(1).sum())
        count = np.bincount(owner, minlength=n)
        total = np.zeros_like(c)
        np.add.at(total, owner, sample)
        c = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], c)
        charge = (CROWDING * spread / len(sample) * (count / count.mean() - 1)).astype(sample.dtype)
    return c


class CentroidGraph:
    """Centroids and their nearest neighbours; batches of vectors are searched together."""

    def __init__(self, centroids: np.ndarray):
        self.c = centroids
        n = len(centroids)
        k = min(DEGREE, n - 1)
        self.next = np.zeros((n, k), np.int64)
        for i in range(0, n, 1024):
            d = squared(centroids[i:i + 1024], centroids)
            d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
            self.next[i:i + 1024] = np.argsort(d, 1, kind="stable")[:, :k]
        # entries spread out: each the farthest from those before
        entry, far = [0], squared(centroids, centroids[:1])[:, 0]
        while len(entry) < min(ENTRIES, n):
            entry.append(int(far.argmax()))
            far = np.minimum(far, squared(centroids, centroids[entry[-1:]])[:, 0])
        self.entry = np.array(entry)

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) of the ``width`` nearest found per row, nearest first; -1 pads."""
        n, b = len(self.c), len(x)
        width, beam = min(width, n), min(max(BEAM, width), n)
        seen = np.zeros((b, n), bool)
        rows = np.arange(b)
        ids = np.tile(self.entry, (b, 1))
        dist = squared(x, self.c[self.entry])
        seen[:, self.entry] = True
        done = np.zeros(ids.shape, bool)
        while True:
            todo = np.where(done, np.inf, dist)
            pick = np.argsort(todo, 1)[:, :4]
            live = np.isfinite(np.take_along_axis(todo, pick, 1))
            if not live.any():
                break
            done[rows[:, None], pick] = True
            near = self.next[np.take_along_axis(ids, pick, 1)].reshape(b, -1)
            fresh = ~np.take_along_axis(seen, near, 1) & np.repeat(live, self.next.shape[1], 1)
            order = np.sort(np.where(fresh, near, n), 1)     # the same centroid by two ways counts once
            fresh = (order < n) & np.concatenate([np.ones((b, 1), bool), order[:, 1:] != order[:, :-1]], 1)
            near = np.where(fresh, order, 0)
            seen[rows[:, None].repeat(near.shape[1], 1)[fresh], near[fresh]] = True
            gap = self.c[near] - x[:, None, :]
            d = np.where(fresh, np.einsum("bkd,bkd->bk", gap, gap), np.inf)
            ids, dist = np.concatenate([ids, near], 1), np.concatenate([dist, d], 1)
            done = np.concatenate([done, ~fresh], 1)
            keep = np.argsort(dist, 1, kind="stable")[:, :beam]
            ids, dist, done = (np.take_along_axis(a, keep, 1) for a in (ids, dist, done))
        ids, dist = ids[:, :width], dist[:, :width]
        return np.where(np.isfinite(dist), ids, -1), np.sqrt(dist)


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float32)


def assign(points: DataFrame, graph, least: int, most: int, ratio: float) -> DataFrame:
    """Each point once per list: the nearest ``least``, and up to ``most`` within the ratio."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, dist = graph.value.search(matrix(batch.column("vector")), most)
            ok = (ids >= 0) & ((dist <= ratio * dist[:, :1]) | (np.arange(ids.shape[1]) < least))
            row, place = np.nonzero(ok)
            yield pa.RecordBatch.from_arrays(
                [batch.column("point").take(pa.array(row)), batch.column("vector").take(pa.array(row)),
                 pa.array(ids[row, place].astype(np.int32))], names=["point", "vector", "list"])

    return points.select("point", "vector").mapInArrow(run, "point long, vector array<float>, list int")


def blocked(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their block within their list, and the number of blocks per list (at most MAX_LISTS rows)."""
    blocks = stored(df.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(f"{name}s")), "blocks")
    return df.join(F.broadcast(blocks), "list").withColumn(
        name, F.pmod(F.xxhash64("point"), f"{name}s").cast("int")).drop(f"{name}s"), blocks


def nearest(table: DataFrame, query_rows, k: int = 10, ids: str = "vec_id", vectors: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row meeting ``query_rows``, its ``k`` nearest found.

    ``query_rows`` is a condition on vec_id. Score is the Euclidean distance in double precision of
    the original vectors; ties go to the smaller id; a query never finds its own id. Vectors that
    are null, zero, hold null or non-finite components, or have another dimension than most of
    the sample take no part. Repeated rows count once; with fewer than ``k`` others all are
    found; an empty table gives no rows; other columns are ignored.
    """
    spark = prepare(table.sparkSession)
    rows = valid(table, ids, vectors)
    ranked = rows.distinct().withColumn("n", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id")))
    points = stored(ranked.where(F.col("n") <= k + 1).groupBy("vector")
                    .agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("point", F.xxhash64("vector")), "points")
    sizes = points.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    points = points.where(F.size("vector") == sizes["d"])
    sample = points.orderBy("point").select("vector").limit(SAMPLE_ROWS).toPandas()["vector"]
    lists = max(1, min(MAX_LISTS, sizes["count"] // LIST_ROWS))
    graph = spark.sparkContext.broadcast(CentroidGraph(fit_centroids(np.stack(sample).astype(np.float32), lists)))

    posted, blocks = blocked(stored(assign(points, graph, 1, REPLICAS, BOUNDARY), "postings"), "block")
    asked = rows.where(query_rows).select("vec_id", F.xxhash64("vector").alias("point"), "vector").where(
        F.size("vector") == sizes["d"]).distinct()
    distinct = asked.select("point", "vector").dropDuplicates(["point"])
    queries, query_blocks = blocked(stored(assign(distinct, graph, LEAST_LISTS, MOST_LISTS, SEARCH_RATIO), "queries"), "part")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = posted.join(F.broadcast(query_blocks), "list").select(
        "list", "block", each("parts").alias("part"), F.lit(0).alias("query"), "point", "vector")
    right = queries.join(F.broadcast(blocks), "list").select(
        "list", each("blocks").alias("block"), "part", F.lit(1).alias("query"), "point", "vector")

    def meet(_: tuple, both: pa.Table) -> pa.Table:
        is_query = both.column("query").to_numpy() == 1
        point = both.column("point").to_numpy()
        vector = matrix(both.column("vector").combine_chunks()).astype(np.float64)
        q, p = np.flatnonzero(is_query), np.flatnonzero(~is_query)
        found: list[list[np.ndarray]] = [[], [], []]
        for i in q.tolist() if len(p) else ():
            gap = vector[p] - vector[i]
            d = np.sqrt((gap * gap).sum(1))
            cut = np.partition(d, k)[k] if len(d) > k + 1 else np.inf
            best = np.flatnonzero(d <= cut)       # all ties stay
            found[0].append(np.full(len(best), point[i]))
            found[1].append(point[p[best]])
            found[2].append(d[best])
        return pa.table({n: pa.array(np.concatenate(c) if c else np.zeros(0, t))
                         for n, c, t in zip(("asked", "point", "score"), found, (np.int64, np.int64, float), strict=True)})

    hits = (left.union(right).groupBy("list", "block", "part").applyInArrow(meet, "asked long, point long, score double")
            .distinct())
    order = Window.partitionBy("asked").orderBy("score", "vec_id")
    named = hits.join(points.select("point", "ids"), "point").select("asked", "score", F.explode("ids").alias("vec_id"))
    answers = stored(named.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).groupBy("asked")
                     .agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("found")), "answers")
    own = F.filter("found", lambda x: x["vec_id"] != F.col("query_id"))
    return (asked.select(F.col("vec_id").alias("query_id"), F.col("point").alias("asked")).join(answers, "asked")
            .select("query_id", F.posexplode(F.slice(own, 1, k)).alias("rank", "x"))
            .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score")))
