import numpy as np
import pytest
from pyspark.sql import functions as F

from skytally.llm import ann
from skytally.llm.queries import op1_nearest_neighbours
from tests.llm.conftest import SF_DIR


def plain(ids, x, query, k):
    d = np.sqrt(((x - x[query]) ** 2).sum(1))
    d[query] = np.inf
    best = np.lexsort((ids, d))[:min(k, len(ids) - 1)]
    return [(int(ids[j]), d[j]) for j in best]


def test_recall_of_the_query(spark, tables):
    rows = tables.sql("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(float)
    got = {}
    for r in op1_nearest_neighbours(spark, SF_DIR).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {i for i in ids.tolist() if i % 100 == 0}
    hits = 0
    for q in np.flatnonzero(ids % 100 == 0):
        want = plain(ids, x, q, 10)
        hits += len({i for i, _ in want} & {i for i, _ in got[ids[q]]})
        assert got[ids[q]] == sorted(got[ids[q]], key=lambda p: (p[1], p[0]))
    assert hits >= 9 * len(got)


@pytest.mark.parametrize("block", [64, 1024])
def test_recall_with_many_lists_and_a_hot_vector(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "LIST_ROWS", 20)
    monkeypatch.setattr(ann, "BLOCK", block)
    rng = np.random.default_rng(0)
    x = (rng.normal(size=(3000, 16)) + 3 * rng.normal(size=(12, 16))[rng.integers(0, 12, 3000)]).astype(np.float32)
    x[::3] = x[0]                                   # a third of all rows are one vector
    ids = np.arange(3000) * 2
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        want = plain(ids, x.astype(float), q, 10)
        hits, total = hits + len({i for i, _ in want} & {i for i, _ in got[ids[q]]}), total + 10
        if q % 3 == 0:
            assert got[ids[q]] == want              # ties to the smallest ids
    assert hits >= 0.9 * total


def test_graph_search_finds_what_a_full_scan_finds():
    rng = np.random.default_rng(1)
    c, x = rng.normal(size=(500, 12)).astype(np.float32), rng.normal(size=(200, 12)).astype(np.float32)
    found, dist = ann.CentroidGraph(c).search(x, 10)
    want = np.argsort(ann.squared(x, c), 1)[:, :10]
    assert np.mean([len(set(a) & set(b)) for a, b in zip(found, want, strict=True)]) > 9.5
    assert (np.diff(dist, axis=1) >= 0).all()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0]), (100, [1.0, 0.0]), (200, None), (300, [0.0, 0.0]), (400, [nan, 1.0]),
            (500, [inf, 1.0]), (600, [None, 1.0]), (None, [1.0, 1.0]), (700, []), (800, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    got = sorted(tuple(r) for r in ann.nearest(df, F.col("vec_id") % 100 == 0).collect())
    assert [(q, k, v) for q, k, v, _ in got] == [(0, 1, 100), (0, 2, 1), (100, 1, 0), (100, 2, 1)]
    assert [s for *_, s in got] == [0.0, 2 ** 0.5, 0.0, 2 ** 0.5]
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0
