"""What the landed feed takes on disk."""

from __future__ import annotations

import glob
import os
import random
from collections import Counter

import pytest
from tests.conftest import RUN_TS

from checks import bridge
from checks.queries import INGEST_COLUMNS, QUERIES, portable
from skytally.sources import feed as feeds


@pytest.fixture
def tables(spark, tmp_path):
    """4,000 observations: a third of one flight, whole duplicates, keys without value or row."""
    rng, path = random.Random(5), f"{tmp_path}/tables"

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}.parquet")

    def key(n):
        return rng.choice([None, *range(n)])

    rows = [(7 if i % 3 == 0 else key(900), key(200), key(30), rng.randrange(1, 8), float(rng.randrange(1, 50)), rng.randrange(10**6) / 100,
             rng.choice("NRA"), rng.choice("OF")) for i in range(3600)]
    write("lineitem", rows + rows[:400], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                         "l_extendedprice double, l_returnflag string, l_linestatus string")
    write("orders", [(i, key(100)) for i in range(800)], "o_orderkey long, o_custkey long")
    write("customer", [(i, i % 25) for i in range(90)], "c_custkey long, c_nationkey int")
    write("supplier", [(i, i % 25) for i in range(25)], "s_suppkey long, s_nationkey int")
    write("part", [(i, f"Brand#{i % 25 + 1}") for i in range(180)], "p_partkey long, p_brand string")
    return path


def test_the_landed_feed_is_compressed_and_whole(spark, tables, tmp_path, monkeypatch, rows_of):
    monkeypatch.setattr(bridge, "scratch_path", lambda spark, purpose: f"{tmp_path}/{purpose}")
    monkeypatch.setattr(bridge, "FEED_FILE_RECORDS", 500, raising=False)
    staged = QUERIES["ingest_staged"](spark, tables)
    lines = bridge.landed_feed_lines(spark, tables)
    texts = [r.value for r in lines.collect()]
    files = glob.glob(f"{tmp_path}/feed/part-*")
    assert len(texts) == 4000
    assert 4 * sum(map(os.path.getsize, files)) < sum(len(t) + 1 for t in texts)
    landed = [[r.value for r in spark.read.text(f).collect()] for f in files]
    assert max(map(len, landed)) <= 500  # a file is read by one task
    assert Counter(t for part in landed for t in part) == Counter(texts)
    lines.write.text(f"{tmp_path}/plain")
    plain = portable(feeds.to_observations(feeds.read_feed(spark, f"{tmp_path}/plain"), RUN_TS, "B1").select(*INGEST_COLUMNS))
    assert rows_of(staged, *INGEST_COLUMNS) == rows_of(plain, *INGEST_COLUMNS)
    assert len(rows_of(plain, *INGEST_COLUMNS)) > 3000
