"""What keeps whole rows out of shuffles: thinned picks, gathered writes, broadcast attribute tables."""

from __future__ import annotations

import glob
import random
from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from tests.conftest import RUN_TS
from tests.test_scale import SF, needs_data, plan_of

from checks import bridge
from checks.queries import QUERIES
from skytally.layout import Lake
from skytally.operators.pick import latest_per_flight, newest_rows
from skytally.sinks.lake import label_hours, write_bronze
from skytally.sources.lake import read_bronze


@pytest.fixture
def stored_rows(spark, tmp_path):
    """4,000 observations in several files: ties, whole duplicates, flights and instants without value."""
    rng = random.Random(3)
    rows = [(rng.choice([None, *(f"F{i}" for i in range(300))]), rng.choice([None, *range(6)]),
             rng.choice(["a", "b", None]), rng.random() < 0.5) for _ in range(4000)]
    df = spark.createDataFrame(rows, "flight_id string, seq int, note string, flag boolean")
    df = df.select("flight_id", F.timestamp_seconds("seq").alias("extraction_timestamp"), "note", "flag")
    df.repartition(7).write.parquet(f"{tmp_path}/t")
    return spark.read.parquet(f"{tmp_path}/t")


def test_latest_of_a_stored_table_is_the_same(stored_rows, rows_of):
    columns = stored_rows.columns
    plain, thinned = latest_per_flight(stored_rows), latest_per_flight(stored_rows, stored=True)
    assert thinned.columns == columns
    assert rows_of(thinned, *columns) == rows_of(plain, *columns)
    assert len(rows_of(plain, *columns)) == 301
    assert rows_of(latest_per_flight(stored_rows.where("flag").drop("flag"), stored=True), "flight_id", "note") == rows_of(
        latest_per_flight(stored_rows.where("flag").drop("flag")), "flight_id", "note")


def test_newest_rows_keep_all_equal_ones(stored_rows):
    newest = {}
    for r in stored_rows.collect():
        at = r.extraction_timestamp
        held = newest.setdefault(r.flight_id, [])
        if not held or (at is not None and (held[0].extraction_timestamp is None or at > held[0].extraction_timestamp)):
            newest[r.flight_id] = [r]
        elif at == held[0].extraction_timestamp:
            held.append(r)
    wanted = Counter(tuple(r) for held in newest.values() for r in held)
    assert Counter(map(tuple, newest_rows(stored_rows, "flight_id", "extraction_timestamp").collect())) == wanted


def test_rows_without_a_place_are_picked_as_they_are(observations):
    rows = observations({"altitude": 1.0}, {"altitude": 2.0})
    assert [r.altitude for r in latest_per_flight(rows, stored=True).collect()] == [2.0]


@needs_data
def test_a_replay_thins_out_before_whole_rows_are_sorted(spark):
    plan = plan_of(QUERIES["replay_bronze"](spark, SF))
    assert "bitmap_construct_agg" in plan
    # the narrow look at places and the pick among what is left
    assert plan.count("WindowGroupLimit") == 4


@needs_data
def test_attribute_tables_do_not_shuffle_the_observations(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = plan_of(bridge.feed(spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning(l_") == 1
    assert "Exchange hashpartitioning(o_custkey" not in plan


def test_gathered_hours_are_written_as_they_lie(spark, tmp_path, observations, rows_of):
    hours = [RUN_TS + timedelta(hours=h) for h in range(6)]
    rows = observations(*({"flight_id": f"V{i}", "extraction_timestamp": at} for at in hours for i in range(4)))
    rows = label_hours(rows, F.col("extraction_timestamp"))
    lake = Lake(str(tmp_path))
    write_bronze(rows, lake, many_hours=True, batch_id="b1")
    write_bronze(read_bronze(spark, lake).withColumn("batch_id", F.lit("b2")), lake, many_hours=True, batch_id="b2", gathered=True)
    files = Counter(p.split("/attempt=")[0] + p.split("/attempt=")[1][:32]
                    for p in glob.glob(f"{lake.bronze}/*/*/*/*/attempt=*/*.parquet"))
    assert len(files) == 12 and set(files.values()) == {1}
    both = read_bronze(spark, lake)
    assert rows_of(both.where("batch_id = 'b2'"), "flight_id", "extraction_timestamp", "tech_hour") == rows_of(
        both.where("batch_id = 'b1'"), "flight_id", "extraction_timestamp", "tech_hour")
    assert both.count() == 48


@needs_data
def test_large_parts_are_joined_before_the_orders(spark, monkeypatch, rows_of):
    columns = ("flight_id", "aircraft_code", "destination_iata")
    small = rows_of(bridge.feed(spark, SF, columns), *columns)
    monkeypatch.setattr(bridge, "BROADCAST_LIMIT_BYTES", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = bridge.feed(spark, SF, columns)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("o_orderkey#") < plan.index("p_partkey#")
        assert rows_of(bridge.feed(spark, SF, columns), *columns) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@needs_data
def test_a_load_thins_out_stored_bronze(spark, tmp_path, observations, monkeypatch):
    """Silver of a replay looks at whole rows only where they are the newest of their flight."""
    from skytally.plans import batch

    seen = []
    pick = batch.silver_fact
    monkeypatch.setattr(batch, "silver_fact", lambda *a, **k: seen.append(pick(*a, **k)) or seen[-1])
    lake = Lake(str(tmp_path))
    rows = observations({"altitude": 1.0}, {"altitude": 2.0, "extraction_timestamp": RUN_TS + timedelta(hours=1)})
    from skytally.operators.quality import flag_quality
    write_bronze(label_hours(flag_quality(rows), F.col("extraction_timestamp")), lake, many_hours=True)
    loaded = batch.replay(spark, lake, RUN_TS)
    assert "bitmap_construct_agg" in plan_of(seen[0])
    assert [r.altitude for r in loaded.silver.collect()] == [2.0]
