"""Plans and skew: what must hold when the tables are large."""

from __future__ import annotations

import glob
import os
import random
from collections import Counter

import pytest
from tests.conftest import RUN_TS
from pyspark.sql import functions as F

from checks.queries import QUERIES
from skytally.layout import Lake
from skytally.operators import kpis
from skytally.operators.dimensions import airports_of_facts
from skytally.operators.enrich import fill_from_dimensions
from skytally.operators.pick import latest_per_flight
from skytally.operators.profile import dimension_cardinality
from skytally.operators.quality import flag_counts, flag_quality
from skytally.plans.silver import silver_fact
from skytally.sinks.lake import label_hours, write_bronze

SF = "/root/testdata/sf0.001"

needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot(spark):
    """20,000 observations; one flight, route, airline and type holds a third of them."""
    rng = random.Random(7)
    names = ["flight_id", "seq", "airline_icao", "aircraft_code", "origin_iata", "destination_iata",
             "altitude"]
    rows = []
    for i in range(20_000):
        if i % 3 == 0:
            rows.append(("HOT", i, "DAL", "B738", "JFK", "LAX", 100.0))
        else:
            rows.append((f"F{rng.randrange(4000)}", i, f"A{rng.randrange(30)}",
                         f"{rng.choice('ABE')}{rng.randrange(9)}", f"O{rng.randrange(20)}",
                         f"O{rng.randrange(20)}", rng.choice([100.0, -1.0, None])))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, names).repartition(8)
    return rows, df.withColumns({
        "extraction_timestamp": F.timestamp_seconds(F.col("seq")), "on_ground": F.lit(0),
        "latitude": F.lit(1.0), "longitude": F.lit(1.0), "ground_speed": F.lit(1.0),
    })


def test_hot_flight_is_reduced_before_the_shuffle(hot):
    rows, df = hot
    latest = latest_per_flight(df, tie_break=["seq"])
    plan = plan_of(latest)
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    newest = {}
    for r in rows:
        newest[r[0]] = max(newest.get(r[0], -1), r[1])
    assert {r.flight_id: r.seq for r in latest.collect()} == newest


def test_hot_keys_do_not_change_counts(hot):
    rows, df = hot
    flagged = flag_quality(df)
    assert {r.flag: r["count"] for r in flag_counts(flagged).collect()} == {
        "INVALID_ALTITUDE": sum(r[6] != 100.0 for r in rows)}
    counts = dimension_cardinality(flagged).first()
    assert counts.unique_airlines == len({r[2] for r in rows})
    assert counts.unique_aircraft == len({r[3] for r in rows})
    assert counts.unique_airports == len({r[4] for r in rows} | {r[5] for r in rows})

    valid = [r for r in rows if r[6] == 100.0]
    facts = flagged.withColumn("airline_name", F.lit("x"))
    top = kpis.airline_volumes(facts, RUN_TS).first()
    assert (top.airline_icao, top.active_flights_count) == Counter(r[2] for r in valid).most_common(1)[0]
    balance = Counter(r[4] for r in valid)
    balance.subtract(Counter(r[5] for r in valid))
    airport, imbalance = min(balance.items(), key=lambda kv: (-abs(kv[1]), kv[0]))
    row = kpis.airport_imbalance(facts, RUN_TS).first()
    assert (row.airport_iata, row.imbalance) == (airport, imbalance)


def test_cardinality_estimate_is_close(hot):
    rows, df = hot
    row = dimension_cardinality(df, approximate=True).first()
    assert row.unique_airlines == pytest.approx(len({r[2] for r in rows}), rel=0.1)


def test_aggregations_combine_before_the_shuffle(hot):
    _, df = hot
    facts = flag_quality(df).withColumn("airline_name", F.lit("x"))
    plan = plan_of(kpis.airline_volumes(facts, RUN_TS))
    assert "TakeOrderedAndProject" in plan
    assert plan.index("Exchange") < plan.index("partial_count")
    assert plan_of(kpis.airport_imbalance(facts, RUN_TS)).count("Scan ExistingRDD") == 1


def test_dimensions_of_facts_scan_the_fact_once(observations):
    plan = plan_of(airports_of_facts(silver_fact(flag_quality(observations())), RUN_TS))
    assert plan.count("Scan ExistingRDD") == 1
    assert plan.count("WindowGroupLimit") == 4


def test_dimension_joins_broadcast_by_size_and_fall_back(spark, observations):
    dims = spark.sql("SELECT * FROM VALUES ('AFR', 'Air France') AS t(airline_icao, airline_name)")
    facts = observations({"airline_icao": "AFR"}, {"airline_icao": None})

    def filled(limit):
        return fill_from_dimensions(facts, airlines=dims, broadcast_limit=limit).select(
            "airline_icao", "airline_name")

    assert "BroadcastHashJoin" in plan_of(filled(1000))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        assert "SortMergeJoin" in plan_of(filled(10))
        assert sorted(map(tuple, filled(10).collect()), key=str) == [
            ("AFR", "Air France"), (None, None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@needs_data
@pytest.mark.parametrize("name", [
    "quality_profile", "flag_counts", "dedup_latest", "silver_fact", "union_zones", "dedup_zones",
    "build_dim_airports", "dimension_cardinality", *kpis.KPIS,
])
def test_plans_hold_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Exchange SinglePartition, REP"):
        assert bad not in plan


@needs_data
def test_scans_read_only_needed_columns(spark):
    plan = plan_of(QUERIES["partition_labels"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_shipdate" in plan
    plan = plan_of(QUERIES["dedup_latest"](spark, SF))
    assert "orders.parquet" not in plan


@needs_data
def test_kpi_joins_follow_the_deduplication(spark):
    """The join with the orders reuses the partitioning of the de-duplication."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = plan_of(QUERIES["kpi_airport_imbalance"](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1


def test_large_dimensions_join_shuffled_with_hot_keys_split(spark):
    """Beyond the broadcast limit a key holding most facts is spread over several tasks."""
    dims = spark.range(2000).select(
        F.concat(F.lit("A"), "id").alias("airline_icao"), F.concat(F.lit("N"), "id").alias("airline_name"))
    facts = spark.range(0, 300_000, 1, 8).select(
        "id", F.when(F.col("id") % 3 > 0, "A7").otherwise(F.concat(F.lit("A"), F.col("id") % 2500))
        .alias("airline_icao"),
        F.lit(None).cast("string").alias("airline_name"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200kb",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200kb",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        filled = fill_from_dimensions(facts, airlines=dims, broadcast_limit=0)
        counts = filled.groupBy((F.col("airline_name") == "N7").alias("hot")).agg(
            F.count("*").alias("count"), F.max("pad"))
        assert {r.hot: r["count"] for r in counts.collect()} == {True: 200_040, False: 79_960, None: 20_000}
        assert "SortMergeJoin(skew=true)" in plan_of(counts)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_large_hour_is_written_by_several_tasks(spark, tmp_path, observations):
    """Rebalancing gathers small hours into one file and splits one that holds most rows.

    A small hour may share the hash partition of the large one and is then split with it.
    """
    lake = Lake(str(tmp_path))
    rows = spark.range(0, 120_000, 1, 6).select(
        F.sha2(F.col("id").cast("string"), 256).alias("flight_id"),
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 5).alias("hour"))
    at = F.timestamp_add("HOUR", F.col("hour").cast("int"), F.lit(RUN_TS))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1mb")
        write_bronze(label_hours(rows, at), lake, many_hours=True)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = Counter(p.split("tech_hour=")[1][:2] for p in glob.glob(f"{lake.bronze}/*/*/*/*/attempt=*/*.parquet"))
    assert files["14"] > 1
    assert Counter(n for hour, n in files.items() if hour != "14")[1] >= 3
    assert spark.read.parquet(lake.bronze).count() == 120_000
