"""Merging batches into the bucketed state against replaying all of Bronze."""

from __future__ import annotations

import glob
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from skytally.layout import Lake
from skytally.operators.pick import latest_per_flight
from skytally.operators.quality import flag_quality
from skytally.plans import state as states
from skytally.plans.silver import silver_fact
from skytally.plans.state import current_fact, merge_batch, merged, read_state
from skytally.schema import BRONZE
from skytally.sinks.lake import label_hours


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


@pytest.fixture
def batches(observations, run_ts):
    rng = random.Random(5)

    def build(n):
        at = run_ts + timedelta(hours=n)
        rows = [{"flight_id": f"F{rng.randrange(12)}", "extraction_timestamp": run_ts + timedelta(minutes=rng.randrange(4)),
                 "altitude": rng.choice([None, 1000.0, float("nan"), 2000.0]), "callsign": rng.choice([None, "", "a", "b"])}
                for _ in range(25)]
        return label_hours(flag_quality(observations(*rows)), at).select(*BRONZE.names)
    return [build(n) for n in range(3)]


def rows(df):
    return sorted(map(str, df.select(*BRONZE.names).collect()))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1, 2), (1, 1, 0, 2)])
def test_merging_equals_replaying(spark, lake, batches, order):
    for i in order:
        state = merge_batch(spark, lake, batches[i], buckets=4)
    whole = batches[0].union(batches[1]).union(batches[2])
    assert rows(state) == rows(latest_per_flight(whole)) == rows(read_state(spark, lake))
    assert sorted(map(str, current_fact(spark, lake).collect())) == sorted(map(str, silver_fact(whole).collect()))


def test_history_is_not_shuffled(spark, lake, batches):
    state = merge_batch(spark, lake, batches[0], buckets=3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        both = merged(state, batches[1], 3)
        plan = plan_of(both)
        history = plan[plan.index("ShuffledHashJoin"):]
        scan = history.index("Scan parquet")
        assert "Bucketed: true" in history and "Exchange" not in history[:scan]
        assert "SortMergeJoin" not in plan
        assert both.count() == latest_per_flight(batches[0].union(batches[1])).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_every_bucket_is_written_by_one_task(spark, lake, batches):
    for b in batches:
        merge_batch(spark, lake, b, buckets=4)
    for version in glob.glob(f"{lake.state}/buckets=4/*"):
        assert 1 <= len(glob.glob(f"{version}/*.parquet")) <= 4


def test_a_lost_merge_changes_nothing_and_is_repeated(spark, lake, batches, monkeypatch):
    assert read_state(spark, lake) is None and current_fact(spark, lake) is None
    merge_batch(spark, lake, batches[0], buckets=2)
    before = rows(read_state(spark, lake))
    with monkeypatch.context() as patched:
        def gone(*args, **kwargs):
            raise OSError("driver lost")
        patched.setattr(states, "move_pointer", gone)
        with pytest.raises(OSError):
            merge_batch(spark, lake, batches[1])
    assert rows(read_state(spark, lake)) == before
    assert rows(merge_batch(spark, lake, batches[1])) == rows(latest_per_flight(batches[0].union(batches[1])))
    assert merge_batch(spark, lake, batches[1].limit(0)).count() == latest_per_flight(batches[0].union(batches[1])).count()


def test_hot_flight_in_a_batch(spark, lake, observations, run_ts):
    rng = random.Random(1)
    base = label_hours(flag_quality(observations()), run_ts).select(*BRONZE.names)
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("F"), F.col("id") % 50)).alias("k"), "id")
    batch = hot.crossJoin(base.limit(1)).withColumns({
        "flight_id": F.col("k"), "extraction_timestamp": F.timestamp_seconds(F.col("id"))}).select(*BRONZE.names)
    merge_batch(spark, lake, batch.where(f"unix_seconds(extraction_timestamp) < {rng.randrange(1000, 2000)}"), buckets=4)
    state = merge_batch(spark, lake, batch)
    assert rows(state) == rows(latest_per_flight(batch)) and state.count() == 51
