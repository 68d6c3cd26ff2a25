from __future__ import annotations

import glob
from datetime import datetime, timedelta, timezone

import pytest
from tests.conftest import FOUR_FLIGHTS
from pyspark.sql import functions as F

from skytally.layout import Lake
from skytally.operators.quality import flag_quality
from skytally.plans.batch import RunSettings, replay, run_batch
from skytally.sinks.lake import label_hours, write_bronze, write_dimension, write_fact, write_gold
from skytally.sources.lake import latest_snapshot, read_bronze, read_latest, read_snapshot
from skytally.sources.runs import read_run_metrics


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def labelled(df, at):
    return label_hours(flag_quality(df), at)


def test_bronze_appends_and_keeps_string_labels(spark, lake, observations, run_ts):
    batch = labelled(observations(*FOUR_FLIGHTS), run_ts)
    write_bronze(batch, lake)
    write_bronze(batch, lake, many_hours=True)
    bronze = read_bronze(spark, lake)
    assert bronze.count() == 8
    row = bronze.first()
    assert (row.tech_year, row.tech_month, row.tech_day, row.tech_hour) == (
        "2026", "2026-06", "2026-06-21", "14")
    assert bronze.columns == batch.columns
    assert glob.glob(f"{lake.bronze}/tech_year=2026/tech_month=2026-06/tech_day=2026-06-21/tech_hour=14/*")


def test_reading_a_day_prunes_partitions(spark, lake, observations, run_ts):
    write_bronze(labelled(observations(), run_ts), lake)
    write_bronze(labelled(observations(), run_ts + timedelta(days=1)), lake)
    day = read_bronze(spark, lake, day="2026-06-21")
    assert day.count() == 1
    assert read_bronze(spark, lake, day="1999-01-01").count() == 0
    plan = read_bronze(spark, lake, day="2026-06-21", batch_id="b1")
    text = plan._jdf.queryExecution().executedPlan().toString()
    location = text[text.index("Location:"):].split("]")[0]
    assert "(1 paths)" in location
    assert all("tech_month=2026-06/tech_day=2026-06-21" in f for f in plan.inputFiles())
    assert "EqualTo(batch_id,b1)" in text


def test_fact_overwrite_replaces_only_hours_in_the_data(spark, lake, observations, run_ts):
    hours = [labelled(observations({"flight_id": f"h{i}"}), run_ts + timedelta(hours=i)) for i in range(3)]
    write_fact(hours[0].union(hours[1]).union(hours[2]), lake, many_hours=True)
    again = labelled(observations({"flight_id": "new"}), run_ts + timedelta(hours=1))
    write_fact(again, lake)
    assert {r.flight_id for r in spark.read.parquet(lake.fact).collect()} == {"h0", "new", "h2"}


def test_gold_keeps_one_snapshot_per_hour_and_an_empty_result_clears_it(spark, lake, run_ts):
    kpi = spark.range(3).withColumn("computed_at", F.lit(1))
    write_gold(kpi, lake, "kpi_x", run_ts)
    write_gold(kpi, lake, "kpi_x", run_ts + timedelta(minutes=20))
    write_gold(kpi, lake, "kpi_x", run_ts + timedelta(hours=2))
    assert spark.read.parquet(lake.gold("kpi_x")).count() == 6
    write_gold(kpi.limit(0), lake, "kpi_x", run_ts)
    assert {r.tech_hour for r in spark.read.parquet(lake.gold("kpi_x")).collect()} == {"16"}


def test_dimension_snapshot_is_replaced(spark, lake):
    write_dimension(spark.range(5), lake.dimension("dim_x"))
    write_dimension(spark.range(2), lake.dimension("dim_x"))
    assert read_snapshot(spark, lake.dimension("dim_x")).count() == 2


def test_latest_snapshot(spark, lake, run_ts):
    for hours, value in ((0, "old"), (2, "new"), (1, "middle")):
        at = run_ts + timedelta(hours=hours)
        table = spark.range(2).select(F.lit(value).alias("v"), F.lit(at).alias("computed_at"))
        write_gold(table, lake, "kpi_x", at)
    latest = read_latest(spark, lake, "kpi_x")
    assert latest.columns == ["v"]
    assert [r.v for r in latest.collect()] == ["new", "new"]
    assert latest_snapshot(spark.read.parquet(lake.gold("kpi_x")).limit(0)).count() == 0
    assert read_latest(spark, lake, "kpi_absent") is None


def airports(spark):
    return spark.sql(
        "SELECT * FROM VALUES ('OSL', 'Norway', 'NO', 60.19D, 11.1D) "
        "AS t(airport_iata, country_name, country_code, latitude, longitude)")


def run_document(spark, lake):
    return read_run_metrics(spark, lake.run_metrics).orderBy(F.desc("end_time")).first()


def test_batch_success(spark, lake, observations, run_ts):
    ok = run_batch(observations(*FOUR_FLIGHTS, {"flight_id": "bad", "altitude": -1.0}), lake, run_ts, "r1")
    assert ok is True
    assert read_bronze(spark, lake, batch_id="r1").count() == 5
    assert spark.read.parquet(lake.fact).count() == 5
    assert read_snapshot(spark, lake.dimension("dim_countries_continents")).count() == 4
    assert read_snapshot(spark, lake.dimension("dim_airports")).count() == 6
    doc = run_document(spark, lake)
    assert (doc.batch_id, doc.status, doc.num_errors) == ("r1", "success", 0)
    assert (doc.extraction.rows, doc.validation.valid_rows, doc.validation.pct_valid) == (5, 4, 80.0)
    assert (doc.analysis.in_flight_count, doc.analysis.pct_in_flight) == (5, 100.0)
    assert doc.dimensions.dim_airlines.unique_count == 2
    assert doc.dimensions.dim_airports.unique_count == 6
    assert doc.dimensions.dim_countries_continents.unique_count == 4
    assert doc.gold.kpis_computed == 7
    assert doc.gold.kpi_airline_aircraft_top3.rows == 4
    report = spark.read.json(lake.quality_report(run_ts)).first()
    assert (report.total_rows, [t.flag for t in report.top_flags]) == (5, ["INVALID_ALTITUDE"])
    assert not glob.glob(lake.alerts)
    assert read_latest(spark, lake, "kpi_airline_volumes").first().airline_icao == "SAS"


def test_rerun_in_the_same_hour_is_idempotent_above_bronze(spark, lake, observations, run_ts):
    for batch in ("r1", "r2"):
        assert run_batch(observations(*FOUR_FLIGHTS), lake, run_ts, batch)
    assert read_bronze(spark, lake).count() == 8
    assert spark.read.parquet(lake.fact).count() == 4
    assert spark.read.parquet(lake.gold("kpi_airline_volumes")).count() == 1


def test_batch_processes_its_snapshot_not_the_history(spark, lake, observations, run_ts):
    assert run_batch(observations(*FOUR_FLIGHTS), lake, run_ts, "r1")
    later = run_ts + timedelta(hours=2)
    assert run_batch(observations(FOUR_FLIGHTS[0]), lake, later, "r2")
    assert read_latest(spark, lake, "kpi_airline_volumes").first().airline_icao == "ACA"
    assert spark.read.parquet(lake.fact).count() == 5


def test_empty_batch_fails_with_a_warning(spark, lake, observations, run_ts):
    assert run_batch(observations().limit(0), lake, run_ts, "r0") is False
    doc = run_document(spark, lake)
    assert [w.type for w in doc.warnings] == ["empty_extraction"]
    assert (doc.status, doc.num_errors) == ("success", 0)
    alert = spark.read.json(lake.alerts).first()
    assert [a.type for a in alert.alerts] == ["empty_extraction"]


def test_silver_failure_keeps_bronze_and_fails_the_run(spark, lake, observations, run_ts):
    broken = spark.range(1).select(F.lit("OSL").alias("airport_iata"))
    assert run_batch(observations(*FOUR_FLIGHTS), lake, run_ts, "r1", airports=broken) is False
    assert read_bronze(spark, lake).count() == 4
    doc = run_document(spark, lake)
    assert (doc.status, [e.type for e in doc.errors], doc.errors[0].phase) == (
        "failed", ["silver_gold_error"], "silver_gold")
    assert [a.type for a in spark.read.json(lake.alerts).first().alerts] == ["pipeline_errors"]


def test_low_quality_batch_warns_but_succeeds(spark, lake, observations, run_ts):
    settings = RunSettings(load_silver_gold=False, save_quality_report=False)
    bad = {"flight_id": "x", "altitude": -1.0}
    assert run_batch(observations({}, bad), lake, run_ts, "r1", settings=settings) is True
    doc = run_document(spark, lake)
    assert [w.type for w in doc.warnings] == ["low_quality"]
    assert [a.type for a in spark.read.json(lake.alerts).first().alerts] == ["low_data_quality"]
    assert not glob.glob(lake.fact)


def test_replay_deduplicates_across_batches(spark, lake, observations, run_ts):
    for hours in (0, 2):
        at = run_ts + timedelta(hours=hours)
        rows = [{**f, "extraction_timestamp": at} for f in FOUR_FLIGHTS]
        write_bronze(labelled(observations(*rows), at), lake)
    now = datetime(2026, 6, 22, 8, 0, tzinfo=timezone.utc)
    loaded = replay(spark, lake, now, airports(spark))
    assert loaded.silver.count() == 4
    assert {r.tech_hour for r in loaded.silver.collect()} == {"16"}
    assert loaded.kpi_counts["kpi_airline_volumes"] == 1
    assert set(loaded.dim_counts) == {"dim_airlines", "dim_aircraft_models", "dim_countries_continents"}
    assert glob.glob(f"{lake.gold('kpi_airline_volumes')}/*/*/tech_day=2026-06-22/tech_hour=08/*.parquet")


def test_replay_ignores_stale_hours_of_the_fact(spark, lake, observations, run_ts):
    write_fact(labelled(observations({"flight_id": "stale"}), run_ts - timedelta(hours=5)), lake)
    write_bronze(labelled(observations(*FOUR_FLIGHTS), run_ts), lake)
    loaded = replay(spark, lake, run_ts)
    assert loaded.silver.count() == 4
    assert spark.read.parquet(lake.fact).count() == 5
