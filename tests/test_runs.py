from __future__ import annotations

import os
from datetime import datetime, timedelta, timezone

import pytest

from skytally.layout import Lake
from skytally.plans import runs as plans
from skytally.schema import RUN_METRICS
from skytally.sinks import reports
from skytally.sources import runs as sources


def measures(spark, **changes):
    start = datetime(2026, 6, 21, 14, 0, tzinfo=timezone.utc)
    row = {
        "batch_id": "r1", "started": start, "ended": start + timedelta(seconds=60.126),
        "extraction_rows": 640, "valid_rows": 480, "on_ground": 90, "on_flight": 310,
        "unique_airlines": 5, "kpi_rows": {"airline_volumes": 1, "kpi_longest_flight": 2, "bogus": 9},
        "errors": [], "warnings": [], **changes,
    }
    schema = (
        "batch_id string, started timestamp, ended timestamp, extraction_rows long, valid_rows long, "
        "on_ground long, on_flight long, unique_airlines long, kpi_rows map<string,bigint>, "
        "errors array<struct<type:string,message:string,phase:string,timestamp:string>>, "
        "warnings array<struct<type:string,message:string,timestamp:string>>")
    return spark.createDataFrame([row], schema)


ERROR = ("silver_gold_error", "boom", "silver_gold", None)


def documents(spark, **changes):
    return plans.run_documents(measures(spark, **changes))


def test_document(spark):
    doc = documents(spark)
    assert doc.schema.names == RUN_METRICS.names
    row = doc.first()
    assert (row.status, row.num_errors, row.total_duration_seconds) == ("success", 0, 60.13)
    assert (row.validation.invalid_rows, row.validation.pct_valid) == (160, 75.0)
    assert row.analysis.pct_in_flight == 77.5
    assert row.dimensions.dim_airlines.unique_count == 5
    assert row.dimensions.dim_countries_continents.unique_count == 0
    assert row.gold.kpi_airline_volumes.rows == 1
    assert row.gold.kpi_longest_flight.rows == 2
    assert row.gold.kpi_airport_imbalance.rows == 0
    assert row.start_time == "2026-06-21T14:00:00.000000"


def test_an_error_fails_the_run(spark):
    row = documents(spark, errors=[ERROR]).first()
    assert (row.status, row.num_errors) == ("failed", 1)


@pytest.mark.parametrize(("changes", "sla", "expected"), [
    ({}, 30, []),
    ({"errors": [ERROR, ERROR]}, 30, [("CRITICAL", "pipeline_errors", "2 erreur(s) durant le batch")]),
    ({"valid_rows": 447}, 30, [("WARNING", "low_data_quality", "Qualité 69.8% < seuil 70%")]),
    ({"valid_rows": 448}, 30, []),
    ({"extraction_rows": 0, "valid_rows": 0}, 30,
     [("WARNING", "empty_extraction", "Aucun vol extrait de l'API")]),
    ({}, 1, [("WARNING", "sla_breach", "Durée 60s > SLA 60s")]),
])
def test_alerts(spark, changes, sla, expected):
    alerts = plans.run_alerts(documents(spark, **changes), sla_minutes=sla)
    assert [tuple(r)[1:] for r in alerts.collect()] == expected


def test_missing_measures_raise_only_the_empty_alert(spark):
    bare = spark.createDataFrame([("r1",)], "batch_id string").selectExpr(
        "batch_id", "cast(null as long) num_errors", "cast(null as double) total_duration_seconds",
        "named_struct('rows', cast(null as long)) extraction",
        "named_struct('pct_valid', cast(null as double)) validation")
    assert [r.type for r in plans.run_alerts(bare).collect()] == ["empty_extraction"]


def test_alert_documents_are_written_only_when_there_are_any(spark, tmp_path):
    lake = Lake(str(tmp_path))
    reports.write_alerts(plans.alert_documents(documents(spark)), lake)
    assert not os.path.exists(lake.alerts)
    reports.write_alerts(plans.alert_documents(documents(spark, errors=[ERROR], valid_rows=1)), lake)
    row = spark.read.json(lake.alerts).first()
    assert (row.batch_id, row.alert_count) == ("r1", 2)
    assert {a.type for a in row.alerts} == {"pipeline_errors", "low_data_quality"}


PRETTY = """{
  "batch_id": "old",
  "extraction": {"rows": 3, "duration_seconds": 1.5},
  "total_duration_seconds": 12.5,
  "status": "success",
  "num_errors": 0,
  "end_time": "2025-01-01T00:00:00"
}"""


def test_history_skips_unreadable_files_and_is_newest_first(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    for i, batch in enumerate(["a", "b"]):
        start = datetime(2026, 6, 21 + i, tzinfo=timezone.utc)
        reports.write_run_metrics(documents(
            spark, batch_id=batch, started=start, ended=start + timedelta(seconds=30)), lake)
    deep = os.path.join(lake.run_metrics, "deep", "er")
    os.makedirs(deep)
    with open(os.path.join(deep, "old_metrics.json"), "w") as f:
        f.write(PRETTY)
    with open(os.path.join(deep, "bad_metrics.json"), "w") as f:
        f.write('{"batch_id": "bad", ')
    runs = sources.read_run_metrics(spark, lake.run_metrics)
    history = plans.run_history(runs).collect()
    assert [r.batch_id for r in history] == ["b", "a", "old"]
    assert (history[2].flights, history[2].pct_valid, history[2].airlines) == (3, 0.0, 0)
    assert [r.batch_id for r in plans.run_trends(runs).collect()] == ["old", "a", "b"]
    assert sources.read_run_metrics(spark, lake.run_metrics, "*_metrics.json").count() == 1

    out = str(tmp_path / "history")
    reports.export_history_csv(plans.run_history(runs), out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == plans.run_history(runs).columns
    assert back.count() == 3


def test_no_runs_yet(spark, tmp_path):
    runs = sources.read_run_metrics(spark, str(tmp_path / "nothing"))
    assert plans.run_history(runs).count() == plans.run_alerts(runs).count() == 0
    assert plans.latest_outcome(runs).count() == 0


def test_latest_outcome(spark):
    start = datetime(2026, 6, 22, tzinfo=timezone.utc)
    good, bad = documents(spark), documents(
        spark, batch_id="r2", started=start, ended=start, errors=[ERROR])
    assert plans.latest_outcome(good).first().succeeded
    row = plans.latest_outcome(bad.unionByName(good)).first()
    assert (row.batch_id, row.status, row.num_errors, row.succeeded) == ("r2", "failed", 1, False)
    assert plans.latest_outcome(good.limit(0)).count() == 0


def test_job_log_status(spark, tmp_path):
    stamp = "2026-06-21 14:00:00,123 - INFO - "
    logs = {
        "done": ["", stamp + "Phase 1 : x", stamp + "Phase 6 : y", stamp + sources.LOG_SUCCEEDED],
        "failed": [stamp + "Phase 2 : x", stamp + sources.LOG_FAILED],
        "empty": [stamp + "Phase 1 : x", stamp + sources.LOG_EMPTY, stamp + sources.LOG_METRICS_SAVED],
        "open": ["no timestamp", stamp + "Phase 1 : x", stamp + "Phase 3 : x"],
    }
    now = datetime(2026, 6, 21, 15, tzinfo=timezone.utc)
    for name, lines in logs.items():
        path = tmp_path / f"batch_job_{name}.log"
        path.write_text("\n".join(lines))
        os.utime(path, (now.timestamp(), now.timestamp()))
    (tmp_path / "other.log").write_text("Phase 1 :")
    lines = sources.read_job_logs(spark, str(tmp_path))

    def status(seconds):
        rows = sources.job_log_status(lines, now + timedelta(seconds=seconds)).collect()
        return {r.file.rsplit("batch_job_")[1][:-4]: r for r in rows}

    rows = status(179)
    assert {n: (r.state, r.reached, r.success, r.empty) for n, r in rows.items()} == {
        "done": ("done", 5, True, False), "failed": ("done", 1, False, False),
        "empty": ("done", 0, False, True), "open": ("running", 2, False, False)}
    assert rows["done"].started == datetime(2026, 6, 21, 14, 0, 0, 123000)
    assert rows["open"].started is None
    assert rows["done"].phase == "Silver + Gold (KPIs)"
    assert rows["open"].age_seconds == 179
    assert status(180)["open"].state == "stalled"
