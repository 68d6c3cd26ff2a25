"""The batch run and the replay: what is written, and in which order."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skytally.functions import partition_label_path
from skytally.layout import Lake
from skytally.operators.dimensions import row_counts
from skytally.operators.profile import dimension_cardinality
from skytally.operators.quality import MIN_PCT_VALID, flag_quality
from skytally.operators.rollup import RolledUp, dimensions_of_rollup, kpis_of_rollup
from skytally.operators.sketches import run_sketches, write_run_sketches
from skytally.plans.gold import concurrently, load_gold
from skytally.plans.runs import SLA_MINUTES, alert_documents, run_documents
from skytally.plans.silver import silver_fact
from skytally.sinks.lake import label_hours, write_bronze, write_dimension, write_fact
from skytally.sinks.reports import (
    quality_report, write_alerts, write_quality_report, write_run_metrics,
)
from skytally.publish import noted
from skytally.schema import LABEL_COLUMNS
from skytally.sources.lake import find_commit, read_bronze, read_commit, read_hour, read_snapshot

log = logging.getLogger(__name__)

# Warning texts of a run document.
EMPTY_WARNING = "Aucun vol retourné par l'API"
QUALITY_WARNING = "Qualité {pct:.1f}% < seuil {threshold}%"


def _utcnow() -> datetime:
    return datetime.now(timezone.utc)


@dataclass
class Loaded:
    """What a Silver/Gold load wrote, as tables read back from storage."""

    silver: DataFrame
    gold: dict[str, DataFrame]
    dim_counts: dict[str, int]
    kpi_counts: dict[str, int] = field(default_factory=dict)


def _counts(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Row counts of small written tables, in one job."""
    return {r["name"]: r["row_count"] for r in row_counts(tables).collect()}


def _load_dimensions(
    derived: dict[str, DataFrame], lake: Lake,
    airports: DataFrame | None, airlines: DataFrame | None, spark: SparkSession,
) -> dict[str, int]:
    """Write the dimensions derived from the fact; supplied ones are already stored."""
    supplied = {"dim_airports": airports, "dim_airlines": airlines}

    def write(name: str, table: DataFrame) -> DataFrame:
        write_dimension(table, lake.dimension(name))
        return read_snapshot(spark, lake.dimension(name))

    return _counts(concurrently(spark, {
        name: lambda name=name, table=table: write(name, table)
        for name, table in derived.items() if supplied.get(name) is None
    }))


def load_silver_gold(
    bronze: DataFrame, lake: Lake, run_ts: datetime,
    airports: DataFrame | None = None, airlines: DataFrame | None = None,
    many_hours: bool = False,
) -> Loaded:
    """Silver fact, dimensions and KPIs of the given Bronze rows.

    Everything after the fact reads a written table, never a cache: an executor that is lost
    costs a re-read. That table is the fact itself, restricted to the hours just replaced: one
    hour is read as its folder; the hours of a replay are noted while they are written (a set of
    labels, one entry per hour) and prune the fact, so hours that a replay does not touch stay
    out. It is scanned once, into a stored roll-up; all KPIs and dimensions come from that.
    """
    spark = bronze.sparkSession
    silver = silver_fact(bronze, airports, airlines, stored=True)
    schema = silver.schema
    if many_hours:
        seen = Observation()
        write_fact(silver.observe(seen, F.collect_set(F.concat_ws("/", *LABEL_COLUMNS)).alias("hours")),
                   lake, many_hours=True)
        silver = _hours_of(spark, schema, lake, noted(seen).get("hours") or [])
    else:
        write_fact(silver, lake)
        silver = read_hour(spark, schema, lake.fact, run_ts)
    rolled = RolledUp(silver, f"{lake.rollup}/{partition_label_path(run_ts)}")
    dim_counts = _load_dimensions(dimensions_of_rollup(rolled, run_ts), lake, airports, airlines, spark)
    gold = load_gold(silver, lake, run_ts, kpis_of_rollup(rolled, spark, run_ts))
    return Loaded(silver, gold, dim_counts, _counts(gold))


def _hours_of(spark: SparkSession, schema, lake: Lake, hours: list[str]) -> DataFrame:
    """The fact's rows of the given hours (labels joined by slashes), pruned as partitions."""
    if not hours:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(lake.fact).where(
        F.concat_ws("/", *LABEL_COLUMNS).isin(hours))


def replay(
    spark: SparkSession, lake: Lake, run_ts: datetime,
    airports: DataFrame | None = None, airlines: DataFrame | None = None,
) -> Loaded:
    """Rebuild Silver and Gold from the whole Bronze history."""
    return load_silver_gold(read_bronze(spark, lake), lake, run_ts, airports, airlines,
                            many_hours=True)


@dataclass
class RunSettings:
    """Thresholds and switches of a batch run."""

    min_pct_valid: float = MIN_PCT_VALID
    sla_minutes: float = SLA_MINUTES
    load_silver_gold: bool = True
    save_quality_report: bool = True


def run_batch(
    observations: DataFrame, lake: Lake, run_ts: datetime, batch_id: str,
    airports: DataFrame | None = None, airlines: DataFrame | None = None,
    settings: RunSettings | None = None, rejected_rows: int = 0,
) -> bool:
    """One batch: flag, append to Bronze, profile, load Silver and Gold, report.

    Bronze is written first; profile and Silver read the batch back from the folders of its
    commit. A batch that has a commit (a retry after a later step failed) is not appended again;
    files of an append that ended before its commit do not count and are not read. Rows that a
    commit promises and storage no longer has fail the run. No flights: the run fails with a
    warning. A Silver or Gold error fails the run but keeps Bronze. A report that cannot be
    written is logged and does not change the outcome. ``rejected_rows`` is what the ingest turned
    away, for the run document. Returns whether the run succeeded.
    """
    settings = settings or RunSettings()
    spark = observations.sparkSession
    started = _utcnow()
    report: dict = {"batch_id": batch_id, "rejected_rows": rejected_rows, "errors": [], "warnings": []}

    def note(kind: str, what: str, message: str, **more: str) -> None:
        report[kind].append({
            "type": what, "message": message, "timestamp": _utcnow().isoformat(), **more,
        })

    ok = False
    try:
        ok = _run(spark, observations, lake, run_ts, batch_id, airports, airlines, settings,
                  started, report, note)
    except Exception as error:  # noqa: BLE001 - recorded in the run document
        log.exception("batch %s failed", batch_id)
        note("errors", "batch_error", str(error), phase="pipeline")
    try:
        _report(spark, report, started, lake, settings)
    except Exception:  # noqa: BLE001 - a lost report is no lost batch
        log.exception("report of batch %s not written", batch_id)
    return ok and not report["errors"]


def _run(spark, observations, lake, run_ts, batch_id, airports, airlines, settings, started,
         report, note) -> bool:
    stamped = observations.withColumn("batch_id", F.lit(batch_id))

    commit = find_commit(spark, lake, run_ts, batch_id)
    if commit is None:
        write_bronze(label_hours(flag_quality(stamped), run_ts), lake, batch_id=batch_id)
        commit = find_commit(spark, lake, run_ts, batch_id)  # or that of a retry which was faster
    else:
        log.info("batch %s is in Bronze already", batch_id)
    report["extraction_seconds"] = (_utcnow() - started).total_seconds()
    bronze = read_commit(spark, lake, commit)

    quality = quality_report(bronze, settings.min_pct_valid)
    profile = quality.first()  # one row
    if profile is None:
        note("warnings", "empty_extraction", EMPTY_WARNING)
        return False
    if profile.total_rows != commit.row_count:
        note("errors", "bronze_incomplete",
             f"{profile.total_rows} of {commit.row_count} committed rows found", phase="bronze")
        return False
    report.update(extraction_rows=profile.total_rows, valid_rows=profile.valid_rows,
                  on_ground=profile.on_ground, on_flight=profile.on_flight)
    if profile.low_quality:
        note("warnings", "low_quality", QUALITY_WARNING.format(
            pct=profile.pct_valid, threshold=settings.min_pct_valid))
    report.update(dimension_cardinality(bronze).first().asDict())
    write_run_sketches(run_sketches(bronze, "batch_id"), lake, partition_label_path(run_ts), batch_id)
    if settings.save_quality_report:
        write_quality_report(spark.createDataFrame([profile], quality.schema), lake, run_ts)

    if settings.load_silver_gold:
        gold_started = _utcnow()
        try:
            loaded = load_silver_gold(bronze, lake, run_ts, airports, airlines)
            report.update(
                kpis_computed=len(loaded.gold), kpi_rows=loaded.kpi_counts,
                gold_seconds=(_utcnow() - gold_started).total_seconds(),
                unique_countries=loaded.dim_counts.get("dim_countries_continents", 0),
            )
        except Exception as error:  # noqa: BLE001 - Bronze stays, the run is marked failed
            log.exception("Silver/Gold of batch %s failed", batch_id)
            note("errors", "silver_gold_error", str(error), phase="silver_gold")
    return True


_REPORT_SCHEMA = (
    "batch_id string, started timestamp, ended timestamp, extraction_seconds double, "
    "gold_seconds double, extraction_rows long, rejected_rows long, valid_rows long, on_ground long, "
    "on_flight long, unique_airlines long, unique_airports long, unique_aircraft long, "
    "unique_countries long, kpis_computed long, kpi_rows map<string,bigint>, "
    "errors array<struct<type:string,message:string,phase:string,timestamp:string>>, "
    "warnings array<struct<type:string,message:string,timestamp:string>>"
)


def _report(spark, report, started, lake, settings) -> None:
    """Write the run document, then the alerts it raises."""
    measured = spark.createDataFrame(
        [{"started": started, "ended": _utcnow(), **report}], _REPORT_SCHEMA,
    )
    runs = run_documents(measured)
    write_run_metrics(runs, lake)
    write_alerts(alert_documents(runs, settings.min_pct_valid, settings.sla_minutes), lake)
