"""Run documents, their history, alerts and outcome; over all runs at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.functions import percent, utc_iso
from skytally.operators.quality import MIN_PCT_VALID
from skytally.schema import DIMENSION_NAMES, KPI_NAMES, RUN_METRICS

SLA_MINUTES = 30

# Severities, types and message formats of alerts.
CRITICAL, WARNING = "CRITICAL", "WARNING"
ERRORS_ALERT = ("pipeline_errors", "%d erreur(s) durant le batch")
QUALITY_ALERT = ("low_data_quality", "Qualité %.1f%% < seuil {threshold}%%")
SLA_ALERT = ("sla_breach", "Durée %ds > SLA {sla}s")
EMPTY_ALERT = ("empty_extraction", "Aucun vol extrait de l'API")

# what a run reports about itself, next to its batch_id, start and end
_COUNTS = ("extraction_rows", "valid_rows", "on_ground", "on_flight", "rejected_rows")
_DIMENSION_COUNTS = dict(zip(DIMENSION_NAMES, (
    "unique_airlines", "unique_airports", "unique_aircraft", "unique_countries",
), strict=True))


def _kpi_rows(name: str) -> Column:
    """Rows of a KPI from the ``kpi_rows`` map; its keys may omit the ``kpi_`` prefix."""
    rows = F.col("kpi_rows")
    return F.coalesce(rows[name], rows[name.removeprefix("kpi_")], F.lit(0))


def _iso(instant: str) -> Column:
    return utc_iso(F.col(instant))


def run_documents(measures: DataFrame) -> DataFrame:
    """Nested run documents from flat measures, one row per run.

    Expects ``batch_id``, ``started`` and ``ended`` (timestamps); the counts of
    ``_COUNTS`` and ``_DIMENSION_COUNTS``; ``extraction_seconds``, ``gold_seconds``;
    ``kpis_computed``, ``kpi_rows`` (a map; unknown KPI names are ignored); ``errors`` and
    ``warnings`` (arrays). A missing column counts as 0 or empty.
    A run failed if and only if it has an error.
    """
    defaults = {c: F.lit(0).cast("long") for c in (*_COUNTS, *_DIMENSION_COUNTS.values(),
                                                   "kpis_computed")}
    defaults |= {c: F.lit(0.0) for c in ("extraction_seconds", "gold_seconds")}
    defaults["kpi_rows"] = F.create_map().cast("map<string,bigint>")
    for field in ("errors", "warnings"):
        defaults[field] = F.array().cast(RUN_METRICS[field].dataType)
    filled = measures.withColumns({
        c: F.coalesce(F.col(c), d) if c in measures.columns else d for c, d in defaults.items()
    })
    rows, valid = F.col("extraction_rows"), F.col("valid_rows")
    seconds = (F.unix_micros("ended") - F.unix_micros("started")) / 1e6
    columns = {
        "batch_id": F.col("batch_id"),
        "start_time": _iso("started"),
        "extraction": F.struct(
            rows.alias("rows"), F.bround("extraction_seconds", 2).alias("duration_seconds"),
            F.col("rejected_rows")),
        "validation": F.struct(
            valid.alias("valid_rows"), (rows - valid).alias("invalid_rows"),
            percent(valid, rows).alias("pct_valid")),
        "analysis": F.struct(
            F.col("on_ground").alias("on_ground_count"), F.col("on_flight").alias("in_flight_count"),
            percent(F.col("on_flight"), F.col("on_ground") + F.col("on_flight"))
            .alias("pct_in_flight")),
        "dimensions": F.struct(*(
            F.struct(F.col(c).alias("unique_count")).alias(name)
            for name, c in _DIMENSION_COUNTS.items())),
        "gold": F.struct(
            F.col("kpis_computed"), F.bround("gold_seconds", 2).alias("duration_seconds"),
            *(F.struct(_kpi_rows(name).alias("rows")).alias(name) for name in KPI_NAMES)),
        "errors": F.col("errors"),
        "warnings": F.col("warnings"),
        "end_time": _iso("ended"),
        "total_duration_seconds": F.bround(seconds, 2),
        "status": F.when(F.size("errors") == 0, "success").otherwise("failed"),
        "num_errors": F.size("errors").cast("long"),
        "num_warnings": F.size("warnings").cast("long"),
    }
    return filled.select(*(
        columns[f.name].cast(f.dataType).alias(f.name) for f in RUN_METRICS
    ))


def _alerts(min_pct_valid: float, sla_minutes: float) -> Column:
    """The alerts of a run as an array. Missing measures count as harmless, except rows."""
    errors = F.coalesce(F.col("num_errors"), F.lit(0))
    pct = F.coalesce(F.col("validation.pct_valid"), F.lit(100.0))
    rows = F.coalesce(F.col("extraction.rows"), F.lit(0))
    seconds = F.coalesce(F.col("total_duration_seconds"), F.lit(0.0))
    sla_seconds = sla_minutes * 60

    def alert(condition: Column, severity: str, kind_and_format: tuple[str, str],
              *values: Column, **limits: float) -> Column:
        kind, message = kind_and_format
        return F.when(condition, F.struct(
            F.lit(severity).alias("severity"), F.lit(kind).alias("type"),
            F.format_string(message.format(**limits), *values).alias("message"),
        ))

    whole_seconds = F.rint(seconds).cast("long")
    return F.array_compact(F.array(
        alert(errors > 0, CRITICAL, ERRORS_ALERT, errors),
        alert((rows > 0) & (pct < min_pct_valid), WARNING, QUALITY_ALERT, pct,
              threshold=min_pct_valid),
        alert(seconds > sla_seconds, WARNING, SLA_ALERT, whole_seconds, sla=sla_seconds),
        alert(rows == 0, WARNING, EMPTY_ALERT),
    ))


def run_alerts(
    runs: DataFrame, min_pct_valid: float = MIN_PCT_VALID, sla_minutes: float = SLA_MINUTES,
) -> DataFrame:
    """One row per alert: ``(batch_id, severity, type, message)``."""
    return runs.select("batch_id", F.inline(_alerts(min_pct_valid, sla_minutes)))


def alert_documents(
    runs: DataFrame, min_pct_valid: float = MIN_PCT_VALID, sla_minutes: float = SLA_MINUTES,
) -> DataFrame:
    """One document per run that has alerts."""
    return (
        runs.select(
            "batch_id", F.col("end_time").alias("timestamp"),
            _alerts(min_pct_valid, sla_minutes).alias("alerts"),
        )
        .where(F.size("alerts") > 0)
        .select("batch_id", "timestamp", F.size("alerts").alias("alert_count"), "alerts")
    )


def run_history(runs: DataFrame) -> DataFrame:
    """Flat history table, newest run first."""
    return runs.select(
        "batch_id", "status", "total_duration_seconds",
        F.coalesce("extraction.rows", F.lit(0)).alias("flights"),
        F.coalesce("validation.pct_valid", F.lit(0.0)).alias("pct_valid"),
        F.coalesce("analysis.pct_in_flight", F.lit(0.0)).alias("pct_in_flight"),
        F.coalesce("dimensions.dim_airlines.unique_count", F.lit(0)).alias("airlines"),
        F.coalesce("dimensions.dim_airports.unique_count", F.lit(0)).alias("airports"),
        F.coalesce("num_errors", F.lit(0)).alias("num_errors"),
        F.coalesce("num_warnings", F.lit(0)).alias("num_warnings"),
        "end_time",
    ).orderBy(F.desc("end_time"), "batch_id")


def run_trends(runs: DataFrame) -> DataFrame:
    """Duration and validity per run, in order of time."""
    return run_history(runs).select(
        "batch_id", "end_time", "total_duration_seconds", "pct_valid",
    ).orderBy("end_time", "batch_id")


def latest_outcome(runs: DataFrame) -> DataFrame:
    """Status of the run that ended last, and whether it was fully successful."""
    last = F.max_by(
        F.struct("batch_id", "status", F.coalesce("num_errors", F.lit(0)).alias("num_errors")),
        F.struct("end_time", "batch_id"),
    )
    return (
        runs.agg(last.alias("last")).where(F.col("last").isNotNull()).select("last.*")
        .withColumn(
            "succeeded",
            F.coalesce(F.col("status") == "success", F.lit(False)) & (F.col("num_errors") == 0),
        )
    )
