"""JSON and CSV reports of a run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.operators.quality import MIN_PCT_VALID, profile_measures, quality_rules, with_shares
from skytally.layout import Lake


def quality_report(flagged: DataFrame, min_pct_valid: float = MIN_PCT_VALID) -> DataFrame:
    """The quality profile with the flag frequencies as one nested row; none for no rows.

    One scan: rows are counted per distinct flag list (at most 2^8 of them) with the profile's
    counters as measures, and both results come from those groups.
    """
    counters = profile_measures()
    groups = flagged.groupBy("data_quality_flags").agg(*(m.alias(n) for n, m in counters.items()))
    raised = F.split("data_quality_flags", ",")
    flags = {f"flag_{flag}": flag for flag in quality_rules()}
    sums = groups.agg(*(F.sum(n).alias(n) for n in counters), *(
        F.coalesce(F.sum(F.when(F.array_contains(raised, flag), F.col("total_rows"))), F.lit(0)).alias(name)
        for name, flag in flags.items()))
    # negated counts make the natural order "most frequent first, then by name"
    ranked = F.array_sort(F.filter(
        F.array(*(F.struct((-F.col(n)).alias("neg"), F.lit(f).alias("flag")) for n, f in flags.items())), lambda e: e["neg"] < 0))
    entries = F.transform(
        ranked, lambda e: F.struct(e["flag"].alias("flag"), (-e["neg"]).alias("count")))
    return with_shares(sums, min_pct_valid).withColumn("top_flags", entries).drop(*flags)


def write_quality_report(report: DataFrame, lake: Lake, run_ts: datetime) -> None:
    """Append a report under its date and hour."""
    report.write.mode("append").json(lake.quality_report(run_ts))


def write_run_metrics(runs: DataFrame, lake: Lake) -> None:
    """Append run documents, one per file."""
    runs.write.mode("append").option("maxRecordsPerFile", 1).json(lake.run_metrics)


def write_alerts(alert_documents: DataFrame, lake: Lake) -> None:
    """Append alert documents; runs without alerts have none, and then nothing is written."""
    if not alert_documents.isEmpty():
        alert_documents.write.mode("append").option("maxRecordsPerFile", 1).json(lake.alerts)


def export_history_csv(history: DataFrame, path: str) -> None:
    """Run history as CSV with a header."""
    history.write.mode("overwrite").option("header", True).csv(path)
