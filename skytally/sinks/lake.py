"""The write disciplines of the lake: append, replace hours, replace snapshot."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from skytally.functions import instant, partition_label_path, partition_labels
from skytally.layout import Lake
from skytally.publish import micros, move_pointer, noted, read_pointer, write_document
from skytally.schema import ATTEMPT, COMMIT, LABEL_COLUMNS, MANY_DAYS


def label_hours(df: DataFrame, at: Column | datetime) -> DataFrame:
    """Stamp the four hourly partition labels of an instant."""
    return df.withColumns(partition_labels(instant(at)))


def _write_hours(
    df: DataFrame, path: str, mode: str, many_hours: bool, *more: str, sort: str | None = None,
    gathered: bool = False, **options: str,
) -> None:
    """Write partitioned by hour, and by ``more`` columns below it; files are sorted by ``sort``.

    With one hour in the data each task already writes into one directory. With many hours a
    rebalance gathers each hour first, so that tasks do not scatter small files; AQE splits
    an hour that outgrows the advisory partition size over several tasks. Rows that are
    ``gathered`` already, read hour by hour from such a table, need no other shuffle.
    """
    if many_hours and not gathered:
        df = df.hint("rebalance", *LABEL_COLUMNS)
    if sort in df.columns:  # after the folders, by which the writer sorts anyway
        df = df.sortWithinPartitions(*LABEL_COLUMNS, *more, sort)
    df.write.mode(mode).options(**options).partitionBy(*LABEL_COLUMNS, *more).parquet(path)


def write_bronze(
    observations: DataFrame, lake: Lake, many_hours: bool = False, batch_id: str | None = None,
    gathered: bool = False,
) -> None:
    """Append labelled observations: raw history, never de-duplicated.

    Every call writes into folders of its own, below the hours, and commits them with one
    document written last. Files without a commit are not read: what a lost driver leaves is no
    part of the history. Of several commits of one ``batch_id`` (the rows' own; retries at the
    same time) the first counts; calls without a batch all count. No rows, no commit.

    ``gathered`` rows come hour by hour, as those read from Bronze do: many hours of them are
    written without a shuffle, into as many files as they are read from, or a few more.

    Rows are sorted by flight within their file, which has a Bloom filter of the flights, so that
    looking for a flight skips the row groups that do not have it.
    """
    attempt, seen = uuid.uuid4().hex, Observation()
    labelled = observations.observe(
        seen, F.count(F.lit(1)).alias("row_count"),
        F.collect_set(F.concat_ws("/", *LABEL_COLUMNS)).alias("hours"))  # an entry per hour
    _write_hours(labelled.withColumn(ATTEMPT, F.lit(attempt)), lake.bronze, "append", many_hours, ATTEMPT, sort="flight_id", gathered=gathered, **{
        "parquet.bloom.filter.enabled#flight_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"})
    rows, hours = noted(seen).get("row_count") or 0, sorted(noted(seen).get("hours") or [])
    if not rows:
        return
    days = {h.split("/")[LABEL_COLUMNS.index("tech_day")] for h in hours}
    day = days.pop() if len(days) == 1 else MANY_DAYS
    write_document(observations.sparkSession, COMMIT, f"{lake.bronze_commits}/day={day}", "append",
                   batch=batch_id or attempt, attempt=attempt, row_count=rows, hours=hours,
                   committed_micros=micros(datetime.now(timezone.utc)))


def write_fact(fact: DataFrame, lake: Lake, many_hours: bool = False) -> None:
    """Replace exactly the hours present in ``fact``; other hours stay."""
    _write_hours(fact, lake.fact, "overwrite", many_hours, partitionOverwriteMode="dynamic")


def write_dimension(dimension: DataFrame, path: str) -> None:
    """Replace a ``_current`` snapshot as a whole; ``dimension`` may be read from it.

    The rows go into a version folder of their own and the pointer moves last, so a reader sees
    the old snapshot or the new one, and a write that is lost half-way changes nothing.
    """
    target, seen = f"version={uuid.uuid4().hex}", Observation()
    dimension.observe(seen, F.count(F.lit(1)).alias("row_count")).write.parquet(f"{path}/{target}")
    spark = dimension.sparkSession
    move_pointer(spark, path, read_pointer(spark, path), target, noted(seen).get("row_count") or 0)


def write_gold(kpi: DataFrame, lake: Lake, name: str, run_ts: datetime) -> str:
    """Overwrite the run's hour of a KPI table and return its path.

    The hour is addressed as a directory, so an empty result clears it; a dynamic overwrite
    would leave the previous rows. The table's pointer then names the latest hour that has rows,
    unless a later one is known; where the latest has been cleared it names none.
    """
    table, hour, seen = lake.gold(name), partition_label_path(run_ts), Observation()
    kpi.observe(seen, F.count(F.lit(1)).alias("row_count")).write.mode("overwrite").parquet(f"{table}/{hour}")
    rows, spark = noted(seen).get("row_count") or 0, kpi.sparkSession
    last = read_pointer(spark, table)
    if last is None or last.at_micros <= micros(run_ts) or last.target == hour:
        if rows:
            move_pointer(spark, table, last, hour, rows, run_ts)
        elif last is not None and last.target == hour:
            move_pointer(spark, table, last, "", 0, run_ts)
    return f"{table}/{hour}"
