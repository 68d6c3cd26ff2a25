"""Landed flight feed (JSON lines) to typed Bronze observations."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions import instant, json_to_int, partition_label_path, to_double
from skytally.layout import Lake
from skytally.operators.zones import GLOBAL_ZONE, dedup_zones
from skytally.publish import NO_TABLE, noted
from skytally.schema import CORRUPT, FEED_RENAMES, FLIGHT_FEED, FLIGHTS_RAW, LABEL_COLUMNS, STAMPED

_FEED_OF = {bronze: feed for feed, bronze in FEED_RENAMES.items()}


def read_feed(
    spark: SparkSession, path: str, multi_line: bool = False, *more: T.StructField,
) -> DataFrame:
    """Landed records as text columns; unreadable ones are kept in ``_corrupt_record``.

    ``more`` declares partition columns of the landing folder.
    """
    return (
        spark.read.schema(T.StructType([*FLIGHT_FEED, *more]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multi_line)
        .json(path)
    )


def read_zone_feeds(
    spark: SparkSession, root: str, wanted: Iterable[str] | None = None,
) -> DataFrame:
    """Feeds landed per zone under ``zone=<name>`` directories, with a ``zone`` column.

    All wanted zones come out of one scan pruned to their directories. A zone without a
    directory, or with an empty one, has no rows; that is not an error, and neither is a root
    where no zone has landed anything yet.
    """
    zone = T.StructField("zone", T.StringType(), True)
    try:
        landed = read_feed(spark, root, False, zone)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        landed = spark.createDataFrame([], T.StructType([*FLIGHT_FEED, zone]))
    return landed if wanted is None else landed.where(F.col("zone").isin(list(wanted)))


def collect_zones(
    spark: SparkSession, root: str, wanted: Iterable[str] | None, run_ts: datetime, batch_id: str,
) -> DataFrame:
    """One batch: the observations of all wanted zones, one row per flight."""
    landed = read_zone_feeds(spark, root, wanted)
    return dedup_zones(to_observations(landed, run_ts, batch_id, F.col("zone")))


def _usable() -> Column:
    return F.col(CORRUPT).isNull() & F.col("id").isNotNull()


def accepted(landed: DataFrame) -> DataFrame:
    """Records that can become observations."""
    return landed.where(_usable()).drop(CORRUPT)


def rejected(landed: DataFrame) -> DataFrame:
    """Records dropped by the ingest: malformed, or without the flight key."""
    return landed.where(~_usable()).select("id", CORRUPT)


def _converted(field: T.StructField) -> Column:
    value = F.col(_FEED_OF.get(field.name, field.name))
    if isinstance(field.dataType, T.DoubleType):
        value = to_double(value)
    elif isinstance(field.dataType, T.IntegerType):
        value = json_to_int(value)
    return value.alias(field.name)


def _observation_columns(
    run_ts: datetime | Column, batch_id: str | Column, zone: str | Column | None,
) -> list[Column]:
    stamps = {
        "extraction_timestamp": instant(run_ts),
        "batch_id": F.lit(batch_id),
        "source_zone": F.coalesce(F.lit(zone).cast("string"), F.lit(GLOBAL_ZONE)),
    }
    return [stamps[f.name].alias(f.name) if f.name in STAMPED else _converted(f) for f in FLIGHTS_RAW]


def to_observations(
    landed: DataFrame, run_ts: datetime | Column, batch_id: str | Column,
    zone: str | Column | None = None,
) -> DataFrame:
    """Rename, convert and stamp accepted records; the result has the 33 Bronze columns.

    A field that cannot be converted becomes NULL, it does not reject its record.
    """
    return accepted(landed).select(*_observation_columns(run_ts, batch_id, zone))


ACCEPTED, MALFORMED, NO_KEY = "accepted", "malformed", "no_key"
_STAGED = T.StructType(
    [T.StructField(f.name, f.dataType, True) for f in FLIGHTS_RAW]
    + [T.StructField("record", T.StringType(), True)]
    + [T.StructField(c, T.StringType(), True) for c in (*LABEL_COLUMNS, "batch", "outcome")]
)


@dataclass
class Staged:
    """A feed that was parsed once: what can become observations, and how much could not."""

    observations: DataFrame
    rejected_rows: dict[str, int]


def stage_feed(
    landed: DataFrame, lake: Lake, run_ts: datetime, batch_id: str, zone: str | Column | None = None,
) -> Staged:
    """Parse a feed in one pass that writes observations and rejects apart and counts both.

    Rejects stay as the quarantine (see ``read_quarantine``) with their reason and, where the
    line was no record, its text. Staging the same batch again replaces what it staged before.
    """
    outcome = F.when(F.col(CORRUPT).isNotNull(), MALFORMED).when(F.col("id").isNull(), NO_KEY).otherwise(ACCEPTED)
    seen = Observation()
    path = f"{lake.staged_feed}/{partition_label_path(run_ts)}/batch={quote(batch_id, safe='')}"
    (landed.select(*_observation_columns(run_ts, batch_id, zone), F.col(CORRUPT).alias("record"), outcome.alias("outcome"))
     .observe(seen, *(F.count_if(F.col("outcome") == o).alias(o) for o in (MALFORMED, NO_KEY)))
     .write.mode("overwrite").partitionBy("outcome").parquet(path))
    spark = landed.sparkSession
    staged = spark.read.schema(T.StructType([*_STAGED.fields[:-6], _STAGED["outcome"]])).parquet(path)
    return Staged(staged.where(F.col("outcome") == ACCEPTED).select(*FLIGHTS_RAW.names),
                  {o: noted(seen).get(o) or 0 for o in (MALFORMED, NO_KEY)})


def stage_zones(
    spark: SparkSession, root: str, wanted: Iterable[str] | None, lake: Lake, run_ts: datetime, batch_id: str,
) -> Staged:
    """``collect_zones`` with a quarantine: one batch of all wanted zones, one row per flight."""
    staged = stage_feed(read_zone_feeds(spark, root, wanted), lake, run_ts, batch_id, F.col("zone"))
    return Staged(dedup_zones(staged.observations), staged.rejected_rows)


def read_quarantine(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rejected records of all batches: (batch, source_zone, reason, record, callsign, labels)."""
    columns = (F.col("batch"), F.col("source_zone"), F.col("outcome").alias("reason"), "record", "callsign", *LABEL_COLUMNS)
    try:
        staged = spark.read.schema(_STAGED).parquet(lake.staged_feed)
    except AnalysisException as error:
        if error.getCondition() not in NO_TABLE:
            raise
        staged = spark.createDataFrame([], _STAGED)
    return staged.where(F.col("outcome") != ACCEPTED).select(*columns)


def empty_observations(spark: SparkSession) -> DataFrame:
    """No observations, with the declared schema."""
    return spark.createDataFrame([], FLIGHTS_RAW)
