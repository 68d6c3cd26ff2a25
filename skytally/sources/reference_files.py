"""Bulk reference data: airports and airlines, and the freshness of their snapshots."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.functions import continent_code, country_code_of_name, instant, is_blank, to_double
from skytally.functions.reference import CODE_OF_NAME_KEY, name_key
from skytally.operators.pick import most_complete_per_key
from skytally.schema import AIRLINE_RECORDS, AIRPORT_RECORDS, AIRPORTS_CSV, CORRUPT, ZONES
from skytally.session import scratch_path
from skytally.sinks.lake import write_dimension
from skytally.sources.lake import read_snapshot

log = logging.getLogger(__name__)

MAX_AGE_DAYS = 7
MIN_AIRPORT_FIELDS = 8
_MISSING = r"\N"
_WHITESPACE = " \t\r\n"


def _stripped(text: Column) -> Column:
    return F.trim(F.coalesce(text, F.lit("")), F.lit(_WHITESPACE))


def _field_count(line: Column) -> Column:
    """Fields of a CSV line: commas outside quotes, plus one."""
    return F.size(F.split(F.regexp_replace(line, '"[^"]*"', ""), ","))


def read_airports_csv(spark: SparkSession, path: str) -> DataFrame:
    r"""Airports of an OpenFlights file that have a three-character IATA code.

    A line needs at least 8 fields. Spark pads shorter lines with NULL and keeps them in
    ``_corrupt_record``, where the fields can be counted. ``\N`` stands for a missing value.
    A quoted field may hold line breaks; the price is that a file, small here, is read by one task.
    """
    lines = (
        spark.read.schema(AIRPORTS_CSV)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("escape", '"')
        .option("multiLine", True)
        .option("columnPruning", False)  # a pruned parser does not notice short lines
        .csv(path)
    )
    complete = F.col(CORRUPT).isNull() | (_field_count(F.col(CORRUPT)) >= MIN_AIRPORT_FIELDS)
    iata = _stripped(F.col("iata"))
    return lines.where(complete & (F.length(iata) == 3)).select(
        iata.alias("airport_iata"),
        F.nullif(_stripped(F.col("icao")), F.lit(_MISSING)).alias("airport_icao"),
        _stripped(F.col("name")).alias("airport_name"),
        _stripped(F.col("country")).alias("country_name"),
        to_double(F.col("latitude")).alias("latitude"),
        to_double(F.col("longitude")).alias("longitude"),
    )


def read_airport_records(spark: SparkSession, path: str) -> DataFrame:
    """Airport records landed as JSON lines."""
    return spark.read.schema(AIRPORT_RECORDS).json(path)


def airports_of_records(records: DataFrame) -> DataFrame:
    """Airports of a record list; a record needs an IATA code."""
    return records.where(~is_blank(F.col("iata"))).select(
        F.col("iata").alias("airport_iata"),
        F.col("icao").alias("airport_icao"),
        F.col("name").alias("airport_name"),
        F.col("country").alias("country_name"),
        to_double(F.col("latitude").cast("string")).alias("latitude"),
        to_double(F.col("longitude").cast("string")).alias("longitude"),
    )


def airports_dimension(airports: DataFrame, run_ts: datetime) -> DataFrame:
    """One row per IATA code with country and continent codes."""
    attributes = ("airport_icao", "airport_name", "country_name", "latitude", "longitude")
    return most_complete_per_key(airports, "airport_iata", attributes).select(
        "airport_iata", "airport_icao", "airport_name", "country_name",
        country_code_of_name(F.col("country_name")).alias("country_code"),
        "latitude", "longitude",
    ).withColumns({
        "continent_code": continent_code(F.col("country_code")),
        "last_updated": instant(run_ts),
    })


def read_airline_records(spark: SparkSession, path: str) -> DataFrame:
    """Airline records ``{Name, ICAO, IATA, n_aircrafts}`` landed as JSON lines."""
    return spark.read.schema(AIRLINE_RECORDS).json(path)


def airlines_dimension(records: DataFrame, run_ts: datetime) -> DataFrame:
    """One row per ICAO code; records without one are dropped."""
    named = records.where(~is_blank(F.col("ICAO"))).select(
        F.col("ICAO").alias("airline_icao"),
        F.col("IATA").alias("airline_iata"),
        F.col("Name").alias("airline_name"),
    )
    return most_complete_per_key(named, "airline_icao", ("airline_iata", "airline_name")) \
        .withColumn("last_updated", instant(run_ts))


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone documents (one JSON object per file) as a ``zones`` map column."""
    documents = spark.read.text(path, wholetext=True)
    return documents.select(F.from_json("value", ZONES).alias("zones"))


def filter_countries(airports: DataFrame, spec: str, country: str = "country_name") -> DataFrame:
    """Airports of the listed countries.

    ``spec`` is ``"ALL"`` or a comma list such as ``"UNITED_STATES,FRANCE"``. Unknown names
    are ignored; when none is left, all countries are kept.
    """
    if spec.strip().upper() == "ALL":
        return airports
    wanted = sorted({name_key(name) for name in spec.split(",")} & CODE_OF_NAME_KEY.keys())
    if not wanted:
        return airports
    key = F.regexp_replace(F.lower(F.col(country)), "[^a-z]", "")
    return airports.where(key.isin(wanted))


def snapshot_freshness(
    snapshot: DataFrame, as_of: datetime, max_age_days: float = MAX_AGE_DAYS,
) -> DataFrame:
    """Age of a snapshot by its newest file: one row ``(newest, age_days, fresh)``."""
    newest = F.max("_metadata.file_modification_time")
    age = (F.unix_micros(instant(as_of)) - F.unix_micros("newest")) / 86_400e6
    return (
        snapshot.agg(newest.alias("newest"))
        .withColumn("age_days", age)
        .withColumn("fresh", F.coalesce(F.col("age_days") < max_age_days, F.lit(False)))
    )


def fresh_or_refreshed(
    spark: SparkSession, path: str, refresh: Callable[[], DataFrame], as_of: datetime,
    max_age_days: float = MAX_AGE_DAYS,
) -> DataFrame | None:
    """A dimension for this run: the snapshot while fresh, otherwise refreshed and rewritten.

    When the refresh fails or brings nothing, the old snapshot serves, however old; None if
    there is none. The refresh is written to the scratch folder first: an overwrite deletes
    before it computes, so a failing one would take the old snapshot with it.
    """
    snapshot = read_snapshot(spark, path)
    if snapshot is not None and snapshot_freshness(snapshot, as_of, max_age_days).first().fresh:
        return snapshot
    try:
        staged = scratch_path(spark, "dimension")
        refresh().write.parquet(staged)
        refreshed = spark.read.parquet(staged)
        if refreshed.isEmpty():
            return snapshot
    except Exception:  # noqa: BLE001 - any source failure falls back to the old snapshot
        log.warning("refreshing %s failed", path, exc_info=True)
        return snapshot
    write_dimension(refreshed, path)
    return read_snapshot(spark, path)
