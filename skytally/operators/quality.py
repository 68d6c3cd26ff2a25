"""Quality flags per observation and the profiles built on them."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.functions import count_when, is_blank, normalize_code, percent

CODE_COLUMNS = ("origin_iata", "destination_iata", "airline_icao", "aircraft_code")

MAX_ALTITUDE_FT = 50_000
MAX_GROUND_SPEED_KN = 600
MIN_PCT_VALID = 70


def normalize_codes(flights: DataFrame) -> DataFrame:
    """Upper-case and trim the four code columns."""
    return flights.withColumns({c: normalize_code(F.col(c)) for c in CODE_COLUMNS})


def _outside(value: Column, low: float, high: float) -> Column:
    """Missing or out of range. NaN sorts above every number, so it is outside as well."""
    return value.isNull() | ~value.between(low, high)


def quality_rules() -> dict[str, Column]:
    """Flag name -> condition, in the order the flags are reported.

    The conditions expect normalised codes. Position, altitude and speed are judged only for
    aircraft known to be airborne; an altitude of 0 is fine.
    """
    airborne = F.col("on_ground") == 0
    lat, lon = F.col("latitude"), F.col("longitude")
    return {
        "MISSING_ORIGIN": is_blank(F.col("origin_iata")),
        "MISSING_DESTINATION": is_blank(F.col("destination_iata")),
        "MISSING_AIRLINE": is_blank(F.col("airline_icao")),
        "MISSING_AIRCRAFT_CODE": is_blank(F.col("aircraft_code")),
        "MISSING_POSITION": airborne & (lat.isNull() | lon.isNull()),
        "INVALID_ALTITUDE": airborne & _outside(F.col("altitude"), 0, MAX_ALTITUDE_FT),
        "INVALID_GROUND_SPEED": airborne & _outside(F.col("ground_speed"), 0, MAX_GROUND_SPEED_KN),
        "INCONSISTENT_POSITION": airborne & (_outside(lat, -90, 90) | _outside(lon, -180, 180)),
    }


def flag_quality(flights: DataFrame) -> DataFrame:
    """Normalise codes, then add ``data_quality_flags`` and ``is_valid``.

    ``data_quality_flags`` is a comma-joined list, NULL when nothing is wrong. ``is_valid``
    means airborne and unflagged, which implies known route and airline; never NULL.
    """
    rules = quality_rules()
    flags = F.concat_ws(",", *(F.when(condition, flag) for flag, condition in rules.items()))
    airborne = F.coalesce(F.col("on_ground") == 0, F.lit(False))
    # stated from the conditions, not from the flag text: a query that only filters on
    # validity then never builds the text
    return normalize_codes(flights).withColumns({
        "data_quality_flags": F.nullif(flags, F.lit("")),
        "is_valid": airborne & ~reduce(or_, rules.values()),
    })


def profile_measures() -> dict[str, Column]:
    """The counters of the quality profile, as aggregates over flagged observations."""
    return {
        "total_rows": F.count(F.lit(1)),
        "valid_rows": count_when(F.col("is_valid")),
        "on_ground": count_when(F.col("on_ground") == 1),
        "on_flight": count_when(F.col("on_ground") == 0),
        "missing_origin": count_when(is_blank(F.col("origin_iata"))),
        "missing_destination": count_when(is_blank(F.col("destination_iata"))),
        "missing_airline": count_when(is_blank(F.col("airline_icao"))),
        "missing_aircraft": count_when(is_blank(F.col("aircraft_code"))),
    }


def quality_profile(flagged: DataFrame, *by: str, min_pct_valid: float = MIN_PCT_VALID) -> DataFrame:
    """Counters, shares and the low-quality verdict in one pass; optionally per group.

    An empty input has an empty profile (no row).
    """
    measures = [measure.alias(name) for name, measure in profile_measures().items()]
    return with_shares(flagged.groupBy(*by).agg(*measures), min_pct_valid)


def with_shares(counters: DataFrame, min_pct_valid: float = MIN_PCT_VALID) -> DataFrame:
    """Add shares and the low-quality verdict to the counters; rows that count nothing go."""
    total, valid = F.col("total_rows"), F.col("valid_rows")
    return counters.where(total > 0).withColumns({
        "pct_valid": percent(valid, total),
        "pct_on_ground": percent(F.col("on_ground"), total),
        "low_quality": valid / total * 100 < min_pct_valid,
    })


def flag_counts(flagged: DataFrame, *by: str) -> DataFrame:
    """How often each flag was raised, most frequent first.

    Rows are first counted per distinct flag list (at most 2^8 of them), so splitting and
    exploding touch a handful of rows instead of every observation. Exploding drops the
    unflagged ones; a filter in front would evaluate the flags twice.
    """
    return (
        flagged.groupBy(*by, "data_quality_flags").agg(F.count(F.lit(1)).alias("n"))
        .select(*by, F.explode(F.split("data_quality_flags", ",")).alias("flag"), "n")
        .groupBy(*by, "flag").agg(F.sum("n").alias("count"))
        .orderBy(*by, F.desc("count"), "flag")
    )
