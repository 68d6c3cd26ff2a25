"""Exploratory profiles of the feed and the reference tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.functions import count_when, is_blank, percent


def dimension_cardinality(flights: DataFrame, *by: str, approximate: bool = False) -> DataFrame:
    """Distinct airlines, airports (either end) and aircraft types; NULL is not counted.

    The empty string is a value here. The exact count unpivots the four code columns and
    de-duplicates (kind, value) once; ``approximate`` uses HyperLogLog sketches instead, which
    need no shuffle of values at all.
    """
    kinds = {
        "airline_icao": "unique_airlines", "origin_iata": "unique_airports",
        "destination_iata": "unique_airports", "aircraft_code": "unique_aircraft",
    }
    pairs = F.array(*(
        F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value")) for c, kind in kinds.items()
    ))
    values = flights.select(*by, F.inline(pairs)).where(F.col("value").isNotNull())
    names = sorted(set(kinds.values()))
    if approximate:
        return values.groupBy(*by).agg(*(
            F.approx_count_distinct(F.when(F.col("kind") == n, F.col("value"))).alias(n) for n in names
        ))
    return (
        values.distinct().groupBy(*by)
        .agg(*(count_when(F.col("kind") == n).alias(n) for n in names))
    )


def missing_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Percentage of NULL or empty values per column, highest first. One aggregation."""
    columns = list(columns or df.columns)
    text = {name for name, dtype in df.dtypes if dtype == "string"}
    rates = df.agg(*(
        percent(
            count_when(is_blank(F.col(c)) if c in text else F.col(c).isNull()), F.count(F.lit(1)),
        ).alias(c)
        for c in columns
    ))
    return (
        rates.unpivot([], columns, "column_name", "missing_pct")
        .orderBy(F.desc("missing_pct"), "column_name")
    )


def feed_shares(flights: DataFrame) -> DataFrame:
    """Share of aircraft on the ground, without a complete route, airline or type code."""
    total = F.count(F.lit(1))
    no_route = is_blank(F.col("origin_iata")) | is_blank(F.col("destination_iata"))
    grounded = F.coalesce(F.sum("on_ground"), F.lit(0))
    return flights.agg(
        grounded.alias("on_ground_rows"),
        total.alias("total_rows"),
        percent(grounded, total).alias("on_ground_pct"),
        percent(count_when(no_route), total).alias("no_route_pct"),
        percent(count_when(is_blank(F.col("airline_icao"))), total).alias("no_airline_pct"),
        percent(count_when(is_blank(F.col("aircraft_code"))), total).alias("no_aircraft_pct"),
    )


def airports_per_country(airports: DataFrame, country: str = "country_name") -> DataFrame:
    """Number of airports by country, largest first; airports without one are left out."""
    return (
        airports.where(F.col(country).isNotNull())
        .groupBy(country).agg(F.count(F.lit(1)).alias("airport_count"))
        .orderBy(F.desc("airport_count"), country)
    )


def top_airlines_by_fleet(airlines: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` airlines with the largest fleet."""
    return airlines.orderBy(F.desc_nulls_last("n_aircrafts"), "ICAO", "Name").limit(n)
