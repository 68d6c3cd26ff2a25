"""Dimension tables derived from the enriched fact."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.functions import instant, is_blank
from skytally.operators.pick import most_complete_per_key

AIRPORT_ATTRIBUTES = (
    "airport_name", "country_code", "country_name", "continent_code", "latitude", "longitude",
)
COUNTRY_ATTRIBUTES = ("country_name", "continent_code")


def _both_ends(facts: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row per end of the route; ``{end}`` in a source name stands for the end.

    Both ends come out of one scan: a union of two projections would run everything upstream
    twice.
    """
    ends = [
        F.struct(*(F.col(src.format(end=end)).alias(dst) for dst, src in columns.items()))
        for end in ("origin", "destination")
    ]
    return facts.select(F.inline(F.array(*ends)))


def _dimension(rows: DataFrame, key: str, attributes: tuple[str, ...], run_ts: datetime) -> DataFrame:
    known = rows.where(~is_blank(F.col(key)))
    picked = most_complete_per_key(known, key, attributes, repetitive=True)
    return picked.withColumn("last_updated", instant(run_ts))


def airports_of_facts(facts: DataFrame, run_ts: datetime) -> DataFrame:
    """Airports seen at either end of a route."""
    rows = _both_ends(facts, {
        "airport_iata": "{end}_iata",
        "airport_name": "{end}_airport_name",
        "country_code": "{end}_airport_country_code",
        "country_name": "{end}_airport_country_name",
        "continent_code": "{end}_continent",
        "latitude": "{end}_airport_latitude",
        "longitude": "{end}_airport_longitude",
    })
    return _dimension(rows, "airport_iata", AIRPORT_ATTRIBUTES, run_ts)


def airlines_of_facts(facts: DataFrame, run_ts: datetime) -> DataFrame:
    """Airlines seen in the fact."""
    return _dimension(facts, "airline_icao", ("airline_iata", "airline_name"), run_ts)


def aircraft_models_of_facts(facts: DataFrame, run_ts: datetime) -> DataFrame:
    """Aircraft type codes with model and manufacturer."""
    return _dimension(facts, "aircraft_code", ("aircraft_model", "manufacturer"), run_ts)


def countries_of_facts(facts: DataFrame, run_ts: datetime) -> DataFrame:
    """Countries seen at either end of a route, with their continent."""
    rows = _both_ends(facts, {
        "country_code": "{end}_airport_country_code",
        "country_name": "{end}_airport_country_name",
        "continent_code": "{end}_continent",
    })
    return _dimension(rows, "country_code", COUNTRY_ATTRIBUTES, run_ts)


def choose_dimensions(
    facts: DataFrame, run_ts: datetime,
    airports: DataFrame | None = None, airlines: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All four dimensions: the bulk ones where supplied, otherwise those of the fact."""
    return {
        "dim_aircraft_models": aircraft_models_of_facts(facts, run_ts),
        "dim_countries_continents": countries_of_facts(facts, run_ts),
        "dim_airports": airports_of_facts(facts, run_ts) if airports is None else airports,
        "dim_airlines": airlines_of_facts(facts, run_ts) if airlines is None else airlines,
    }


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, as ``(name, row_count)``; a single job over all of them."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
