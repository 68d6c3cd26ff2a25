"""The seven KPIs over the Silver fact.

Every ranking appends its key columns, so equal measures always resolve the same way.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.functions import instant
from skytally.functions.reference import OTHER, UNKNOWN


def _active(facts: DataFrame) -> DataFrame:
    """Valid flights; validity already implies being airborne."""
    return facts.where(F.col("is_valid") & (F.col("on_ground") == 0))


def _stamp(result: DataFrame, run_ts: datetime) -> DataFrame:
    return result.withColumn("computed_at", instant(run_ts))


def _volume(facts: DataFrame, keys: list[str], measure: str) -> DataFrame:
    return facts.groupBy(*keys).agg(F.count(F.lit(1)).alias(measure))


def _top_per_group(counted: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    window = Window.partitionBy(group).orderBy(*order)
    return counted.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)


def _open_routes(facts: DataFrame) -> DataFrame:
    """Active flights of known length that do not return to where they started."""
    return _active(facts).where(
        F.col("distance_km").isNotNull() & (F.col("origin_iata") != F.col("destination_iata"))
    )


def airline_volumes(facts: DataFrame, run_ts: datetime) -> DataFrame:
    """The airline with most active flights. The name is a grouping key of its own."""
    counted = _volume(_active(facts), ["airline_icao", "airline_name"], "active_flights_count")
    top = counted.orderBy(F.desc("active_flights_count"), "airline_icao", "airline_name").limit(1)
    return _stamp(top, run_ts)


def continental_regional(facts: DataFrame, run_ts: datetime) -> DataFrame:
    """Per continent, the airline with most flights that stay within it."""
    regional = _active(facts).where(
        (F.col("origin_continent") == F.col("destination_continent"))
        & (F.col("origin_continent") != UNKNOWN)
    )
    counted = _volume(
        regional, ["origin_continent", "airline_icao", "airline_name"], "regional_flights_count",
    )
    order = [F.desc("regional_flights_count"), F.asc("airline_icao"), F.asc("airline_name")]
    return _stamp(_top_per_group(counted, "origin_continent", order, 1).drop("rank"), run_ts)


def longest_flight(facts: DataFrame, run_ts: datetime, tie_break: str = "flight_id") -> DataFrame:
    """The active flight with the longest route.

    Distances are compared to the millimetre: the same route may differ in the last bits.
    """
    top = (
        _open_routes(facts)
        .orderBy(F.desc(F.round("distance_km", 6)), tie_break)
        .limit(1)
        .select("callsign", "airline_icao", "airline_name", "origin_iata", "destination_iata",
                "distance_km")
    )
    return _stamp(top, run_ts)


def continental_avg_distance(facts: DataFrame, run_ts: datetime) -> DataFrame:
    """Distance statistics by continent of origin."""
    stats = (
        _open_routes(facts).where(F.col("origin_continent") != UNKNOWN)
        .groupBy("origin_continent")
        .agg(
            F.avg("distance_km").alias("avg_distance_km"),
            F.min("distance_km").alias("min_distance_km"),
            F.max("distance_km").alias("max_distance_km"),
            F.count(F.lit(1)).alias("flight_count"),
        )
        .orderBy("origin_continent")
    )
    return _stamp(stats, run_ts)


def aircraft_manufacturers(facts: DataFrame, run_ts: datetime) -> DataFrame:
    """The manufacturer with most active aircraft."""
    known = _active(facts).where(F.col("manufacturer") != OTHER)
    counted = _volume(known, ["manufacturer"], "active_flights_count")
    return _stamp(counted.orderBy(F.desc("active_flights_count"), "manufacturer").limit(1), run_ts)


def airline_aircraft_top3(facts: DataFrame, run_ts: datetime) -> DataFrame:
    """Per country of the origin airport, the three aircraft types used most."""
    known = _active(facts).where(
        F.col("aircraft_code").isNotNull() & F.col("origin_airport_country_code").isNotNull()
    )
    counted = _volume(known, ["origin_airport_country_code", "aircraft_code"], "usage_count")
    order = [F.desc("usage_count"), F.asc("aircraft_code")]
    return _stamp(_top_per_group(counted, "origin_airport_country_code", order, 3), run_ts)


def airport_imbalance(facts: DataFrame, run_ts: datetime) -> DataFrame:
    """The airport where departures and arrivals differ most.

    Flights are counted per route first; each route then adds to its two airports. That is one
    pass over the fact, against two aggregations and a full outer join.
    """
    routes = _volume(
        facts.where(F.col("is_valid")), ["origin_iata", "destination_iata"], "flights",
    )
    ends = F.array(
        F.struct(F.col("origin_iata").alias("airport_iata"),
                 F.col("flights").alias("departures"), F.lit(0).cast("long").alias("arrivals")),
        F.struct(F.col("destination_iata").alias("airport_iata"),
                 F.lit(0).cast("long").alias("departures"), F.col("flights").alias("arrivals")),
    )
    balance = (
        routes.select(F.inline(ends))
        .groupBy("airport_iata")
        .agg(F.sum("departures").alias("departures"), F.sum("arrivals").alias("arrivals"))
        .withColumn("imbalance", F.col("departures") - F.col("arrivals"))
        .withColumn("imbalance_abs", F.abs("imbalance"))
        .orderBy(F.desc("imbalance_abs"), "airport_iata")
        .limit(1)
    )
    return _stamp(balance, run_ts)


KPIS: dict[str, Callable[[DataFrame, datetime], DataFrame]] = {
    "kpi_airline_volumes": airline_volumes,
    "kpi_continental_regional": continental_regional,
    "kpi_longest_flight": longest_flight,
    "kpi_continental_avg_distance": continental_avg_distance,
    "kpi_aircraft_manufacturers": aircraft_manufacturers,
    "kpi_airline_aircraft_top3": airline_aircraft_top3,
    "kpi_airport_imbalance": airport_imbalance,
}


def top3_for_country(top3: DataFrame, country: str | None = None) -> DataFrame:
    """One country's rows of the top-3 table by rank.

    Without a country: ``US`` if present, otherwise the first in alphabetical order.
    """
    code = F.col("origin_airport_country_code")
    if country is not None:
        chosen = F.lit(country)
    else:
        chosen = top3.agg(F.coalesce(F.max(F.when(code == "US", code)), F.min(code))).scalar()
    return top3.where(code == chosen).orderBy("rank")


def countries_listed(top3: DataFrame) -> DataFrame:
    """The countries one can choose from, sorted."""
    code = F.col("origin_airport_country_code")
    return top3.where(code.isNotNull()).select(code).distinct().orderBy(code)
