"""One scan of the fact for all KPIs and dimensions: counts by grouping sets, stored as a small table.

Four sets of keys cover everything: carriers with their continents, aircraft types with the country
they leave from, and the airports of departure and of arrival with their attributes. Each set has as
many groups as there are different such combinations, however many flights there are, and is
combined before the shuffle. What belongs to a single flight, the longest one, is noted while the
fact streams by.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions import instant, is_blank
from skytally.functions.reference import OTHER, UNKNOWN
from skytally.operators.dimensions import AIRPORT_ATTRIBUTES, COUNTRY_ATTRIBUTES
from skytally.operators.pick import most_complete_per_key
from skytally.publish import noted

AIRPORT = {
    "airport_iata": "{end}_iata", "airport_name": "{end}_airport_name",
    "country_code": "{end}_airport_country_code", "country_name": "{end}_airport_country_name",
    "continent_code": "{end}_continent", "latitude": "{end}_airport_latitude", "longitude": "{end}_airport_longitude",
}


def _airport_of(end: str) -> tuple[str, ...]:
    return tuple(c.format(end=end) for c in AIRPORT.values())


SETS = {
    "carrier": ("airline_icao", "airline_iata", "airline_name", "origin_continent", "destination_continent"),
    "type": ("aircraft_code", "aircraft_model", "manufacturer", "origin_airport_country_code"),
    "departure": _airport_of("origin"),
    "arrival": _airport_of("destination"),
}
KEYS = tuple(dict.fromkeys(c for keys in SETS.values() for c in keys))
LONGEST = ("callsign", "airline_icao", "airline_name", "origin_iata", "destination_iata", "distance_km")


def _set_name() -> Column:
    """The name of a row's grouping set, told by which keys it leaves out."""
    name = F.lit(None).cast("string")
    for s, keys in SETS.items():
        bits = sum(0 if k in keys else 1 << (len(KEYS) - 1 - i) for i, k in enumerate(KEYS))
        name = F.when(F.grouping_id() == bits, s).otherwise(name)
    return name


def roll_up(facts: DataFrame) -> DataFrame:
    """Groups of all sets: ``set``, its keys, flights (valid, active, on an open route) and distances."""
    active = F.col("is_valid") & (F.col("on_ground") == 0)
    opened = active & F.col("distance_km").isNotNull() & (F.col("origin_iata") != F.col("destination_iata"))
    far = F.when(opened, F.col("distance_km"))
    return facts.groupingSets([list(k) for k in SETS.values()], *KEYS).agg(
        _set_name().alias("set"),
        F.count_if(F.col("is_valid")).alias("valid"), F.count_if(active).alias("active"), F.count_if(opened).alias("open"),
        F.sum(far).alias("sum_km"), F.min(far).alias("min_km"), F.max(far).alias("max_km"))


def longest_measure(tie_break: str = "flight_id") -> Column:
    """The flight of the longest open route, as one aggregate; NULL without any."""
    opened = (F.col("is_valid") & (F.col("on_ground") == 0) & F.col("distance_km").isNotNull()
              & (F.col("origin_iata") != F.col("destination_iata")))
    order = F.when(opened, F.struct((-F.round("distance_km", 6)).alias("km"), F.col(tie_break).alias("tie")))
    return F.min_by(F.struct(*LONGEST), order)


class RolledUp:
    """A roll-up written from one scan of the fact, and the longest flight noted on the way."""

    def __init__(self, facts: DataFrame, path: str):
        spark, seen = facts.sparkSession, Observation()
        rolled = roll_up(facts.observe(seen, longest_measure().alias("longest")))
        rolled.write.mode("overwrite").parquet(path)
        self.groups = spark.read.schema(rolled.schema).parquet(path)
        self.longest: Row | None = noted(seen).get("longest")
        self.types = T.StructType([facts.schema[c] for c in LONGEST])

    def of(self, name: str, condition: str = "true") -> DataFrame:
        return self.groups.where((F.col("set") == name) & F.expr(condition))


def kpis_of_rollup(rolled: RolledUp, spark: SparkSession, run_ts: datetime) -> dict[str, DataFrame]:
    """The seven KPIs, row for row those of ``operators.kpis``, from the groups alone."""
    def top(df: DataFrame, *order: Column) -> DataFrame:
        return df.orderBy(*order).limit(1)

    def ranked(df: DataFrame, group: str, n: int, *order: Column) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= n)

    def counted(df: DataFrame, measure: str, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.sum("active").alias(measure))

    carriers, types = rolled.of("carrier", "active > 0"), rolled.of("type", "active > 0")
    volumes = top(counted(carriers, "active_flights_count", "airline_icao", "airline_name"),
                  F.desc("active_flights_count"), F.asc("airline_icao"), F.asc("airline_name"))
    regional = carriers.where((F.col("origin_continent") == F.col("destination_continent")) & (F.col("origin_continent") != UNKNOWN))
    regional = ranked(counted(regional, "regional_flights_count", "origin_continent", "airline_icao", "airline_name"),
                      "origin_continent", 1, F.desc("regional_flights_count"), F.asc("airline_icao"), F.asc("airline_name")).drop("rank")
    longest = spark.createDataFrame([] if rolled.longest is None else [tuple(rolled.longest[c] for c in LONGEST)], rolled.types)
    distances = (
        rolled.of("departure", "open > 0").where(F.col("origin_continent") != UNKNOWN).groupBy("origin_continent")
        .agg((F.sum("sum_km") / F.sum("open")).alias("avg_distance_km"), F.min("min_km").alias("min_distance_km"),
             F.max("max_km").alias("max_distance_km"), F.sum("open").alias("flight_count"))
        .orderBy("origin_continent"))
    makers = top(counted(types.where(F.col("manufacturer") != OTHER), "active_flights_count", "manufacturer"),
                 F.desc("active_flights_count"), F.asc("manufacturer"))
    known = types.where(F.col("aircraft_code").isNotNull() & F.col("origin_airport_country_code").isNotNull())
    top3 = ranked(counted(known, "usage_count", "origin_airport_country_code", "aircraft_code"),
                  "origin_airport_country_code", 3, F.desc("usage_count"), F.asc("aircraft_code"))
    none = F.lit(0).cast("long")
    ends = rolled.of("departure", "valid > 0").select(
        F.col("origin_iata").alias("airport_iata"), F.col("valid").alias("departures"), none.alias("arrivals")).union(
        rolled.of("arrival", "valid > 0").select("destination_iata", none, "valid"))
    balance = top(
        ends.groupBy("airport_iata").agg(F.sum("departures").alias("departures"), F.sum("arrivals").alias("arrivals"))
        .withColumn("imbalance", F.col("departures") - F.col("arrivals")).withColumn("imbalance_abs", F.abs("imbalance")),
        F.desc("imbalance_abs"), F.asc("airport_iata"))
    tables = {
        "kpi_airline_volumes": volumes, "kpi_continental_regional": regional, "kpi_longest_flight": longest,
        "kpi_continental_avg_distance": distances, "kpi_aircraft_manufacturers": makers,
        "kpi_airline_aircraft_top3": top3, "kpi_airport_imbalance": balance,
    }
    return {name: df.withColumn("computed_at", instant(run_ts)) for name, df in tables.items()}


def dimensions_of_rollup(rolled: RolledUp, run_ts: datetime) -> dict[str, DataFrame]:
    """The four dimensions of the fact, row for row those of ``operators.dimensions``."""
    def dimension(rows: DataFrame, key: str, attributes: tuple[str, ...]) -> DataFrame:
        return most_complete_per_key(rows.where(~is_blank(F.col(key))), key, attributes, repetitive=True).withColumn(
            "last_updated", instant(run_ts))

    def ends(columns: Mapping[str, str]) -> DataFrame:
        parts = [rolled.of(name).select(*(F.col(src.format(end=end)).alias(dst) for dst, src in columns.items()))
                 for name, end in (("departure", "origin"), ("arrival", "destination"))]
        return parts[0].union(parts[1])

    return {
        "dim_aircraft_models": dimension(rolled.of("type"), "aircraft_code", ("aircraft_model", "manufacturer")),
        "dim_countries_continents": dimension(ends({c: AIRPORT[c] for c in ("country_code", *COUNTRY_ATTRIBUTES)}),
                                              "country_code", COUNTRY_ATTRIBUTES),
        "dim_airports": dimension(ends(AIRPORT), "airport_iata", AIRPORT_ATTRIBUTES),
        "dim_airlines": dimension(rolled.of("carrier"), "airline_icao", ("airline_iata", "airline_name")),
    }
