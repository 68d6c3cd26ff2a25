"""Joins with the reference dimensions and the derived Silver columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.functions import continent_code, great_circle_km, manufacturer

# fact column suffix <- dimension column, for either end of the route
_AIRPORT_FILL = {
    "country_name": "country_name",
    "country_code": "country_code",
    "latitude": "latitude",
    "longitude": "longitude",
}


# a dimension planned larger than this is not broadcast
BROADCAST_LIMIT_BYTES = 10 * 1024 * 1024


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; exact for files and inline tables, huge where unknown."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Mark a join side for broadcast up to a checked size, whatever the session's threshold is."""
    return F.broadcast(df) if planned_bytes(df) <= limit else df


def _fill_left(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
               fill: dict[str, str], broadcast_limit: int) -> DataFrame:
    """Left join on the dimension key, filling fact columns only where they are NULL.

    Grouping the dimension by its key makes it unique by construction: a duplicate key cannot
    multiply facts. It also lets Catalyst drop the join altogether when a query uses none of
    the filled columns.
    """
    attributes = F.struct(*(F.col(src).alias(dst) for dst, src in fill.items()))
    lookup = dim.groupBy(F.col(dim_key).alias("_key")).agg(F.max(attributes).alias("_fill"))
    if planned_bytes(dim) <= broadcast_limit:
        lookup = F.broadcast(lookup)
    else:
        # Shuffled join. Its hot keys are split by AQE, which wants the exchange right below
        # the join; a derived key keeps the join from reusing the one of the grouping.
        lookup = lookup.withColumn("_key", F.concat(F.lit(""), F.col("_key")))
    joined = facts.join(lookup, F.col(fact_key) == F.col("_key"), "left")
    return joined.select(*(
        F.coalesce(F.col(c), F.col(f"_fill.{c}")).alias(c) if c in fill else F.col(c)
        for c in facts.columns
    ))


def fill_from_dimensions(
    facts: DataFrame, airports: DataFrame | None = None, airlines: DataFrame | None = None,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Fill country, coordinates and airline name from the dimensions; no dimension, no change.

    Only NULL is filled: an empty string counts as a value. Fact keys are expected normalised,
    dimension keys are used as they are.
    """
    if airports is not None:
        for end in ("origin", "destination"):
            fill = {f"{end}_airport_{dst}": src for dst, src in _AIRPORT_FILL.items()}
            facts = _fill_left(facts, airports, f"{end}_iata", "airport_iata", fill,
                               broadcast_limit)
    if airlines is not None:
        facts = _fill_left(facts, airlines, "airline_icao", "airline_icao",
                           {"airline_name": "airline_name"}, broadcast_limit)
    return facts


def derive_columns(facts: DataFrame) -> DataFrame:
    """Add both continents, the manufacturer and the great-circle distance."""
    return facts.withColumns({
        "origin_continent": continent_code(F.col("origin_airport_country_code")),
        "destination_continent": continent_code(F.col("destination_airport_country_code")),
        "manufacturer": manufacturer(F.col("aircraft_code")),
        "distance_km": great_circle_km(
            F.col("origin_airport_latitude"), F.col("origin_airport_longitude"),
            F.col("destination_airport_latitude"), F.col("destination_airport_longitude"),
        ),
    })
