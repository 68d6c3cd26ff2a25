"""Selecting the feed by geographic zone, airline and aircraft type."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.operators.pick import first_per_key

GLOBAL_ZONE = "global"


class Box(NamedTuple):
    """Bounding box: top, bottom (latitude), left, right (longitude)."""

    y1: float
    y2: float
    x1: float
    x2: float

    @classmethod
    def parse(cls, bounds: str) -> Box:
        """Read the ``"y1,y2,x1,x2"`` spelling."""
        return cls(*(float(part) for part in bounds.split(",")))

    @classmethod
    def of_zone(cls, zone: Mapping[str, float]) -> Box:
        """The box of a zone document: its top-left and bottom-right corners."""
        return cls(zone["tl_y"], zone["br_y"], zone["tl_x"], zone["br_x"])

    def holds(self) -> Column:
        """Whether the row's position is inside; left of right, the box crosses the date line."""
        longitude = F.col("longitude")
        inside = longitude.between(self.x1, self.x2)
        if self.x1 > self.x2:  # NaN, which is greater than any number, is nowhere
            inside = ((longitude >= self.x1) & ~F.isnan(longitude)) | (longitude <= self.x2)
        return F.col("latitude").between(self.y2, self.y1) & inside


def filter_feed(
    feed: DataFrame, zones: Mapping[str, Box], zone: str | None = None,
    airline: str | None = None, aircraft_type: str | None = None,
) -> DataFrame:
    """Observations of a zone, airline and type. An unknown zone has none; no error."""
    conditions = []
    if zone is not None and zone != GLOBAL_ZONE:
        conditions.append(zones[zone].holds() if zone in zones else F.lit(False))
    if airline is not None:
        conditions.append(F.col("airline_icao") == airline)
    if aircraft_type is not None:
        conditions.append(F.col("aircraft_code") == aircraft_type)
    for condition in conditions:
        feed = feed.where(condition)
    return feed


def union_zones(feed: DataFrame, zones: Mapping[str, Box], wanted: Iterable[str]) -> DataFrame:
    """The feeds of all wanted zones, each row stamped with the zone that returned it.

    Zones overlap, so an observation may appear several times. The zones are tested side by
    side in one scan; a union of filters would read the feed once per zone.
    """
    hits = [
        F.when(F.lit(True) if name == GLOBAL_ZONE else zones[name].holds(), name)
        for name in wanted if name == GLOBAL_ZONE or name in zones
    ]
    if not hits:
        return feed.where(F.lit(False))
    others = [c for c in feed.columns if c != "source_zone"]
    return (
        feed.select(*others, F.explode(F.array_compact(F.array(*hits))).alias("source_zone"))
        .select(*feed.columns)
    )


CELL_DEGREES = 10.0
_ROWS, _COLUMNS = 90, 180  # degrees at the border cells, which take what lies beyond


def zone_table(spark: SparkSession, zones: Mapping[str, Box]) -> DataFrame:
    """Zones as a table (zone, y1, y2, x1, x2), as ``union_zone_table`` takes them."""
    rows = [(name, *map(float, box)) for name, box in zones.items()]
    return spark.createDataFrame(rows, "zone string, y1 double, y2 double, x1 double, x2 double")


def _cell(value: Column, most: int, degrees: float) -> Column:
    """Number of the cell a coordinate lies in; NULL for none. Border cells reach to infinity."""
    inside = F.least(F.greatest(value, F.lit(float(-most))), F.lit(float(most)))
    return F.when(~F.isnan(value), F.floor(inside / degrees)).cast("int")


def zone_cells(zones: DataFrame, degrees: float = CELL_DEGREES) -> DataFrame:
    """Every grid cell that a zone touches: a bounded number per zone, whatever its size."""
    def steps(low: Column, high: Column, most: int) -> Column:
        return F.sequence(_cell(low, most, degrees), _cell(high, most, degrees))

    west, east = F.lit(float(-_COLUMNS)), F.lit(float(_COLUMNS))
    x1, x2 = F.col("x1"), F.col("x2")
    columns = F.when(x1 <= x2, steps(x1, F.greatest(x1, x2), _COLUMNS)).otherwise(
        F.array_distinct(F.concat(steps(x1, F.greatest(x1, east), _COLUMNS), steps(F.least(x2, west), x2, _COLUMNS))))
    rows = F.when(F.col("y2") <= F.col("y1"), steps(F.col("y2"), F.greatest("y1", "y2"), _ROWS))
    return zones.withColumn("_row", F.explode(rows)).withColumn("_column", F.explode(columns))


def union_zone_table(
    feed: DataFrame, zones: DataFrame, wanted: Iterable[str] | None = None, degrees: float = CELL_DEGREES,
) -> DataFrame:
    """``union_zones`` for zones that are a table: an equi-join on grid cells, then the exact test.

    A row meets only the zones of its own cell, so any number of zones can be held against the
    feed. A zone whose left is greater than its right crosses the date line. Without ``wanted``
    all zones count; ``global`` among them adds every row.
    """
    names = None if wanted is None else list(wanted)
    if names is not None:
        zones = zones.where(F.col("zone").isin(names))
    others = [c for c in feed.columns if c != "source_zone"]
    cells = zone_cells(zones, degrees)
    located = feed.withColumns({
        "_row": _cell(F.col("latitude"), _ROWS, degrees), "_column": _cell(F.col("longitude"), _COLUMNS, degrees)})
    longitude = F.col("longitude")
    across = F.when(F.col("x1") <= F.col("x2"), longitude.between(F.col("x1"), F.col("x2"))).otherwise(
        (longitude >= F.col("x1")) | (longitude <= F.col("x2")))
    found = (located.join(cells, ["_row", "_column"])
             .where(F.col("latitude").between(F.col("y2"), F.col("y1")) & across)
             .select(*others, F.col("zone").alias("source_zone")))
    if names is not None and GLOBAL_ZONE in names:
        found = found.unionByName(feed.select(*others, F.lit(GLOBAL_ZONE).alias("source_zone")))
    return found.select(*feed.columns)


def dedup_zones(collected: DataFrame, order: Iterable[str] | None = None) -> DataFrame:
    """One row per ``flight_id`` over all zones: the latest, then the smallest other values."""
    if order is None:
        order = [c for c in collected.columns if c not in ("flight_id", "extraction_timestamp")]
    ranking = [F.desc("extraction_timestamp"), *(F.asc_nulls_last(c) for c in order)]
    return first_per_key(collected, ["flight_id"], ranking)


def subzones(zones: DataFrame) -> DataFrame:
    """Zones that have sub-zones, with their number and names.

    Expects one ``zones`` column: a map from zone name to its box and sub-zones.
    """
    return (
        zones.select(F.explode("zones").alias("zone", "info"))
        .where(F.coalesce(F.size("info.subzones"), F.lit(0)) > 0)
        .select(
            "zone",
            F.size("info.subzones").alias("subzone_count"),
            F.array_join(F.map_keys("info.subzones"), ",").alias("subzone_names"),
        )
    )
