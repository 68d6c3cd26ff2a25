"""Deterministic "one row per key" and "top n" selections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_pick_rank"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key under ``order``.

    Written as ``row_number() = 1`` so that Catalyst plans a ``WindowGroupLimit`` on both
    sides of the exchange: each map task forwards at most one row per key, which keeps a key
    that holds a large share of the table from landing in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def newest_rows(table: DataFrame, key: str, at: str) -> DataFrame:
    """The rows of a written table with the newest ``at`` of their key; equal ones all stay.

    Which rows these are is told from the key, ``at`` and the row's place (file and row number),
    so that whole rows need neither a sort nor a shuffle. The places come back as bitmaps, broadcast:
    one bit per row of the table, 4 KB per 32,768 rows of a file. Files are told apart by a hash;
    two with one hash share their bits, which only lets some older rows through. So this thins out
    what a pick has to look at and does not replace the pick.

    The table is scanned twice. One that has no places (not read from Parquet files) stays as it is.
    """
    try:
        placed = table.withColumns({
            "_file": F.xxhash64("_metadata.file_path"),
            "_chunk": F.bitmap_bucket_number(F.col("_metadata.row_index")),
            "_bit": F.bitmap_bit_position(F.col("_metadata.row_index")),
        })
    except AnalysisException:
        return table
    place = ("_file", "_chunk")
    newest = placed.select(key, at, *place, "_bit").withColumn(
        _RANK, F.rank().over(Window.partitionBy(key).orderBy(F.desc(at)))).where(F.col(_RANK) == 1)
    # dealt by place first: a bitmap is then made once, not in part by every task
    marks = newest.select(*place, "_bit").repartition(*place).groupBy(*place).agg(
        F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.substring("_bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))
    marked = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.col("_bit") % 8) == 1
    return placed.join(F.broadcast(marks), [*place]).where(marked).select(*table.columns)


def latest_per_flight(
    flights: DataFrame,
    key: str = "flight_id",
    at: str = "extraction_timestamp",
    tie_break: Sequence[str] | None = None,
    stored: bool = False,
) -> DataFrame:
    """The most recent observation of each flight.

    Observations with equal timestamps are ordered by ``tie_break`` (descending), by default
    by every other column, so that the survivor never depends on row order.

    ``stored`` says that ``flights`` is read from a written table, which may be scanned twice: whole
    rows are then sorted and shuffled only where they have the newest timestamp of their flight.
    """
    if tie_break is None:
        tie_break = [c for c in flights.columns if c not in (key, at)]
    if stored:
        flights = newest_rows(flights, key, at)
    return first_per_key(flights, [key], [F.desc(at), *(F.desc(c) for c in tie_break)])


def most_complete_per_key(
    df: DataFrame, key: str, attributes: Sequence[str], repetitive: bool = False,
) -> DataFrame:
    """One row per key: the one with most known attributes, then the smallest values.

    For a ``repetitive`` input (facts, which repeat few attribute combinations) ``distinct``
    goes first: its map-side hash aggregation leaves little to sort. For an input of mostly
    different rows that would only add a shuffle of everything.
    """
    known = sum((F.col(a).isNotNull().cast("int") for a in attributes), F.lit(0))
    order = [F.desc(known), *(F.asc_nulls_last(a) for a in attributes)]
    rows = df.select(key, *attributes)
    return first_per_key(rows.distinct() if repetitive else rows, [key], order)
