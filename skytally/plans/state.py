"""The latest observation of every flight as a bucketed table that batches are merged into.

A replay picks the latest of all observations, which shuffles the whole history. The same rows can
be kept instead: one per flight, in buckets by ``flight_id``. A batch is reduced to its own latest
rows, dealt to the same buckets and joined there, so only the batch is shuffled; the history is
read bucket by bucket where it lies and written once as the next version. Versions are complete
tables, the pointer moves last: a merge that is lost half-way changes nothing and can be repeated,
and merging a batch again changes nothing either.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skytally.layout import Lake
from skytally.operators.enrich import derive_columns, fill_from_dimensions
from skytally.operators.pick import latest_per_flight
from skytally.publish import move_pointer, noted, read_pointer
from skytally.schema import BRONZE

KEY, AT = "flight_id", "extraction_timestamp"
_OTHERS = [c for c in BRONZE.names if c not in (KEY, AT)]


def _table_name(path: str) -> str:
    return f"flight_state_{hashlib.md5(path.encode()).hexdigest()}"


def _registered(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """The bucketed table at a path. Spark knows buckets from a catalog only, so it is entered there."""
    name = _table_name(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in BRONZE)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{location}'")
    return spark.table(name)


def _buckets_of(target: str) -> int:
    return int(target.split("/")[0].removeprefix("buckets="))


def read_state(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """The latest observation of every flight merged so far; None before the first batch."""
    pointer = read_pointer(spark, lake.state)
    return None if pointer is None else _registered(spark, f"{lake.state}/{pointer.target}", _buckets_of(pointer.target))


def _row(side: str) -> Column:
    """An observation in the order that decides which is later; NULL where the flight is missing."""
    return F.when(F.col(f"{side}.{KEY}").isNotNull(), F.struct(*(F.col(f"{side}.{c}") for c in (AT, *_OTHERS, KEY))))


def merged(state: DataFrame | None, batch: DataFrame, buckets: int) -> DataFrame:
    """State after a batch, in buckets: per flight the later of what is known and what came.

    Equal timestamps are decided by every other column, as ``latest_per_flight`` does, so the order
    of batches does not matter.
    """
    # dealt out only when reduced to a row per flight, to exactly the buckets of the table
    fresh = latest_per_flight(batch.select(*BRONZE.names), KEY, AT, _OTHERS).repartition(buckets, KEY)
    if state is None:
        return fresh
    # the batch's bucket is held as a hash table while the history's streams past it
    both = state.alias("known").join(
        fresh.hint("shuffle_hash").alias("fresh"), F.col(f"known.{KEY}") == F.col(f"fresh.{KEY}"), "full_outer")
    later = F.greatest(_row("known"), _row("fresh"))
    return both.select(later.alias("later")).select("later.*").select(*BRONZE.names)


def merge_batch(spark: SparkSession, lake: Lake, batch: DataFrame, buckets: int | None = None) -> DataFrame:
    """Merge Bronze rows (their ``flight_id`` is never NULL) into the state; returns it as written.

    A new table has ``buckets``, by default as many as shuffles have partitions, and keeps them.
    """
    pointer = read_pointer(spark, lake.state)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if pointer is not None:
        buckets = _buckets_of(pointer.target)
    target = f"buckets={buckets}/version={uuid.uuid4().hex}"
    path, seen = f"{lake.state}/{target}", Observation()
    rows = merged(read_state(spark, lake), batch, buckets).observe(seen, F.count(F.lit(1)).alias("row_count"))
    rows.write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(_table_name(path))
    move_pointer(spark, lake.state, pointer, target, noted(seen).get("row_count") or 0)
    if pointer is not None:  # the entry goes, the old version's files stay
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(f'{lake.state}/{pointer.target}')}")
    return _registered(spark, path, buckets)


def current_fact(
    spark: SparkSession, lake: Lake, airports: DataFrame | None = None, airlines: DataFrame | None = None,
) -> DataFrame | None:
    """The Silver fact of everything merged so far, without de-duplicating any history."""
    state = read_state(spark, lake)
    return None if state is None else derive_columns(fill_from_dimensions(state, airports, airlines))
