"""Helpers the operators share: tables, written intermediates, words, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.session import scratch_path

# Texts vary from empty to megabytes; small batches bound a worker's memory.
BATCH_ROWS = 500
BATCH_BYTES = 16 << 20

# A-Z become a-z, every other ASCII byte that is no digit or letter a space.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256))


def prepare(spark: SparkSession) -> SparkSession:
    """Set how many rows and bytes go to a Python worker at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write a table to the cluster's shared scratch folder and read it back.

    What several jobs read, or what must not be computed again when executors are lost,
    goes through here; it cuts the lineage without local checkpoints.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def split_words(text: bytes) -> list[bytes]:
    """Lower-case A-Z, then the runs of ASCII letters, digits and non-ASCII bytes."""
    return text.translate(WORD_BYTES).split()


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow column as UTF-8 bytes; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def map_batches(df: DataFrame, one: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``mapInArrow`` for functions that turn a batch into columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = one(batch)
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x, type=f.type)
                 for f, x in ((f, columns[f.name]) for f in arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def fingerprint(pairs: DataFrame) -> tuple:
    """Count and hash sum of a table of pairs; equal tables have equal ones."""
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Smallest reachable id per vertex: rows (id, component) for every vertex of an edge.

    ``edges`` has long columns a and b. Alternates large-star and small-star steps, so the
    number of rounds grows with the logarithm of a component's size; every step is written
    to the shared folder. Null ends and self loops are dropped, repeated edges count once.
    The hub of a star is never collected: both steps are a ``min`` per vertex and a join.
    """
    def directed(df: DataFrame) -> DataFrame:
        return df.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    current = stored(directed(edges.where("a is not null and b is not null")), purpose)
    before = fingerprint(current)
    while before[0]:
        # large star: larger neighbours of a vertex move to the smallest of it and its neighbours
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = stored(directed(both.join(least, "a").where("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b"))), purpose)
        # small star: smaller neighbours of a vertex, and itself, move to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        current = stored(directed(
            large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))), purpose)
        after = fingerprint(current)
        if after == before:
            break
        before = after
    return current.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("id"), F.col("m").alias("component")).union(
        current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
