"""Small documents that say which files count: pointers that are moved last, and commits.

Data files appear one by one, so what counts is decided by one document, written after them. A
document is a single file that the committer renames into place: it is there whole or not at all.
"""

from __future__ import annotations

from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession

from skytally.functions import as_utc

# Conditions that mean "nothing written there yet".
NO_TABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")

POINTER = "sequence long, target string, row_count long, at_micros long"


def noted(seen: Observation) -> dict:
    """What an observation saw; nothing where Spark found out that there was nothing to run."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def micros(at: datetime) -> int:
    """An instant as microseconds since 1970, which no session's time zone changes."""
    return int(as_utc(at).timestamp() * 1_000_000)


def read_documents(spark: SparkSession, schema: str, path: str) -> DataFrame:
    """Documents below a path (which may hold wildcards); none if there is no such path."""
    try:
        return spark.read.schema(schema).option("ignoreMissingFiles", True).json(path)
    except AnalysisException as error:
        if error.getCondition() in NO_TABLE:
            return spark.createDataFrame([], schema)
        raise


def write_document(spark: SparkSession, schema: str, path: str, mode: str, **values: object) -> None:
    """Write one document as one file."""
    spark.createDataFrame([values], schema).coalesce(1).write.mode(mode).json(path)


def read_pointer(spark: SparkSession, path: str) -> Row | None:
    """The pointer of a table: its last complete move; None before the first."""
    slots = read_documents(spark, POINTER, f"{path}/_pointer/slot=*").where("sequence is not null").collect()  # two at most
    return max(slots, key=lambda slot: slot.sequence, default=None)


def move_pointer(
    spark: SparkSession, path: str, last: Row | None, target: str, row_count: int, at: datetime | None = None,
) -> None:
    """Point a table, whose ``last`` pointer has been read, at a folder below it.

    There are two slots, written in turn. Only the older one is replaced, so a move that is lost
    half-way leaves the pointer where it was, and reading takes two files however often it moved.
    """
    sequence = 0 if last is None else last.sequence + 1
    write_document(spark, POINTER, f"{path}/_pointer/slot={sequence % 2}", "overwrite",
                   sequence=sequence, target=target, row_count=row_count, at_micros=micros(at or datetime.now(timezone.utc)))
