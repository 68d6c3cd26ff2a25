"""Reading the lake: Bronze history, Silver and Gold snapshots."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions import partition_label_path
from skytally.layout import Lake
from skytally.publish import NO_TABLE, read_documents, read_pointer
from skytally.schema import ATTEMPT, BRONZE, COMMIT, LABEL_COLUMNS, MANY_DAYS


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None when there is none (yet) at that path; other errors surface.

    Where the table has versions, the one its pointer names.
    """
    pointer = read_pointer(spark, path)
    try:
        return spark.read.parquet(path if pointer is None else f"{path}/{pointer.target}")
    except AnalysisException as error:
        if error.getCondition() in NO_TABLE:
            return None
        raise


def read_folder(spark: SparkSession, schema: T.StructType, root: str, folder: str) -> DataFrame:
    """Some partition folders of a table, without listing the others. Missing ones have no rows.

    ``folder`` is a path below ``root`` and may hold wildcards.
    """
    try:
        return spark.read.schema(schema).option("basePath", root).parquet(f"{root}/{folder}")
    except AnalysisException as error:
        if error.getCondition() in NO_TABLE:
            return spark.createDataFrame([], schema)
        raise


def read_hour(spark: SparkSession, schema: T.StructType, root: str, run_ts: datetime) -> DataFrame:
    """The folder of one run's hour."""
    return read_folder(spark, schema, root, partition_label_path(run_ts))


def commits(spark: SparkSession, lake: Lake, day: str | None = None) -> DataFrame:
    """Commits of Bronze, one per batch: (batch, attempt, row_count, hours).

    Of a batch that was committed more than once the first counts. With a ``day`` only the
    commits that may hold rows of it are read.
    """
    folder = "day=*" if day is None else f"day={{{day},{MANY_DAYS}}}"
    known = read_documents(spark, COMMIT, f"{lake.bronze_commits}/{folder}").where("attempt is not null")
    first = F.min_by(F.struct("attempt", "row_count", "hours"), F.struct("committed_micros", "attempt"))
    return known.groupBy("batch").agg(first.alias("c")).select("batch", "c.*")


def find_commit(spark: SparkSession, lake: Lake, run_ts: datetime, batch_id: str) -> Row | None:
    """The commit of a batch whose hour is that of the run."""
    day = dict(p.split("=") for p in partition_label_path(run_ts).split("/"))["tech_day"]
    return commits(spark, lake, day).where(F.col("batch") == batch_id).first()


def read_commit(spark: SparkSession, lake: Lake, commit: Row | None) -> DataFrame:
    """The rows of one commit, from its own folders; none without a commit."""
    if commit is None:
        return spark.createDataFrame([], BRONZE)
    folders = ["/".join(f"{n}={v}" for n, v in zip(LABEL_COLUMNS, hour.split("/"), strict=True)) for hour in commit.hours]
    return spark.read.schema(BRONZE).option("basePath", lake.bronze).parquet(
        *(f"{lake.bronze}/{f}/{ATTEMPT}={commit.attempt}" for f in folders)).drop(ATTEMPT)


def read_bronze(
    spark: SparkSession, lake: Lake, day: str | None = None, batch_id: str | None = None,
    flight_id: str | None = None,
) -> DataFrame:
    """Bronze history under its declared schema: the rows of all commits.

    ``day`` (yyyy-MM-dd) reads the folders of one ``tech_day`` and lists no other (a missing day
    has no rows). ``batch_id`` leaves out the folders of other batches; it and ``flight_id`` are
    pushed to the Parquet scan, where row groups without the flight are skipped. Files without a commit are left out
    as partitions. A history without any commit (written by other means) is read as it stands.
    The names of the committed attempts go through the driver, as the paths of their files do.
    """
    if day is None:
        bronze = spark.read.schema(BRONZE).parquet(lake.bronze)
    else:
        bronze = read_folder(spark, BRONZE, lake.bronze,
                             f"tech_year={day[:4]}/tech_month={day[:7]}/tech_day={day}")
    if ATTEMPT in bronze.columns:
        known = commits(spark, lake, day)
        if batch_id is not None:  # an append without a batch may hold rows of any
            known = known.where((F.col("batch") == batch_id) | (F.col("batch") == F.col(ATTEMPT)))
        attempts = [r.attempt for r in known.select(ATTEMPT).collect()]
        bronze = bronze.where(F.col(ATTEMPT).isin(attempts)).drop(ATTEMPT)
    if batch_id is not None:
        bronze = bronze.where(F.col("batch_id") == batch_id)
    if flight_id is not None:
        bronze = bronze.where(F.col("flight_id") == flight_id)
    return bronze


def uncommitted_files(spark: SparkSession, lake: Lake) -> DataFrame:
    """(path, length, modified, attempt) of Bronze files that no commit counts, for removal.

    Attempts that are still running have no commit yet: compare ``modified``.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
             .load(lake.bronze).select("path", "length", F.col("modificationTime").alias("modified")))
    attempt = F.regexp_extract("path", f"/{ATTEMPT}=([^/]+)/", 1)
    return files.withColumn(ATTEMPT, attempt).join(commits(spark, lake).select(ATTEMPT), ATTEMPT, "left_anti").select(
        "path", "length", "modified", ATTEMPT)


def latest_snapshot(table: DataFrame) -> DataFrame:
    """The rows computed last, without technical columns. No rows in, no rows out."""
    if "computed_at" in table.columns:
        newest = table.agg(F.max("computed_at")).scalar()
        table = table.where(F.col("computed_at") == newest)
    return table.drop("computed_at", *LABEL_COLUMNS)


def read_latest(spark: SparkSession, lake: Lake, kpi: str) -> DataFrame | None:
    """Latest snapshot of a Gold table; None before the first one.

    The table's pointer names its hour, so that hour's files alone are listed and read. A table
    without pointer, or whose latest hour was cleared, is searched as a whole.
    """
    path = lake.gold(kpi)
    pointer = read_pointer(spark, path)
    if pointer is not None and pointer.target:
        return latest_snapshot(spark.read.option("basePath", path).parquet(f"{path}/{pointer.target}"))
    try:
        return latest_snapshot(spark.read.parquet(path))
    except AnalysisException as error:
        if error.getCondition() in NO_TABLE:
            return None
        raise
