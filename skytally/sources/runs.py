"""Run-metric documents and job logs."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions import instant
from skytally.publish import NO_TABLE
from skytally.schema import CORRUPT, RUN_METRICS

# What a job log says on entering each phase, and the phase's display name.
LOG_PHASES = [
    ("Phase 1 :", "Extraction API"),
    ("Phase 2 :", "Validation & qualité"),
    ("Phase 3 :", "Profil qualité"),
    ("Phase 4 :", "Partitionnement"),
    ("Phase 5 :", "Écriture Bronze"),
    ("Phase 6 :", "Silver + Gold (KPIs)"),
]

# Log lines that tell how a run ended.
LOG_METRICS_SAVED = "✓ Métriques sauvegardées"
LOG_SUCCEEDED = "✅ Batch complété avec succès"
LOG_FAILED = "❌ Erreur lors du batch"
LOG_EMPTY = "Aucun vol collecté"

RUNNING_SECONDS = 180
_LOG_TIMESTAMP = "yyyy-MM-dd HH:mm:ss,SSS"


def _run_documents(
    spark: SparkSession, path: str, pattern: str, multi_line: bool, newer_than: int | None,
) -> DataFrame:
    """Readable run documents with ``file`` and ``file_modified``, of files modified after a second."""
    schema = T.StructType([*RUN_METRICS, T.StructField(CORRUPT, T.StringType(), True)])
    reader = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if newer_than is not None:
        at = datetime.fromtimestamp(newer_than, timezone.utc)
        reader = reader.option("modifiedAfter", f"{at:%Y-%m-%dT%H:%M:%S}").option("timeZone", "UTC")
    try:
        documents = reader.json(path)
    except AnalysisException:  # no run yet
        return spark.createDataFrame([], RUN_METRICS).withColumns({
            "file_modified": F.lit(None).cast("timestamp"), "file": F.lit(None).cast("string")})
    return (
        documents.select("*", F.col("_metadata.file_modification_time").alias("file_modified"),
                         F.col("_metadata.file_path").alias("file"))
        .where(F.col(CORRUPT).isNull() & F.col("batch_id").isNotNull())
        .drop(CORRUPT)
    )


def read_run_metrics(
    spark: SparkSession, path: str, pattern: str = "*.json", multi_line: bool = True,
) -> DataFrame:
    """All run documents under a folder, with ``file_modified``; unreadable files are skipped.

    No folder, no documents.

    ``multi_line`` reads one (possibly pretty-printed) document per file.
    """
    return _run_documents(spark, path, pattern, multi_line, None).drop("file")


_INDEX_OVERLAP_SECONDS = 5  # files that came while the last refresh was listing


def refresh_run_index(spark: SparkSession, path: str, index: str) -> DataFrame:
    """All run documents under a folder, opening only files that came since the last refresh.

    What has been read is kept as Parquet under ``index`` with the file it came from. New files are
    told by their modification time; those of the last seconds are looked at again, and a file that
    is in the index already is not added twice. A refresh that is lost half-way is made up for by
    the next. Rows are as ``read_run_metrics`` gives them.
    """
    schema = T.StructType([
        *RUN_METRICS, T.StructField("file_modified", T.TimestampType(), True), T.StructField("file", T.StringType(), True)])
    known = _index(spark, index, schema)
    latest = known.agg(F.unix_seconds(F.max("file_modified"))).first()[0]
    since = None if latest is None else latest - _INDEX_OVERLAP_SECONDS
    new = _run_documents(spark, path, "*.json", True, since)
    recent = known.where(F.unix_seconds("file_modified") >= (since or 0) - 1).select("file")
    new.join(recent, "file", "left_anti").select(*schema.names).write.mode("append").parquet(index)
    return _index(spark, index, schema).dropDuplicates(["file"]).drop("file")


def _index(spark: SparkSession, index: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(index)
    except AnalysisException as error:
        if error.getCondition() in NO_TABLE:
            return spark.createDataFrame([], schema)
        raise


def read_job_logs(spark: SparkSession, path: str, pattern: str = "batch_job_*.log") -> DataFrame:
    """Log lines with their file, its modification time and a position within the file."""
    lines = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path)
    )
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
        # blocks of a file are read in order, and ids grow within a task
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("position"),
        "value",
    )


def job_log_status(lines: DataFrame, as_of: datetime) -> DataFrame:
    """State of every run, from its log: one row per file.

    ``reached`` is the furthest phase (0-based, -1 before the first). An unfinished run counts
    as running while its log was touched less than three minutes before ``as_of``.
    """
    def seen(marker: str):
        return F.max(F.col("value").contains(marker))

    phases = [F.when(F.col("value").contains(m), i) for i, (m, _) in enumerate(LOG_PHASES)]
    furthest = F.coalesce(F.max(F.greatest(*phases)), F.lit(-1))
    first_line = F.min_by("value", F.when(F.trim("value") != "", F.col("position")))
    started = F.try_to_timestamp(F.substring("first_line", 1, 23), F.lit(_LOG_TIMESTAMP))
    age = F.unix_seconds(instant(as_of)) - F.unix_seconds("file_modified")
    labels = F.array(*(F.lit(label) for _, label in LOG_PHASES))
    return (
        lines.groupBy("file", "file_modified")
        .agg(
            furthest.alias("reached"),
            (seen(LOG_METRICS_SAVED) | seen(LOG_SUCCEEDED) | seen(LOG_FAILED)).alias("finished"),
            seen(LOG_SUCCEEDED).alias("success"),
            seen(LOG_EMPTY).alias("empty"),
            first_line.alias("first_line"),
        )
        .select(
            "file", "file_modified", "reached",
            F.when(F.col("reached") >= 0, F.get(labels, F.col("reached"))).alias("phase"),
            "finished", "success", "empty", started.alias("started"), age.alias("age_seconds"),
            F.when(F.col("finished"), "done").when(age < RUNNING_SECONDS, "running")
            .otherwise("stalled").alias("state"),
        )
    )
