"""Silver to Gold: the seven KPI tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from skytally.layout import Lake
from skytally.operators.kpis import KPIS
from skytally.sinks.lake import write_gold


def gold_tables(silver: DataFrame, run_ts: datetime) -> dict[str, DataFrame]:
    """All KPIs by table name, computed as of one instant."""
    return {name: kpi(silver, run_ts) for name, kpi in KPIS.items()}


def concurrently(spark: SparkSession, tasks: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Run independent writes at the same time, so that their small last stages overlap.

    The first error is raised after all have ended.
    """
    if not tasks:
        return {}
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(task)) for name, task in tasks.items()}
    return {name: future.result() for name, future in running.items()}


def load_gold(
    silver: DataFrame, lake: Lake, run_ts: datetime, tables: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Write every KPI for the run's hour; returns the tables as written.

    ``tables`` are the KPIs where they are known already, as from a roll-up; otherwise each scans
    its own few columns of ``silver``, which should be read from a written table.
    """
    def write(name: str, table: DataFrame) -> DataFrame:
        path = write_gold(table, lake, name, run_ts)
        return silver.sparkSession.read.schema(table.schema).parquet(path)

    return concurrently(silver.sparkSession, {
        name: lambda name=name, table=table: write(name, table)
        for name, table in (tables or gold_tables(silver, run_ts)).items()
    })
