"""Run every query against its SQL and report differences.

    python -m checks.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(rows, names) -> list[tuple]:
    """Rows with columns in name order, sorted; floats and ints keep their own type."""
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple((type(r[i]).__name__, str(r[i])) for i in order) for r in rows)


def difference(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    """What differs between a query and its SQL; None when nothing does."""
    df = QUERIES[name](spark, sf_dir)
    actual = normal([tuple(r) for r in df.collect()], df.columns)
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    expected = normal(cursor.fetchall(), names)
    if actual == expected:
        return None
    extra, missing = set(actual) - set(expected), set(expected) - set(actual)
    return (f"{len(actual)} rows against {len(expected)}; "
            f"only Spark {sorted(extra)[:2]}; only SQL {sorted(missing)[:2]}")


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = difference(spark, con, name, sf_dir) if name in ORACLES else "no SQL"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = str(error)[:1500]
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - start:.1f}s "
              f"{problem or ''}", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
