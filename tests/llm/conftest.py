from __future__ import annotations

import glob
import os

import duckdb
import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """Documents of the given (doc_id, text) rows, with an extra column of a clashing name."""
    def build(*rows):
        return spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, label string")
    return build


@pytest.fixture(scope="session")
def tables():
    """DuckDB with the smallest driver tables."""
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.fixture(scope="session")
def texts(tables):
    return dict(tables.sql("SELECT doc_id, text FROM documents").fetchall())


def agrees_with_sql(query, sql, spark, con):
    """Same rows, columns compared by name."""
    df = query(spark, SF_DIR)
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in rel.fetchall()), key=str)
    got = sorted((tuple(r[c] for c in sorted(names)) for r in df.collect()), key=str)
    assert got == want
