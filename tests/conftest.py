"""One Spark session for all tests, and the DuckDB oracle."""

from __future__ import annotations

import math
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = os.environ.get("FRESHET_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def normal(value):
    """A value as both engines should give it."""
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if hasattr(value, "isoformat"):
        return value.isoformat()[:19]
    return int(value) if hasattr(value, "__int__") and not isinstance(value, str) else value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="session")
def agree(spark):
    """agree(query, sql, sf_dir): the query's rows are those of the SQL."""
    import duckdb

    def check(query, sql: str, sf_dir: str) -> None:
        con = duckdb.connect()
        con.execute("SET TimeZone = 'UTC'")
        for t in TABLES:
            if os.path.exists(path := f"{sf_dir}/{t}.parquet"):
                con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
        got = query(spark, sf_dir)
        want = con.execute(sql)
        names = [d[0] for d in want.description]
        assert sorted(got.columns) == sorted(names)
        assert rows_of(got.columns, got.collect()) == rows_of(names, want.fetchall())

    return check
