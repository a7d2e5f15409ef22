"""Every query against its SQL, on the driver's tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from freshet.plans import domain_queries, file_queries  # noqa: F401
from freshet.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(agree, name):
    agree(QUERIES[name], ORACLE_SQL[name], SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_without_sql(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_no_pair_of_all_rows(spark):
    """Joins have keys; a nested loop may only pair one-row tables."""
    for name in ("jn12_or_to_union", "jn14_event_window", "ag09_propagate", "dm10_merge_by_time", "jn16_points_within"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_scans_are_pruned(spark):
    """Filters and columns reach the Parquet scan."""
    plan = QUERIES["fl08_compound"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(p_size,10)" in plan and "p_retailprice" in plan
    narrow = QUERIES["ag05_minmax"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint,value:double>" in narrow


def test_means_stay_in_the_engine(spark):
    for name in ("wn14_bin_mean_15min", "ag11_renormalize", "dm10_merge_by_time", "sp03_albers", "dm01_pet", "jn15_window_peak"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_tiny_overlaps_of_all_cells(spark):
    got = {row.divide_id: row.total for row in QUERIES["fl19_tiny_overlap"](spark, SF).collect()}
    want: dict = {}
    for row in domain_queries.crosswalk(spark, SF).select("divide_id", "fraction").collect():
        if row.fraction > 0.01:
            want[row.divide_id] = want.get(row.divide_id, 0) + float(row.fraction)
    assert got.keys() == want.keys() and all(abs(float(got[k]) - v) < 1e-3 for k, v in want.items())


def test_polygon_overlap_beyond_the_grid(agree, spark, tmp_path):
    """Suppliers north of the coarse grid, across its edge, and with one id twice: a row each."""
    table = spark.read.parquet(f"{SF}/supplier.parquet").limit(1)
    keys = spark.createDataFrame([(k,) for k in (0, 659, 660, 665, 999, 59999, 7, 7)], "s_suppkey long")
    keys.crossJoin(table.drop("s_suppkey")).write.parquet(str(tmp_path / "supplier.parquet"))
    agree(QUERIES["sp10_polygon_overlap"], ORACLE_SQL["sp10_polygon_overlap"], str(tmp_path))
