"""Guards on physical plans: no cross joins, no global windows, pushed filters, one shuffle of the rows."""

import re

import pytest

from __spark_entry__ import queries
from tidewell.operators import blocks

SERIES_QUERIES = (
    "ffill ffill_blocked row_id stable_id densify_ffill densify_hours gold_wide asof_monthly upsert_range upsert_merge pair_models"
    " chrono_split minmax_scale lag_difference restore_aligned restore_cumulative adf_lag0 sliding_windows window_count var_score"
    " var_fit granger var1_gramian forecast_errors naive_errors commit_detail snapshot_diff"
).split()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", SERIES_QUERIES)
def test_no_cross_join_and_no_global_window(spark, sf_dir, no_broadcast, name):
    plan = physical(queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()
    for line, below in zip(lines, lines[1:], strict=False):
        if "Exchange SinglePartition" in line:
            # Partial results, or one row per partition number.
            assert "partial_" in below or "keys=[_chunk" in below, f"rows go to one task: {below.strip()[:200]}"


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    plan = physical(queries()["date_range_filter"](spark, sf_dir))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed, schema = re.search(r"PushedFilters: (.*), ReadSchema: (\S+)", plan).groups()
    assert "IsNotNull(o_totalprice)" in pushed
    assert "GreaterThanOrEqual(o_orderdate,1996-03-01" in pushed
    assert "LessThan(o_orderdate,1996-01-01" in pushed
    assert "o_custkey" not in schema


def test_wide_table_reads_four_columns(spark, sf_dir):
    plan = physical(queries()["gold_wide"](spark, sf_dir))
    schemas = set(re.findall(r"ReadSchema: struct<(.*?)>", plan))
    assert max(s.count(":") for s in schemas) == 4


def test_fill_shuffles_and_sorts_the_rows_once(spark, no_broadcast):
    rows = spark.range(100).selectExpr("CAST(id % 3 AS string) AS series", "id AS t", "CAST(id AS double) AS v", "hash(id) AS p")
    lines = physical(blocks.fill_forward(rows, ["series"], "t", ["v"], 16)).splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    summary = next(i for i, line in enumerate(lines[join + 1 :], join + 1) if re.match(r"^ +\+- Sort", line) and "_block1" in line and ":" not in line)
    rows_side = lines[join + 1 : summary]
    assert sum("Exchange" in line for line in rows_side) == 1
    assert sum("Sort [" in line for line in rows_side) == 1
    assert "Window" in rows_side[1]


def test_partial_aggregates_before_dedupe(spark, sf_dir):
    plan = physical(queries()["dedupe_last"](spark, sf_dir))
    assert plan.index("partial_max_by") > plan.index("Exchange hashpartitioning")


def test_rank_limit_is_applied_before_the_shuffle(spark, sf_dir):
    assert plan_has(physical(queries()["commit_detail"](spark, sf_dir)), "WindowGroupLimit", "Partial")


def plan_has(plan, *words):
    return any(all(w in line for w in words) for line in plan.splitlines())
