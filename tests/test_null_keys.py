"""Rows whose key is null are rows of one more key."""

import datetime

import pytest

from tidewell.operators import blocks, clean, prep

DAYS = [datetime.date(2024, 1, d) for d in range(1, 6)]


def test_split_and_scale_keep_null_keys(spark):
    rows = [(k, d, float(i)) for k in (None, "a") for i, d in enumerate(DAYS)]
    df = spark.createDataFrame(rows, "series string, date date, price double")
    split = prep.chronological_split_by(df, ["series"], "date", 0.8)
    assert split.columns == [*df.columns, "fold"] and split.groupBy("series", "fold").count().count() == 4
    scaler = df.groupBy("series").agg({"price": "min"}).toDF("series", "low").crossJoin(spark.createDataFrame([(4.0,)], "high double"))
    scaled = prep.scale_series(df, scaler, ["series"], "price", "x")
    assert scaled.count() == 10 and scaled.where("series is null and x = 1").count() == 1


def test_latest_per_key_without_order(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", 1, 2), ("b", 2, 3), (None, 1, 4)], "k string, o int, v int")
    got = sorted((r["k"] or "", r["v"]) for r in clean.latest_per_key(df, ["k"], "o").collect())
    assert got == [("", 4), ("a", 1), ("b", 3)]


@pytest.mark.parametrize("levels", [1, 2])
def test_scans_over_null_keys(spark, levels):
    rows = [(k, i, float(i) if i % 5 == 0 else None) for k in (None, "a") for i in range(20)]
    df = spark.createDataFrame(rows, "series string, at bigint, price double")
    filled = blocks.fill_forward(df, ["series"], "at", ["price"], size=3, levels=levels)
    assert filled.columns == df.columns
    want = sorted((k or "", i, float(i - i % 5)) for k, i, _ in rows)
    assert sorted((r["series"] or "", r["at"], r["price"]) for r in filled.collect()) == want
    numbered = blocks.row_index(df, ["series"], "at", "id", size=3, levels=levels)
    assert sorted((r["series"] or "", r["id"]) for r in numbered.collect()) == [(k, i) for k in ("", "a") for i in range(1, 21)]


def test_ranged_sum_over_null_keys(spark):
    df = spark.createDataFrame([(k, i, 1) for k in (None, "a") for i in range(6)], "k string, o int, v bigint")
    got = blocks.ranged_sum(df, ["k"], ["o"], "v")
    assert sorted((r["k"] or "", r["o"], r["upto"], r["total"]) for r in got.collect()) == [(k, i, i + 1, 6) for k in ("", "a") for i in range(6)]


def test_scans_share_a_shuffle_with_nullable_keys(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    df = orders.selectExpr("nullif(o_orderpriority, '1-URGENT') AS series", "o_orderkey AS at", "o_totalprice AS price")
    plan = blocks.fill_forward(df, ["series"], "at", ["price"])._jdf.queryExecution().optimizedPlan().toString()
    assert "filter isnotnull" not in plan.lower()


def test_look_back_keeps_rows_without_a_place(spark):
    df = spark.createDataFrame([("a", 2, 1.0), ("a", 3, 2.0), ("a", None, 7.0), ("a", None, 8.0), (None, 3, 5.0)], "k string, at bigint, v double")
    got = blocks.halo_window(df, ["k"], "at", 1, {"was": blocks.back("v", 1)}, 3).collect()
    assert sorted(((r["at"], r["v"], r["was"]) for r in got), key=str) == sorted(
        [(2, 1.0, None), (3, 2.0, 1.0), (None, 7.0, None), (None, 8.0, None), (3, 5.0, None)], key=str
    )
