"""Block operations against the same thing done by pandas on whole series."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewell.operators import blocks, clean, gold, prep


def random_rows(seed, n=400, span=900, hot=0.7):
    """Sparse days of three series, one of them holding most rows, with nulls."""
    rng = np.random.default_rng(seed)
    rows = {}
    for _ in range(n):
        series = "a" if rng.random() < hot else ("b" if rng.random() < 0.9 else "c")
        day = int(rng.integers(-50, span))
        rows[(series, day)] = None if rng.random() < 0.4 else float(rng.integers(0, 100))
    frame = pd.DataFrame([(s, t, v) for (s, t), v in rows.items()], columns=["series", "t", "v"])
    return frame.sample(frac=1, random_state=seed)


def as_spark(spark, frame):
    return spark.createDataFrame(
        [(s, int(t), None if pd.isna(v) else v) for s, t, v in frame.itertuples(index=False)], "series string, t bigint, v double"
    )


@pytest.mark.parametrize("size,levels", [(1, 1), (7, 1), (64, 1), (4096, 1), (7, 2), (5, 3)])
def test_prefix_scan(spark, size, levels):
    frame = random_rows(size * 10 + levels).sort_values(["series", "t"])
    grouped = frame.groupby("series")
    frame["filled"] = grouped["v"].ffill()
    frame["total"] = grouped["v"].transform(lambda v: v.fillna(0).cumsum())
    frame["following"] = grouped["t"].shift(-1)
    scans = {"filled": ("last", "v"), "total": ("sum", "v"), "following": ("next", "t")}
    got = blocks.prefix_scan(as_spark(spark, frame[["series", "t", "v"]]), ["series"], "t", scans, size, levels).toPandas()
    got = got.sort_values(["series", "t"]).reset_index(drop=True)
    want = frame.reset_index(drop=True)
    np.testing.assert_array_equal(got["filled"], want["filled"])
    np.testing.assert_allclose(got["total"].fillna(0), want["total"])
    np.testing.assert_array_equal(got["following"].astype(float), want["following"])


def test_exclusive_scan(spark):
    rows = spark.createDataFrame([("a", t, float(t)) for t in range(10)], "series string, t bigint, v double")
    got = blocks.prefix_scan(rows, ["series"], "t", {"before": ("sum", "v")}, 3, 2, inclusive=False)
    assert [r["before"] for r in got.orderBy("t").collect()] == [None] + [float(sum(range(t))) for t in range(1, 10)]


@pytest.mark.parametrize("size,levels", [(10, 1), (3, 2)])
def test_row_index_and_global_id(spark, size, levels):
    frame = random_rows(3)
    dated = as_spark(spark, frame).select("series", F.date_from_unix_date(F.col("t").cast("int")).alias("date"))
    got = clean.with_row_id(dated, ["series"], "date", size=size, levels=levels).toPandas().sort_values(["series", "date"])
    assert (got["id"] == got.groupby("series").cumcount() + 1).all()
    got = clean.with_global_id(dated, ["series"], "date", size=size, levels=levels).toPandas().sort_values(["series", "date"])
    assert list(got["id"]) == list(range(1, len(got) + 1))


def test_leading_nulls_stay(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 9, 5.0), ("a", 20, None), ("b", 3, None)], "series string, t bigint, v double")
    got = {(r["series"], r["t"]): r["v"] for r in blocks.fill_forward(rows, ["series"], "t", ["v"], 4).collect()}
    assert got == {("a", 1): None, ("a", 9): 5.0, ("a", 20): 5.0, ("b", 3): None}


QUOTES = [
    ("a", "2024-01-30", 1.0, 1.5),
    ("a", "2024-02-02", None, 2.5),
    ("a", "2024-02-04", 3.0, None),
    ("b", "2024-02-01", 7.0, 7.5),
]


@pytest.mark.parametrize("size", [1, 2, 4096])
def test_densify_modes(spark, size):
    rows = spark.createDataFrame(QUOTES, "series string, date string, price double, open double").withColumn("date", F.to_date("date"))
    per_column = clean.densify(rows, ["series"], "date", ["price", "open"], size=size).orderBy("series", "date").collect()
    assert [(r["price"], r["open"]) for r in per_column if r["series"] == "a"] == [
        (1.0, 1.5), (1.0, 1.5), (1.0, 1.5), (1.0, 2.5), (1.0, 2.5), (3.0, 2.5),
    ]
    whole_row = clean.densify(rows, ["series"], "date", ["price", "open"], "whole_row", size=size).orderBy("series", "date").collect()
    assert [(r["price"], r["open"]) for r in whole_row if r["series"] == "a"] == [
        (1.0, 1.5), (1.0, 1.5), (1.0, 1.5), (None, 2.5), (None, 2.5), (3.0, None),
    ]
    assert [r["price"] for r in per_column if r["series"] == "b"] == [7.0]
    with pytest.raises(ValueError):
        clean.densify(rows, ["series"], "date", ["price"], "nearest")


def test_densify_to_common_end(spark):
    rows = spark.createDataFrame(QUOTES, "series string, date string, price double, open double").withColumn("date", F.to_date("date"))
    end = F.to_date(F.lit("2024-02-06"))
    got = clean.densify(rows, ["series"], "date", ["price"], end=end).groupBy("series").agg(F.max("date").cast("string"), F.count("*"))
    assert sorted(tuple(r) for r in got.collect()) == [("a", "2024-02-06", 8), ("b", "2024-02-06", 6)]


@pytest.mark.parametrize("periods,size", [(1, 3), (3, 3), (7, 16), (0, 4)])
def test_difference_and_restore(spark, periods, size):
    rng = np.random.default_rng(5)
    values = {s: rng.standard_normal(50) for s in "ab"}
    rows = spark.createDataFrame([(s, t, float(v[t])) for s, v in values.items() for t in range(50)], "s string, t bigint, v double")
    diffs = prep.difference_wide(rows, ["s"], "t", ["v"], periods, size)
    for series, got in diffs.toPandas().groupby("s"):
        want = pd.Series(values[series])
        want = want.diff(periods).dropna() if periods else want
        np.testing.assert_allclose(got.sort_values("t")["v"], want)
    if periods:
        back = prep.restore_aligned(diffs, rows, ["s"], "t", "v", "level", periods).toPandas()
        for series, got in back.groupby("s"):
            np.testing.assert_allclose(got.sort_values("t")["level"], values[series][periods:])


def test_halo_longer_than_block_is_refused(spark):
    rows = spark.createDataFrame([("a", 1, 1.0)], "s string, t bigint, v double")
    with pytest.raises(ValueError):
        prep.difference_wide(rows, ["s"], "t", ["v"], 5, 4)


@pytest.mark.parametrize("length,n", [(3, 10), (3, 3), (4, 2)])
def test_sliding_windows(spark, length, n):
    rows = spark.createDataFrame([("d", t, float(t), float(-t)) for t in range(n)], "d string, t bigint, a double, b double")
    got = prep.sliding_windows(rows, ["d"], "t", ["a", "b"], length, 4).orderBy("t").collect()
    assert [r["t"] for r in got] == list(range(length, n))
    for r in got:
        assert r["x"] == [[float(u), float(-u)] for u in range(r["t"] - length, r["t"])]
        assert r["y"] == [float(r["t"]), float(-r["t"])]


def test_scale_of_constant_series(spark):
    rows = spark.createDataFrame([("a", 3.0), ("a", 3.0), ("b", 1.0), ("b", 5.0)], "s string, v double")
    scaler = prep.series_scaler(rows, ["s"], "v", F.lit(True))
    got = prep.scale_series(rows, scaler, ["s"], "v", "z")
    assert sorted(r["z"] for r in got.collect()) == [-1.0, -1.0, -1.0, 1.0]
    back = prep.unscale_series(got.drop("v"), scaler, ["s"], "z", "v")
    assert sorted((r["s"], r["v"]) for r in back.collect()) == [("a", 3.0), ("a", 3.0), ("b", 1.0), ("b", 5.0)]


@pytest.mark.parametrize("size", [2, 1000])
def test_as_of(spark, size):
    left = spark.createDataFrame([("k", t) for t in (1, 5, 6, 30)] + [("z", 4)], "k string, t bigint")
    right = spark.createDataFrame([("k", 2, 20.0), ("k", 6, None), ("k", 40, 1.0)], "k string, t bigint, rate double")
    got = {(r["k"], r["t"]): r["rate"] for r in gold.as_of(left, right, ["k"], "t", ["rate"], size).collect()}
    assert got == {("k", 1): None, ("k", 5): 20.0, ("k", 6): None, ("k", 30): None, ("z", 4): None}


def test_exact_quantiles(spark):
    rng = np.random.default_rng(0)
    values = np.round(rng.exponential(10, 997), 1)
    rows = spark.createDataFrame([(float(v), float(i % 3)) for i, v in enumerate(values)] + [(None, None)], "a double, b double")
    got = {(r["variable"], r["probability"]): r["value"] for r in clean.exact_quantiles(rows, ["a", "b"], [0.0, 0.25, 0.5, 1.0]).collect()}
    for p in (0.0, 0.25, 0.5, 1.0):
        assert got["a", p] == pytest.approx(np.quantile(values, p))
        assert got["b", p] == pytest.approx(np.quantile(np.arange(997) % 3, p))


@pytest.mark.parametrize("size", [2, 3, 5, 1000])
def test_gaps_mean_the_same_in_every_block(spark, size):
    present = [0, 1, 2, 4, 5, 6, 7, 11, 12]
    rows = spark.createDataFrame([("d", t, float(t * t)) for t in present], "d string, t bigint, v double")
    diffs = prep.difference_wide(rows, ["d"], "t", ["v"], 2, size).orderBy("t").collect()
    assert [(r["t"], r["v"]) for r in diffs] == [(t, float(t * t - (t - 2) ** 2)) for t in present if t - 2 in present]
    windows = prep.sliding_windows(rows, ["d"], "t", ["v"], 2, size).orderBy("t").collect()
    assert [r["t"] for r in windows] == [t for t in present if t - 1 in present and t - 2 in present]


def test_shared_folder_is_the_configured_one(spark):
    from tidewell.session import scratch, shared_dir

    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured.rstrip("/")
    assert scratch(spark, "x") != scratch(spark, "x")
