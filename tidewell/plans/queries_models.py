"""Queries over preparation, statistics and forecast models."""

from __future__ import annotations

from datetime import date

import numpy as np
from pyspark.sql import functions as F

from tidewell.functions.networks import FeedForward, RegimeNetwork
from tidewell.functions.scalars import tidy
from tidewell.operators import blocks, forecast, prep, regress, stored, training
from tidewell.plans import forecasting
from tidewell.plans.checks import FEATURES, check_sql, elimination_sql, products_sql, rounded, rounded_all
from tidewell.plans.registry import query
from tidewell.session import scratch, settle
from tidewell.sources import fixtures

SIZE = 256
K = len(FEATURES)
# Tasks go over their shards ten times between two averagings, ten averagings at most.
FIT = {"epochs": 10, "local": 10}


def _dense_axis(spark, sf_dir):
    return fixtures.px_dense(spark, sf_dir).select("series", "date", "price").withColumn("t", blocks.day_axis("date"))


def _split_dense(spark, sf_dir):
    dense = fixtures.px_dense(spark, sf_dir).select("series", "date", "price")
    return prep.chronological_split_by(dense, ["series"], "date", 0.8)


def _diffs(spark, sf_dir):
    return fixtures.scaled_diff(spark, sf_dir).withColumn("domain", F.lit("prices"))


def _train(diffs):
    return diffs.where(F.col("fold") == "train").drop("fold")


_SPLIT_SQL = (
    "folds AS (SELECT series, date, price, CASE WHEN row_number() OVER (PARTITION BY series ORDER BY date) <="
    " floor(count(*) OVER (PARTITION BY series) * 0.8) THEN 'train' ELSE 'test' END AS fold FROM dense)"
)


@query("chrono_split", check_sql("SELECT * FROM folds", "dense", extra=_SPLIT_SQL))
def chrono_split(spark, sf_dir):
    return _split_dense(spark, sf_dir)


_SCALED_LONG = (
    _SPLIT_SQL + ", scaler AS (SELECT series, min(price) AS low, max(price) AS high FROM folds WHERE fold = 'train' GROUP BY"
    " series)"
)


@query(
    "minmax_scale",
    check_sql(
        "SELECT series, date, fold, "
        + rounded("(price - low) * 2 / CASE WHEN high = low THEN 1 ELSE high - low END - 1", 6, "scaled")
        + " FROM folds JOIN scaler USING (series)",
        "dense",
        extra=_SCALED_LONG,
    ),
)
def minmax_scale(spark, sf_dir):
    split = _split_dense(spark, sf_dir)
    scaler = prep.series_scaler(split, ["series"], "price", F.col("fold") == "train")
    scaled = prep.scale_series(split, scaler, ["series"], "price", "scaled")
    return scaled.select("series", "date", "fold", tidy(F.col("scaled"), 6).alias("scaled"))


@query(
    "minmax_inverse",
    check_sql(f"SELECT series, date, fold, {rounded('price', 4)} FROM folds", "dense", extra=_SPLIT_SQL),
)
def minmax_inverse(spark, sf_dir):
    split = _split_dense(spark, sf_dir)
    scaler = settle(prep.series_scaler(split, ["series"], "price", F.col("fold") == "train"), "scaler")
    scaled = prep.scale_series(split, scaler, ["series"], "price", "scaled").drop("price")
    back = prep.unscale_series(scaled, scaler, ["series"], "scaled", "price")
    return back.select("series", "date", "fold", tidy(F.col("price"), 4).alias("price"))


@query(
    "lag_difference",
    check_sql(
        f"SELECT series, date, {rounded('diff', 4)} FROM (SELECT series, date, price - lag(price, 7) OVER (PARTITION BY"
        " series ORDER BY date) AS diff FROM dense) WHERE diff IS NOT NULL",
        "dense",
    ),
)
def lag_difference(spark, sf_dir):
    diffs = prep.difference_wide(_dense_axis(spark, sf_dir), ["series"], "t", ["price"], 7, SIZE)
    return diffs.select("series", "date", tidy(F.col("price"), 4).alias("diff"))


@query(
    "restore_aligned",
    check_sql(
        f"SELECT series, date, {rounded('price', 4)} FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY date) AS n"
        " FROM dense) WHERE n > 7",
        "dense",
    ),
)
def restore_aligned(spark, sf_dir):
    levels = _dense_axis(spark, sf_dir)
    diffs = prep.difference_wide(levels, ["series"], "t", ["price"], 7, SIZE)
    back = prep.restore_aligned(diffs, levels, ["series"], "t", "price", "restored", periods=7)
    return back.select("series", "date", tidy(F.col("restored"), 4).alias("price"))


@query(
    "restore_cumulative",
    check_sql(
        f"SELECT series, date, {rounded('price', 4)} FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY date) AS n"
        " FROM dense) WHERE n > 1",
        "dense",
    ),
)
def restore_cumulative(spark, sf_dir):
    levels = _dense_axis(spark, sf_dir)
    diffs = prep.difference_wide(levels, ["series"], "t", ["price"], 1, SIZE)
    start = levels.groupBy("series").agg(F.min_by("price", "t").alias("level"))
    back = prep.restore_cumulative(diffs, start, ["series"], "t", "price", "restored", SIZE)
    return back.select("series", "date", tidy(F.col("restored"), 4).alias("price"))


def _adf_rows(spark, sf_dir):
    """Dense prices with ``t`` = 0, 1, ... per series, as a written table."""
    dense = fixtures.px_dense(spark, sf_dir).select("series", "date", "price")
    first = dense.groupBy("series").agg(F.min("date").alias("first"))
    placed = dense.join(first, "series").select("series", F.datediff("date", "first").cast("bigint").alias("t"), "price")
    return settle(placed, "adf-rows")


@query("adf")
def adf(spark, sf_dir):
    return regress.adf_test(_adf_rows(spark, sf_dir), ["series"], "price")


@query(
    "adf_lag0",
    check_sql(
        f"SELECT series, n, {rounded('slope / sqrt((syy - slope * sxy) / (n - 2) / sxx)', 6, 'statistic')} FROM (SELECT series,"
        " count(*) AS n, regr_slope(dy, was) AS slope, regr_sxx(dy, was) AS sxx, regr_syy(dy, was) AS syy,"
        " regr_sxy(dy, was) AS sxy FROM (SELECT series, price - lag(price) OVER w AS dy, lag(price) OVER w AS was FROM dense"
        " WINDOW w AS (PARTITION BY series ORDER BY date)) WHERE was IS NOT NULL GROUP BY series)",
        "dense",
    ),
)
def adf_lag0(spark, sf_dir):
    lagged = blocks.halo_window(
        _dense_axis(spark, sf_dir), ["series"], "t", 1, {"was": blocks.back("price", 1)}, SIZE
    )
    steps = lagged.where(F.col("was").isNotNull()).withColumn("dy", F.col("price") - F.col("was"))
    sums = steps.groupBy("series").agg(
        F.count("*").alias("n"),
        F.regr_slope("dy", "was").alias("slope"),
        F.regr_sxx("dy", "was").alias("sxx"),
        F.regr_syy("dy", "was").alias("syy"),
        F.regr_sxy("dy", "was").alias("sxy"),
    )
    error = F.sqrt((F.col("syy") - F.col("slope") * F.col("sxy")) / (F.col("n") - 2) / F.col("sxx"))
    return sums.select("series", "n", tidy(F.col("slope") / error, 6).alias("statistic"))


# Fixed value: lag limit of the test that SQL repeats.
SHORT = 3


def _adf_system(lag: int, start: str) -> str:
    """Cross products for one lag length over the rows from ``start`` on, the level last among the regressors."""
    used = ["const", *[f"d{i}" for i in range(1, lag + 1)], "was", "dy"]
    return (
        f"SELECT series, {lag} AS lag, '{start}' AS sample, count(*) AS n, {products_sql(used, used)} AS m FROM steps"
        f" WHERE n_before > {SHORT if start == 'common' else lag} GROUP BY series"
    )


@query(
    "adf_short",
    check_sql(
        "SELECT series, lag, n, "
        + rounded("m[lag + 2][lag + 3] / m[lag + 2][lag + 2] / sqrt(ssr / (n - lag - 2) / m[lag + 2][lag + 2])", 6, "statistic")
        + " FROM fits WHERE sample = 'own' AND (series, lag) IN (SELECT (series, arg_min(lag, n * ln(ssr / n) + 2 * (lag + 2)))"
        " FROM fits WHERE sample = 'common' GROUP BY series)",
        "dense",
        extra="steps AS (SELECT *, "
        + ", ".join(f"lag(dy, {i}) OVER v AS d{i}" for i in range(1, SHORT + 1))
        + ", row_number() OVER v - 1 AS n_before FROM (SELECT series, date, 1.0::DOUBLE AS const, price - lag(price) OVER w AS"
        " dy, lag(price) OVER w AS was FROM dense WINDOW w AS (PARTITION BY series ORDER BY date)) WHERE was IS NOT NULL"
        " WINDOW v AS (PARTITION BY series ORDER BY date)), systems AS ("
        + " UNION ALL ".join(_adf_system(lag, start) for lag in range(SHORT + 1) for start in ("common", "own"))
        + "), "
        + elimination_sql("systems", "series, lag, sample, n", "lag + 1")
        + ", fits AS (SELECT *, m[lag + 3][lag + 3] - m[lag + 2][lag + 3] ** 2 / m[lag + 2][lag + 2] AS ssr FROM solve WHERE k ="
        " lag + 2)",
        recursive=True,
    ).replace("n_before > ", "n_before >= "),
)
def adf_short(spark, sf_dir):
    tests = regress.adf_test(_adf_rows(spark, sf_dir), ["series"], "price", SIZE, SHORT)
    return tests.select("series", F.col("lag").cast("int").alias("lag"), "n", tidy(F.col("statistic"), 6).alias("statistic"))


# Fixed value: lag limit of the test for series of 2204 to 2563 values, as the test tables have at every size.
FULL = 27
_ADF_USED = [f"d{i}" for i in range(1, FULL + 1)]
_ADF_ON = [f"CASE WHEN {i} <= lag THEN d{i} ELSE 0 END" for i in range(1, FULL + 1)]


@query(
    "adf_statistic",
    check_sql(
        # one elimination gives the squared residuals of every lag length over the rows they share
        "SELECT series, lag, n, "
        + rounded(f"m[{FULL + 2}][{FULL + 3}] / m[{FULL + 2}][{FULL + 2}] / sqrt((m[{FULL + 3}][{FULL + 3}] - m[{FULL + 2}][{FULL + 3}] ** 2"
                  f" / m[{FULL + 2}][{FULL + 2}]) / (n - lag - 2) / m[{FULL + 2}][{FULL + 2}])", 6, "statistic")
        + f" FROM solve WHERE k = {FULL + 2}",
        "dense",
        extra="steps AS MATERIALIZED (SELECT *, "
        + ", ".join(f"lag(dy, {i}) OVER v AS d{i}" for i in range(1, FULL + 1))
        + ", row_number() OVER v - 1 AS n_before FROM (SELECT series, date, 1.0::DOUBLE AS const, price - lag(price) OVER w AS"
        " dy, lag(price) OVER w AS was FROM dense WINDOW w AS (PARTITION BY series ORDER BY date)) WHERE was IS NOT NULL"
        f" WINDOW v AS (PARTITION BY series ORDER BY date)), shared AS (SELECT series, count(*) AS n,"
        f" {products_sql(['const', 'was', *_ADF_USED, 'dy'], ['const', 'was', *_ADF_USED, 'dy'])} AS m FROM steps"
        f" WHERE n_before >= {FULL} GROUP BY series), "
        + elimination_sql("shared", "series, n", f"{FULL} + 2").replace("solve", "nested")
        + f", chosen AS (SELECT series, arg_min(k - 3, n * ln(m[{FULL + 3}][{FULL + 3}] / n) + 2 * (k - 1)) AS lag FROM nested"
        " WHERE k >= 3 GROUP BY series), own AS (SELECT series, lag, count(*) AS n, "
        + products_sql(["const", *_ADF_ON, "was", "dy"], ["const", *_ADF_ON, "was", "dy"])
        + " AS m FROM steps JOIN chosen USING (series) WHERE n_before >= lag GROUP BY series, lag),"
        # lags that are not used become unit rows, which change nothing
        " systems AS (SELECT series, lag, n, list_transform(range(1, len(m) + 1), lambda i: list_transform(range(1, len(m) + 1),"
        " lambda j: CASE WHEN i = j AND m[i][j] = 0 THEN 1 ELSE m[i][j] END)) AS m FROM own), "
        + elimination_sql("systems", "series, lag, n", f"{FULL} + 1"),
        recursive=True,
    ),
)
def adf_statistic(spark, sf_dir):
    """The test with the lag chosen from its usual range, without the tabulated p-value."""
    tests = regress.adf_test(_adf_rows(spark, sf_dir), ["series"], "price", SIZE)
    return tests.select("series", F.col("lag").cast("bigint").alias("lag"), "n", tidy(F.col("statistic"), 6).alias("statistic"))


@query("stationarity_order")
def stationarity_order(spark, sf_dir):
    found = regress.stationary_order(_adf_rows(spark, sf_dir), ["series"], "price")
    return found.tests.withColumn("chosen_order", F.lit(found.order)).withColumn("reached", F.lit(found.reached))


def _lag_terms(p: int) -> list[str]:
    return ["const", *[f"l{lag}_{c}" for lag in range(1, p + 1) for c in FEATURES]]


def _lag_rows(p: int, name: str) -> str:
    """Rows of constant, lags and targets ``y_*`` of the training differences."""
    lags = ", ".join(f"lag({c}, {lag}) OVER w AS l{lag}_{c}" for lag in range(1, p + 1) for c in FEATURES)
    return (
        f"{name} AS (SELECT 1.0::DOUBLE AS const, {lags}, {', '.join(f'{c} AS y_{c}' for c in FEATURES)} FROM scaled_diff WHERE"
        f" fold = 'train' WINDOW w AS (ORDER BY t) QUALIFY row_number() OVER w > {p})"
    )


_TARGETS = [f"y_{c}" for c in FEATURES]
P = 2
_VAR_SYSTEM = (
    _lag_rows(P, "rows_p")
    + f", systems AS (SELECT 0 AS one, {products_sql(_lag_terms(P), _lag_terms(P) + _TARGETS)} AS m FROM rows_p), "
    + elimination_sql("systems", "one", "len(m)")
)
_VAR_CELLS = " UNION ALL ".join(
    f"SELECT '{'const' if i == 0 else FEATURES[(i - 1) % K]}' AS term, {0 if i == 0 else (i - 1) // K + 1}::INTEGER AS lag,"
    f" '{c}' AS target, m[{i + 1}][{1 + K * P + j + 1}] AS value FROM solve WHERE k = {1 + K * P} + 1"
    for i in range(1 + K * P)
    for j, c in enumerate(FEATURES)
)


@query(
    "var_fit",
    check_sql(
        f"SELECT 'prices' AS domain, term, lag, target, {rounded('value', 6)} FROM ({_VAR_CELLS})",
        "scaled_diff",
        extra=_VAR_SYSTEM,
        recursive=True,
    ),
)
def var_fit(spark, sf_dir):
    params = regress.var_fit(_train(_diffs(spark, sf_dir)), ["domain"], FEATURES, P)
    return params.drop("ill_conditioned").withColumn("value", tidy(F.col("value"), 6))


_TERMS = ["const", *[f"l_{c}" for c in FEATURES], *[f"y_{c}" for c in FEATURES]]
_LAGGED = (
    "lagged AS (SELECT * FROM (SELECT 1.0 AS const, "
    + ", ".join(f"lag({c}) OVER (ORDER BY t) AS l_{c}" for c in FEATURES)
    + ", "
    + ", ".join(f"{c} AS y_{c}" for c in FEATURES)
    + f" FROM scaled_diff WHERE fold = 'train') WHERE l_{FEATURES[0]} IS NOT NULL)"
)


@query(
    "var1_gramian",
    check_sql(
        " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, {rounded(f'sum({a} * {b})', 6, 'v')} FROM lagged"
            for i, a in enumerate(_TERMS)
            for b in _TERMS[i:]
        ),
        "scaled_diff",
        extra=_LAGGED,
    ),
)
def var1_gramian(spark, sf_dir):
    rows = _train(_diffs(spark, sf_dir))
    products = regress.lag_products(rows, ["domain"], FEATURES, 1, regress.var_terms, SIZE).where(F.col("i") >= 0)
    names = F.array(*[F.lit(t) for t in _TERMS])
    return products.select(
        F.get(names, "i").alias("a"), F.get(names, "j").alias("b"), tidy(F.col("v"), 6).alias("v")
    )


@query("var_aic")
def var_aic(spark, sf_dir):
    return regress.var_lag_choice(_train(_diffs(spark, sf_dir)), ["domain"], FEATURES).orderBy("aic")


def _aic_system(p: int) -> str:
    used = _lag_terms(p) + _TARGETS
    return f"SELECT {p} AS p, count(*) AS n, {products_sql(used, used)} AS m FROM rows_{p}"


@query(
    "var_aic_short",
    check_sql(
        "SELECT p, "
        + rounded(f"sum(ln(m[k][k] / n)) + 2.0 * (p * {K * K} + {K}) / max(n)", 6, "aic")
        + f" FROM solve WHERE k > 1 + {K} * p GROUP BY p",
        "scaled_diff",
        extra=", ".join(_lag_rows(p, f"rows_{p}") for p in range(1, SHORT + 1))
        + ", systems AS ("
        + " UNION ALL ".join(_aic_system(p) for p in range(1, SHORT + 1))
        + "), "
        + elimination_sql("systems", "p, n", f"{K} * p + {K}"),
        recursive=True,
    ),
)
def var_aic_short(spark, sf_dir):
    choice = regress.var_lag_choice(_train(_diffs(spark, sf_dir)), ["domain"], FEATURES, SHORT)
    return choice.select("p", tidy(F.col("aic"), 6).alias("aic"))


@query("granger")
def granger(spark, sf_dir):
    pairs = regress.granger(_train(_diffs(spark, sf_dir)), ["domain"], FEATURES, 7)
    return regress.granger_matrix(pairs, ["domain"], FEATURES)


_GRANGER_SQL = " UNION ALL ".join(
    f"SELECT '{y}' AS y, '{x}' AS x, {rounded('ryy - ryo * ryo / roo', 6, 'ssr_own')}, "
    + rounded("ryy - (ryo * ryo * rxx - 2 * ryo * ryx * rox + ryx * ryx * roo) / (roo * rxx - rox * rox)", 6, "ssr_joint")
    + f" FROM (SELECT regr_sxx(1, y_{y}) AS ryy, regr_sxx(1, l_{y}) AS roo, regr_sxx(1, l_{x}) AS rxx,"
    f" regr_sxy(y_{y}, l_{y}) AS ryo, regr_sxy(y_{y}, l_{x}) AS ryx, regr_sxy(l_{y}, l_{x}) AS rox FROM lagged)"
    for y in FEATURES
    for x in FEATURES
    if x != y
)


@query("granger_ssr_lag1", check_sql(_GRANGER_SQL, "scaled_diff", extra=_LAGGED))
def granger_ssr_lag1(spark, sf_dir):
    """Squared residuals at lag 1 with and without the other series, in closed form from one aggregate."""
    rows = _train(_diffs(spark, sf_dir))
    lagged = blocks.halo_window(
        rows, ["domain"], "t", 1, {f"l_{c}": blocks.back(c, 1) for c in FEATURES}, SIZE
    ).where(F.col(f"l_{FEATURES[0]}").isNotNull())
    n = F.count("*")
    spread = lambda a, b: F.sum(F.col(a) * F.col(b)) - F.sum(a) * F.sum(b) / n
    cells = {}
    for y in FEATURES:
        cells[f"yy_{y}"], cells[f"oo_{y}"] = spread(y, y), spread(f"l_{y}", f"l_{y}")
        for x in FEATURES:
            cells[f"y_{y}_{x}"], cells[f"o_{y}_{x}"] = spread(y, f"l_{x}"), spread(f"l_{y}", f"l_{x}")
    sums = lagged.agg(*[expr.alias(name) for name, expr in cells.items()])
    pairs = []
    for y in FEATURES:
        for x in FEATURES:
            if x == y:
                continue
            yy, oo, xx = F.col(f"yy_{y}"), F.col(f"oo_{y}"), F.col(f"oo_{x}")
            yo, yx, ox = F.col(f"y_{y}_{y}"), F.col(f"y_{y}_{x}"), F.col(f"o_{y}_{x}")
            explained = (yo * yo * xx - yo * yx * ox * 2 + yx * yx * oo) / (oo * xx - ox * ox)
            pairs.append(
                F.struct(
                    F.lit(y).alias("y"), F.lit(x).alias("x"), tidy(yy - yo * yo / oo, 6).alias("ssr_own"),
                    tidy(yy - explained, 6).alias("ssr_joint"),
                )
            )
    return sums.select(F.inline(F.array(*pairs)))


def _granger_system(y: str, x: str, p: int) -> str:
    """Constant, own lags, the other's lags, target."""
    used = ["const", *[f"l{lag}_{c}" for c in (y, x) for lag in range(1, p + 1)], f"y_{y}"]
    return f"SELECT '{y}' AS y, '{x}' AS x, {p} AS lag, count(*) AS n, {products_sql(used, used)} AS m FROM rows_{p}"


@query(
    "granger_f",
    check_sql(
        "SELECT y, x, lag, n, "
        + rounded("(own - joint) / joint / lag * (n - 2 * lag - 1)", 6, "statistic")
        + " FROM (SELECT y, x, lag, n, max(m[len(m)][len(m)]) FILTER (k = lag + 2) AS own, max(m[len(m)][len(m)]) FILTER"
        " (k = 2 * lag + 2) AS joint FROM solve GROUP BY y, x, lag, n)",
        "scaled_diff",
        extra=", ".join(_lag_rows(p, f"rows_{p}") for p in range(1, SHORT + 1))
        + ", systems AS ("
        + " UNION ALL ".join(_granger_system(y, x, p) for p in range(1, SHORT + 1) for y in FEATURES for x in FEATURES if x != y)
        + "), "
        + elimination_sql("systems", "y, x, lag, n", "2 * lag + 1"),
        recursive=True,
    ),
)
def granger_f(spark, sf_dir):
    """The F statistic of every pair at each lag length, the rows from which the matrix takes its least p-value."""
    tests = regress.granger_tests(_train(_diffs(spark, sf_dir)), ["domain"], FEATURES, SHORT).where("lag is not null")
    return tests.select("y", "x", "lag", "n", tidy(F.col("statistic"), 6).alias("statistic"))


LENGTH = 7


def _windows(diffs, fold: str, length: int):
    return prep.sliding_windows(diffs.where(F.col("fold") == fold), ["fold"], "t", FEATURES, length, SIZE)


@query(
    "sliding_windows",
    check_sql(
        "SELECT * FROM (SELECT date, t, "
        + ", ".join(
            [rounded(f"lag({c}, {lag}) OVER w", 6, f"{c}_lag{lag}") for lag in range(1, LENGTH + 1) for c in FEATURES]
            + [rounded(c, 6, f"{c}_target") for c in FEATURES]
        )
        + f" FROM scaled_diff WHERE fold = 'train' WINDOW w AS (ORDER BY t)) WHERE {FEATURES[0]}_lag{LENGTH} IS NOT NULL",
        "scaled_diff",
    ),
)
def sliding_windows(spark, sf_dir):
    windows = _windows(_diffs(spark, sf_dir), "train", LENGTH)
    cells = [
        tidy(F.col("x")[LENGTH - lag][i], 6).alias(f"{c}_lag{lag}")
        for lag in range(1, LENGTH + 1)
        for i, c in enumerate(FEATURES)
    ]
    return windows.select("date", "t", *cells, *[tidy(F.col("y")[i], 6).alias(f"{c}_target") for i, c in enumerate(FEATURES)])


@query(
    "window_count",
    check_sql(f"SELECT fold, count(*) - {LENGTH} AS n_windows FROM scaled_diff GROUP BY fold", "scaled_diff"),
)
def window_count(spark, sf_dir):
    windows = prep.sliding_windows(fixtures.scaled_diff(spark, sf_dir), ["fold"], "t", FEATURES, LENGTH, SIZE)
    return windows.groupBy("fold").agg(F.count("*").alias("n_windows"))


@query(
    "hash_split",
    check_sql(
        "SELECT series, date, price, CASE WHEN ('0x' || substr(md5('42:' || series || ' ' || date::VARCHAR), 1, 8))::BIGINT"
        " % 100 < 20 THEN 'validation' ELSE 'train' END AS fold FROM px",
        "px",
    ),
)
def hash_split(spark, sf_dir):
    px = fixtures.px_long(spark, sf_dir).select("series", "date", "price")
    return prep.hash_split(px, F.concat_ws(" ", "series", F.col("date").cast("string")), 20)


@query(
    "tail_split",
    check_sql("SELECT date, t, CASE fold WHEN 'train' THEN 'train' ELSE 'validation' END AS fold FROM split", "split"),
)
def tail_split(spark, sf_dir):
    rows = fixtures.wide_axis(spark, sf_dir).select("date", "t")
    return prep.chronological_split(rows, "t", 0.8, ("train", "validation"))


# Coefficients of the given VAR models used where SQL must score too.
GIVEN_CONST, GIVEN_OWN, GIVEN_CROSS, GIVEN_SECOND = 0.01, 0.5, 0.1, 0.2


def _given(p: int) -> forecast.VarModel:
    """0.5 on the own first lag, 0.1 on the others', and 0.2 on the own second lag if there is one."""
    first = np.full((K, K), GIVEN_CROSS) + np.eye(K) * (GIVEN_OWN - GIVEN_CROSS)
    lags = [first] + [np.eye(K) * GIVEN_SECOND] * (p - 1)
    return forecast.VarModel(np.full(K, GIVEN_CONST), np.array(lags))


def _given_sql(column: str, first: str, second: str | None = None) -> str:
    terms = [f"{GIVEN_OWN if c == column else GIVEN_CROSS} * {first.format(c)}" for c in FEATURES]
    if second:
        terms.append(f"{GIVEN_SECOND} * {second.format(column)}")
    return " + ".join([str(GIVEN_CONST), *terms])


@query(
    "var_score",
    check_sql(
        "SELECT date, t, "
        + ", ".join(rounded(_given_sql(c, "lag({}) OVER w", "lag({}, 2) OVER w"), 6, c) for c in FEATURES)
        + " FROM scaled_diff WHERE fold = 'test' WINDOW w AS (ORDER BY t) QUALIFY row_number() OVER w > 2",
        "scaled_diff",
    ),
)
def var_score(spark, sf_dir):
    scored = forecast.var_score(_windows(_diffs(spark, sf_dir), "test", 2), _given(2), FEATURES, ["date", "t"])
    return scored.select("date", "t", *[tidy(F.col(c), 6).alias(c) for c in FEATURES])


@query(
    "recursive_forecast",
    check_sql(
        f"SELECT 'prices' AS domain, step, (start + step::INTEGER)::DATE AS date, {rounded_all(FEATURES, 6)} FROM ahead"
        " WHERE step > 0",
        "scaled_diff",
        extra="ahead AS (SELECT 0 AS step, date AS start, "
        + ", ".join(FEATURES)
        + " FROM scaled_diff WHERE date = (SELECT max(date) FROM scaled_diff) UNION ALL SELECT step + 1, start, "
        + ", ".join(_given_sql(c, "{}") for c in FEATURES)
        + " FROM ahead WHERE step < 7)",
        recursive=True,
    ),
)
def recursive_forecast(spark, sf_dir):
    diffs = fixtures.scaled_diff(spark, sf_dir).where(F.col("fold") == "test").withColumn("domain", F.lit("prices"))
    model = _given(1)
    window = forecast.last_rows(diffs, "t", model.p)
    ahead = forecast.recursive_forecast(window, ["domain"], "date", FEATURES, model.step, 7)
    return ahead.withColumns({c: tidy(F.col(c), 6) for c in FEATURES})


_DOMAIN_TERMS = ["const", *[f"l1_{c}" for c in FEATURES]]
_DOMAIN_MODELS = (
    "rows_1 AS (SELECT fold, 1.0::DOUBLE AS const, "
    + ", ".join(f"lag({c}) OVER w AS l1_{c}, {c} AS y_{c}" for c in FEATURES)
    + " FROM scaled_diff WINDOW w AS (PARTITION BY fold ORDER BY t) QUALIFY row_number() OVER w > 1), systems AS (SELECT fold,"
    f" {products_sql(_DOMAIN_TERMS, _DOMAIN_TERMS + _TARGETS)} AS m FROM rows_1 GROUP BY fold), "
    + elimination_sql("systems", "fold", "len(m)")
    + f", models AS (SELECT fold, m FROM solve WHERE k = {K + 2}), ahead AS (SELECT fold, 0 AS step, date AS start, {', '.join(FEATURES)}"
    " FROM scaled_diff QUALIFY row_number() OVER (PARTITION BY fold ORDER BY t DESC) = 1 UNION ALL SELECT fold, step + 1, start, "
    + ", ".join(
        f"m[1][{K + 2 + j}] + " + " + ".join(f"m[{i + 2}][{K + 2 + j}] * {s}" for i, s in enumerate(FEATURES)) for j in range(K)
    )
    + " FROM ahead JOIN models USING (fold) WHERE step < 7)"
)


@query(
    "domain_forecast",
    check_sql(
        f"SELECT fold AS domain, step, (start + step::INTEGER)::DATE AS date, {rounded_all(FEATURES, 6)} FROM ahead WHERE step > 0",
        "scaled_diff",
        extra=_DOMAIN_MODELS,
        recursive=True,
    ),
)
def domain_forecast(spark, sf_dir):
    """Two domains (the days of each fold), two fitted models, one job."""
    diffs = fixtures.scaled_diff(spark, sf_dir).withColumnRenamed("fold", "domain")
    first = diffs.groupBy("domain").agg(F.min("t").alias("first"))
    rows = blocks.join_per_key(diffs, first, ["domain"]).withColumn("t", F.col("t") - F.col("first")).drop("first")
    rows = settle(rows, "domains")
    params = regress.var_fit(rows, ["domain"], FEATURES, 1)
    ahead = forecast.domain_forecast(forecast.last_rows_by(rows, ["domain"], "t", 1), params, ["domain"], "date", FEATURES, 7)
    return ahead.withColumns({c: tidy(F.col(c), 6) for c in FEATURES})


@query(
    "future_dates",
    check_sql(
        "SELECT series, step::INTEGER AS step, (last + step::INTEGER)::DATE AS date FROM (SELECT series, max(date) AS last FROM px"
        " GROUP BY series), generate_series(1, 17) AS g(step)",
        "px",
    ),
)
def future_dates(spark, sf_dir):
    return forecast.future_dates(fixtures.px_long(spark, sf_dir), ["series"], "date", 17)


_NEXT_SCALED = (
    "reach AS (SELECT "
    + ", ".join(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in FEATURES)
    + " FROM wide), level AS (SELECT date, "
    + ", ".join(f"({c} - {c}_lo) * 2 / ({c}_hi - {c}_lo) - 1 AS {c}" for c in FEATURES)
    + " FROM wide, reach), change AS (SELECT date, "
    + ", ".join(f"{c} AS s_{c}, {c} - lag({c}) OVER w AS {c}, lag({c}) OVER w - lag({c}, 2) OVER w AS p_{c}" for c in FEATURES)
    + " FROM level WINDOW w AS (ORDER BY date) QUALIFY row_number() OVER (ORDER BY date DESC) = 1)"
)


_NEXT_SQL = check_sql(
    "SELECT (date + 1)::DATE AS date, "
    + ", ".join(
        rounded(f"({_given_sql(c, '{}', 'p_{}')} + s_{c} + 1) / 2 * ({c}_hi - {c}_lo) + {c}_lo", 4, c) for c in FEATURES
    )
    + " FROM change, reach",
    "wide",
    extra=_NEXT_SCALED,
)


@query("next_step", _NEXT_SQL)
def next_step(spark, sf_dir):
    table = settle(fixtures.wide(spark, sf_dir), "wide")
    made = forecast.next_step(table, "date", FEATURES, _given(2), 2)
    return made.select("date", *[tidy(F.col(c), 4).alias(c) for c in FEATURES])


@query("stored_next_step", _NEXT_SQL)
def stored_next_step(spark, sf_dir):
    """The same by a model that was saved, saved again over itself, and loaded by its path alone."""
    table = settle(fixtures.wide(spark, sf_dir), "wide")
    bounds = table.agg(*[f(c).alias(f"{n}_{c}") for c in FEATURES for n, f in (("low", F.min), ("high", F.max))]).first()
    scaler = {c: (bounds[f"low_{c}"], bounds[f"high_{c}"]) for c in FEATURES}
    path = scratch(spark, "model")
    for _ in range(2):
        stored.ForecastModel("var", _given(2).as_fit(), 2, 1, FEATURES, scaler).write().overwrite().save(path)
    made = stored.ForecastModel.load(path).transform(table)
    return made.select("date", *[tidy(F.col(c), 4).alias(c) for c in FEATURES])


def _samples(diffs, length: int, tail: bool):
    """Training windows of a written table with a fifth held back: the last ones, or by hash."""
    windows = prep.sliding_windows(diffs, ["domain"], "t", FEATURES, length, SIZE).withColumn("t", F.col("t") - length)
    if tail:
        total = diffs.agg(F.count("*") - length).scalar()
        marked = prep.chronological_split(windows, "t", 0.8, ("train", "validation"), total)
    else:
        marked = prep.hash_split(windows, F.col("t"), 20)
    return training.window_samples(marked)


def _history(spark, fits):
    return training.history_frame(spark, fits).withColumn("parameters", F.lit(sum(f.network.size() for f in fits)))


@query("varnn_v1")
def varnn_v1(spark, sf_dir):
    """The output layer is frozen at the coefficients of the fitted VAR."""
    p = 2
    diffs = _train(settle(_diffs(spark, sf_dir), "diffs"))
    params = regress.var_fit(diffs, ["domain"], FEATURES, p)
    frozen = forecast.VarModel.from_rows(params, FEATURES, p).output_layer()
    fits = training.fit(_samples(diffs, p, True), {"varnn_v1": FeedForward(p, K, frozen)}, p, **FIT)
    return _history(spark, fits)


@query("varnn_v2")
def varnn_v2(spark, sf_dir):
    """Fitted on the training windows, then scored on every test window."""
    p, diffs = 2, settle(_diffs(spark, sf_dir), "diffs")
    fits = training.fit(_samples(_train(diffs), p, True), {"varnn_v2": FeedForward(p, K)}, p, **FIT)
    windows = _windows(diffs, "test", p).withColumn("x", F.flatten("x"))
    return training.score(windows, fits[0], p, FEATURES, ["date", "t"])


@query("srvar_regimes")
def srvar_regimes(spark, sf_dir):
    windows = _windows(_diffs(spark, sf_dir), "train", 1).select(F.flatten("x").alias("x"), "y")
    return forecast.regimes(settle(windows, "pairs"), FEATURES, 2)


@query("srvar_network")
def srvar_network(spark, sf_dir):
    """The recurrent regime network, fitted on the training windows and scored on every test window."""
    p, diffs = 2, settle(_diffs(spark, sf_dir), "diffs")
    fits = training.fit(_samples(_train(diffs), p, False), {"srvar": RegimeNetwork(K, 2)}, p, **FIT)
    windows = _windows(diffs, "test", p).withColumn("x", F.flatten("x"))
    return training.score(windows, fits[0], p, FEATURES, ["date", "t"])


_EXP = ", ".join(f"exp({c}) AS e{i}" for i, c in enumerate(FEATURES))
_SUM = " + ".join(f"e{i}" for i in range(K))


@query(
    "state_entropy",
    check_sql(
        "SELECT date, "
        + rounded("-(" + " + ".join(f"e{i} / z * ln(e{i} / z + 1e-10)" for i in range(K)) + ")", 6, "entropy")
        + f" FROM (SELECT *, {_SUM} AS z FROM (SELECT date, {_EXP} FROM scaled))",
        "scaled",
    ),
)
def state_entropy(spark, sf_dir):
    """Entropy of soft state weights, here a softmax over the scaled series of each day."""
    scores = F.array(*FEATURES)
    rows = fixtures.scaled(spark, sf_dir)
    return rows.select("date", tidy(forecast.entropy(forecast.softmax(scores)), 6).alias("entropy"))


@query("srvar_acyclicity")
def srvar_acyclicity(spark, sf_dir):
    """The graph penalty of each regime's coefficient matrix."""
    edges = srvar_regimes(spark, sf_dir).where(F.col("term") != "const")
    return forecast.acyclicity(
        edges.select("state", F.col("term").alias("src"), F.col("target").alias("dst"), F.col("value").alias("weight")),
        ["state"],
    )


_EDGES = " UNION ALL ".join(
    f"SELECT year(date)::BIGINT AS state, '{x}' AS src, '{y}' AS dst, regr_slope({y}, l_{x}) AS weight FROM yearly GROUP BY 1"
    for x in FEATURES
    for y in FEATURES
)
_YEARLY = (
    "yearly AS (SELECT * FROM (SELECT date, " + ", ".join(FEATURES) + ", "
    + ", ".join(f"lag({c}) OVER (ORDER BY t) AS l_{c}" for c in FEATURES)
    + f" FROM scaled) WHERE l_{FEATURES[0]} IS NOT NULL)"
)


@query(
    "acyclicity",
    check_sql(
        f"SELECT state, {rounded('sum(v) - ' + str(K), 6, 'h')} FROM powers WHERE i = j GROUP BY state",
        "scaled",
        extra=f"{_YEARLY}, edges AS ({_EDGES}), powers AS (SELECT DISTINCT 0 AS n, state, src AS i, src AS j, 1.0::DOUBLE AS v"
        " FROM edges UNION ALL SELECT p.n + 1, p.state, p.i, e.src, sum(p.v * e.weight * e.weight / (p.n + 1)) FROM powers p"
        " JOIN edges e ON e.state = p.state AND e.dst = p.j WHERE p.n < 25 GROUP BY p.n, p.state, p.i, e.src)",
        recursive=True,
    ),
)
def acyclicity(spark, sf_dir):
    """The graph penalty per year, the graph being the slopes of each series on the day before of every other."""
    rows = fixtures.scaled(spark, sf_dir).withColumn("domain", F.lit("prices"))
    lags = {f"l_{c}": blocks.back(c, 1) for c in FEATURES}
    lagged = blocks.halo_window(rows, ["domain"], "t", 1, lags, SIZE).where(F.col(f"l_{FEATURES[0]}").isNotNull())
    slopes = lagged.groupBy(F.year("date").cast("bigint").alias("state")).agg(
        *[F.regr_slope(y, f"l_{x}").alias(f"{x}_on_{y}") for x in FEATURES for y in FEATURES]
    )
    edges = [
        F.struct(F.lit(x).alias("src"), F.lit(y).alias("dst"), F.col(f"{x}_on_{y}").alias("weight"))
        for x in FEATURES
        for y in FEATURES
    ]
    penalty = forecast.acyclicity(slopes.select("state", F.inline(F.array(*edges))), ["state"])
    return penalty.select("state", tidy(F.col("h"), 6).alias("h"))


@query("loss_history")
def loss_history(spark, sf_dir):
    p = 2
    fits = training.fit(_samples(_train(settle(_diffs(spark, sf_dir), "diffs")), p, True), {"varnn_v2": FeedForward(p, K)}, p)
    return training.history_frame(spark, fits)


@query("state_selection")
def state_selection(spark, sf_dir):
    """Two to five states, fitted side by side; the one with the least validation loss is fitted on over all windows."""
    p = 2
    candidates = {f"states_{s}": RegimeNetwork(K, s) for s in range(2, 6)}
    samples = _samples(_train(_diffs(spark, sf_dir)), p, False)
    fits = training.fit(samples, candidates, p, **FIT)
    chosen = training.best_fit(fits)
    again = training.refit(samples, chosen, p, **FIT)
    chosen = chosen.name
    last = training.history_frame(spark, [again if f.name == chosen else f for f in fits]).groupBy("model").agg(F.min("val_loss").alias("val_loss"))
    return last.withColumn("chosen", F.col("model") == chosen)


@query(
    "params_roundtrip",
    check_sql(
        "SELECT 'var' AS model, 'prices' AS domain, DATE '2025-06-10' AS run_date, CASE lag WHEN 0 THEN 'bias' ELSE 'weights' END"
        f" AS name, CASE lag WHEN 0 THEN 0 ELSE (lag - 1) * {K} + src END::INTEGER AS i, dst::INTEGER AS j,"
        f" {rounded('value', 6)} FROM (SELECT lag, value, list_position({list(FEATURES)}, term) - 1 AS src,"
        f" list_position({list(FEATURES)}, target) - 1 AS dst FROM ({_VAR_CELLS}))",
        "scaled_diff",
        extra=_VAR_SYSTEM,
        recursive=True,
    ),
)
def params_roundtrip(spark, sf_dir):
    """Parameters of a fitted model stored as rows and loaded back."""
    day, path = date(2025, 6, 10), scratch(spark, "params")
    params = regress.var_fit(_train(_diffs(spark, sf_dir)), ["domain"], FEATURES, P)
    fitted = forecast.VarModel.from_rows(params, FEATURES, P).as_fit()
    training.save_params(training.params_frame(spark, fitted, "prices", day), path)
    loaded = training.load_params(spark, path, fitted.network, "var", "prices", day)
    return training.params_frame(spark, loaded, "prices", day).withColumn("value", tidy(F.col("value"), 6))


@query("forecast_run")
def forecast_run(spark, sf_dir):
    """The whole job on the wide table: split, scale, difference, choose the lag, fit, score; its errors."""
    result = forecasting.run(fixtures.wide(spark, sf_dir), FEATURES, "varnn")
    return result.errors.withColumn("p", F.lit(result.p)).withColumn("order", F.lit(result.order))
