"""Queries over gold assembly, joins, upserts and the semantic layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions.scalars import tidy
from tidewell.operators import blocks, evaluate, gold, semantic, upsert
from tidewell.plans.checks import FEATURES, WIDE, check_sql, rounded, rounded_all
from tidewell.plans.registry import query
from tidewell.sources import fixtures

PRICES = ("price", "open", "high", "low")
SIZE = 256


@query("gold_wide", check_sql("SELECT * FROM wide", "wide"))
def gold_wide(spark, sf_dir):
    return fixtures.wide(spark, sf_dir)


@query(
    "asof_monthly",
    check_sql(
        "SELECT s.indicator, s.date, s.n_lines, m.rate FROM shipping s ASOF LEFT JOIN monthly m"
        " ON s.indicator = m.indicator AND s.date >= m.date",
        "shipping",
        "monthly",
    ),
)
def asof_monthly(spark, sf_dir):
    daily = fixtures.shipping_days(spark, sf_dir).withColumn("t", blocks.day_axis("date"))
    monthly = fixtures.macro_monthly(spark, sf_dir).withColumn("t", blocks.day_axis("date"))
    return gold.as_of(daily, monthly, ["indicator"], "t", ["rate"], SIZE).drop("t")


@query(
    "yearly_avg",
    check_sql(
        "SELECT row_number() OVER (PARTITION BY series ORDER BY year(date)) AS id, series, year(date)::BIGINT AS year, "
        + ", ".join(rounded(f"avg({c})", 4, f"{c}_avg") for c in PRICES)
        + " FROM px GROUP BY series, year(date)",
        "px",
    ),
)
def yearly_avg(spark, sf_dir):
    yearly = gold.yearly_averages(fixtures.px_long(spark, sf_dir), ["series"], "date", PRICES)
    numbered = blocks.row_index(yearly, ["series"], "year")
    return numbered.withColumns({f"{c}_avg": tidy(F.col(f"{c}_avg"), 4) for c in PRICES})


_PAIR = ", ".join(
    rounded(f"max(CASE WHEN model = '{m}' AND variable = '{s}' THEN predicted END)", 4, f"{c}_{m}")
    for m in ("srvar", "varnn")
    for s, c in WIDE.items()
)
_PAIR_SQL = check_sql(
    f"SELECT date, (date - DATE '1970-01-01')::BIGINT AS id, {_PAIR} FROM forecasts GROUP BY date", "forecasts"
)


def _rounded_pair(paired):
    return paired.select("date", "id", *[tidy(F.col(f"{c}_{m}"), 4).alias(f"{c}_{m}") for m in ("srvar", "varnn") for c in FEATURES])


@query("pair_models", _PAIR_SQL)
def pair_models(spark, sf_dir):
    """The long form: both models pivoted at once."""
    return _rounded_pair(gold.pair_long(fixtures.forecasts(spark, sf_dir), WIDE, ("srvar", "varnn")))


@query("pair_models_join", _PAIR_SQL)
def pair_models_join(spark, sf_dir):
    """The form for two wide tables, as forecast files give them: an inner join on the day."""
    names = {s: {"predicted": c} for s, c in WIDE.items()}
    rows = fixtures.forecasts(spark, sf_dir)
    tables = [gold.spread(rows.where(F.col("model") == m), ["date"], "variable", ["predicted"], names) for m in ("srvar", "varnn")]
    return _rounded_pair(gold.pair_models(tables[0], tables[1], ("srvar", "varnn")))


@query("batch_bounds", check_sql("SELECT low AS min_date, high AS max_date FROM span", "span"))
def batch_bounds(spark, sf_dir):
    return gold.batch_bounds(fixtures.batch(spark, sf_dir))


@query(
    "upsert_range",
    check_sql(
        "SELECT series, date, price FROM existing, span WHERE date < low OR date > high"
        " UNION ALL SELECT series, date, price FROM batch",
        "existing",
        "batch",
        "span",
    ),
)
def upsert_range(spark, sf_dir):
    return upsert.range_replace(fixtures.existing(spark, sf_dir), fixtures.batch(spark, sf_dir))


@query(
    "upsert_merge",
    check_sql(
        "SELECT series, date, coalesce(b.price, e.price) AS price FROM existing e FULL JOIN batch b USING (series, date)",
        "existing",
        "batch",
    ),
)
def upsert_merge(spark, sf_dir):
    return upsert.merge(fixtures.existing(spark, sf_dir), fixtures.batch(spark, sf_dir), ["series", "date"])


@query(
    "updates_inner",
    check_sql("SELECT b.* FROM batch b JOIN existing e ON b.series = e.series AND b.date = e.date", "existing", "batch"),
)
def updates_inner(spark, sf_dir):
    return upsert.updates(fixtures.existing(spark, sf_dir), fixtures.batch(spark, sf_dir), ["series", "date"])


@query(
    "inserts_anti",
    check_sql("SELECT b.* FROM batch b WHERE (series, date) NOT IN (SELECT (series, date) FROM existing)", "existing", "batch"),
)
def inserts_anti(spark, sf_dir):
    return upsert.inserts(fixtures.existing(spark, sf_dir), fixtures.batch(spark, sf_dir), ["series", "date"])


_ERRORS = ("mse", "rmse", "mae")


@query(
    "eval_pair",
    check_sql(
        "SELECT variable, "
        + ", ".join(
            rounded(f"max(CASE WHEN model = '{m}' THEN {e} END)", 2, f"{e}_{s}")
            for m, s in (("srvar", "srvar"), ("varnn", "var"))
            for e in _ERRORS
        )
        + " FROM (SELECT * FROM errors UNION ALL SELECT model, 'Total', avg(mse), sqrt(avg(mse)), avg(mae) FROM errors"
        " GROUP BY model) GROUP BY variable",
        "errors",
    ),
)
def eval_pair(spark, sf_dir):
    metrics = evaluate.forecast_errors(fixtures.forecasts(spark, sf_dir))
    paired = gold.metrics_side_by_side(metrics, {"srvar": "srvar", "varnn": "var"})
    return paired.select("variable", *[tidy(F.col(c), 2).alias(c) for c in paired.columns if c != "variable"])


QUOTES = semantic.Cube("quotes", {"series": "series", "status": "status", "arrival": "arrival"}, "date", "arrival")


@query("cube_count", check_sql("SELECT series, status, count(*) AS count FROM quotes GROUP BY ALL", "quotes"))
def cube_count(spark, sf_dir):
    return semantic.cube_query(fixtures.quotes(spark, sf_dir), QUOTES, ["series", "status"])


@query(
    "cube_time",
    check_sql(
        "SELECT series, date_trunc('month', date)::DATE AS date, count(*) AS count FROM quotes"
        " WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' GROUP BY ALL",
        "quotes",
    ),
)
def cube_time(spark, sf_dir):
    quotes = fixtures.quotes(spark, sf_dir)
    return semantic.cube_query(quotes, QUOTES, ["series"], "month", ("1996-01-01", "2000-12-31"))


@query(
    "cube_view",
    check_sql(
        "SELECT o_orderkey AS arrival, o_orderstatus AS status, o_custkey AS accounts_account, c_mktsegment AS"
        " accounts_segment FROM orders JOIN customer ON o_custkey = c_custkey"
    ),
)
def cube_view(spark, sf_dir):
    orders = semantic.Cube("orders", {"arrival": "o_orderkey", "status": "o_orderstatus"}, "o_orderdate", "o_orderkey")
    accounts = semantic.Cube("accounts", {"account": "c_custkey", "segment": "c_mktsegment"}, key="c_custkey")
    joined = fixtures.table(spark, sf_dir, "orders").join(
        fixtures.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    views = [semantic.CubeView(orders, ("arrival", "status")), semantic.CubeView(accounts, ("account", "segment"), True)]
    return semantic.view_query(joined, views)


@query(
    "forecast_errors",
    check_sql(
        f"SELECT model, variable, {rounded_all(_ERRORS, 2)} FROM (SELECT * FROM errors UNION ALL"
        " SELECT model, 'Total', avg(mse), sqrt(avg(mse)), avg(mae) FROM errors GROUP BY model)",
        "errors",
    ),
)
def forecast_errors(spark, sf_dir):
    errors = evaluate.forecast_errors(fixtures.forecasts(spark, sf_dir))
    return errors.select("model", "variable", *[tidy(F.col(c), 2).alias(c) for c in _ERRORS])


@query(
    "naive_errors",
    check_sql(
        f"SELECT variable, {rounded_all(_ERRORS, 2)} FROM (SELECT * FROM naive UNION ALL"
        " SELECT 'Total', avg(mse), sqrt(avg(mse)), avg(mae) FROM naive)",
        "dense",
        extra="lagged AS (SELECT series AS variable, price, lag(price) OVER (PARTITION BY series ORDER BY date) AS was FROM"
        " dense), naive AS (SELECT variable, avg((price - was) ** 2) AS mse, sqrt(avg((price - was) ** 2)) AS rmse,"
        " avg(abs(price - was)) AS mae FROM lagged GROUP BY variable)",
    ),
)
def naive_errors(spark, sf_dir):
    dense = fixtures.px_dense(spark, sf_dir).select(F.col("series").alias("variable"), "date", "price")
    placed = dense.withColumn("t", blocks.day_axis("date"))
    errors = evaluate.forecast_errors(evaluate.persistence(placed, ["variable"], "t", "price", SIZE), by=())
    return errors.select("variable", *[tidy(F.col(c), 2).alias(c) for c in _ERRORS])


@query(
    "wide_left_out",
    check_sql(
        "SELECT series, CASE WHEN series = '5_low' THEN 'unlisted' ELSE 'early' END AS reason, count(*) AS n_rows FROM px WHERE series ="
        " '5_low' OR date < (SELECT max(first) FROM (SELECT min(date) AS first FROM px WHERE series <> '5_low' GROUP BY series))"
        " GROUP BY ALL",
        "px",
    ),
)
def wide_left_out(spark, sf_dir):
    """Rows that a wide table of four of the series leaves out."""
    listed = {name: column for name, column in WIDE.items() if name != "5_low"}
    return gold.left_out(fixtures.px_long(spark, sf_dir), listed)
