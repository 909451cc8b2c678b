"""Queries over projections, filters, duplicates, fills, ids and order."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions import scalars
from tidewell.operators import blocks, clean
from tidewell.plans import medallion
from tidewell.plans.checks import FEATURES, check_sql, rounded
from tidewell.plans.registry import query
from tidewell.sources import fixtures

# Small enough that the test series span many blocks; deployments keep the default size.
SIZE = 256
PRICES = ("price", "open", "high", "low")


@query(
    "silver_project",
    check_sql("SELECT date, price, price AS open, price AS high, price AS low FROM quotes", "quotes"),
)
def silver_project(spark, sf_dir):
    raw = fixtures.quotes_raw(spark, sf_dir)
    named = raw.select(F.col("d").alias("date"), *[F.col("p").alias(c) for c in PRICES], F.col("arrival").alias("volume"))
    return clean.typed_quotes(named)


@query(
    "parse_date",
    check_sql("SELECT arrival, CASE WHEN status <> 'P' THEN date END AS date FROM quotes", "quotes"),
)
def parse_date(spark, sf_dir):
    """Both layouts, and text that is no date."""
    raw = fixtures.quotes(spark, sf_dir)
    text = (
        F.when(F.col("status") == "F", F.date_format("date", "MM/dd/yyyy"))
        .when(F.col("status") == "O", F.date_format("date", "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit("week of "), F.date_format("date", "MM/dd/yyyy")))
    )
    return raw.select("arrival", scalars.parse_day(text).alias("date"))


@query(
    "parse_number",
    check_sql("SELECT arrival, try_cast(replace(p, ',', '') AS DOUBLE) AS price FROM quotes_dirty", "quotes_dirty"),
)
def parse_number(spark, sf_dir):
    padded = F.concat(F.lit(" "), "p", F.lit(" "))
    return fixtures.quotes_dirty(spark, sf_dir).select("arrival", scalars.parse_number(padded).alias("price"))


@query(
    "cast_ohlc",
    check_sql(
        "SELECT arrival AS id, date::TIMESTAMP AS date, price AS price, price::FLOAT::DOUBLE AS price_float FROM quotes",
        "quotes",
    ),
)
def cast_ohlc(spark, sf_dir):
    raw = fixtures.quotes_raw(spark, sf_dir)
    price = scalars.parse_number(F.col("p"))
    return raw.select(
        F.col("arrival").cast("string").try_cast("bigint").alias("id"),
        scalars.parse_day(F.col("d")).cast("timestamp_ntz").alias("date"),
        price.alias("price"),
        price.cast("float").cast("double").alias("price_float"),
    )


@query(
    "calendar_cols",
    check_sql("SELECT arrival, date, year(date)::BIGINT AS year, month(date)::BIGINT AS month FROM quotes", "quotes"),
)
def calendar_cols(spark, sf_dir):
    return scalars.calendar_columns(fixtures.quotes(spark, sf_dir).select("arrival", "date"))


# The span the range filter keeps.
RANGE = ("1996-03-01", "2000-09-30")


@query(
    "date_range_filter",
    check_sql(
        "SELECT o_orderkey, o_orderdate::DATE AS date, o_totalprice, o_orderdate BETWEEN DATE '1996-03-01' AND DATE"
        " '2000-09-30' AS inside FROM orders WHERE o_totalprice IS NOT NULL AND (o_orderdate BETWEEN DATE '1996-03-01' AND"
        " DATE '2000-09-30' OR o_orderdate < DATE '1996-01-01' OR o_orderdate > DATE '2001-01-01')"
    ),
)
def date_range_filter(spark, sf_dir):
    """Inclusive range, outside of a range and non-null, on the stored column so that all of it reaches the scan."""
    low, high = [F.lit(f"{d} 00:00:00").cast("timestamp_ntz") for d in RANGE]
    early, late = [F.lit(f"{d} 00:00:00").cast("timestamp_ntz") for d in ("1996-01-01", "2001-01-01")]
    day = F.col("o_orderdate")
    kept = fixtures.table(spark, sf_dir, "orders").where(
        F.col("o_totalprice").isNotNull() & (day.between(low, high) | (day < early) | (day > late))
    )
    return kept.select("o_orderkey", F.to_date(day).alias("date"), "o_totalprice", day.between(low, high).alias("inside"))


@query("feature_project", check_sql(f"SELECT {', '.join(FEATURES)} FROM wide", "wide"))
def feature_project(spark, sf_dir):
    return clean.feature_columns(fixtures.wide(spark, sf_dir))


def _profile_sql(column: str) -> str:
    return (
        f"SELECT '{column}' AS variable, count({column}) AS count, {rounded(f'avg({column})', 4, 'mean')},"
        f" {rounded(f'stddev({column})', 4, 'std')}, min({column}) AS min, max({column}) AS max, "
        + ", ".join(rounded(f"quantile_cont({column}, 0.{q})", 4, f"q{q}") for q in ("25", "50", "75"))
        + " FROM bars"
    )


@query(
    "profile",
    check_sql(
        " UNION ALL ".join(_profile_sql(c) for c in ("price", "open", "total", "lines")),
        extra="bars AS (SELECT o_totalprice AS price, o_totalprice / 2 AS open, CASE WHEN o_orderstatus <> 'P' THEN"
        " o_totalprice END AS total, (o_custkey + 0.0)::DOUBLE AS lines FROM orders)",
    ),
)
def profile(spark, sf_dir):
    orders = fixtures.table(spark, sf_dir, "orders")
    bars = orders.select(
        F.col("o_totalprice").alias("price"),
        (F.col("o_totalprice") / 2).alias("open"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("total"),
        F.col("o_custkey").cast("double").alias("lines"),
    )
    result = clean.profile(bars, bars.columns)
    return result.withColumns({c: scalars.tidy(F.col(c), 4) for c in ("mean", "std", "q25", "q50", "q75")})


@query(
    "tail_n",
    check_sql("SELECT arrival, series, date, price FROM quotes ORDER BY date DESC, arrival DESC LIMIT 5", "quotes"),
)
def tail_n(spark, sf_dir):
    rows = fixtures.quotes(spark, sf_dir).select("arrival", "series", "date", "price")
    return rows.orderBy(F.col("date").desc(), F.col("arrival").desc()).limit(5)


@query("dedupe_rows", check_sql("SELECT DISTINCT series, d, p, arrival FROM quotes_dirty", "quotes_dirty"))
def dedupe_rows(spark, sf_dir):
    return fixtures.quotes_dirty(spark, sf_dir).select("series", "d", "p", "arrival").dropDuplicates()


@query(
    "dedupe_last",
    check_sql(
        "SELECT series, date, arg_max(price, arrival) AS price, max(arrival) AS arrival, arg_max(status, arrival) AS status"
        " FROM quotes GROUP BY series, date",
        "quotes",
    ),
)
def dedupe_last(spark, sf_dir):
    return clean.latest_per_key(fixtures.quotes(spark, sf_dir), ["series", "date"], "arrival")


_FILL_SQL = check_sql(
    "SELECT series, date, last_value(price IGNORE NULLS) OVER w AS price, last_value(open IGNORE NULLS) OVER w AS open"
    " FROM px_gaps WINDOW w AS (PARTITION BY series ORDER BY date)",
    "px_gaps",
)


@query("ffill", _FILL_SQL)
def ffill(spark, sf_dir):
    placed = fixtures.px_gaps(spark, sf_dir).withColumn("t", blocks.day_axis("date"))
    return blocks.fill_forward(placed, ["series"], "t", ["price", "open"]).drop("t")


@query("ffill_blocked", _FILL_SQL)
def ffill_blocked(spark, sf_dir):
    """Small blocks and two levels of summaries, with the same answer."""
    placed = fixtures.px_gaps(spark, sf_dir).withColumn("t", blocks.day_axis("date"))
    return blocks.fill_forward(placed, ["series"], "t", ["price", "open"], size=32, levels=2).drop("t")


@query(
    "row_id",
    check_sql("SELECT row_number() OVER (PARTITION BY series ORDER BY date) AS id, * FROM px", "px"),
)
def row_id(spark, sf_dir):
    return clean.with_row_id(fixtures.px_long(spark, sf_dir), ["series"], "date", size=SIZE)


@query("stable_id", check_sql("SELECT row_number() OVER (ORDER BY series, date) AS id, * FROM px", "px"))
def stable_id(spark, sf_dir):
    return clean.with_global_id(fixtures.px_long(spark, sf_dir), ["series"], "date", size=SIZE)


@query(
    "densify_ffill",
    check_sql(
        "SELECT c.series, c.date, last_value(price IGNORE NULLS) OVER w AS price, last_value(open IGNORE NULLS) OVER w AS"
        " open FROM calendar c LEFT JOIN px_gaps g ON g.series = c.series AND g.date = c.date"
        " WINDOW w AS (PARTITION BY c.series ORDER BY c.date)",
        "calendar",
        "px_gaps",
    ),
)
def densify_ffill(spark, sf_dir):
    return clean.densify(fixtures.px_gaps(spark, sf_dir), ["series"], "date", ["price", "open"], size=SIZE)


@query(
    "densify_whole_row",
    check_sql(
        "SELECT c.series, c.date, g.price, g.open FROM calendar c ASOF JOIN px_gaps g ON g.series = c.series AND g.date <= c.date",
        "calendar",
        "px_gaps",
    ),
)
def densify_whole_row(spark, sf_dir):
    """Every day holds the last row as it is, nulls included."""
    return clean.densify(fixtures.px_gaps(spark, sf_dir), ["series"], "date", ["price", "open"], "whole_row", size=SIZE)


@query(
    "densify_hours",
    check_sql(
        "SELECT c.series, c.hour, last_value(price IGNORE NULLS) OVER w AS price FROM hours c LEFT JOIN hour_bars b ON"
        " b.series = c.series AND b.hour = c.hour WINDOW w AS (PARTITION BY c.series ORDER BY c.hour)",
        "hour_bars",
        extra="hours AS (SELECT series, unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM"
        " hour_bars GROUP BY series)",
    ),
)
def densify_hours(spark, sf_dir):
    return clean.densify(fixtures.hour_bars(spark, sf_dir), ["series"], "hour", ["price"], size=SIZE, step="hour")


@query(
    "silver_series",
    check_sql(
        "SELECT series, date, last_value(price IGNORE NULLS) OVER w AS price, row_number() OVER w AS id FROM latest"
        " WINDOW w AS (PARTITION BY series ORDER BY date)",
        "quotes_dirty",
        extra="latest AS (SELECT series, strptime(d, '%m/%d/%Y')::DATE AS date, (list(try_cast(replace(p, ',', '') AS DOUBLE)"
        " ORDER BY arrival DESC))[1] AS price FROM quotes_dirty GROUP BY 1, 2)",
    ),
)
def silver_series(spark, sf_dir):
    """The whole cleaning job on raw text: parse, the latest file per day, fill, number."""
    dirty = fixtures.quotes_dirty(spark, sf_dir)
    file = F.concat(F.lit("/raw/"), "series", F.lit("/"), F.lpad(F.col("arrival").cast("string"), 20, "0"), F.lit(".csv"))
    raw = dirty.select("series", file.alias("file"), F.col("d").alias("Date"), *[F.col("p").alias(c) for c in PRICES])
    return medallion.silver(raw).select("series", "date", "price", "id")


@query(
    "order_top",
    check_sql("SELECT series, date, price, low FROM px ORDER BY price DESC, series, date LIMIT 10", "px"),
)
def order_top(spark, sf_dir):
    px = fixtures.px_long(spark, sf_dir).select("series", "date", "price", "low")
    return px.orderBy(F.col("price").desc(), "series", "date").limit(10)


@query(
    "rejected_rows",
    check_sql(
        "SELECT series, CASE WHEN p IS NULL THEN 'no price' WHEN p = 'n/a' THEN 'unread price' ELSE 'kept' END AS reason,"
        " count(*) AS n_rows FROM quotes_dirty GROUP BY ALL",
        "quotes_dirty",
    ),
)
def rejected_rows(spark, sf_dir):
    """Quotes set aside with the reason, and those kept, from one pass over the text."""
    price = scalars.parse_number(F.col("p"))
    rules = {"no date": scalars.parse_day(F.col("d")).isNull(), "no price": F.col("p").isNull(), "unread price": price.isNull()}
    found = clean.sort_out(fixtures.quotes_dirty(spark, sf_dir), rules)
    assert found.counts["kept"] + sum(found.counts[label] for label in rules) == found.counts["read"]
    told = found.rejected.unionByName(found.kept.withColumn("reason", F.lit("kept")))
    return told.groupBy("series", "reason").agg(F.count("*").alias("n_rows"))
