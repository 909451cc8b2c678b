"""Queries over sources, sinks and the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions import scalars
from tidewell.operators import clean, gold, semantic, upsert
from tidewell.plans.checks import FEATURES, WIDE, check_sql, rounded
from tidewell.plans.registry import query
from tidewell.session import scratch
from tidewell.sources import fixtures, quotes, tables


@query(
    "folder_to_series",
    check_sql(
        "SELECT file_no, lower(regexp_replace(split_part(path, '/', 3), '\\s+', '_', 'g')) AS series FROM folder_paths",
        "folder_paths",
    ),
)
def folder_to_series(spark, sf_dir):
    paths = fixtures.folder_paths(spark, sf_dir)
    return paths.select("file_no", scalars.series_from_path(F.col("path")).alias("series"))


def _vendor_files(spark, sf_dir) -> str:
    """The quotes as vendor files, a folder per instrument; the volume column carries the arrival number."""
    raw = fixtures.quotes_raw(spark, sf_dir)
    layout = raw.select(
        "series", F.col("d").alias("Date"), F.col("p").alias("Close"), F.col("p").alias("High"), F.col("p").alias("Low"),
        F.col("p").alias("Open"), F.col("arrival").alias("Volume"),
    )
    return tables.round_trip(layout, "vendor-files", by=["series"])


@query("csv_scan", check_sql("SELECT series, date, price, arrival FROM quotes", "quotes"))
def csv_scan(spark, sf_dir):
    scan = quotes.read_quote_files(spark, _vendor_files(spark, sf_dir))
    return scan.select(
        F.substring_index("series", "=", -1).alias("series"),
        scalars.parse_day(F.col("Date")).alias("date"),
        scalars.parse_number(F.col("Price")).alias("price"),
        F.col("Volume").cast("bigint").alias("arrival"),
    )


@query(
    "ticker_header",
    check_sql("SELECT series, upper(series) || '=F' AS ticker, d, p FROM quotes_raw", "quotes_raw"),
)
def ticker_header(spark, sf_dir):
    rows = fixtures.quotes_raw(spark, sf_dir).select("series", "d", "p")
    code = F.concat(F.upper("series"), F.lit("=F"))
    lines = rows.select("series").distinct().select("series", F.lit(None).cast("string").alias("d"), code.alias("p"))
    return quotes.split_ticker_rows(rows.unionByName(lines), "d", "p", ["series"])


@query("union_by_name", check_sql("SELECT series, d, arrival, p AS price FROM quotes_raw", "quotes_raw"))
def union_by_name(spark, sf_dir):
    raw = fixtures.quotes_raw(spark, sf_dir)
    vendor = raw.where("status = 'F'").select("series", "d", "arrival", F.col("p").alias("close"))
    history = raw.where("status <> 'F'").select("d", F.col("p").alias("price"), "arrival", "series")
    both = quotes.union_layouts([vendor, history], strict=False)
    return quotes.merge_price_columns(both, ["close", "price"])


@query(
    "clean_columns",
    check_sql('SELECT d AS "Date", p AS "Price", arrival AS "Vol", status AS "Change" FROM quotes_raw', "quotes_raw"),
)
def clean_columns(spark, sf_dir):
    raw = fixtures.quotes_raw(spark, sf_dir).select("d", "p", "arrival", "status")
    return scalars.clean_columns(raw.toDF("Date", "Price", "Vol.", "Change %"))


def _namespace(spark, name: str) -> str:
    tables.create_namespace(spark, name, scratch(spark, name))
    return name


@query("bronze_overwrite", check_sql("SELECT series, d, p, arrival, status FROM quotes_raw", "quotes_raw"))
def bronze_overwrite(spark, sf_dir):
    name = _namespace(spark, "tidewell_bronze") + ".quotes"
    raw = fixtures.quotes_raw(spark, sf_dir)
    tables.overwrite_table(fixtures.quotes_dirty(spark, sf_dir), name)
    tables.overwrite_table(raw, name)
    return spark.table(name)


@query("ctas_copy", check_sql("SELECT * FROM px", "px"))
def ctas_copy(spark, sf_dir):
    name = f"{_namespace(spark, 'tidewell_gold')}.px"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    tables.copy_table(fixtures.px_long(spark, sf_dir), name, {"layer": "gold"})
    return spark.table(name)


@query(
    "partition_overwrite",
    check_sql(
        "SELECT series, date, price FROM existing, span WHERE date < low OR date > high"
        " UNION ALL SELECT series, date, price FROM batch",
        "existing",
        "batch",
        "span",
    ),
)
def partition_overwrite(spark, sf_dir):
    path = scratch(spark, "silver-by-month")
    upsert.publish(fixtures.existing(spark, sf_dir), path, ["series", "date"])
    upsert.publish(fixtures.batch(spark, sf_dir), path, ["series", "date"], "range_replace")
    return upsert.read(spark, path).select("series", "date", "price")


@query(
    "list_tables",
    check_sql(
        "SELECT 'monthly' AS table_name, (SELECT count(*) FROM monthly) AS n_rows"
        " UNION ALL SELECT 'px', (SELECT count(*) FROM px)",
        "monthly",
        "px",
    ),
)
def list_tables(spark, sf_dir):
    namespace = _namespace(spark, "tidewell_silver")
    tables.overwrite_table(fixtures.px_long(spark, sf_dir), f"{namespace}.px")
    tables.overwrite_table(fixtures.macro_monthly(spark, sf_dir), f"{namespace}.monthly")
    names = sorted(r.table_name for r in tables.list_tables(spark, namespace).collect())
    counted = [
        spark.table(f"{namespace}.{n}").agg(F.lit(n).alias("table_name"), F.count("*").alias("n_rows")) for n in names
    ]
    return quotes.union_layouts(counted)


def _forecast_rows(spark, sf_dir, model: str):
    rows = fixtures.forecasts(spark, sf_dir).where(F.col("model") == model)
    columns = {s: {"predicted": c} for s, c in WIDE.items()}
    return gold.spread(rows, ["date"], "variable", ["predicted"], columns).select(*FEATURES, "date")


# Model folders and the day the forecast files are written for.
MODEL_FOLDERS = {"srvar": "SrVAR", "varnn": "VARNN"}
RUN_DAY = "10_06_2025"

_PIVOTED = ", ".join(rounded(f"max(CASE WHEN variable = '{s}' THEN predicted END)", 5, c) for s, c in WIDE.items())


@query(
    "forecast_sink",
    check_sql(
        f"SELECT date, 'future' AS kind, model, 'prices' AS \"table\", DATE '2025-06-10' AS run_date, {_PIVOTED}"
        " FROM forecasts GROUP BY date, model",
        "forecasts",
    ),
)
def forecast_sink(spark, sf_dir):
    root = scratch(spark, "forecast-files")
    for model, folder in MODEL_FOLDERS.items():
        path = f"{root}/future/{folder}/prices_future_{RUN_DAY}.csv"
        tables.write_csv(_forecast_rows(spark, sf_dir, model), path, digits=5)
    read = quotes.read_forecast_files(spark, root, FEATURES)
    return read.withColumns({c: scalars.tidy(F.col(c), 5) for c in FEATURES})


@query(
    "file_name_facets",
    check_sql(
        "SELECT arrival, CASE status WHEN 'O' THEN 'future' ELSE 'predict' END AS kind,"
        " CASE status WHEN 'P' THEN 'varnn' ELSE 'srvar' END AS model, series AS \"table\", date AS run_date FROM quotes",
        "quotes",
    ),
)
def file_name_facets(spark, sf_dir):
    kind = F.when(F.col("status") == "O", "future").otherwise("predict")
    folder = F.when(F.col("status") == "P", MODEL_FOLDERS["varnn"]).otherwise(MODEL_FOLDERS["srvar"])
    day = F.date_format("date", "dd_MM_yyyy")
    path = F.concat(F.lit("/data/"), kind, F.lit("/"), folder, F.lit("/"), "series", F.lit("_"), kind, F.lit("_"), day, F.lit(".csv"))
    files = fixtures.quotes(spark, sf_dir).select("arrival", path.alias("path"))
    return files.select("arrival", *[c.alias(n) for n, c in scalars.forecast_file_facets(F.col("path")).items()])


_COLUMNS = ("date", "year", "month", "id", *FEATURES)


@query(
    "verify_counts",
    check_sql(
        f"SELECT count(*) AS n_rows, {len(_COLUMNS)}::BIGINT AS n_columns, min(id) AS min_key, max(id) AS max_key, "
        + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in _COLUMNS)
        + " FROM wide",
        "wide",
    ),
)
def verify_counts(spark, sf_dir):
    return clean.table_check(fixtures.wide(spark, sf_dir), "id")


@query(
    "sql_preview",
    check_sql(
        "SELECT series, count(*) AS n, " + rounded("avg(price)", 4, "mean_price") + ", max(date) AS last_date FROM quotes"
        " GROUP BY series ORDER BY series LIMIT 100",
        "quotes",
    ),
)
def sql_preview(spark, sf_dir):
    fixtures.quotes(spark, sf_dir).createOrReplaceTempView("tidewell_quotes")
    statement = (
        "SELECT series, count(*) AS n, round(avg(price) + 1e-8, 4) + 0.0D AS mean_price, max(date) AS last_date"
        " FROM tidewell_quotes GROUP BY series ORDER BY series"
    )
    return semantic.preview(spark, statement, 100)


@query(
    "row_transpose",
    check_sql(
        "SELECT u.* FROM (SELECT series, date::VARCHAR AS date, n::VARCHAR AS n, low::VARCHAR AS low, high::VARCHAR AS high"
        " FROM (SELECT series, min(date) AS date, count(*) AS n, min(price) AS low, max(price) AS high FROM quotes"
        " GROUP BY series ORDER BY series LIMIT 1)) AS t, LATERAL (VALUES ('series', t.series), ('date', t.date),"
        " ('n', t.n), ('low', t.low), ('high', t.high)) AS u(\"column\", value)",
        "quotes",
    ),
)
def row_transpose(spark, sf_dir):
    fixtures.quotes(spark, sf_dir).createOrReplaceTempView("tidewell_quotes")
    statement = (
        "SELECT series, min(date) AS date, count(*) AS n, min(price) AS low, max(price) AS high FROM tidewell_quotes"
        " GROUP BY series ORDER BY series"
    )
    return semantic.preview(spark, statement, 1)


