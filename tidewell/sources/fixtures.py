"""Quote, indicator, forecast and audit shapes derived by Spark from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.scalars import tidy
from tidewell.operators import blocks, clean, gold, prep
from tidewell.session import settle

# The five series of the orders table, in name order, and the columns they take in a wide table. Their names
# are the order priorities in lower case with "-" and blanks as "_"; none holds two of these in a row.
SERIES = ("1_urgent", "2_high", "3_medium", "4_not_specified", "5_low")
WIDE = {s: "s" + s for s in SERIES}
FEATURES = tuple(WIDE.values())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def series_name() -> Column:
    """Series of an order, never null, so that joins on it add no filter and branches of a plan can share a shuffle."""
    return F.coalesce(F.translate(F.lower("o_orderpriority"), "- ", "__"), F.lit(""))


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed quotes: several per series and day, ``arrival`` is unique."""
    return table(spark, sf_dir, "orders").select(
        series_name().alias("series"),
        F.to_date("o_orderdate").alias("date"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("arrival"),
    )


def quotes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same quotes as the text a quote file holds."""
    return quotes(spark, sf_dir).select(
        "series",
        F.date_format("date", "MM/dd/yyyy").alias("d"),
        F.format_number("price", 2).alias("p"),
        "arrival",
        "status",
    )


def quotes_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial quotes (status P) without a price, the dearest as 'n/a', finished ones (status F) delivered twice."""
    raw = quotes_raw(spark, sf_dir)
    text = F.when(F.col("status") == "P", F.lit(None)).when(F.length("p") > 9, F.lit("n/a")).otherwise(F.col("p"))
    dirty = raw.withColumn("p", text)
    copies = F.when(F.col("status") == "F", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return dirty.withColumn("copy", F.explode(copies)).drop("copy")


def folder_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("file_no"),
        F.concat(
            F.lit("/raw/"), "o_orderpriority", F.lit("/"), series_name(), F.lit("_"),
            F.date_format("o_orderdate", "dd_MM_yyyy"), F.lit(".csv"),
        ).alias("path"),
    )


def px_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per series and day: last, first, highest and lowest price."""
    return clean.daily_bars(quotes(spark, sf_dir), ["series"], "date", "price", "arrival")


def px_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars in which partial quotes have no price, so that fills have work to do."""
    known = F.when(F.col("status") != "P", F.col("price"))
    return (
        quotes(spark, sf_dir)
        .groupBy("series", "date")
        .agg(F.max_by(known, "arrival").alias("price"), F.min_by(known, "arrival").alias("open"))
    )


def px_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.densify(px_long(spark, sf_dir), ["series"], "date", ["price", "open", "high", "low"])


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day from the day every series has started, a column per series."""
    return gold.wide_table(px_long(spark, sf_dir), WIDE)


def wide_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table as a written table, with ``t`` = 0, 1, 2, ... in day order."""
    return settle(wide(spark, sf_dir), "wide").withColumn("t", F.col("id") - 1)


def scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide table scaled to [-1, 1] on the first 80 % of days, with ``t`` and ``fold``."""
    split = prep.chronological_split(wide_axis(spark, sf_dir), "t", 0.8)
    return prep.scale_wide(split, FEATURES, F.col("fold") == "train")


def scaled_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First differences of the scaled table, ``t`` starting at 0 again; each fold loses its first row."""
    diffs = prep.difference_wide(scaled(spark, sf_dir), ["fold"], "t", FEATURES, 1)
    return diffs.select("date", (F.col("t") - 1).alias("t"), "fold", *FEATURES)


def macro_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A monthly rate per indicator (return flag), dated the first of its month."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_returnflag").alias("indicator"), F.trunc("l_shipdate", "month").alias("date"))
        .agg(tidy(F.avg("l_discount"), 6).alias("rate"))
    )


def shipping_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shipped per indicator and day."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_returnflag").alias("indicator"), F.to_date("l_shipdate").alias("date"))
        .agg(F.count("*").alias("n_lines"))
    )


# The day the stored quotes end and the day the new batch starts.
STORED_UNTIL = "2001-01-01"
BATCH_FROM = "2000-10-01"


def existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored daily bars, up to STORED_UNTIL."""
    return px_long(spark, sf_dir).where(F.col("date") < F.to_date(F.lit(STORED_UNTIL))).select("series", "date", "price")


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new delivery from BATCH_FROM on, priced one higher, holding only days with finished quotes, so it has holes."""
    finished = quotes(spark, sf_dir).where((F.col("status") == "F") & (F.col("date") >= F.to_date(F.lit(BATCH_FROM))))
    return finished.groupBy("series", "date").agg((F.max_by("price", "arrival") + 1).alias("price"))


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models per series and day: the value of the day before, and the mean of the two days before."""
    dense = px_dense(spark, sf_dir).select("series", "date", "price").withColumn("t", blocks.day_axis("date"))
    lagged = blocks.halo_window(
        dense,
        ["series"],
        "t",
        2,
        {"lag1": blocks.back("price", 1), "lag2": blocks.back("price", 2)},
    ).where(F.col("lag2").isNotNull())
    pairs = F.array(
        F.struct(F.lit("srvar").alias("model"), F.col("lag1").alias("predicted")),
        F.struct(F.lit("varnn").alias("model"), ((F.col("lag1") + F.col("lag2")) / 2).alias("predicted")),
    )
    return lagged.select(F.col("series").alias("variable"), "date", F.col("price").alias("actual"), F.inline(pairs))


def hour_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars per event type and hour of the event values."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "value",
        F.struct("ts", "event_id").alias("arrival"),
    )
    return clean.daily_bars(events, ["series"], "hour", "value", "arrival")


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as commits."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("snapshot_id"),
        F.col("event_type").alias("branch"),
        F.col("user_id").alias("author"),
        "ts",
        F.col("props").alias("op"),
    )


def snap_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("account"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )


def snap_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later version of the accounts: overdrawn ones closed, building ones credited, suppliers opened as new ones."""
    kept = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    credit = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    opened = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1_000_000_000_000).alias("account"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    accounts = kept.select(F.col("c_custkey").alias("account"), F.col("c_name").alias("name"), credit.alias("balance"))
    return accounts.union(opened)
