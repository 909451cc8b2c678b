"""Raw quote files to silver to gold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.scalars import file_order, parse_day, parse_number
from tidewell.operators import blocks, clean, gold
from tidewell.operators.versions import VersionedTable
from tidewell.sources import fixtures, quotes


def bronze(spark: SparkSession, roots: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """All quote files of the given (folder, layout) pairs as text, without ticker lines; a missing folder is skipped."""
    scans = [quotes.read_quote_files(spark, root, layout) for root, layout in roots]
    found = [s for s in scans if s is not None]
    if not found:
        raise LookupError(f"none of the folders exists: {[root for root, _ in roots]}")
    return quotes.split_ticker_rows(quotes.union_layouts(found, strict=False), "Date", "Price", ["series", "file"])


def sort_quotes(raw: DataFrame) -> clean.Sorted:
    """Raw quotes that can be used, and those set aside: a date that is missing or cannot be read, a price that is there but cannot be."""
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    rules = {
        "no date": blank(F.col("Date")),
        "unread date": parse_day(F.col("Date")).isNull(),
        "unread price": ~blank(F.col("Price")) & parse_number(F.col("Price")).isNull(),
    }
    return clean.sort_out(raw, rules, "quotes")


def silver(raw: DataFrame) -> DataFrame:
    """(series, date, price, open, high, low, id): parsed, the latest file per day, filled, numbered in day order.

    Rows without a readable date are no days; ``sort_quotes`` says which they are.
    """
    typed = clean.typed_quotes(raw, ["series", "file"])
    dated = typed.where(F.col("date").isNotNull())
    daily = clean.latest_per_key(dated, ["series", "date"], file_order(F.col("file"))).drop("file")
    prices = list(clean.QUOTE_COLUMNS[1:])
    placed = daily.withColumn("_t", blocks.day_axis("date")).withColumn("_one", F.lit(1).cast("bigint"))
    scans = {c: ("last", c) for c in prices} | {"id": ("sum", "_one")}
    return blocks.prefix_scan(placed, ["series"], "_t", scans).select("series", "date", *prices, "id")


def failed_series(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Series that arrived but have no price after cleaning."""
    usable = cleaned.where(F.col("price").isNotNull()).select("series").distinct()
    return raw.select("series").distinct().join(usable, "series", "left_anti")


def load(
    spark: SparkSession, roots: Sequence[tuple[str, Sequence[str]]], warehouse: str, columns: Mapping[str, str], name: str
) -> DataFrame:
    """Bronze, rejected, silver and gold as new versions below ``warehouse``, and a read-back check of gold.

    Each layer goes back to its last version if the load fails, also when a series could not be cleaned.
    """
    layers = {layer: VersionedTable(spark, f"{warehouse}/{layer}") for layer in ("bronze", "rejected", "silver", name)}

    def job() -> None:
        layers["bronze"].commit(bronze(spark, roots), "quotes")
        raw = layers["bronze"].read()
        quotes_found = sort_quotes(raw)
        layers["rejected"].commit(quotes_found.rejected, ", ".join(f"{n} {label}" for label, n in quotes_found.counts.items()))
        layers["silver"].commit(silver(quotes_found.kept), "cleaned quotes")
        cleaned = layers["silver"].read()
        failed = [r["series"] for r in failed_series(raw, cleaned).limit(20).collect()]
        if failed:
            raise ValueError(f"no usable price in series {failed}")
        layers[name].commit(gold.wide_table(cleaned, columns), "wide table")

    guarded = job
    for layer in layers.values():
        guarded = _nested(layer, guarded)
    guarded()
    return clean.table_check(layers[name].read(), "date")


def _nested(layer: VersionedTable, job):
    return lambda: layer.guarded(job, "load quotes")


def yearly_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly averages of the wide table, starting from the raw text of the quotes."""
    raw = fixtures.quotes_raw(spark, sf_dir)
    typed = raw.select("series", parse_day(F.col("d")).alias("date"), parse_number(F.col("p")).alias("price"), "arrival")
    daily = typed.groupBy("series", "date").agg(F.max_by("price", "arrival").alias("price"))
    table = gold.wide_table(daily, fixtures.WIDE)
    return table.groupBy("year").agg(*[F.avg(c).alias(f"{c}_avg") for c in fixtures.FEATURES])
