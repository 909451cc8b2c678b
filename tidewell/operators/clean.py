"""Cleaning: duplicates, daily bars, fills, dense calendars, ids, profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidewell.functions.scalars import parse_day, parse_number
from tidewell.operators import blocks
from tidewell.session import settle

# The columns of a cleaned quote and the ones that hold no feature.
QUOTE_COLUMNS = ("date", "price", "open", "high", "low")
NON_FEATURES = ("id", "date", "year", "month")


def typed_quotes(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Text quotes to the fixed projection: date parsed, prices parsed, everything else but ``keep`` dropped."""
    day, *prices = QUOTE_COLUMNS
    return df.select(*keep, parse_day(F.col(day)).alias(day), *[parse_number(F.col(c)).alias(c) for c in prices])


@dataclass
class Sorted:
    """Rows that pass all rules, rows that fail one with its name as ``reason``, and counts: ``read``, ``kept``, and one per rule."""

    kept: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def sort_out(df: DataFrame, rules: Mapping[str, Column], name: str = "sorted") -> Sorted:
    """Rows that fail a rule are set aside with the first rule they fail, in one pass that also counts them.

    A rule is true for a row to reject; null is no rejection. Kept and rejected rows add up to the rows read.
    """
    reason = F.coalesce(*[F.when(rule, F.lit(label)) for label, rule in rules.items()])
    counted = Observation()
    counts = [F.count(F.lit(1)).alias("read"), F.count_if(F.col("reason").isNull()).alias("kept")]
    counts += [F.count_if(F.col("reason") == label).alias(label) for label in rules]
    both = settle(df.withColumn("reason", reason).observe(counted, *counts), name)
    return Sorted(both.where("reason is null").drop("reason"), both.where("reason is not null"), dict(counted.get))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str | Column) -> DataFrame:
    """One whole row per key, the one with the greatest ``order``; partial maxima are combined before the shuffle.

    A null order is the smallest, so a key without any order value still keeps one of its rows.
    """
    order = F.col(order) if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def daily_bars(df: DataFrame, keys: Sequence[str], day: str, value: str, arrival: str) -> DataFrame:
    """Last, first, highest and lowest value per key and day, in arrival order."""
    return df.groupBy(*keys, day).agg(
        F.max_by(value, arrival).alias("price"),
        F.min_by(value, arrival).alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
    )


def densify(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    columns: Sequence[str],
    mode: str = "per_column",
    end: Column | None = None,
    size: int = blocks.BLOCK,
    step: str = "day",
) -> DataFrame:
    """One row per key and calendar day (or hour, by ``step``) from the first to the last (or ``end``), holding the values known by then.

    ``per_column`` carries the last non-null value of each column; ``whole_row`` repeats the last row, nulls included.
    Each row spreads itself over the days until the next one, so no calendar is built or joined. (keys, day) is unique.
    """
    if mode not in ("per_column", "whole_row"):
        raise ValueError(f"unknown mode {mode}")
    axis = {"day": blocks.day_axis, "hour": blocks.hour_axis}[step](day)
    placed = df.select(*keys, day, *columns).withColumn("_t", axis)
    scans = {"_next": ("next", "_t")}
    if mode == "per_column":
        scans.update({c: ("last", c) for c in columns})
    placed = blocks.prefix_scan(placed, keys, "_t", scans, size)
    if step == "day":
        last = F.coalesce(F.col("_next") - 1, F.unix_date(end) if end is not None else F.col("_t"))
        days = F.explode(F.sequence(F.col("_t").cast("int"), F.greatest(last, "_t").cast("int"))).alias("_day")
        return placed.select(*keys, days, *columns).select(*keys, F.date_from_unix_date("_day").alias(day), *columns)
    until = F.col(day) + F.make_dt_interval(hours=(F.col("_next") - F.col("_t") - 1).cast("int"))
    stop = F.greatest(F.coalesce(until, end if end is not None else F.col(day)), F.col(day))
    hours = F.explode(F.sequence(F.col(day), stop, F.expr("INTERVAL 1 HOUR"))).alias(day)
    return placed.select(*keys, hours, *columns)


def with_row_id(
    df: DataFrame, keys: Sequence[str], day: str, name: str = "id", size: int = blocks.BLOCK, levels: int = 1
) -> DataFrame:
    """1-based id per key in day order; the same rows always get the same ids. (keys, day) is unique."""
    placed = df.withColumn("_t", blocks.day_axis(day))
    return blocks.row_index(placed, keys, "_t", name, size, levels).drop("_t")


def with_global_id(
    df: DataFrame, keys: Sequence[str], day: str, name: str = "id", size: int = blocks.BLOCK, levels: int = 1
) -> DataFrame:
    """1-based id over the whole table in (keys, day) order, the same in every run.

    It is the id within the key plus the number of rows of earlier keys, which needs one counted row per key only.
    """
    numbered = with_row_id(df, keys, day, name, size, levels)
    counts = blocks.ranged_sum(df.groupBy(*keys).agg(F.count("*").alias("_n")), [], keys, "_n")
    offsets = counts.select(*keys, (F.col("upto") - F.col("_n")).alias("_offset"))
    return blocks.join_per_key(numbered, offsets, keys).withColumn(name, F.col(name) + F.col("_offset")).drop("_offset")


def with_name_id(df: DataFrame, name: str, out: str = "id") -> DataFrame:
    """1-based id in name order for a table with one row per variable (a handful of rows, at most the column count)."""
    return df.withColumn(out, F.row_number().over(Window.orderBy(name)).cast("bigint"))


def feature_columns(df: DataFrame) -> DataFrame:
    return df.drop(*NON_FEATURES)


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(variable, probability, value) with linear interpolation between neighbours, without gathering a column.

    Equal values are counted first, and ranks are running counts over the distinct ones.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in columns])
    counted = (
        df.select(F.inline(pairs)).where(F.col("value").isNotNull()).groupBy("variable", "value").agg(F.count("*").alias("n"))
    )
    ranked = blocks.ranged_sum(counted, ["variable"], ["value"], "n")
    wanted = ranked.withColumn("probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
    place = F.col("probability") * (F.col("total") - 1)
    low, high = F.floor(place), F.ceil(place)
    holds = lambda rank: (rank >= F.col("upto") - F.col("n")) & (rank < F.col("upto"))
    weight = F.when(holds(low), F.lit(1.0) - (place - low)).otherwise(F.lit(0.0)) + F.when(
        holds(high), place - low
    ).otherwise(F.lit(0.0))
    return (
        wanted.where(holds(low) | holds(high))
        .groupBy("variable", "probability")
        .agg(F.sum(F.col("value") * weight).alias("value"))
    )


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: count, mean, sample deviation, min, quartiles, max."""
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in columns])
    moments = (
        df.select(F.inline(pairs))
        .groupBy("variable")
        .agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    quantiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    at = lambda p: F.max(F.when(F.col("probability") == p, F.col("value")))
    quartiles = quantiles.groupBy("variable").agg(at(0.25).alias("q25"), at(0.5).alias("q50"), at(0.75).alias("q75"))
    return moments.join(quartiles, "variable", "left")


def table_check(df: DataFrame, key: str) -> DataFrame:
    """Read-back check in one pass: rows, columns, key bounds, nulls per column."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns]
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.min(key).alias("min_key"),
        F.max(key).alias("max_key"),
        *nulls,
    )
