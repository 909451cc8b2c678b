"""Preparation of wide and long series for models: positions, splits, scaling, differences, windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators import blocks

# Fixed value: the random seed of the validation split.
SPLIT_SEED = 42


def with_position(df: DataFrame, day: str, name: str = "t") -> DataFrame:
    """0-based position on a dense calendar (one row per day)."""
    return df.withColumn(name, F.datediff(day, df.agg(F.min(day)).scalar()).cast("bigint"))


def chronological_split(
    df: DataFrame,
    position: str,
    share: float,
    names: tuple[str, str] = ("train", "test"),
    total: Column | None = None,
) -> DataFrame:
    """``fold`` = first name for the first floor(n * share) positions, second name for the rest.

    ``total`` = n where it is cheaper to know than by counting ``df``.
    """
    count = total if total is not None else df.agg(F.count("*")).scalar()
    limit = F.floor(count * F.lit(share))
    return df.withColumn("fold", F.when(F.col(position) < limit, names[0]).otherwise(names[1]))


def chronological_split_by(df: DataFrame, keys: Sequence[str], day: str, share: float) -> DataFrame:
    """The same per key, on dense daily series: the limit comes from the span of each key."""
    spans = df.groupBy(*keys).agg(F.min(day).alias("_first"), F.count("*").alias("_n"))
    placed = blocks.join_per_key(df, spans, keys)
    limit = F.floor(F.col("_n") * F.lit(share))
    fold = F.when(F.datediff(day, "_first") < limit, "train").otherwise("test")
    return placed.withColumn("fold", fold).drop("_first", "_n")


def hash_split(df: DataFrame, key: Column, percent: int, seed: int = SPLIT_SEED) -> DataFrame:
    """``fold`` = validation for about ``percent`` % of the keys; it depends on the key and seed only."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return df.withColumn("fold", F.when(bucket < percent, "validation").otherwise("train"))


def _span(low: Column, high: Column) -> Column:
    return F.when(high == low, F.lit(1.0)).otherwise(high - low)


def scale(value: Column, low: Column, high: Column) -> Column:
    """Min-max scaling to [-1, 1]; a constant series becomes -1."""
    return (value - low) * 2 / _span(low, high) - 1


def unscale(value: Column, low: Column, high: Column) -> Column:
    return (value + 1) / 2 * _span(low, high) + low


def wide_scaler(df: DataFrame, features: Sequence[str], fitted_on: Column) -> Column:
    """Bounds of every feature on the rows it is fitted on, as a one-row subquery of structs."""
    bounds = [F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in features]
    return df.where(fitted_on).agg(F.struct(*bounds)).scalar()


def stored_scaler(scaler: DataFrame, features: Sequence[str], name: str = "variable") -> Column:
    """The same from stored rows (name, low, high), so that later data is scaled as the training days were."""
    bound = lambda c, side: F.max(F.when(F.col(name) == c, F.col(side))).alias(side)
    return scaler.agg(F.struct(*[F.struct(bound(c, "low"), bound(c, "high")).alias(c) for c in features])).scalar()


def scale_wide(df: DataFrame, features: Sequence[str], fitted_on: Column) -> DataFrame:
    bounded = df.withColumn("_bounds", wide_scaler(df, features, fitted_on))
    low, high = (lambda c: F.col(f"_bounds.{c}.low")), (lambda c: F.col(f"_bounds.{c}.high"))
    return bounded.withColumns({c: scale(F.col(c), low(c), high(c)) for c in features}).drop("_bounds")


def series_scaler(df: DataFrame, keys: Sequence[str], value: str, fitted_on: Column) -> DataFrame:
    """One row per key: bounds on the rows it is fitted on. Store it with the model."""
    return df.where(fitted_on).groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high"))


def scale_series(df: DataFrame, scaler: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    joined = blocks.join_per_key(df, scaler, keys)
    return joined.withColumn(out, scale(F.col(value), F.col("low"), F.col("high"))).drop("low", "high")


def unscale_series(df: DataFrame, scaler: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    joined = blocks.join_per_key(df, scaler, keys)
    return joined.withColumn(out, unscale(F.col(value), F.col("low"), F.col("high"))).drop("low", "high")


def difference_wide(
    df: DataFrame, keys: Sequence[str], axis: str, columns: Sequence[str], periods: int, size: int = blocks.BLOCK
) -> DataFrame:
    """``x[t] - x[t - periods]`` per key; rows without a row ``periods`` earlier go. 0 periods is the identity."""
    if periods == 0:
        return df
    earlier = {f"_was_{c}": blocks.back(c, periods) for c in (axis, *columns)}
    shifted = blocks.halo_window(df, keys, axis, periods, earlier, size).where(F.col(f"_was_{axis}").isNotNull())
    return shifted.withColumns({c: F.col(c) - F.col(f"_was_{c}") for c in columns}).select(*df.columns)


def restore_aligned(
    diffs: DataFrame, levels: DataFrame, keys: Sequence[str], axis: str, value: str, out: str, periods: int = 1
) -> DataFrame:
    """``diff[t] + level[t - periods]``."""
    earlier = levels.select(*keys, (F.col(axis) + periods).alias(axis), F.col(value).alias("_level"))
    return diffs.join(earlier, [*keys, axis]).withColumn(out, F.col(value) + F.col("_level")).drop("_level")


def restore_cumulative(
    diffs: DataFrame, start: DataFrame, keys: Sequence[str], axis: str, value: str, out: str, size: int = blocks.BLOCK
) -> DataFrame:
    """Running sum of the differences from the ``level`` that ``start`` holds per key."""
    running = blocks.prefix_scan(diffs, keys, axis, {"_total": ("sum", value)}, size)
    return blocks.join_per_key(running, start, keys).withColumn(out, F.col("level") + F.col("_total")).drop("_total", "level")


def sliding_windows(
    df: DataFrame, keys: Sequence[str], axis: str, features: Sequence[str], length: int, size: int = blocks.BLOCK
) -> DataFrame:
    """One row per target: ``x`` = the ``length`` rows before it (oldest first), ``y`` = the row itself.

    Targets with a gap in the ``length`` positions before them have no window.
    """
    rows = df.withColumn("y", F.array(*[F.col(c).cast("double") for c in features])).drop(*features)
    past = {"x": lambda window: F.collect_list("y").over(window.rangeBetween(-length, -1))}
    return blocks.halo_window(rows, keys, axis, length, past, size).where(F.size("x") == length)
