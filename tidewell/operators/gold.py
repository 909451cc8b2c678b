"""Gold tables: wide assembly, as-of, yearly averages, paired models, metrics side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.scalars import calendar_columns
from tidewell.operators import blocks, clean


def spread(
    df: DataFrame, keys: Sequence[str], names: str, values: Sequence[str], columns: Mapping[str, Mapping[str, str]]
) -> DataFrame:
    """Long to wide with one shuffle: ``columns[name][value]`` is the output column. Unlisted names are left out."""
    cells = [
        F.max(F.when(F.col(names) == name, F.col(value))).alias(columns[name][value])
        for name in columns
        for value in values
    ]
    return df.where(F.col(names).isin(list(columns))).groupBy(*keys).agg(*cells)


def wide_table(px: DataFrame, columns: Mapping[str, str], size: int = blocks.BLOCK) -> DataFrame:
    """Daily wide table ``date, one price per series, year, month, id``.

    It starts on the day every series has a value and ends on the last day of any; prices are carried forward.
    """
    spans = px.where(F.col("series").isin(list(columns))).groupBy("series").agg(
        F.min("date").alias("first"), F.max("date").alias("last")
    )
    bounds = spans.agg(F.struct(F.max("first").alias("start"), F.max("last").alias("end"))).scalar()
    listed = {name: {"price": out} for name, out in columns.items()}
    kept = px.where(F.col("series").isin(list(columns)))
    dense = clean.densify(kept, ["series"], "date", ["price"], end=bounds["end"], size=size)
    table = spread(dense, ["date"], "series", ["price"], listed).withColumn("_start", bounds["start"])
    from_start = table.where(F.col("date") >= F.col("_start"))
    numbered = from_start.withColumn("id", F.datediff("date", "_start").cast("bigint") + 1)
    return calendar_columns(numbered.drop("_start"))


def left_out(px: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """(series, reason, n_rows): rows that ``wide_table`` has no day or no column for, and why."""
    listed = F.col("series").isin(list(columns))
    start = px.where(listed).groupBy("series").agg(F.min("date").alias("first")).agg(F.max("first")).scalar()
    reason = F.when(~F.coalesce(listed, F.lit(False)), "unlisted").when(F.col("date").isNull(), "undated").when(F.col("date") < start, "early")
    found = px.select("series", reason.alias("reason")).where("reason is not null")
    return found.groupBy("series", "reason").agg(F.count("*").alias("n_rows"))


def as_of(
    left: DataFrame, right: DataFrame, keys: Sequence[str], axis: str, columns: Sequence[str], size: int = blocks.BLOCK
) -> DataFrame:
    """Each left row with the right ``columns`` of the greatest right axis value not after its own.

    Both sides go into one ordered stream per key; a right row comes before the left rows of its own position.
    (keys, axis) is unique within each side; a left row without an earlier right row gets nulls.
    """
    carried = F.struct(*columns)
    order = "_order"
    extra = [c for c in left.columns if c not in (*keys, axis)]
    lefts = left.select(
        *keys, axis, F.struct(*(extra or [F.lit(1).alias("_")])).alias("_left"), F.lit(None).alias("_right"),
        (F.col(axis).cast("bigint") * 2 + 1).alias(order),
    )
    rights = right.select(
        *keys, axis, F.lit(None).alias("_left"), carried.alias("_right"), (F.col(axis).cast("bigint") * 2).alias(order)
    )
    filled = blocks.prefix_scan(lefts.unionByName(rights), keys, order, {"_right": ("last", "_right")}, size)
    picked = [F.col(f"_right.{c}").alias(c) for c in columns]
    return filled.where(F.col("_left").isNotNull()).select(*keys, axis, *[F.col(f"_left.{c}") for c in extra], *picked)


def yearly_averages(df: DataFrame, keys: Sequence[str], day: str, columns: Sequence[str]) -> DataFrame:
    yearly = df.groupBy(*keys, F.year(day).cast("bigint").alias("year"))
    return yearly.agg(*[F.avg(c).alias(f"{c}_avg") for c in columns])


def suffixed(df: DataFrame, suffix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c in keep else f"{c}_{suffix}") for c in df.columns])


def day_id(day: str) -> Column:
    """Id of a daily row: days since 1970. The same in every run and batch, and it never collides between batches."""
    return F.unix_date(day).cast("bigint")


def pair_models(first: DataFrame, second: DataFrame, suffixes: tuple[str, str], key: str = "date") -> DataFrame:
    """Two wide forecasts side by side on the days both have."""
    both = suffixed(first, suffixes[0], [key]).join(suffixed(second, suffixes[1], [key]), key, "inner")
    return both.withColumn("id", day_id(key))


def pair_long(df: DataFrame, columns: Mapping[str, str], models: Sequence[str], value: str = "predicted") -> DataFrame:
    """The same from long rows (model, variable, date, value): one shuffle whatever the number of models.

    ``columns`` names the output of each variable, which the model's name follows.
    """
    cell = lambda m, v: F.max(F.when((F.col("model") == m) & (F.col("variable") == v), F.col(value)))
    cells = [cell(m, v).alias(f"{out}_{m}") for m in models for v, out in columns.items()]
    present = [F.count_if(F.col("model") == m).alias(f"_n_{m}") for m in models]
    rows = df.where(F.col("model").isin(list(models)) & F.col("variable").isin(list(columns)))
    wide = rows.groupBy("date").agg(*cells, *present)
    for m in models:
        wide = wide.where(F.col(f"_n_{m}") > 0).drop(f"_n_{m}")
    return wide.withColumn("id", day_id("date"))


def batch_bounds(df: DataFrame, day: str = "date") -> DataFrame:
    return df.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def metrics_side_by_side(metrics: DataFrame, suffixes: Mapping[str, str]) -> DataFrame:
    """One row per variable with the mse, rmse and mae of every model, named by ``suffixes[model]``."""
    names = {model: {m: f"{m}_{suffix}" for m in ("mse", "rmse", "mae")} for model, suffix in suffixes.items()}
    return spread(metrics, ["variable"], "model", ["mse", "rmse", "mae"], names)


def in_range(day: str, low: Column, high: Column) -> Column:
    return F.col(day).between(low, high)
