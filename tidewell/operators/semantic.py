"""Cubes and views over gold tables, and previews of SQL results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Cube:
    """Names a table exposes: dimensions (name -> column), one time dimension, the key behind the measure ``count``."""

    name: str
    dimensions: Mapping[str, str]
    time: str | None = None
    key: str = "id"


# The series of each gold table.
GOLD_SERIES = {
    "indices": ("gold", "russell2000", "dow_jones", "msci_world", "nasdaq100", "s_p500"),
    "macro": ("gold", "oil", "us_dollar", "usd_vnd", "cpi", "inflation_rate", "interest_rate"),
    "usbonds": ("gold", "us_2_year_bond", "us_3_month_bond", "us_5_year_bond", "us_10_year_bond"),
}
METRICS = ("mse", "rmse", "mae")


def gold_cubes() -> dict[str, Cube]:
    """The twelve cubes: each gold table, its paired predictions and forecasts, and its metrics."""
    cubes = {}
    for name, series in GOLD_SERIES.items():
        paired = [f"{s}_{model}" for s in series for model in ("srvar", "varnn")]
        metrics = [f"{m}_{model}" for model in ("srvar", "var") for m in METRICS]
        for cube, columns, time in (
            (name, series, "date"),
            (f"{name}_predict", paired, "date"),
            (f"{name}_future", paired, "date"),
            (f"{name}_eval", ("variable", *metrics), None),
        ):
            cubes[cube] = Cube(cube, {c: c for c in ("id", *columns)}, time)
    return cubes


def cube_query(
    df: DataFrame,
    cube: Cube,
    dimensions: Sequence[str] = (),
    granularity: str | None = None,
    time_range: tuple[str, str] | None = None,
) -> DataFrame:
    """Measure ``count`` by dimensions and, with a granularity (day, week, month, quarter, year), by time."""
    unknown = [d for d in dimensions if d not in cube.dimensions]
    if unknown:
        raise ValueError(f"{cube.name} has no dimension {unknown}")
    if time_range:
        df = df.where(F.col(cube.time).between(*[F.to_date(F.lit(t)) for t in time_range]))
    by = [F.col(cube.dimensions[d]).alias(d) for d in dimensions]
    if granularity:
        by.append(F.date_trunc(granularity, cube.time).cast("date").alias(cube.time))
    return df.groupBy(*by).agg(F.count("*").alias("count"))


@dataclass(frozen=True)
class CubeView:
    """A subset of a cube's columns, prefixed with the cube's name if ``prefix``."""

    cube: Cube
    includes: Sequence[str] = field(default_factory=tuple)
    prefix: bool = False


def view_query(df: DataFrame, views: Sequence[CubeView]) -> DataFrame:
    """The exposed columns of each view's cube, all from one table or join."""
    columns = [
        F.col(v.cube.dimensions.get(name, name)).alias(f"{v.cube.name}_{name}" if v.prefix else name)
        for v in views
        for name in v.includes
    ]
    return df.select(*columns)


def preview(spark: SparkSession, statement: str, limit: int = 100, name: str | None = None) -> DataFrame:
    """First ``limit`` rows of a query, as (column, value) pairs when the limit is one; ``name`` keeps it as a view."""
    result = spark.sql(statement)
    if name:
        result.createOrReplaceTempView(name)
    return transposed(result) if limit == 1 else result.limit(limit)


def transposed(df: DataFrame) -> DataFrame:
    """One row as (column, value), values as text."""
    texts = df.limit(1).select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    return texts.unpivot([], df.columns, "column", "value")
