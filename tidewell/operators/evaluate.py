"""Forecast errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators import blocks


def forecast_errors(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """mse, rmse and mae per variable and the row ``Total`` over variables, from (*by, variable, actual, predicted).

    Total is the mean over variables, and its rmse the root of the mean mse.
    """
    gap = F.col("actual") - F.col("predicted")
    cells = df.groupBy(*by, "variable").agg(F.avg(gap * gap).alias("mse"), F.avg(F.abs(gap)).alias("mae"))
    total = cells.groupBy(*by).agg(F.lit("Total").alias("variable"), F.avg("mse").alias("mse"), F.avg("mae").alias("mae"))
    both = cells.unionByName(total.select(*cells.columns))
    return both.select(*by, "variable", "mse", F.sqrt("mse").alias("rmse"), "mae")


def persistence(df: DataFrame, keys: Sequence[str], axis: str, value: str, size: int = blocks.BLOCK) -> DataFrame:
    """The forecast "as yesterday" on dense series: (keys, actual, predicted)."""
    lagged = blocks.halo_window(df, keys, axis, 1, {"predicted": blocks.back(value, 1)}, size)
    return lagged.where(F.col("predicted").isNotNull()).select(*keys, F.col(value).alias("actual"), "predicted")
