"""Forecast files of two models into one gold table, and their metrics side by side."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import clean, gold, training, upsert
from tidewell.plans.forecasting import Forecast
from tidewell.sources import quotes, tables

# Folder and column suffix of each model, suffixes in the metrics table, and decimals of the files.
MODELS = {"SrVAR": "srvar", "VARNN": "varnn"}
METRIC_SUFFIXES = {"srvar": "srvar", "varnn": "var"}
DIGITS = 5


def write_forecast(df: DataFrame, root: str, kind: str, folder: str, table: str, run_date: date) -> str:
    """A wide forecast with ``date`` as ``{root}/{kind}/{folder}/{table}_{kind}_{dd_MM_yyyy}.csv``."""
    path = f"{root}/{kind}/{folder}/{table}_{kind}_{run_date:%d_%m_%Y}.csv"
    tables.write_csv(df, path, DIGITS, mode="overwrite")
    return path


def write_run(result: Forecast, features: Sequence[str], root: str, folder: str, table: str, run_date: date) -> None:
    """What a run made, below ``root``: predictions, forecast and errors as CSV, parameters and scaler as Parquet."""
    columns = {c: {"value": c} for c in features}
    for kind, rows in (("predict", result.predicted.withColumnRenamed("predicted", "value")), ("future", result.future)):
        wide = gold.spread(rows, ["date"], "variable", ["value"], columns)
        write_forecast(wide.select(*features, "date"), root, kind, folder, table, run_date)
    errors = result.errors.where(F.col("scale") == "original").drop("scale")
    tables.write_csv(errors, f"{root}/evaluation/{folder}_{table}_metrics.csv", mode="overwrite")
    spark = result.errors.sparkSession
    training.save_params(training.params_frame(spark, result.fitted, table, run_date), f"{root}/model/{folder}/params")
    dated = result.scaler.withColumn("domain", F.lit(table)).withColumn("run_date", F.lit(run_date))
    tables.write_partitions(dated, f"{root}/model/{folder}/scaler", ["domain", "run_date"])


def publish_forecasts(
    spark: SparkSession, root: str, warehouse: str, table: str, kind: str, features: Sequence[str], run_date: date
) -> DataFrame | None:
    """Pair the day's files of both models, upsert them into ``{table}_{kind}``, and check what is stored.

    None, and nothing is changed, if a model has no file for the day.
    """
    files = quotes.read_forecast_files(spark, f"{root}/{kind}", features)
    if files is None:
        return None
    mine = files.where((F.col("table") == table) & (F.col("kind") == kind) & (F.col("run_date") == F.lit(run_date)))
    if mine.select("model").distinct().count() < len(MODELS):
        return None
    parts = [mine.where(F.col("model") == m).select(*features, "date") for m in MODELS.values()]
    paired = gold.pair_models(parts[0], parts[1], tuple(MODELS.values()))
    target = f"{warehouse}/{table}_{kind}"
    upsert.publish(paired, target, ["date"], "range_replace")
    return clean.table_check(upsert.read(spark, target), "date")


def read_metrics(spark: SparkSession, root: str, table: str) -> DataFrame:
    """(model, variable, mse, rmse, mae) of both models for a table."""
    schema = "variable string, mse double, rmse double, mae double"
    parts = [
        spark.read.schema(schema).option("header", True).csv(f"{root}/evaluation/{folder}_{table}_metrics.csv")
        .withColumn("model", F.lit(model))
        for folder, model in MODELS.items()
    ]
    return quotes.union_layouts(parts)


def publish_metrics(metrics: DataFrame, target: str) -> None:
    """(model, variable, mse, rmse, mae) as one row per variable with both models' metrics and an id."""
    paired = gold.metrics_side_by_side(metrics, METRIC_SUFFIXES)
    numbered = clean.with_name_id(paired, "variable")
    numbered.write.mode("overwrite").parquet(target)
