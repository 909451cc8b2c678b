"""Quote and forecast files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.scalars import clean_columns, decoded_path, forecast_file_facets, parse_number, series_from_path
from tidewell.sources.tables import path_exists

# The two layouts a quote file comes in.
VENDOR_LAYOUT = ("Date", "Close", "High", "Low", "Open", "Volume")
HISTORY_LAYOUT = ("Date", "Price", "Open", "High", "Low", "Vol.", "Change %")


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_quote_files(spark: SparkSession, root: str, layout: Sequence[str] = VENDOR_LAYOUT) -> DataFrame | None:
    """All CSV files below ``root`` in one scan, every column text, with ``series`` (the folder) and ``file``.

    One read for all folders: no schema inference and no loop over files. A file whose header is another layout is an
    error. None if the root is missing.
    """
    if not path_exists(spark, root):
        return None
    scan = (
        spark.read.schema(text_schema(layout))
        .option("header", True)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .csv(root)
    )
    path = decoded_path(F.col("_metadata.file_path"))
    cleaned = clean_columns(scan.select("*", series_from_path(path).alias("series"), path.alias("file")))
    return cleaned.withColumnsRenamed({"Close": "Price"})


def split_ticker_rows(df: DataFrame, day: str, code: str, per: Sequence[str]) -> DataFrame:
    """Quotes without the ticker line (no date, the code in every column), with its code as ``ticker``.

    ``per`` names the file. A file has one ticker line, so the codes make one small row per file. An undated line with a number, or
    nothing, where the code would be is a quote and stays.
    """
    undated = F.col(day).isNull() | (F.trim(day) == "")
    is_ticker = F.coalesce(undated & (F.trim(code) != "") & parse_number(F.col(code)).isNull(), F.lit(False))
    codes = df.where(is_ticker).groupBy(*per).agg(F.max(code).alias("ticker"))
    return df.where(~is_ticker).join(codes, list(per), "left")


def union_layouts(parts: Sequence[DataFrame], strict: bool = True) -> DataFrame:
    """Union by column name. Strict: a missing column is an error; otherwise it is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=not strict), parts)


def merge_price_columns(df: DataFrame, names: Sequence[str], out: str = "price") -> DataFrame:
    """One price column from the layouts' own ones, the first that is filled."""
    return df.withColumn(out, F.coalesce(*names)).drop(*[n for n in names if n != out])


def read_forecast_files(spark: SparkSession, root: str, columns: Sequence[str]) -> DataFrame | None:
    """Forecast files below ``root`` as ``columns, date, kind, model, table, run_date``, the last four from the path."""
    if not path_exists(spark, root):
        return None
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in columns] + [T.StructField("date", T.DateType())])
    scan = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .csv(root)
    )
    facets = forecast_file_facets(decoded_path(F.col("_metadata.file_path")))
    return scan.select("*", *[c.alias(n) for n, c in facets.items()])
