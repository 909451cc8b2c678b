"""Tables and files: namespaces, overwrites, copies, partition overwrites, CSV sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import scratch


#: Fixed value: how Spark names the folder of a null partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as an object of it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = file_system(spark, path)
    return files.exists(hadoop_path)


def folder_bytes(spark: SparkSession, path: str) -> int:
    files, hadoop_path = file_system(spark, path)
    return files.getContentSummary(hadoop_path).getLength()


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}{where}")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """Stored tables of a namespace; temporary views, which belong to none, are left out."""
    shown = spark.sql(f"SHOW TABLES IN {namespace}").where(~F.col("isTemporary"))
    return shown.select("namespace", F.col("tableName").alias("table_name"))


def overwrite_table(df: DataFrame, name: str) -> None:
    """Replace the whole table."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def copy_table(df: DataFrame, name: str, properties: Mapping[str, str] | None = None) -> None:
    """Create a table from a query with table properties; an existing table of that name is an error."""
    writer = df.writeTo(name).using("parquet")
    for key, value in (properties or {}).items():
        writer = writer.tableProperty(key, value)
    writer.create()


def write_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Overwrite exactly the partitions that occur in ``df``.

    Rebalancing gives each partition few files and lets adaptive execution split one that holds most rows.
    """
    spread = df.hint("rebalance", *[F.col(c) for c in by])
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_csv(df: DataFrame, path: str, digits: int | None = None, by: Sequence[str] = (), mode: str = "error") -> None:
    """CSV sink with a header; ``digits`` writes doubles with that many decimals."""
    if digits is not None:
        kinds = dict(df.dtypes)
        df = df.select(
            *[F.format_string(f"%.{digits}f", c).alias(c) if kinds[c] in ("double", "float") else c for c in df.columns]
        )
    df.write.mode(mode).option("header", True).partitionBy(*by).csv(path)


def round_trip(df: DataFrame, name: str, by: Sequence[str] = (), digits: int | None = None) -> str:
    """Write ``df`` as CSV to a new folder of the shared folder and give its path."""
    path = scratch(df.sparkSession, name)
    write_csv(df, path, digits, by)
    return path
