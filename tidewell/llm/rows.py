"""Row keys, so that nulls and repeated ids keep a defined place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

NULL_ID = -(1 << 63)


def id_key(column: str = "doc_id") -> Column:
    """The id as a bigint that is never null: a null id counts as the smallest."""
    return F.coalesce(F.col(f"`{column}`").cast("bigint"), F.lit(NULL_ID))


def text_key(column: str = "text") -> Column:
    """A hash that tells apart rows which share an id but not their text."""
    return F.xxhash64(F.coalesce(F.col(f"`{column}`"), F.lit("")))


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row as (k, t, row): id key, text key, and the whole row as a struct, which has the text once.

    Extra columns travel inside ``row``, so their names never clash with those of an operator.
    """
    return docs.select(id_key(key).alias("k"), text_key(text).alias("t"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def body(text: str = "text") -> Column:
    """The text of a packed row; a null one is empty."""
    return F.coalesce(F.col("row").getField(text), F.lit("")).alias("body")


def row_type(frame: DataFrame) -> str:
    return frame.schema["row"].dataType.simpleString()


def unpacked(frame: DataFrame, schema_of: DataFrame, **results: Column) -> DataFrame:
    """The columns of ``row`` and the results; a result replaces a column of its name."""
    taken = {name.lower() for name in results}
    kept = [F.col("row").getField(c).alias(c) for c in schema_of.columns if c.lower() not in taken]
    return frame.select(*kept, *[value.alias(name) for name, value in results.items()])
