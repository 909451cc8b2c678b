"""Vectors as columns and as keys, and the scan of blocks of vectors by the queries that ask for them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK = 4096
FOUND = "query bigint, vec_id bigint, score double"


def matrix(column: pa.Array | pa.ChunkedArray, kind=np.float64) -> np.ndarray:
    """A list column whose lists have one length, as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0), dtype=kind)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))


def prepared(table: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): usable vectors with an id, in double precision; repeated rows count once.

    Where vectors differ in length, those of the most common length (of equally common ones the longest) take part.
    """
    rows = table.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    width = rows.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("width")).limit(1).collect()
    return rows.where(F.size("v") == (width[0]["width"] if width else 0)).distinct()


def folded(rows: DataFrame, most: int) -> DataFrame:
    """(v, ids): one row for each distinct vector with its ``most`` smallest ids.

    A search for k neighbours returns at most k of equal vectors, those of the smallest ids, and leaves out the query itself, so
    ``most`` = k + 1 keeps every possible answer. Each task thins out its own copies before they are shuffled.
    """
    ranked = rows.withColumn("place", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("place") <= most)
    return ranked.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def _in_order(a: np.ndarray, b: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Inner products of some pairs of rows, added up component by component: the same for a pair whatever else is asked for."""
    total = np.zeros(len(row))
    for left, right in zip(np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)):
        total += left[row] * right[column]
    return total


def _best(k: int, whole: bool):
    def of(key: tuple, rows: pa.Table, asks: pa.Table) -> pa.Table:
        names, made = ["query", "vec_id", "score"], []
        if rows.num_rows and asks.num_rows:
            have, ids = matrix(rows["v"]), rows["ids"].combine_chunks()
            starts, values = np.asarray(ids.offsets, dtype=np.int64), ids.values.to_numpy(zero_copy_only=False)
            counts = np.diff(starts)
            queries, floors = asks["query"].to_numpy(), asks["floor"].to_numpy()
            wanted = matrix(asks["q"])
            exact = whole and np.abs(have).max() * np.abs(wanted).max() * have.shape[1] >= 2.0**53
            # far above what the order of a sum can change
            slack = 0.0 if whole else 2.0**-50 * have.shape[1] * np.sqrt((have**2).sum(axis=1).max())
            for lo in range(0, len(queries), 256):
                part = wanted[lo : lo + 256]
                if exact:  # whole numbers too large for doubles
                    scores = (part.astype(object) @ have.T.astype(object)).astype(np.float64)
                else:
                    scores = part @ have.T
                floor = floors[lo : lo + 256]
                least = floor[:, None]
                if scores.shape[1] > k + 1:
                    least = np.maximum(least, np.partition(scores, -(k + 1), axis=1)[:, [-(k + 1)]])
                row, column = np.nonzero(scores >= least - slack * np.sqrt((part**2).sum(axis=1))[:, None])
                score = scores[row, column] if whole else _in_order(part, have, row, column)
                enough = score >= floor[row]
                row, column, score = row[enough], column[enough], score[enough]
                n = counts[column]
                at = np.repeat(starts[column] - np.cumsum(n) + n, n) + np.arange(n.sum())
                query, vec = np.repeat(queries[lo + row], n), values[at]
                score, other = np.repeat(score, n), vec != query
                made.append(pa.table([pa.array(query[other]), pa.array(vec[other]), pa.array(score[other])], names=names))
        empty = pa.table([pa.array([], type=t) for t in (pa.int64(), pa.int64(), pa.float64())], names=names)
        return pa.concat_tables([empty, *made])

    return of


def scan(rows: DataFrame, asks: DataFrame, k: int, whole: bool = False) -> DataFrame:
    """(query, vec_id, score): the best k of each block (block, v, ids) for each query that asks for it (block, query, q, floor).

    All ties of the k-th, and nothing below ``floor``. Large blocks and large groups of queries are cut, so that no task holds more
    than about ``BLOCK`` of either; ``asks`` needs the queries of a block in no order. A pair has the same score in every block;
    ``whole`` says that all components are whole numbers, whose sums are exact in any order.
    """
    sizes = rows.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("cells"))
    askers = asks.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    cuts = sizes.join(askers, "block")
    left = rows.join(cuts, "block").withColumn("cell", F.pmod(F.xxhash64("v"), "cells").cast("int"))
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("block", "cell", "part", "v", "ids")
    right = asks.join(cuts, "block").withColumn("part", F.pmod(F.xxhash64("query"), "parts").cast("int"))
    right = right.withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))).select("block", "cell", "part", "query", "q", "floor")
    keys = ("block", "cell", "part")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_best(k, whole), FOUND)


def best(found: DataFrame, k: int) -> DataFrame:
    """(query, rank, vec_id, score): the k highest scores of each query, ties to smaller ids."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "rank", "vec_id", "score")
