"""Exact top-k by inner product over a pivot-distance index.

One more component makes all vectors equally long, so that the highest inner product is the smallest distance. Each vector is keyed
by its nearest pivot and its distance to it, cut into rings. A query first searches the rings nearest to it, which gives its k-th
score so far; then it asks for every ring that the triangle inequality cannot exclude from holding as high a score, and for no
other. Pivots come from a bounded sample; every vector is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidewell.llm.vectors import best, folded, matrix, prepared, scan
from tidewell.session import settle

#: Vectors that pivots are chosen from, pivots, rings of a pivot, rings searched first.
SAMPLE, PIVOTS, RINGS, FIRST = 2048, 16, 8, 2


def _pivots(sample: np.ndarray, reach: float, n: int) -> np.ndarray:
    """Vectors far from one another, each with its further component."""
    long = _longer(sample, reach)
    chosen = [long[0]]
    far = ((long - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(long)) and far.max() > 0:
        chosen.append(long[far.argmax()])
        far = np.minimum(far, ((long - chosen[-1]) ** 2).sum(axis=1))
    return np.stack(chosen)


def _longer(vectors: np.ndarray, reach: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(reach - (vectors**2).sum(axis=1), 0))
    return np.concatenate((vectors, rest[:, None]), axis=1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a**2).sum(axis=1)[:, None] - 2 * a @ b.T + (b**2).sum(axis=1), 0))


def _keys(pivots: np.ndarray, reach: float):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                far = _distances(_longer(matrix(batch.column(0)), reach), pivots)
                nearest = far.argmin(axis=1)
                columns = [batch.column(0), batch.column(1), pa.array(nearest.astype(np.int32)), pa.array(far[np.arange(len(far)), nearest])]
                yield pa.record_batch(columns, names=["v", "ids", "pivot", "distance"])

    return of


def _queries(pivots: np.ndarray):
    """Each query with its distance to every pivot, its own further component being 0."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                q = matrix(batch.column(1))
                far = _distances(np.concatenate((q, np.zeros((len(q), 1))), axis=1), pivots)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(q) + 1, dtype=np.int32) * far.shape[1]), pa.array(far.ravel()))
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array((q**2).sum(axis=1)), lists], names=["query", "q", "size", "far"])

    return of


def top_k(table: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products of floor(scale * component), ties to smaller ids.

    ``is_query`` is a condition on the column ``id``. A query's own id is no candidate. Vectors that are null, empty or hold null or
    non-finite components, and rows with a null id, take no part; an empty table gives no rows. Scores are exact below 2**53.
    """
    rows = prepared(table, key, vector).select("id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("double")).alias("v"))
    rows = settle(rows, "whole")
    spark = table.sparkSession
    sample = rows.select("v", "id").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()["v"]
    if not len(sample):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    reach = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0]
    pivots = _pivots(matrix(sample), reach, PIVOTS)
    width = f"{(float(np.sqrt(reach)) * 2 + 1) / RINGS / 4!r}"
    index = settle(
        folded(rows, k + 1)
        .mapInArrow(_keys(pivots, reach), "v array<double>, ids array<bigint>, pivot int, distance double")
        .withColumn("ring", F.floor(F.col("distance") / F.expr(width + "D")))
        .withColumn("block", F.concat_ws("/", "pivot", "ring"))
        .select("block", "pivot", "v", "ids", "distance"),
        "index",
    )
    queries = rows.where(is_query).select(F.col("id").alias("query"), F.col("v").alias("q"))
    queries = settle(queries.mapInArrow(_queries(pivots), "query bigint, q array<double>, size double, far array<double>"), "queries")
    rings = index.groupBy("block", "pivot").agg(F.min("distance").alias("low"), F.max("distance").alias("high"))
    # a margin far above rounding keeps the bound on the safe side
    gap = F.greatest(F.lit(0.0), F.col("d") - F.col("high"), F.col("low") - F.col("d")) - 1e-6 * (1 + F.col("d"))
    by_pivot = queries.select("query", "size", F.posexplode("far").alias("pivot", "d"))
    asks = settle(by_pivot.join(rings, "pivot").select("query", "block", ((F.col("size") + reach - F.pow(F.greatest(gap, F.lit(0.0)), 2)) / 2 + 1e-6).alias("most")), "asks")

    nearest = Window.partitionBy("query").orderBy(F.desc("most"), "block")
    first = asks.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= FIRST).select("query", "block")
    vectors = queries.select("query", "q")
    found = settle(scan(index, first.join(vectors, "query").withColumn("floor", F.lit(float("-inf"))), k, whole=True), "first")
    floors = best(found, k).where(F.col("rank") == k).select("query", F.col("score").alias("floor"))
    vectors = vectors.join(floors, "query", "left").select("query", "q", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    rest = asks.join(first, ["query", "block"], "left_anti").join(vectors, "query").where(F.col("most") >= F.col("floor")).select("query", "block", "q", "floor")
    all_found = found.unionByName(scan(index, rest, k, whole=True))
    return best(all_found, k).select(F.col("query").alias("query_id"), "rank", "vec_id", F.col("score").cast("bigint").alias("score"))


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 20 == 0)


SQL = """
WITH good AS (SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
              WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
          FROM good q JOIN good c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 20
"""
