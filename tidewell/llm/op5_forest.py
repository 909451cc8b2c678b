"""Approximate nearest neighbours by a forest of random-projection trees.

A tree splits at the median of the projection on the line between two of its points. The splits, and how many leaves a query needs,
come from a bounded sample; every vector is put in one leaf of each tree. A query walks all trees at once: one priority queue holds
the nodes of all of them by the least margin on the way there, and its best leaves become the query's candidates. Their inner
products are then computed exactly, leaf by leaf.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.llm.vectors import best, folded, matrix, prepared, scan
from tidewell.session import settle

#: Vectors that the trees are fitted on, trees, rows of a leaf, recall on the sample that decides the number of leaves.
SAMPLE, TREES, LEAF, RECALL = 8192, 10, 512, 0.95
TRIED = 64


class Forest:
    """Splits of all trees as matrices: directions (tree, node, component) and thresholds (tree, node); nodes in heap order."""

    def __init__(self, sample: np.ndarray, reach: float, trees: int, depth: int, seed: int = 1):
        random = np.random.default_rng(seed)
        self.reach, self.depth, self.trees = reach, depth, trees
        points = self.longer(sample)
        self.lines = np.zeros((trees, (1 << depth) - 1, points.shape[1]))
        self.cuts = np.zeros((trees, (1 << depth) - 1))
        for tree in range(trees):
            member = np.zeros(len(points), dtype=np.int64)
            for node in range((1 << depth) - 1):
                own = np.flatnonzero(member == node)
                line = random.normal(size=points.shape[1])
                if len(own) > 1:
                    a, b = points[random.choice(own, 2, replace=False)]
                    line = a - b if (a != b).any() else line
                line /= np.linalg.norm(line)
                place = points[own] @ line
                cut = float(np.median(place)) if len(own) else 0.0
                self.lines[tree, node], self.cuts[tree, node] = line, cut
                member[own] = 2 * node + 1 + (place > cut)

    def longer(self, vectors: np.ndarray) -> np.ndarray:
        """With one more component that makes all equally long, so that inner products rank as distances do."""
        rest = np.sqrt(np.maximum(self.reach - (vectors**2).sum(axis=1), 0))
        return np.concatenate((vectors, rest[:, None]), axis=1)

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree (vector, tree)."""
        points, out = self.longer(vectors), []
        for tree in range(self.trees):
            node = np.zeros(len(points), dtype=np.int64)
            for _ in range(self.depth):
                right = (points * self.lines[tree, node]).sum(axis=1) > self.cuts[tree, node]
                node = 2 * node + 1 + right
            out.append(node - ((1 << self.depth) - 1))
        return np.stack(out, axis=1)

    def search(self, queries: np.ndarray, visits: int) -> Iterator[list[tuple[int, int]]]:
        """For each query its ``visits`` best leaves (tree, leaf), best first, by one queue over all trees."""
        points = np.concatenate((queries, np.zeros((len(queries), 1))), axis=1)
        inner = (1 << self.depth) - 1
        margins = np.einsum("tnd,qd->qtn", self.lines, points) - self.cuts
        for own in margins.tolist():
            queue = [(-np.inf, tree, 0) for tree in range(self.trees)]
            heapq.heapify(queue)
            found = []
            while queue and len(found) < visits:
                cost, tree, node = heapq.heappop(queue)
                if node >= inner:
                    found.append((tree, node - inner))
                    continue
                margin = own[tree][node]
                heapq.heappush(queue, (max(cost, margin), tree, 2 * node + 1))
                heapq.heappush(queue, (max(cost, -margin), tree, 2 * node + 2))
            yield found

    def visits_for(self, sample: np.ndarray, k: int, recall: float) -> int:
        """The fewest leaves that find ``recall`` of the k neighbours of some sample vectors among the sample."""
        tried = sample[: min(TRIED, len(sample))]
        scores = tried @ sample.T
        scores[np.arange(len(tried)), np.arange(len(tried))] = -np.inf
        k = min(k, len(sample) - 1)
        if k < 1:
            return self.trees
        true = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        leaves = self.leaves(sample)
        total = self.trees << self.depth
        hits = np.zeros(total)
        for neighbours, order in zip(true, self.search(tried, total)):
            rank = np.zeros((self.trees, 1 << self.depth), dtype=np.int64)
            for i, (tree, leaf) in enumerate(order):
                rank[tree, leaf] = i
            first = rank[np.arange(self.trees), leaves[neighbours]].min(axis=1)
            hits += np.bincount(first, minlength=total)
        enough = np.cumsum(hits) >= recall * hits.sum()
        return max(self.trees, int(np.argmax(enough)) + 1)


def _placed(shared):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest: Forest = shared.value
        for batch in batches:
            if batch.num_rows:
                leaves = forest.leaves(matrix(batch.column(0))) + (np.arange(forest.trees) << forest.depth)
                n, trees = leaves.shape
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * trees), pa.array(leaves.ravel()))
                yield pa.record_batch([batch.column(0), batch.column(1), lists], names=["v", "ids", "blocks"])

    return of


def _asked(shared, visits: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest: Forest = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                blocks = [[(tree << forest.depth) + leaf for tree, leaf in own] for own in forest.search(matrix(part.column(1)), visits)]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(blocks, type=pa.list_(pa.int64()))], names=["query", "q", "blocks"])

    return of


def nearest(table: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding", trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found by inner product, ties to smaller ids.

    ``is_query`` is a condition on the column ``id``; a query's own id is no candidate. A query whose leaves hold fewer than k others
    is searched in all leaves. Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null id,
    take no part; an empty table gives no rows.
    """
    rows = settle(prepared(table, key, vector).where(F.exists("v", lambda x: x != 0)), "vectors")
    spark = table.sparkSession
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()["v"]
    if not len(sample):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    points = np.unique(matrix(sample), axis=0)
    points = points[np.random.default_rng(0).permutation(len(points))]
    distinct = settle(folded(rows, k + 1), "distinct")
    n, reach = distinct.agg(F.count(F.lit(1)), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()
    depth = int(np.clip(round(np.log2(max(n / LEAF, 2))), 1, max(1, np.log2(len(points) / 16))))
    forest = Forest(points, reach, trees, depth)
    visits = forest.visits_for(points, k, recall)
    shared = spark.sparkContext.broadcast(forest)
    placed = distinct.mapInArrow(_placed(shared), "v array<double>, ids array<bigint>, blocks array<bigint>")
    index = placed.select(F.explode("blocks").alias("block"), "v", "ids")
    queries = rows.where(is_query).select(F.col("id").alias("query"), F.col("v").alias("q"))
    asked = settle(queries.mapInArrow(_asked(shared, visits), "query bigint, q array<double>, blocks array<bigint>"), "asked")
    first = asked.select(F.explode(F.slice("blocks", 1, trees)).alias("block"), "query", "q", F.lit(float("-inf")).alias("floor"))
    found = settle(scan(index, first, k), "first")
    floors = best(found, k).where(F.col("rank") == k).select("query", F.col("score").alias("floor"))
    known = asked.join(floors, "query", "left")
    every = F.sequence(F.lit(0), F.lit((trees << depth) - 1)).cast("array<bigint>")
    blocks = F.when(F.col("floor").isNull(), every).otherwise(F.slice("blocks", trees + 1, visits))
    rest = known.select(F.explode(blocks).alias("block"), "query", "q", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    return best(found.unionByName(scan(index, rest, k)), k).select(F.col("query").alias("query_id"), "rank", "vec_id", "score")


def op5_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 20 == 0)
