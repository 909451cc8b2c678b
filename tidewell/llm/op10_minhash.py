"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two one-to-one maps of 32-bit numbers stand for the two permutations: the first scrambles a shingle, the second, shifted by one
more step of the circle for each coordinate, gives all coordinates of the signature. Bands of the signature are bucket keys.

Equal sets are one node from the start. In each bucket every node is first paired with the bucket's smallest node; the pairs whose
signatures agree enough are confirmed on the full sets and joined to components. Only buckets that still hold nodes of more than
one component are compared in full, block by block inside tasks, so a large group of copies never becomes all its pairs.

At a similarity of 0.8, the 24 bands of 4 coordinates miss a pair with probability 3e-6; the agreement test (50 of 96) with less
than 1e-9.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.llm import flat
from tidewell.llm.components import components
from tidewell.llm.rows import NULL_ID, body, packed
from tidewell.session import settle

BANDS, ROWS = 24, 4
COORDINATES = BANDS * ROWS
STEP = np.uint32(0x9E3779B1)
AGREE = 50
BLOCK = 512


def _scramble(x: np.ndarray) -> np.ndarray:
    """A one-to-one map of 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def shingle_sets(words: flat.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all rows, row after row and sorted, and how many each row has.

    A row with fewer words than a shingle has its whole sequence as one, a row without words none.
    """
    n, rows = len(words), len(words.counts)
    stop = words.first[1:][words.row] if n else np.zeros(0, dtype=np.int64)
    at = np.arange(n)
    short = words.counts[words.row] < size
    keep = (at + size <= stop) | (short & (at == words.first[:-1][words.row]))
    at = at[keep]
    end = np.minimum(at + size, stop[at])
    hashes = flat.mix(words.runs()(at, end) ^ flat.mix((end - at).astype(np.uint64), 17))
    row = words.row[at]
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[new], np.bincount(row[new], minlength=rows)


def _signatures(size: int):
    @flat.tidy
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words in flat.word_chunks(batch.column(2), fold_case=True):
                hashes, counts = shingle_sets(words, size)
                some = np.flatnonzero(counts)
                starts = (np.cumsum(counts) - counts)[some]
                one, two = np.zeros((2, hi - lo), dtype=np.uint64)
                signature = np.zeros((hi - lo, COORDINATES), dtype=np.uint32)
                if len(some):
                    one[some] = np.add.reduceat(flat.mix(hashes, 19), starts)
                    two[some] = np.add.reduceat(flat.mix(hashes, 23), starts)
                    first = _scramble((hashes >> np.uint64(32)).astype(np.uint32))
                    for i in range(COORDINATES):
                        signature[some, i] = np.minimum.reduceat(_scramble(first + np.uint32((int(STEP) * i) & 0xFFFFFFFF)), starts)
                bands = np.empty((hi - lo, BANDS), dtype=np.uint64)
                for b in range(BANDS):
                    part = flat.mix(np.full(hi - lo, b, dtype=np.uint64), 29)
                    for i in range(b * ROWS, (b + 1) * ROWS):
                        part = flat.mix(part ^ signature[:, i].astype(np.uint64))
                    bands[:, b] = part
                short = np.ascontiguousarray(signature.astype(np.uint16))
                yield pa.record_batch(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(1).slice(lo, hi - lo),
                        pa.array(counts.astype(np.int64)),
                        flat.signed(one),
                        flat.signed(two),
                        pa.array([r.tobytes() for r in short], type=pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * BANDS), flat.signed(bands.ravel())),
                    ],
                    names=["k", "t", "n", "one", "two", "signature", "bands"],
                )

    return of


def _agreement(a: pa.Array, b: pa.Array) -> np.ndarray:
    def table(column: pa.Array) -> np.ndarray:
        return flat.bytes_of(column.cast(pa.large_binary()))[0].view(np.uint16).reshape(-1, COORDINATES)

    return (table(a) == table(b)).sum(axis=1)


@flat.tidy
def _promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, signature a, signature b) whose signatures agree enough."""
    for batch in batches:
        if batch.num_rows:
            keep = pa.array(_agreement(batch.column(2), batch.column(3)) >= AGREE)
            yield batch.select([0, 1]).filter(keep)


def _confirmed(size: int, percent: int):
    """Pairs (a, b, text a, text b) whose full sets are similar enough."""

    @flat.tidy
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            texts, offsets = zip(*(flat.bytes_of(batch.column(i)) for i in (2, 3)))
            for lo, hi in flat.chunks(offsets[0] + offsets[1], 2 * flat.CHUNK_BYTES):
                hashes, counts = [], []
                for data, at in zip(texts, offsets):
                    h, c = shingle_sets(flat.Words(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], fold_case=True), size)
                    hashes.append(h)
                    counts.append(c)
                row = np.concatenate([np.repeat(np.arange(hi - lo), c) for c in counts])
                both = np.concatenate(hashes)
                order = np.lexsort((both, row))
                both, row = both[order], row[order]
                shared = np.bincount(row[1:][(both[1:] == both[:-1]) & (row[1:] == row[:-1])], minlength=hi - lo)
                keep[lo:hi] = 100 * shared >= percent * (counts[0] + counts[1] - shared)
            yield batch.select([0, 1]).filter(pa.array(keep))

    return of


def _across(size: int, percent: int):
    """Links within a block of a bucket between different components, confirmed on the full sets.

    Rows that a link has joined are not compared again, so a block gives fewer links than it has rows.
    """

    def of(table: pa.Table) -> pa.Table:
        side, n = table["side"].to_numpy(), table["n"].to_numpy()
        rep, label = table["rep"].to_numpy(), table["component"].to_numpy().copy()
        signatures = np.stack([np.frombuffer(x, dtype=np.uint16) for x in table["signature"].to_pylist()])
        sets: dict[int, np.ndarray] = {}
        bodies = table["body"]

        def shingles(row: int) -> np.ndarray:
            if row not in sets:
                data, offsets = flat.bytes_of(bodies.slice(row, 1))
                sets[row] = shingle_sets(flat.Words(data, offsets, fold_case=True), size)[0]
            return sets[row]

        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1)
        alone = not len(right)  # a block with itself
        made = []
        for place, i in enumerate(left):
            others = left[place + 1 :] if alone else right
            others = others[(label[others] != label[i]) & (100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i]))]
            others = others[(signatures[others] == signatures[i]).sum(axis=1) >= AGREE]
            for j in others.tolist():
                if label[i] == label[j]:
                    continue
                shared = len(np.intersect1d(shingles(i), shingles(j), assume_unique=True))
                if 100 * shared >= percent * (n[i] + n[j] - shared):
                    made.append((rep[i], rep[j]))
                    label[label == label[j]] = label[i]
        return pa.table({"a": pa.array([x for x, _ in made], type=pa.int64()), "b": pa.array([y for _, y in made], type=pa.int64())})

    return of


def _links(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    a = texts.select(F.col("rep").alias("a"), F.col("body").alias("body_a"))
    b = texts.select(F.col("rep").alias("b"), F.col("body").alias("body_b"))
    return settle(pairs.join(a, "a").join(b, "b").select("a", "b", "body_a", "body_b").mapInArrow(_confirmed(size, percent), "a bigint, b bigint"), "confirmed")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, percent: int = 80) -> DataFrame:
    """(k, t, n_shingles, component) for every row: shingles of its set and the smallest id linked to it, directly or by a chain.

    Two documents are linked if 100 * intersection >= percent * union of their sets of ``size``-word shingles, A-Z in lower case.
    A shorter text has its whole sequence as one shingle; null and empty texts have none and are linked with nothing. ``k`` is the
    id, a null one counting as the smallest; rows that share an id are one node. ``t`` tells apart rows that share an id.
    """
    source = packed(docs, key, text)
    texts = source.select("k", "t", body(text))
    schema = "k bigint, t bigint, n bigint, one bigint, two bigint, signature binary, bands array<bigint>"
    signed = settle(texts.mapInArrow(_signatures(size), schema), "signatures")
    sets = settle(
        signed.where("n > 0")
        .groupBy("one", "two")
        .agg(F.min(F.struct("k", "t")).alias("least"), *[F.first(c).alias(c) for c in ("n", "signature", "bands")])
        .select(F.col("least.k").alias("rep"), F.col("least.t").alias("rep_t"), "one", "two", "n", "signature", "bands"),
        "sets",
    )
    buckets = sets.select("rep", "n", F.explode(F.array_distinct("bands")).alias("bucket"))
    hubs = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.min("rep").alias("hub")).where("members > 1")
    shared = settle(buckets.join(hubs, "bucket").select("bucket", "rep", "n", "hub", "members"), "buckets")

    star = shared.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    facts = sets.select("rep", "n", "signature")
    star = (
        star.join(facts.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("sig_b")), "b")
        .join(facts.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("sig_a")), "a")
        .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        .select("a", "b", "sig_a", "sig_b")
        .mapInArrow(_promising, "a bigint, b bigint")
    )
    members = shared.select("rep").distinct()
    holders = sets.join(members, "rep", "left_semi").select("rep", F.col("rep").alias("k"), F.col("rep_t").alias("t"))
    bodies = settle(texts.join(holders, ["k", "t"]).dropDuplicates(["rep", "t"]).select("rep", "body"), "bodies")
    links = _links(star, bodies, size, percent)

    labels = components(links)
    owned = shared.join(labels, shared["rep"] == labels["node"], "left").select("bucket", "rep", "n", "members", F.coalesce("component", "rep").alias("component"))
    mixed = owned.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("bucket")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    rows = owned.join(mixed, "bucket").join(facts.select("rep", "signature"), "rep").join(bodies, "rep").withColumn("blocks", blocks).withColumn("mine", mine)
    dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket", "rep", "n", "component", "signature", "body", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).alias("side")
    )
    more = dealt.groupBy("bucket", "i", "j").applyInArrow(_across(size, percent), "a bigint, b bigint")
    links = links.unionByName(settle(more.distinct(), "across"))
    # rows that share an id are one node
    twins = sets.select("one", "two", "rep").join(signed.select("k", "one", "two"), ["one", "two"]).groupBy("k").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("a", "b")
    labels = components(links.unionByName(twins))

    placed = sets.join(labels, sets["rep"] == labels["node"], "left").select("one", "two", F.coalesce("component", "rep").alias("component"))
    return signed.select("k", "t", "one", "two", F.col("n").alias("n_shingles")).join(placed, ["one", "two"], "left").select("k", "t", "n_shingles", F.coalesce("component", "k").alias("component"))


def _id(column: str):
    return F.when(F.col(column) != NULL_ID, F.col(column))


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component; of rows with equal id and text, all stay."""
    found = near_duplicates(docs, key, text, **options).where("k <> component").select("k", "t").distinct()
    return packed(docs, key, text).join(found, ["k", "t"], "left_anti").select("row.*")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select(_id("k").alias("doc_id"), "n_shingles", _id("component").alias("component_id"), (F.col("k") == F.col("component")).alias("kept"))


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 80 * (x.n + y.n - m)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS seen FROM documents UNION SELECT r.doc_id, b FROM reach r JOIN ways ON r.seen = a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.c AS component_id, d.doc_id = c.c AS kept
FROM documents d JOIN (SELECT doc_id, min(seen) AS c FROM reach GROUP BY 1) c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
