"""Importance resampling of documents towards a target by hashed word runs, and an exact draw by distributed quickselect.

Counts of a fixed number of buckets are added up over all documents and over the target; each bucket's gain is the logarithm of the ratio
of its smoothed shares, kept as one array, and a document's weight is the sum of the gains of its features. The draw is without
replacement: a fixed Gumbel noise per id is added and the k highest scores win. The k-th key is found by rounds of random pivot keys
with exact counts above, at and below each; only the winners are sorted and ranked, in ranges.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewell.llm import flat, terms
from tidewell.llm.rows import NULL_ID, body, packed
from tidewell.operators.blocks import ranged_sum
from tidewell.session import settle

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
PIVOTS = 16
#: Longer features are hashed one by one, shorter ones place by place together.
LONG = 64


def _crc_table() -> np.ndarray:
    """The 256 steps of the reflected CRC-32 polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


CRC = _crc_table()


def crc32_of(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """CRC-32 of byte runs."""
    crc = np.full(len(starts), 0xFFFFFFFF, dtype=np.uint32)
    sizes = stops - starts
    short = np.flatnonzero(sizes <= LONG)
    short = short[np.argsort(-sizes[short].astype(np.int16), kind="stable")]
    left = np.searchsorted(-sizes[short], -np.arange(LONG + 1), side="left")  # runs with more bytes than a place, longest first
    state, at = crc[short], starts[short]
    for place in range(LONG):
        n = int(left[place])
        if not n:
            break
        own = state[:n]
        state[:n] = CRC[(own ^ data[at[:n] + place]) & np.uint32(0xFF)] ^ (own >> np.uint32(8))
    crc[short] = ~state
    for i in np.flatnonzero(sizes > LONG):
        crc[i] = zlib.crc32(data[starts[i] : stops[i]].tobytes())
    return crc


def _spaced(words: flat.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the words with one space after each, and where each word starts and stops there."""
    sizes = words.stops - words.starts
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    out = np.full(int((sizes + 1).sum()), 0x20, dtype=np.uint8)
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[within + np.repeat(starts, sizes)] = words.data[within + np.repeat(words.starts, sizes)]
    return out, starts, starts + sizes


def features(words: flat.Words, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every run of 1 to ``longest`` words of a row."""
    data, starts, stops = (words.data, words.starts, words.stops) if longest == 1 else _spaced(words)
    rows, found = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    last = words.first[1:][words.row] if len(words) else np.zeros(0, dtype=np.int64)
    for n in range(1, longest + 1):
        at = np.flatnonzero(np.arange(len(words)) + n <= last)
        rows.append(words.row[at])
        found.append((crc32_of(data, starts[at], stops[at + n - 1]) % np.uint32(buckets)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(found)


def _chunked(column: pa.Array, longest: int, buckets: int) -> Iterator[tuple[int, int, flat.Words, np.ndarray, np.ndarray]]:
    data, offsets = flat.bytes_of(column)
    for lo, hi in flat.chunks(offsets):
        words = terms.words_of(terms.TERM_BYTES, data, offsets, lo, hi)
        yield lo, hi, words, *features(words, longest, buckets)


def _counts(longest: int, buckets: int):
    """How many features of a task fall into each bucket."""

    @flat.tidy
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, _, _, bucket in _chunked(batch.column(0), longest, buckets):
                seen += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(some), pa.array(seen[some])], names=["bucket", "n"])

    return of


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over whole texts; a fixed number of sums reaches the driver."""
    seen = np.zeros(buckets, dtype=np.int64)
    texts = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    for row in texts.mapInArrow(_counts(longest, buckets), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        seen[row["bucket"]] = row["n"]
    return seen


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight, in thousandths of a natural logarithm, rounded down."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t))))).astype(np.int64)


def _weighed(gain: np.ndarray, longest: int):
    @flat.tidy
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words, row, bucket in _chunked(batch.column(2), longest, len(gain)):
                weight = np.zeros(hi - lo, dtype=np.int64)
                np.add.at(weight, row, gain[bucket])
                n = np.bincount(row, minlength=hi - lo).astype(np.int64)
                yield pa.record_batch(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(words.counts.astype(np.int64)), pa.array(n), pa.array(weight)],
                    names=["k", "t", "n_words", "n_features", "weight"],
                )

    return of


def scored(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = 1, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(k, t, n_words, n_features, weight, score) of every row of ``docs``; null and empty texts have no features and weight 0.

    The noise depends on the id alone; a null id has that of the empty string and is ordered as the smallest.
    """
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    weighed = packed(docs, key, text).select("k", "t", body(text)).mapInArrow(_weighed(gain, longest), "k bigint, t bigint, n_words bigint, n_features bigint, weight bigint")
    named = F.concat(F.lit(f"{seed}:"), F.when(F.col("k") != NULL_ID, F.col("k").cast("string")).otherwise(""))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")
    return weighed.withColumn("score", F.col("weight") + noise)


def _key() -> Column:
    """Higher is better: score, then smaller id, then the hash of the text, which tells apart rows that share an id."""
    return F.struct(F.col("score"), F.bitwise_not("k").alias("id"), F.col("t"))


def _literal(key: tuple) -> Column:
    return F.struct(*[F.lit(v).cast("bigint").alias(name) for v, name in zip(key, ("score", "id", "t"))])


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS) -> tuple | None:
    """The k-th highest (score, ~id, text hash) of ``rows``, counting equal keys as often as they occur; None if there are fewer.

    Each round takes some of the rows still open as pivots, those whose keys have the smallest hash, which is a random choice that a
    repeated task makes again, and counts exactly how many rows lie above and at each. The k-th key is a pivot or lies between two.
    """
    low = high = None  # open keys lie strictly between
    for attempt in range(1 << 20):
        open_ = rows
        if low is not None:
            open_ = open_.where((F.col("score") >= low[0]) & (_key() > _literal(low)))
        if high is not None:
            open_ = open_.where((F.col("score") <= high[0]) & (_key() < _literal(high)))
        drawn = open_.select(_key().alias("key")).orderBy(F.xxhash64("key", F.lit(attempt)), "key").limit(pivots).collect()
        chosen = sorted({tuple(r["key"]) for r in drawn}, reverse=True)
        if not chosen:
            return None
        counted = [f(_key() > _literal(p) if strict else _key() == _literal(p)) for p in chosen for f, strict in ((F.count_if, True), (F.count_if, False))]
        counts = rows.agg(*[c.alias(f"c{i}") for i, c in enumerate(counted)]).first()
        for place, pivot in enumerate(chosen):
            above, at = counts[2 * place], counts[2 * place + 1]
            if above < k <= above + at:
                return pivot
            if above >= k:  # pivots go down, so the k-th lies above this one and below the one before
                low = pivot
                break
            high = pivot
    raise AssertionError("unreachable: each round takes its pivots out of the open keys")


def draw(rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Every row of written ``scored`` rows with ``rank``: 1, 2, 3 ... for the drawn, null for all others.

    floor(percent * N / 100) rows are drawn of the N with ``least_words`` words: highest scores, ties to smaller ids. Of rows equal in
    id and text, those that still fit are drawn.
    """
    fit = rows.where(F.col("n_words") >= least_words)
    k = fit.count() * percent // 100
    last = kth_key(fit, k) if k else None
    none = F.lit(None).cast("bigint")
    if last is None:
        return rows.withColumn("rank", none)
    won = (F.col("n_words") >= least_words) & (F.col("score") >= last[0]) & (_key() >= _literal(last))
    ordered = rows.where(won).withColumn("down", -F.col("score")).withColumn("one", F.lit(1).cast("bigint")).withColumn("tie", -F.col("t").cast("decimal(20,0)"))
    ranked = ranged_sum(ordered, [], ["down", "k", "tie"], "one").withColumn("rank", F.when(F.col("upto") <= k, F.col("upto")))
    return rows.where(~won).withColumn("rank", none).unionByName(ranked.select(*rows.columns, "rank"))


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", percent: int = PERCENT, least_words: int = LEAST_WORDS, **options) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``, see ``scored`` and ``draw``. An empty table gives no rows; an empty
    target leaves all gains to the smoothing."""
    rows = settle(scored(docs, target, key, **options), "scored")
    doc = F.when(F.col("k") != NULL_ID, F.col("k")).alias(key)
    return draw(rows, percent, least_words).select(doc, "n_features", "weight", "score", "rank")


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn towards the benchmark texts; nulls, ties and repeats as in ``scored`` and ``draw``."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    return resample(docs.select("doc_id", "text"), items.select("text"))


SQL = r"""
WITH steps AS (SELECT list_transform(range(256), lambda i: list_reduce([i::BIGINT] || range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
aims AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
uses AS (SELECT doc_id, w, count(*)::BIGINT AS n FROM (SELECT doc_id, unnest(ws) AS w FROM words) GROUP BY ALL),
known AS (SELECT DISTINCT w, hex(encode(w)) AS x FROM (SELECT w FROM uses UNION ALL SELECT w FROM aims)),
bytes AS (SELECT w, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i::INT + 1, 2))::BIGINT) AS b FROM known),
hashed AS (SELECT w, xor(list_reduce([4294967295::BIGINT] || b, lambda c, x: xor(c >> 8, t[1 + xor(c & 255, x)])), 4294967295) % 10000 AS bucket FROM bytes, steps),
s AS (SELECT bucket, sum(n) AS s FROM uses JOIN hashed USING (w) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM aims JOIN hashed USING (w) GROUP BY 1),
sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS s_all, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS t_all),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket), sums),
weights AS (SELECT doc_id, sum(n * gain)::BIGINT AS weight FROM uses JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY 1),
scores AS (SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
                  + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
           FROM words LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scores)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND r <= 10 * n // 100 THEN r END AS rank FROM ranked
"""
