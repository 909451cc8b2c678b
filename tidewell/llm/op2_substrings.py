"""Substring deduplication over a sparse De Bruijn graph of token k-mers.

Edges of the graph are k-mers of ``edge`` words, and of each window of ``window`` words only the k-mer with the smallest hash is an
edge (its minimizer): equal windows have the same edge at the same place, so a window can repeat only if its edge does. The windows
that share an edge occurrence form its stretch. An edge is nonbranching when all its occurrences lie in equal stretches; then one
decision holds for the whole stretch, and neighbouring stretches of a document compact into one span. Where an edge branches, equal
stretches are still decided as one, and only the first of each is opened: its windows are taken one by one from their source
coordinates and compared by 128-bit hashes of all their words. All decisions are joins on the edge, stretch or window against its
statistics, aggregated before the shuffle, so a passage that a third of all documents hold is no hot group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.llm import flat
from tidewell.llm.rows import body, packed, row_type, unpacked
from tidewell.session import settle

EDGE_SCHEMA = "edge bigint, stretch bigint, k bigint, t bigint, place bigint"
WINDOW_SCHEMA = "one bigint, two bigint, k bigint, t bigint, place bigint"


def _minimizers(words: flat.Words, edge: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts (of all rows), and for each the position and hash of its edge."""
    n = len(words)
    stop = words.first[1:][words.row] if n else np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(np.arange(n) + window <= stop)
    if not len(at):
        return at, at, np.zeros(0, dtype=np.uint64)
    begin = np.arange(n - edge + 1)
    kmers = words.runs()(begin, begin + edge)
    # order by hash, ties by position: the position sits in the low bits
    order = (flat.mix(kmers, 5) & np.uint64(0xFFFFFFFF00000000)) | begin.astype(np.uint64)
    span, wide = window - edge + 1, 1
    least = order
    while wide * 2 <= span:
        least = np.minimum(least[: len(least) - wide], least[wide:])
        wide *= 2
    if wide < span:
        least = np.minimum(least[: len(least) - (span - wide)], least[span - wide :])
    seed = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return at, seed, kmers


def _later(rows: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Whether the same keys stand earlier in the same row; the entries come in order of place."""
    order = np.lexsort((*keys, rows))
    same = np.ones(max(len(order) - 1, 0), dtype=bool)
    for values in (rows, *keys):
        values = values[order]
        same &= values[1:] == values[:-1]
    later = np.zeros(len(order), dtype=bool)
    later[order[1:]] = same
    return later


def _edges(edge: int, window: int):
    @flat.tidy
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, t = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for lo, hi, words in flat.word_chunks(batch.column(2)):
                at, seed, kmers = _minimizers(words, edge, window)
                if not len(at):
                    continue
                fresh = np.flatnonzero(np.concatenate(([True], seed[1:] != seed[:-1])))
                first, last = at[fresh], at[np.concatenate((fresh[1:], [len(at)])) - 1]
                place, key = seed[fresh], kmers[seed[fresh]]
                shape = ((place - first) << 16 | (last - first)).astype(np.uint64)
                stretch = flat.mix(words.runs()(first, last + window) ^ flat.mix(shape, 13))
                row = words.row[first]
                later = _later(row, key, stretch)
                start = first - words.first[row]
                packed_place = start << 16 | (last - first + 1) << 1 | later
                yield pa.record_batch(
                    [flat.signed(key), flat.signed(stretch), pa.array(k[lo:hi][row]), pa.array(t[lo:hi][row]), pa.array(packed_place)],
                    names=["edge", "stretch", "k", "t", "place"],
                )

    return of


def _windows(window: int, text: str):
    """The windows at given places (start, count) of each text, with both hashes."""

    @flat.tidy
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, t = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            places = batch.column(3)
            ends = np.asarray(places.offsets, dtype=np.int64)
            flat_places = places.values.to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, words in flat.word_chunks(batch.column(2).field(text)):
                mine = flat_places[ends[lo] : ends[hi]]
                row = np.repeat(np.arange(hi - lo), np.diff(ends[lo : hi + 1]))
                order = np.lexsort((mine, row))
                mine, row = mine[order], row[order]
                count = mine >> 1 & 0x7FFF
                steps = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                row = np.repeat(row, count)
                start = np.repeat(mine >> 16, count) + steps
                at = start + words.first[row]
                one, two = words.runs()(at, at + window), words.second_runs()(at, at + window)
                later = _later(row, one, two)
                yield pa.record_batch(
                    [flat.signed(one), flat.signed(two), pa.array(k[lo:hi][row]), pa.array(t[lo:hi][row]), pa.array(start << 16 | 1 << 1 | later)],
                    names=["one", "two", "k", "t", "place"],
                )

    return of


def _cut(window: int, text: str):
    """The words of each text without those under the given places."""

    @flat.tidy
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places = batch.column(0), batch.column(1)
            ends = np.asarray(places.offsets, dtype=np.int64)
            flat_places = places.values.to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, words in flat.word_chunks(rows.field(text)):
                mine = flat_places[ends[lo] : ends[hi]]
                row = np.repeat(np.arange(hi - lo), np.diff(ends[lo : hi + 1]))
                start = words.first[row] + (mine >> 16)
                stop = start + (mine >> 1 & 0x7FFF) + window - 1
                depth = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(depth, start, 1)
                np.add.at(depth, stop, -1)
                kept = np.cumsum(depth[:-1]) == 0
                n_kept = np.bincount(words.row[kept], minlength=hi - lo)
                starts, lengths = words.starts[kept], (words.stops - words.starts)[kept]
                # one space after each word but the last of a row
                room = lengths + 1
                done = np.cumsum(n_kept)
                room[done[n_kept > 0] - 1] -= 1
                goes = np.cumsum(room) - room
                out = np.full(int(room.sum()), 0x20, dtype=np.uint8)
                shift = np.repeat(starts - goes, lengths)
                to = np.arange(int(lengths.sum())) + np.repeat(goes - (np.cumsum(lengths) - lengths), lengths)
                out[to] = words.data[to + shift]
                cuts = np.concatenate(([0], np.cumsum(room)))[np.concatenate(([0], done))]
                body = pa.LargeStringArray.from_buffers(hi - lo, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())
                n_words = words.counts.astype(np.int64)
                yield pa.record_batch([rows.slice(lo, hi - lo), body, pa.array(n_words), pa.array(n_words - n_kept)], names=["row", "kept_text", "n_words", "n_removed"])

    return of


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 20, edge: int = 6) -> DataFrame:
    """``docs`` with kept_text, n_words and n_removed: words under a window that also starts earlier are removed.

    Earlier means a smaller id, or an earlier start in the same row; rows that share an id are never earlier than one another. A
    null id counts as the smallest, a null text as empty, and a text of fewer than ``window`` words has no window. Kept words are
    joined by one space. Input columns are returned, save those that have the name of a result.
    """
    if not 0 < edge < window < 1 << 14:
        raise ValueError("edges must be shorter than windows")
    # half of the text's hash is enough to tell apart rows that share an id, and is shuffled with every edge
    source = packed(docs, key, text).withColumn("t", F.col("t").bitwiseAND(F.lit(0xFFFFFFFF)))
    texts = source.select("k", "t", body(text))
    edges = texts.mapInArrow(_edges(edge, window), EDGE_SCHEMA)
    facts = (
        edges.groupBy("edge")
        .agg(F.count(F.lit(1)).alias("n"), F.min("stretch").alias("low"), F.max("stretch").alias("high"), F.min("k").alias("first_k"))
        .where("n > 1")
        .select("edge", "first_k", (F.col("low") == F.col("high")).alias("straight"))
    )
    # written, so that the join that follows has a shuffle of its own and can split a hot edge
    facts = settle(facts, "facts")
    later = F.col("place").bitwiseAND(F.lit(1)) == 1
    repeated = edges.join(facts, "edge")
    not_first = (F.col("k") > F.col("first_k")) | later
    repeated = repeated.where(~F.col("straight") | not_first).select(*[F.when(~F.col("straight"), F.col(c)).alias(c) for c in ("edge", "stretch")], "k", "t", "place")
    repeated = settle(repeated, "repeated")
    gone = repeated.where("edge is null").select("k", "t", "place")
    branching = repeated.where("edge is not null")
    ways = settle(branching.groupBy("edge", "stretch").agg(F.min("k").alias("first_k")), "ways")
    branching = branching.join(ways, ["edge", "stretch"]).withColumn("not_first", not_first)
    gone = gone.unionByName(branching.where("not_first").select("k", "t", "place"))
    to_open = branching.where("not not_first").groupBy("k", "t").agg(F.collect_set("place").alias("open"))
    # both joins with texts take whole rows, and so read the same shuffle
    open_texts = source.join(to_open, ["k", "t"])
    windows = open_texts.select("k", "t", "row", "open").mapInArrow(_windows(window, text), WINDOW_SCHEMA)
    first = windows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("first_k")).where("n > 1").drop("n")
    again = windows.join(first, ["one", "two"]).where(not_first).select("k", "t", "place")
    spans = gone.unionByName(again).groupBy("k", "t").agg(F.collect_set("place").alias("places"))
    joined = source.join(spans, ["k", "t"], "left").select("row", F.coalesce("places", F.array().cast("array<bigint>")).alias("places"))
    cut = joined.mapInArrow(_cut(window, text), f"row {row_type(joined)}, kept_text string, n_words bigint, n_removed bigint")
    return unpacked(cut, docs, kept_text=F.col("kept_text"), n_words=F.col("n_words"), n_removed=F.col("n_removed"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS body FROM starts),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY body ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + d AS i FROM again, (SELECT unnest(range(0, 20)) AS d)),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) AS body, count(*) AS n
         FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
