"""Byte-level BPE: encoding with a queue of merge ranks, and decoding.

The queue has one bucket per merge rank. A bucket holds positions of a linked list of tokens; three levels of 64-bit words tell which
buckets hold any, and the lowest set bit of each level leads to the next rank. An entry whose tokens have changed since is stale and
is skipped when it comes up, so a merge costs a few steps however long the pre-token is.

Long pre-tokens are merged one by one. Short ones that the cache does not know are laid end to end as one linked list with borders,
and a bucket is emptied by array operations: the leftmost entry of every pre-token at a time, which is the order of merges of each
pre-token alone.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.llm import flat
from tidewell.llm.rows import packed, row_type, unpacked

LONG = 48
KNOWN = 200_000
PLAIN_BELOW = 0x250


class RankQueue:
    """Buckets by rank; first() is the smallest rank whose bucket holds anything."""

    def __init__(self, ranks: int):
        self.low = [0] * (ranks + 63 >> 6)
        self.middle = [0] * (len(self.low) + 63 >> 6)
        self.top = 0

    def mark(self, rank: int) -> None:
        word, group = rank >> 6, rank >> 12
        self.low[word] |= 1 << (rank & 63)
        self.middle[group] |= 1 << (word & 63)
        self.top |= 1 << group

    def clear(self, rank: int) -> None:
        word, group = rank >> 6, rank >> 12
        self.low[word] &= ~(1 << (rank & 63))
        if not self.low[word]:
            self.middle[group] &= ~(1 << (word & 63))
            if not self.middle[group]:
                self.top &= ~(1 << group)

    def first(self) -> int:
        """The smallest marked rank, -1 if there is none."""
        if not self.top:
            return -1
        group = (self.top & -self.top).bit_length() - 1
        bits = self.middle[group]
        word = group << 6 | (bits & -bits).bit_length() - 1
        bits = self.low[word]
        return word << 6 | (bits & -bits).bit_length() - 1


class Ranks:
    """A vocabulary in the layout of rank files: base64 token, blank, rank."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.size = max(self.rank.values()) + 1
        self.token = [b""] * self.size
        for token, rank in self.rank.items():
            self.token[rank] = token
        self.single = np.array([self.rank[bytes([i])] for i in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                a, b = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = rank
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)
        lengths = np.array([len(t) for t in self.token], dtype=np.int64)
        self.token_starts = np.concatenate(([0], np.cumsum(lengths)))
        self.token_bytes = np.frombuffer(b"".join(self.token), dtype=np.uint8)

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens, -1 where they do not merge."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)


@cache
def ranks_at(path: str) -> Ranks:
    return Ranks(path)


def merge_one(piece: bytes, ranks: Ranks) -> list[int]:
    """The ids of one pre-token of any length."""
    n, size, pairs = len(piece), ranks.size, ranks.pairs
    ids = ranks.single[np.frombuffer(piece, dtype=np.uint8)].tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue, buckets = RankQueue(size), {}

    def put(at: int) -> None:
        rank = pairs.get(ids[at] * size + ids[after[at]])
        if rank is not None:
            held = buckets.get(rank)
            if held:
                heapq.heappush(held, at)
            else:
                buckets[rank] = [at]
                queue.mark(rank)

    for at in range(n - 1):
        put(at)
    while (rank := queue.first()) >= 0:
        held = buckets[rank]
        at = heapq.heappop(held)
        if not held:
            queue.clear(rank)
        if ids[at] < 0 or after[at] >= n or pairs.get(ids[at] * size + ids[after[at]]) != rank:
            continue
        gone = after[at]
        ids[at], ids[gone] = rank, -1
        after[at] = after[gone]
        if after[at] < n:
            before[after[at]] = at
            put(at)
        if before[at] >= 0:
            put(before[at])
    return [i for i in ids if i >= 0]


def merge_many(pieces: list[bytes], ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """The ids of many pre-tokens, one after the other, and how many each has."""
    lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    n = int(lengths.sum())
    ids = np.append(ranks.single[np.frombuffer(b"".join(pieces), dtype=np.uint8)], -1)  # the last place stands for "none"
    owner = np.append(np.repeat(np.arange(len(pieces)), lengths), -1)
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    border = owner[:-1] != owner[1:]
    after[:-1][border] = n
    before[1:][border] = n
    before[0], after[n], before[n] = n, n, n
    queue, buckets = RankQueue(ranks.size), {}

    def current(at: np.ndarray) -> np.ndarray:
        follows = after[at]
        return np.where((ids[at] >= 0) & (follows < n), ranks.rank_of(ids[at], ids[follows]), -1)

    def put(at: np.ndarray) -> None:
        rank = current(at)
        at, rank = at[rank >= 0], rank[rank >= 0]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        heads = rank[np.concatenate(([0], cuts))].tolist() if len(rank) else []
        for head, part in zip(heads, np.split(at, cuts)):
            held = buckets.get(head)
            if held is None:
                buckets[head] = [part]
                queue.mark(head)
            else:
                held.append(part)

    put(np.arange(n))
    while (rank := queue.first()) >= 0:
        queue.clear(rank)
        held = buckets.pop(rank)
        at = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
        at = at[current(at) == rank]
        if not len(at):
            continue
        leads = np.ones(len(at), dtype=bool)
        leads[1:] = owner[at[1:]] != owner[at[:-1]]
        rest, at = at[~leads], at[leads]
        gone = after[at]
        ids[at], ids[gone] = rank, -1
        after[at] = after[gone]
        before[after[at]] = at
        before[n] = n
        left = before[at]
        put(np.concatenate((at, left[left < n], rest)))
    kept = ids[:n] >= 0
    return ids[:n][kept], np.bincount(owner[:n][kept], minlength=len(pieces))


@cache
def plain_split(pattern: str) -> tuple[Callable, Callable]:
    """A test for texts with code points below PLAIN_BELOW only, and the pattern for them, its classes spelt out.

    The built-in engine has no letter and number classes but is twice as fast; both give the same matches.
    """
    every = "".join(map(chr, range(PLAIN_BELOW)))
    spelt = {name: "".join(f"\\U{ord(c):08x}" for c in regex.findall(name, every)) for name in (r"\p{L}", r"\p{N}", r"\s")}
    bare = pattern.replace(r"\S", "[^" + spelt[r"\s"] + "]")
    in_class, made = False, []
    for part in re.findall(r"\\p\{[LN]\}|\\U[0-9a-f]{8}|\\.|.", bare, re.DOTALL):
        in_class = part == "[" or (in_class and part != "]")
        made.append((spelt[part] if in_class else f"[{spelt[part]}]") if part in spelt else part)
    return re.compile(f"[^\\x00-\\u{PLAIN_BELOW - 1:04x}]").search, re.compile("".join(made)).findall


class Encoder:
    """Ids of texts; a bounded cache keeps those of short pre-tokens."""

    def __init__(self, ranks: Ranks, pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.special, self.plain = plain_split(pattern)
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.zeros(0, dtype=np.int32)
        self.starts = np.zeros(1, dtype=np.int64)

    def _learn(self, pieces: list[str]) -> None:
        """Adds pre-tokens to the cache."""
        raw = [p.encode() for p in pieces]
        short = [i for i, p in enumerate(raw) if len(p) <= LONG]
        made, counts = merge_many([raw[i] for i in short], self.ranks)
        lengths = np.zeros(len(raw), dtype=np.int64)
        lengths[short] = counts
        long = {i: merge_one(p, self.ranks) for i, p in enumerate(raw) if len(p) > LONG}
        for i, ids in long.items():
            lengths[i] = len(ids)
        starts = np.cumsum(lengths) - lengths
        ids = np.empty(int(lengths.sum()), dtype=np.int32)
        is_short = np.zeros(len(raw), dtype=bool)
        is_short[short] = True
        ids[np.repeat(is_short, lengths)] = made
        for i, own in long.items():
            ids[starts[i] : starts[i] + len(own)] = own
        self.place.update(zip(pieces, range(len(self.place), len(self.place) + len(pieces))))
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(lengths)))
        self.ids = np.concatenate((self.ids, ids))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        if len(self.place) > KNOWN:
            self._forget()
        pieces = [(self.split if self.special(t) else self.plain)(t) for t in texts]
        new = set().union(*pieces).difference(self.place)
        if new:
            self._learn(sorted(new))
        get = self.place.__getitem__
        per_text = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        at = np.fromiter(map(get, chain.from_iterable(pieces)), dtype=np.int64, count=int(per_text.sum()))
        lengths = self.starts[at + 1] - self.starts[at]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        ids = self.ids[np.repeat(self.starts[at] - ends[:-1], lengths) + np.arange(ends[-1])]
        return ids, np.diff(ends[np.concatenate(([0], np.cumsum(per_text)))])


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder_at(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(ranks_at(path), pattern)
    return _ENCODERS[path, pattern]


def _id_lists(path: str, pattern: str, text: str) -> Callable:
    @flat.tidy
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_at(path, pattern)
        for batch in batches:
            column = batch.column(0).field(text).fill_null("")
            _, offsets = flat.bytes_of(column)
            for lo, hi in flat.chunks(offsets, 4 * flat.CHUNK_BYTES):
                ids, counts = encode(column.slice(lo, hi - lo).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), lists], names=["row", "ids"])
            flat.release()

    return of


def _byte_strings(path: str) -> Callable:
    @flat.tidy
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_at(path)
        lengths_of = np.diff(ranks.token_starts)
        for batch in batches:
            lists = batch.column(1)
            ends = np.asarray(lists.offsets, dtype=np.int64)
            all_ids = lists.values.to_numpy(zero_copy_only=False)
            for lo, hi in flat.chunks(ends, flat.CHUNK_BYTES):
                ids = all_ids[ends[lo] : ends[hi]]
                lengths = lengths_of[ids]
                to = np.concatenate(([0], np.cumsum(lengths)))
                data = ranks.token_bytes[np.repeat(ranks.token_starts[ids] - to[:-1], lengths) + np.arange(to[-1])]
                cuts = to[ends[lo : hi + 1] - ends[lo]].astype(np.int32)
                decoded = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(cuts), pa.py_buffer(data)])
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), lists.slice(lo, hi - lo), decoded], names=["row", "ids", "decoded"])

    return of


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, text: str = "text") -> DataFrame:
    """``docs`` with ids (array<int>): each match of the pattern encoded by the rank file at ``path``, without special tokens.

    Null and empty texts have no ids. Every executor must find the rank file at that path.
    """
    source = packed(docs, docs.columns[0], text).select("row")
    return unpacked(source.mapInArrow(_id_lists(path, pattern, text), f"row {row_type(source)}, ids array<int>"), docs, ids=F.col("ids"))


def decode(frame: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``frame`` with decoded (binary): the bytes of its ids, which need not be valid UTF-8. Null ids give no bytes."""
    listed = F.coalesce(F.col(f"`{ids}`").cast("array<int>"), F.array().cast("array<int>"))
    source = frame.select(F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias("row"), listed.alias("ids"))
    made = source.mapInArrow(_byte_strings(path), f"row {row_type(source)}, ids array<int>, decoded binary")
    return unpacked(made, frame, decoded=F.col("decoded"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = decode(encode(docs, path).drop("text"), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
