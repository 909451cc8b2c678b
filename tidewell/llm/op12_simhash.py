"""Near-duplicate documents by SimHash, compared bit plane by bit plane.

Equal fingerprints are one node. The 64 bits are cut into six pieces; two fingerprints that differ in at most four bits agree in at least two
pieces, so every pair of pieces with their values is a bucket and linked nodes share one. In a bucket the fingerprints are stored
vertically, one machine word holding the same bit of 64 of them; counters of differing bits, held in the same way, take up two planes at
a time through a carry-save adder, and words in which all 64 pairs are past the radius are left out of the planes that follow.

Buckets of more than BLOCK nodes are cut into blocks by hash. Blocks are compared inside first, then block against block, only between nodes that
are not yet in one component; a block gives only links that join components, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewell.llm import flat, terms
from tidewell.llm.components import components
from tidewell.llm.rows import NULL_ID, body, packed
from tidewell.session import settle

BITS = 64
RADIUS = 4
SHARED = 2
SIZE = 4
SEED = 42
BLOCK = 4096
#: Rows of small groups that are compared together in one task's array.
PART = 1 << 13
EVERY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_bytes(words: flat.Words, size: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Words joined by single spaces as one run of bytes, where each shingle starts and stops there, and its row.

    Shingles are counted with repeats; a row with fewer words has its whole sequence as one, a row without words none.
    """
    sizes = words.stops - words.starts
    ends = np.cumsum(sizes + 1)
    begins = ends - (sizes + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, dtype=np.uint8)
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[within + np.repeat(begins, sizes)] = words.data[within + np.repeat(words.starts, sizes)]
    n = len(words)
    last = words.first[1:][words.row] if n else np.zeros(0, dtype=np.int64)
    at = np.arange(n)
    whole = (words.counts[words.row] < size) & (at == words.first[:-1][words.row])
    at = np.flatnonzero((at + size <= last) | whole)
    return out.tobytes(), begins[at], ends[np.minimum(at + size, last[at]) - 1] - 1, words.row[at]


def fingerprints(words: flat.Words, size: int = SIZE, seed: int = SEED) -> np.ndarray:
    """The SimHash of each row: a bit is 1 if it is set in over half of the hashes of its shingles; without words it is zero."""
    data, starts, stops, row = shingle_bytes(words, size)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(data[a:b], seed) for a, b in zip(starts.tolist(), stops.tolist())), dtype=np.uint64, count=len(starts))
    counts = np.bincount(row, minlength=len(words.counts))
    some = np.flatnonzero(counts)
    out = np.zeros(len(words.counts), dtype=np.uint64)
    if len(some):
        first = (np.cumsum(counts) - counts)[some]
        for bit in range(BITS):
            ones = np.add.reduceat((hashes >> np.uint64(bit)) & np.uint64(1), first)
            out[some] |= (2 * ones > counts[some].astype(np.uint64)).astype(np.uint64) << np.uint64(bit)
    return out


def _signed(size: int, seed: int):
    @flat.tidy
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat.bytes_of(batch.column(1))
            found = [np.zeros(0, dtype=np.uint64)]
            for lo, hi in flat.chunks(offsets):
                found.append(fingerprints(terms.words_of(terms.LOWER, data, offsets, lo, hi), size, seed))
            yield pa.record_batch([batch.column(0), flat.signed(np.concatenate(found))], names=["k", "fp"])

    return of


# ---- bit-sliced comparison


def planes(values: np.ndarray) -> np.ndarray:
    """Fingerprints stored vertically: (64 bits, words of 64 fingerprints); what fills the last word is zero."""
    padded = np.zeros(-(-len(values) // 64) * 64, dtype=np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def lanes_of(mask: np.ndarray) -> np.ndarray:
    """A mask of pairs as words of 64, one bit each."""
    padded = np.zeros(-(-len(mask) // 64) * 64, dtype=bool)
    padded[: len(mask)] = mask
    return np.packbits(padded, bitorder="little").view(np.uint64)


def within(differing: Callable[[int, np.ndarray], np.ndarray], asked: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, bits) of the pairs asked for whose fingerprints differ in at most ``radius`` bits.

    ``differing(b, words)`` gives bit b of the differences of the pairs in some words; ``asked`` has a bit per pair. Counters start so
    high that one more difference than the radius carries out of their highest bit; a pair with such a carry is out for good.
    """
    size = max(radius.bit_length(), 1)
    start = (1 << size) - 1 - radius
    words = np.flatnonzero(asked)
    out = ~asked[words]
    counter = [np.full(len(words), EVERY if (start >> i) & 1 else 0, dtype=np.uint64) for i in range(size)]
    for b in range(0, BITS, 2):
        if b % 8 == 0 and b:
            alive = np.flatnonzero(out != EVERY)
            if len(alive) < len(words):
                words, out, counter = words[alive], out[alive], [c[alive] for c in counter]
            if not len(words):
                break
        one, two = differing(b, words), differing(b + 1, words)
        partial = counter[0] ^ one
        carry = (counter[0] & one) | (partial & two)
        counter[0] = partial ^ two
        for i in range(1, size):
            counter[i], carry = counter[i] ^ carry, counter[i] & carry
        out = out | carry
    alive = np.flatnonzero(out != EVERY)
    return words[alive], ~out[alive]


def _pairs(words: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Numbers of the pairs whose bits are set."""
    at, lane = np.nonzero(np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return words[at] * 64 + lane


class Joined:
    """Rows that links have joined; ``label`` is equal for rows of one component."""

    def __init__(self, label: np.ndarray):
        _, self.label = np.unique(label, return_inverse=True)
        self.root = np.arange(self.label.max() + 1 if len(label) else 0)
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []

    def _top(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Keeps those of the links that join two components."""
        used = []
        for i, (x, y) in enumerate(zip(self.label[a].tolist(), self.label[b].tolist())):
            x, y = self._top(x), self._top(y)
            if x != y:
                self.root[max(x, y)] = min(x, y)
                used.append(i)
        if used:
            self.a.append(a[used])
            self.b.append(b[used])
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]
            self.label = self.root[self.label]

    def links(self, rep: np.ndarray) -> pa.Table:
        none = [np.zeros(0, dtype=np.int64)]
        return pa.table({"a": pa.array(rep[np.concatenate(none + self.a)]), "b": pa.array(rep[np.concatenate(none + self.b)])})


def _groups(*columns: np.ndarray) -> np.ndarray:
    """A number per row, equal for rows with equal columns; rows are in order of them."""
    new = np.zeros(len(columns[0]), dtype=bool)
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.cumsum(new)


def compare_inside(values: np.ndarray, group: np.ndarray, joined: Joined, radius: int) -> None:
    """Joins rows of a group within the radius of one another; rows are in order of groups.

    Each row is compared with the one ``step`` places after it, for all groups at once; when the step has doubled, the groups that are
    still larger are put into fresh planes.
    """
    rows = np.arange(len(values))
    step = 1
    while True:
        sizes = np.bincount(group[rows], minlength=group[-1] + 1 if len(group) else 0)
        rows = rows[sizes[group[rows]] > step]
        if not len(rows):
            return
        own, bits = group[rows], planes(values[rows])
        for step in range(step, 2 * step):
            if step >= len(rows):
                return
            ask = np.zeros(len(rows), dtype=bool)
            ask[:-step] = (own[:-step] == own[step:]) & (joined.label[rows[:-step]] != joined.label[rows[step:]])
            if not ask.any():
                continue
            jump, turn = divmod(step, 64)
            later = np.zeros((BITS, bits.shape[1] + jump + 1), dtype=np.uint64)
            later[:, : bits.shape[1]] = bits

            def differing(b: int, words: np.ndarray) -> np.ndarray:
                shifted = later[b, words + jump] >> np.uint64(turn)
                if turn:
                    shifted |= later[b, words + jump + 1] << np.uint64(64 - turn)
                return bits[b, words] ^ shifted

            found = _pairs(*within(differing, lanes_of(ask), radius))
            joined.add(rows[found], rows[found + step])
        step += 1


def compare_across(left: np.ndarray, right: np.ndarray, joined: Joined, values: np.ndarray, radius: int, at_once: int = 64) -> None:
    """Joins rows of ``left`` with rows of ``right`` (row numbers) within the radius, some left rows against all right ones at a time."""
    bits = planes(values[right])
    n_words = bits.shape[1]
    for lo in range(0, len(left), at_once):
        some = left[lo : lo + at_once]
        every = ((values[some][None, :] >> np.arange(BITS, dtype=np.uint64)[:, None]) & np.uint64(1)) * EVERY
        ask = np.concatenate([lanes_of(joined.label[right] != joined.label[x]) for x in some])
        if not ask.any():
            continue
        found = _pairs(*within(lambda b, words: bits[b, words % n_words] ^ every[b, words // n_words], ask, radius))
        joined.add(some[found // (64 * n_words)], right[found % (64 * n_words)])


def _inside(radius: int):
    def of(table: pa.Table) -> pa.Table:
        table = table.sort_by([("bucket", "ascending"), ("block", "ascending"), ("fp", "ascending")])
        values, rep = table["fp"].to_numpy().view(np.uint64), table["rep"].to_numpy()
        group = _groups(table["bucket"].to_numpy(), table["block"].to_numpy())
        joined = Joined(rep)
        compare_inside(values, group, joined, radius)
        return joined.links(rep)

    return of


def _across(radius: int):
    def of(table: pa.Table) -> pa.Table:
        values, rep, side = table["fp"].to_numpy().view(np.uint64), table["rep"].to_numpy(), table["side"].to_numpy()
        joined = Joined(table["component"].to_numpy())
        if 0 < side.sum() < len(side):
            compare_across(np.flatnonzero(side == 0), np.flatnonzero(side == 1), joined, values, radius)
        return joined.links(rep)

    return of


# ---- buckets


def _buckets(radius: int, shared: int) -> Column:
    """A fingerprint's buckets: each choice of ``shared`` of the pieces with their bits, told apart by the number of the choice."""
    n = radius + shared
    cuts = [BITS * i // n for i in range(n + 1)]
    masks = [((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in range(n)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(signed(sum(masks[p] for p in chosen))))) for i, chosen in enumerate(combinations(range(n), shared))])


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, size: int = SIZE, seed: int = SEED, shared: int = SHARED) -> DataFrame:
    """(k, fp, component) for every row: its id, its fingerprint as a bigint, and the smallest id reachable through links.

    A-Z count as a-z, words are what lies between blanks, a shingle is ``size`` words. Fingerprints link at ``radius`` or fewer differing
    bits. Null, empty and blank texts have fingerprint zero, which links like any other. A null id counts as the smallest; rows that
    share an id are one node. More pieces in common (``shared``) mean smaller and more buckets.
    """
    source = packed(docs, key, text).select("k", body(text))
    signed = settle(source.mapInArrow(_signed(size, seed), "k bigint, fp bigint"), "fingerprints")
    nodes = settle(signed.groupBy("fp").agg(F.min("k").alias("rep")), "nodes")
    keyed = nodes.select("fp", "rep", F.explode(_buckets(radius, shared)).alias("bucket"))
    full = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    rows = settle(keyed.join(full, "bucket").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("fp"), "blocks").cast("int")), "buckets")
    count, most = rows.agg(F.count(F.lit(1)), F.max("blocks")).first()
    parts = F.pmod(F.xxhash64("bucket", "block"), F.lit(-(-count // PART) or 1))
    inside = rows.select("bucket", "block", "fp", "rep", parts.alias("part")).groupBy("part").applyInArrow(_inside(radius), "a bigint, b bigint")
    twins = nodes.join(signed, "fp").groupBy("k").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("a", "b")
    links = settle(inside.unionByName(twins).distinct(), "inside")
    labels = components(links)
    if (most or 1) > 1:
        owned = rows.where("blocks > 1").join(labels, rows["rep"] == labels["node"], "left").select("bucket", "blocks", "block", "fp", "rep", F.coalesce("component", "rep").alias("component"))
        mixed = owned.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("bucket")
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
        dealt = owned.join(mixed, "bucket").select("*", other).where("other <> block").select(
            "bucket", "fp", "rep", "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side")
        )
        across = dealt.groupBy("bucket", "i", "j").applyInArrow(_across(radius), "a bigint, b bigint")
        labels = components(links.unionByName(settle(across.distinct(), "across")))
    placed = nodes.join(labels, nodes["rep"] == labels["node"], "left").select("fp", F.coalesce("component", "rep").alias("component"))
    return signed.join(placed, "fp").select("k", "fp", "component")


def _id(column: str) -> Column:
    return F.when(F.col(column) != NULL_ID, F.col(column))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; nulls, ties and repeats as in ``near_duplicates``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select(_id("k").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), _id("component").alias("component_id"))
