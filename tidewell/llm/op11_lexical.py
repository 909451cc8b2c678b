"""Ranked lexical search over a term-document grid held as quadtrees of impact maxima (K2-treaps).

Documents are indexed in blocks of at most 4096, ordered by length within a block: each block is one row of the index with the block's
distinct terms (64-bit hashes) and, term by term, the documents that hold it with their counts. Statistics are sums over that
table. A search then takes every block on its own: the rows of the asked terms become a quadtree whose cells hold the largest impact
below them, and the paths of an item's terms go down together, most promising range of documents first, until no open range can reach
the item's worst kept score. Scores kept in one block are the bar for the next ones of the same task; Spark merges what the tasks keep.

A term has a band of as many rows as there are columns, so below the band's cell no cell mixes two terms and an item's bound for a
range of documents is exact per term. Cells of 8 columns are the leaves and hold the impacts themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidewell.llm import flat, terms
from tidewell.llm.rows import NULL_ID, body, packed
from tidewell.session import settle

BLOCK_BYTES = 4 << 20
#: Documents of a block at most; flat.chunks cuts there.
WIDTH_BITS = 12
LEAF_BITS = 3
#: Open ranges of an item that are taken from the queue at a time.
AT_ONCE = 16
#: Distinct (item, term) pairs searched in one pass over the index; more items are searched in further passes.
PAIRS = 1 << 18
SLOPE, SCALE = 12, 1_000_000_000

INDEX = "ids binary, lengths binary, terms binary, starts binary, docs binary, counts binary, n_docs bigint, n_terms bigint"


def _counted(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The term hashes of some rows one after the other, and how many each row has; scratch arrays stay small."""
    hashes, counts = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    for lo, hi in flat.chunks(offsets):
        words = terms.words_of(terms.TERM_BYTES, data, offsets, lo, hi)
        hashes.append(words.hashes)
        counts.append(words.counts)
    return np.concatenate(hashes), np.concatenate(counts).astype(np.int64)


@flat.tidy
def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = flat.bytes_of(batch.column(1))
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for lo, hi in flat.chunks(offsets, BLOCK_BYTES):
            hashes, lengths = _counted(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            order = np.argsort(lengths, kind="stable")
            place = np.empty(hi - lo, dtype=np.int64)
            place[order] = np.arange(hi - lo)
            known, term = np.unique(hashes, return_inverse=True)
            cells = (term.astype(np.int64) << WIDTH_BITS) | np.repeat(place, lengths)
            cells, counts = np.unique(cells, return_counts=True)
            starts = np.searchsorted(cells, np.arange(len(known) + 1, dtype=np.int64) << WIDTH_BITS)
            columns = [ids[lo:hi][order], lengths[order], known, starts.astype(np.int64), (cells & ((1 << WIDTH_BITS) - 1)).astype(np.uint16), counts.astype(np.uint32)]
            yield pa.record_batch(
                [*[pa.array([np.ascontiguousarray(c).tobytes()], type=pa.binary()) for c in columns], pa.array([int((lengths > 0).sum())]), pa.array([int(lengths.sum())])],
                names=["ids", "lengths", "terms", "starts", "docs", "counts", "n_docs", "n_terms"],
            )


def index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per block of documents, from whole texts; null and empty texts are in it without terms."""
    return packed(docs, key, text).select("k", body(text)).mapInArrow(_indexed, INDEX)


@flat.tidy
def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = flat.bytes_of(batch.column(1))
        found, repeats = [], []
        for row in range(batch.num_rows):
            own, times = np.unique(_counted(data[offsets[row] : offsets[row + 1]], offsets[row : row + 2] - offsets[row])[0], return_counts=True)
            found.append(own.view(np.int64))
            repeats.append(times)
        yield pa.record_batch([batch.column(0), pa.array(found, type=pa.list_(pa.int64())), pa.array(repeats, type=pa.list_(pa.int64()))], names=["row", "terms", "times"])


@dataclass
class Items:
    """Items of one pass: place in ``asked`` of each distinct term, how often it is asked, where each item's terms start (n + 1), row numbers."""

    asked: np.ndarray
    row: np.ndarray
    times: np.ndarray
    first: np.ndarray
    numbers: np.ndarray

    @staticmethod
    def of(group: list) -> Items:
        """From rows (row, terms, times)."""
        hashes = np.array([h for r in group for h in r["terms"]], dtype=np.int64).view(np.uint64)
        asked, row = np.unique(hashes, return_inverse=True)
        first = np.cumsum([0, *[len(r["terms"]) for r in group]])
        times = np.array([t for r in group for t in r["times"]], dtype=np.int64)
        return Items(asked, row.astype(np.int64), times, first, np.array([r["row"] for r in group], dtype=np.int64))


def _held(block: dict[str, np.ndarray], asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which asked terms a block holds, and where their documents start and stop."""
    at = np.searchsorted(block["terms"], asked)
    at[at == len(block["terms"])] = 0
    rows = np.flatnonzero(block["terms"][at] == asked) if len(block["terms"]) else np.zeros(0, dtype=np.int64)
    return rows, block["starts"][at[rows]], block["starts"][at[rows] + 1]


_TYPES = {"ids": np.int64, "lengths": np.int64, "terms": np.uint64, "starts": np.int64, "docs": np.uint16, "counts": np.uint32}


def _blocks(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
    for row in range(batch.num_rows):
        yield {name: np.frombuffer(batch.column(name)[row].as_py(), dtype=_TYPES[name]) for name in batch.schema.names if name in _TYPES}


def _holders(asked: np.ndarray):
    """How many documents of a task hold each asked term."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(asked), dtype=np.int64)
        for batch in batches:
            for block in _blocks(batch):
                rows, start, stop = _held(block, asked)
                held[rows] += stop - start
        some = np.flatnonzero(held)
        yield pa.record_batch([pa.array(some), pa.array(held[some])], names=["term", "df"])

    return of


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of 32-bit numbers at every second place."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


_BITS = np.array([bin(i).count("1") for i in range(16)], dtype=np.int64)


class Treap:
    """The quadtree of some terms' bands over a block's documents.

    Level 0 is the root. A cell has four bits, one per quadrant that is not empty (row bit, column bit), the number of its first child, and
    the largest impact below it; cells of all levels are numbered through. Cell ``empty`` stands for every empty quadrant.
    """

    def __init__(self, rows: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_rows: int, n_docs: int):
        """Cells (row, doc) in order of both; rows count bands."""
        self.column_bits = max(int(n_docs - 1).bit_length() - LEAF_BITS, 0)
        self.row_bits = max(int(n_rows - 1).bit_length(), 0)
        self.depth = self.row_bits + self.column_bits
        leaf = (_spread(rows << self.column_bits) << np.uint64(1)) | _spread(docs >> LEAF_BITS)
        new = np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1]])
        place = np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(leaf)]))
        self.leaves = np.zeros((len(new) + 1, 1 << LEAF_BITS), dtype=np.int64)
        self.leaves[place, docs & ((1 << LEAF_BITS) - 1)] = impacts
        codes, high = [leaf[new]], [self.leaves[:-1].max(axis=1)]
        masks = [np.zeros(len(new), dtype=np.int64)]
        ahead = [np.zeros(len(new), dtype=np.int64)]
        for _ in range(self.depth):
            up = codes[-1] >> np.uint64(2)
            first = np.flatnonzero(np.r_[True, up[1:] != up[:-1]])
            masks.append(np.bitwise_or.reduceat(np.int64(1) << (codes[-1] & np.uint64(3)).astype(np.int64), first))
            high.append(np.maximum.reduceat(high[-1], first))
            ahead.append(first)
            codes.append(up[first])
        sizes = [len(c) for c in codes]
        below = np.cumsum([0, *sizes])  # cells are numbered leaves first
        self.mask = np.r_[np.concatenate(masks), 0]
        self.high = np.r_[np.concatenate(high), 0]
        self.first = np.r_[np.concatenate([a + (below[i - 1] if i else 0) for i, a in enumerate(ahead)]), 0]
        self.empty = int(below[-1])
        self.root = self.empty - 1

    def child(self, cells: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        mask = self.mask[cells]
        found = self.first[cells] + _BITS[mask & ((1 << quadrant) - 1)]
        return np.where((mask >> quadrant) & 1 == 1, found, self.empty)

    def impacts(self, cells: np.ndarray) -> np.ndarray:
        """Impacts of the columns of leaf cells."""
        return self.leaves[np.minimum(cells, len(self.leaves) - 1)]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Best:
    """The best ``most`` documents of each item so far: highest scores, equal ones by ascending id."""

    def __init__(self, n_items: int, most: int):
        self.most = most
        self.bar = np.ones(n_items, dtype=np.int64)
        self.item, self.score, self.id = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        item, score, doc = np.r_[self.item, item], np.r_[self.score, score], np.r_[self.id, doc]
        order = np.lexsort((doc, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        order, item, rank = order[rank < self.most], item[rank < self.most], rank[rank < self.most]
        self.item, self.score, self.id = item, score[order], doc[order]
        full = rank == self.most - 1
        self.bar[item[full]] = self.score[full]


def search_block(block: dict[str, np.ndarray], items: Items, weights: np.ndarray, n: int, total: int, best: Best) -> None:
    """Takes up a block's documents that are among the best of an item.

    Queue entries are (item, level, range, bound) with the cells of the item's terms; an entry whose bound is below the item's bar can hold
    no better document and goes. Equal bounds stay, as a smaller id wins among equal scores.
    """
    rows, start, stop = _held(block, items.asked)
    if not len(rows):
        return
    at = _ranges(start, stop - start)
    docs, counts = block["docs"][at].astype(np.int64), block["counts"][at].astype(np.int64)
    measure = 75 + (25 * block["lengths"] * n) // total
    impacts = (SCALE * counts) // (1000 * counts + SLOPE * measure[docs])
    tree = Treap(np.repeat(np.arange(len(rows)), stop - start), docs, impacts, len(rows), len(block["ids"]))

    band = np.full(len(items.asked), -1, dtype=np.int64)
    band[rows] = np.arange(len(rows))
    held = band[items.row] >= 0  # terms of items that the block holds
    owner = np.repeat(np.arange(len(items.first) - 1), np.diff(items.first))[held]
    term_band, weight = band[items.row[held]], (items.times * weights[items.row])[held]
    n_own = np.bincount(owner, minlength=len(items.first) - 1)
    first = np.cumsum(n_own) - n_own

    item = np.flatnonzero(n_own)
    level, column = np.zeros(len(item), dtype=np.int64), np.zeros(len(item), dtype=np.int64)
    cells = np.full(len(owner), tree.root)
    place = first[item]
    bound = np.add.reduceat(weight * tree.high[cells], place)
    while True:
        open_ = np.flatnonzero(bound >= best.bar[item])
        if not len(open_):
            return
        order = open_[np.lexsort((-bound[open_], item[open_]))]
        rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        taken, rest = order[rank < AT_ONCE], order[rank >= AT_ONCE]

        own = n_own[item[taken]]
        terms_at, cells_at = _ranges(first[item[taken]], own), cells[_ranges(place[taken], own)]
        entry = np.repeat(np.arange(len(taken)), own)
        ends = level[taken] == tree.depth
        if ends.any():
            some = ends[entry]
            begin = np.cumsum(own[ends]) - own[ends]
            scores = np.add.reduceat(weight[terms_at[some], None] * tree.impacts(cells_at[some]), begin, axis=0)
            who, where = np.nonzero((scores >= best.bar[item[taken[ends]], None]) & (scores > 0))
            doc = (column[taken[ends]][who] << LEAF_BITS) + where
            best.add(item[taken[ends]][who], scores[who, where], block["ids"][doc])

        down = ~ends
        some = down[entry]
        own_down = own[down]
        deeper = level[taken[down]]
        splits_rows = deeper < tree.row_bits
        by_term = np.repeat(deeper, own_down)
        row_bit = np.where(by_term < tree.row_bits, (term_band[terms_at[some]] >> np.maximum(tree.row_bits - 1 - by_term, 0)) & 1, 0)
        begin = np.cumsum(own_down) - own_down
        new = []
        for column_bit in (0, 1):
            goes = ~splits_rows if column_bit else np.ones(len(deeper), dtype=bool)
            if not goes.any():
                continue
            lanes = np.repeat(goes, own_down)
            child = tree.child(cells_at[some][lanes], 2 * row_bit[lanes] + column_bit)
            starts = np.cumsum(own_down[goes]) - own_down[goes]
            top = np.add.reduceat(weight[terms_at[some]][lanes] * tree.high[child], starts)
            at_column = np.where(splits_rows[goes], 0, 2 * column[taken[down]][goes] + column_bit)
            new.append((item[taken[down]][goes], deeper[goes] + 1, at_column, top, child, own_down[goes]))

        kept = n_own[item[rest]]
        parts = [(item[rest], level[rest], column[rest], bound[rest], cells[_ranges(place[rest], kept)], kept), *new]
        item, level, column, bound, cells, own = (np.concatenate([p[i] for p in parts]) for i in range(6))
        place = np.cumsum(own) - own


def _searched(items: Items, weights: np.ndarray, n: int, total: int, most: int):
    @flat.tidy
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(items.first) - 1, most)
        for batch in batches:
            for block in _blocks(batch):
                search_block(block, items, weights, n, total, best)
        yield pa.record_batch([pa.array(items.numbers[best.item]), pa.array(best.id), pa.array(best.score)], names=["row", "k", "score"])

    return of


def _passes(items: DataFrame) -> Iterator[list]:
    """Rows of asked terms in groups of about PAIRS pairs."""
    group, pairs = [], 0
    for row in items.toLocalIterator():
        if group and pairs + len(row["terms"]) > PAIRS:
            yield group
            group, pairs = [], 0
        group.append(row)
        pairs += len(row["terms"])
    if group:
        yield group


def search(found: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text", most: int = 20) -> DataFrame:
    """(key, rank, doc_id, score): the ``most`` best documents of a written ``index`` for each item, with a score above 0.

    Equal scores are ranked by ascending id, a null id first. Rows of documents that share an id are ranked each; rows of items that
    share an id are answered each. Items without terms, or a table without terms, have no rows. Items are searched in passes of
    bounded size, whatever their number.
    """
    spark = found.sparkSession
    numbered = items.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    numbered = settle(numbered, "items")
    asked = settle(numbered.select("row", "body").mapInArrow(_asked, "row bigint, terms array<bigint>, times array<bigint>").where("size(terms) > 0"), "asked")
    n, total = found.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    out = spark.createDataFrame([], "row bigint, k bigint, score bigint")
    for group in _passes(asked) if n else ():
        part = Items.of(group)
        df = np.zeros(len(part.asked), dtype=np.int64)
        for row in found.select("terms", "starts").mapInArrow(_holders(part.asked), "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
            df[row["term"]] = row["df"]
        weights = np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)
        hits = found.select("ids", "lengths", "terms", "starts", "docs", "counts").mapInArrow(_searched(part, weights, n, total, most), "row bigint, k bigint, score bigint")
        out = out.unionByName(hits)
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "k"))).where(F.col("rank") <= most)
    doc = F.when(F.col("k") != NULL_ID, F.col("k")).alias("doc_id")
    return ranked.join(numbered.select("row", "key"), "row").select(F.col("key").alias(key), "rank", doc, "score")


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of each benchmark item; nulls, ties and repeats as in ``search``."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    return search(settle(index(docs.select("doc_id", "text")), "blocks"), items.select("item_id", "text"))


SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
sizes AS (SELECT doc_id, len(ws)::BIGINT AS n FROM words WHERE len(ws) > 0),
facts AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS l FROM sizes),
asked AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
times AS (SELECT item_id, term, count(*)::BIGINT AS q FROM asked GROUP BY ALL),
tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(ws) AS term FROM words) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, facts GROUP BY term),
scores AS (SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // l))))::BIGINT AS score
           FROM times JOIN w USING (term) JOIN tf USING (term) JOIN sizes USING (doc_id), facts GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM scores WHERE score > 0)
SELECT item_id, r::INT AS rank, doc_id, score FROM ranked WHERE r <= 20
"""
