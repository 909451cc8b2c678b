"""Packing token sequences by the linear grouping scheme.

Lengths are whole numbers up to the capacity, so the whole corpus is one histogram of at most ``capacity`` counts, whatever its
size. On it the large lengths are cut into groups of equal cardinality and rounded up to the longest of their group; a linear
programme over the few rounded sizes finds the configurations; documents of each group take the slots of its size; what the
rounding and the whole numbers leave, and all small documents, go to the tightest open sequence (best fit, longest first). The plan
is a short list of runs: documents of one length and a range of ranks go to a range of sequences. Spark ranks the documents of each
length, looks up their run, and adds up offsets inside each sequence.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidewell.llm import flat
from tidewell.llm.rows import NULL_ID, body, packed
from tidewell.session import settle

KNOWN = 400_000
LARGE_SHARES, GROUPS = (2, 3, 6), (8, 16, 40)
PER_CELL = 200_000


# ---- tokens


class Places(dict):
    """Numbers keys as they come."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list = []

    def __missing__(self, key) -> int:
        place = self[key] = len(self)
        self.new.append(key)
        return place


class Known:
    """Ids of keys, by their number, and how often each was asked for."""

    def __init__(self) -> None:
        self.place, self.ids, self.starts = Places(), np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)
        self.seen = np.zeros(0, dtype=np.int32)

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.ids = np.concatenate((self.ids, ids))
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(lengths)))
        self.place.new = []

    def count(self, at: np.ndarray) -> None:
        times = np.bincount(at, minlength=len(self.place)).astype(np.int32)
        times[: len(self.seen)] += self.seen
        self.seen = times

    def halve(self) -> None:
        """Forgets the half of the keys asked for least; those that stay have to be asked for again to stay once more."""
        n = len(self.place) // 2
        kept = np.sort(np.argpartition(-self.seen, n)[:n])
        lengths = np.diff(self.starts)[kept]
        ids, _ = self.of(kept)
        keys = list(self.place)
        self.place = Places()
        self.place.update((keys[i], j) for j, i in enumerate(kept.tolist()))
        self.ids, self.starts = ids, np.concatenate(([0], np.cumsum(lengths)))
        self.seen = self.seen[kept] >> 1

    def of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all given keys, and where those of each end (from 0)."""
        lengths = self.starts[at + 1] - self.starts[at]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        return self.ids[np.repeat(self.starts[at] - ends[:-1], lengths) + np.arange(ends[-1])], ends


class WordTokens:
    """Ids of texts by a tokenizer whose pre-tokens never hold white space: each blank-separated part is encoded once, and kept while it is
    among those asked for most.

    A part that is one Latin word and a run of ASCII signs, or none, is put together from these two; unknown words are encoded in one
    call and told apart by the tokens that end a word. If the tokenizer takes no notice of case, A-Z are put in lower case first, save in
    texts where that could make a literal of a special token.
    """

    SIMPLE = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+)([!-/:-@[-`{-~]*)").fullmatch

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        normalizer = self.tokenizer.normalizer
        self.folds = normalizer is not None and all(normalizer.normalize_str(c) == c.lower() for c in map(chr, range(65, 91)))
        self.literals = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.parts, self.words = Known(), Known()

    def _split(self, text: bytes) -> list[bytes]:
        if self.folds:
            low = text.lower()
            if not any(literal in low for literal in self.literals):
                return low.split()
        return text.split()

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(made), dtype=np.uint32), np.fromiter(map(len, made), dtype=np.int64, count=len(made))

    def _learn_words(self) -> None:
        new = self.words.place.new
        if new:
            ids = self._encode([" ".join(new)])[0].astype(np.int64)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(new):
                self.words.add(ids.astype(np.uint32), np.diff(stops, prepend=0))
            else:  # some word is more than one pre-token
                self.words.add(*self._encode(new))

    def _learn(self) -> None:
        """Adds the new parts: their simple ones from words, the rest one by one."""
        new = [p.decode() for p in self.parts.place.new]
        split = [self.SIMPLE(p) for p in new]
        place = self.words.place.__getitem__
        pairs = [(place(m[1]), place(m[2]) if m[2] else -1) for m in split if m]
        self._learn_words()
        simple = np.fromiter((m is not None for m in split), dtype=bool, count=len(new))
        rest_ids, rest_lengths = self._encode([p for p, m in zip(new, split) if m is None])
        both = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        has_end = both[:, 1] >= 0
        used = both.ravel()[np.stack((np.ones(len(both), dtype=bool), has_end), axis=1).ravel()]
        self.words.count(used)
        ids, ends = self.words.of(used)
        made_lengths = np.diff(ends[np.concatenate(([0], np.cumsum(1 + has_end)))])
        lengths = np.empty(len(new), dtype=np.int64)
        lengths[simple], lengths[~simple] = made_lengths, rest_lengths
        out, of_simple = np.empty(int(lengths.sum()), dtype=np.uint32), np.repeat(simple, lengths)
        out[of_simple], out[~of_simple] = ids, rest_ids
        self.parts.add(out, lengths)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        for known in (self.parts, self.words):
            if len(known.place) > KNOWN:
                known.halve()
        get = self.parts.place.__getitem__
        parts = [self._split(t) for t in texts]
        per_text = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        at = np.fromiter(map(get, chain.from_iterable(parts)), dtype=np.int64, count=int(per_text.sum()))
        if self.parts.place.new:
            self._learn()
        self.parts.count(at)
        ids, ends = self.parts.of(at)
        return ids, np.diff(ends[np.concatenate(([0], np.cumsum(per_text)))])


_TOKENS: dict[str, WordTokens] = {}


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool) -> Callable:
    @flat.tidy
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _TOKENS:
            _TOKENS[path] = WordTokens(path)
        tokens = _TOKENS[path]
        for batch in batches:
            data, offsets = flat.bytes_of(batch.column(2))
            for lo, hi in flat.chunks(offsets, 4 * flat.CHUNK_BYTES):
                raw = data[offsets[lo] : offsets[hi]].tobytes()
                cuts = (offsets[lo : hi + 1] - offsets[lo]).tolist()
                ids, counts = tokens([raw[a:b] for a, b in zip(cuts, cuts[1:])])
                whole = np.full(len(ids) + hi - lo, end_id, dtype="<u4")
                stops = np.cumsum(counts + 1)
                keep = np.ones(len(whole), dtype=bool)
                keep[stops - 1] = False
                whole[keep] = ids
                n_pieces = -(-(counts + 1) // capacity)
                row = np.repeat(np.arange(hi - lo), n_pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                start = piece * capacity
                length = np.minimum(counts[row] + 1 - start, capacity)
                begin = (stops - counts - 1)[row] + start
                view = memoryview(whole.tobytes())
                sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist())]
                columns = [batch.column(0).slice(lo, hi - lo).take(pa.array(row)), batch.column(1).slice(lo, hi - lo).take(pa.array(row))]
                columns += [pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(sums, type=pa.int64())]
                names = ["k", "t", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([whole[a : a + n].tolist() for a, n in zip(begin.tolist(), length.tolist())], type=pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.record_batch(columns, names=names)

    return of


def pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(k, t, piece, start, length, ids_crc32[, ids]) for every document: its ids and ``end_id``, cut only where longer than capacity.

    A null text counts as empty and has ``end_id`` alone; a null id counts as the smallest; ``t`` tells apart rows that share an id.
    """
    schema = "k bigint, t bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    return packed(docs, key, text).select("k", "t", body(text)).mapInArrow(_pieces(path, capacity, end_id, with_ids), schema)


# ---- the plan, on the histogram of lengths


def _configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Whole-number parts of an optimal fractional cover of ``demand`` by configurations: column generation with a knapsack."""
    n, least = len(sizes), min(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    want = np.array(demand, dtype=float)
    for _ in range(60 * n):
        worth = np.linalg.solve(basis.T, np.ones(n))
        best = np.zeros(capacity + 1)
        pick = np.full(capacity + 1, -1)
        for lo in range(least, capacity + 1, least):  # a block only looks at blocks before it
            hi = min(lo + least, capacity + 1)
            best[lo:hi], pick[lo:hi] = best[lo - 1], -2
            for i, s in enumerate(sizes):
                frm = max(lo, s)
                if frm < hi:
                    value = best[frm - s : hi - s] + worth[i]
                    better = value > best[frm:hi] + 1e-12
                    best[frm:hi][better], pick[frm:hi][better] = value[better], i
        column, room = np.zeros(n), capacity
        if best[capacity] <= 1 + 1e-9:
            break
        while room >= least:
            while room > 0 and pick[room] == -2:
                room = (room // least) * least - 1
            if room < least or pick[room] < 0:
                break
            column[pick[room]] += 1
            room -= sizes[pick[room]]
        if column @ worth <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, column)
        have = np.linalg.solve(basis, want)
        ratio = np.where(step > 1e-9, np.maximum(have, 0) / np.where(step > 1e-9, step, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = column
    times = np.floor(np.maximum(np.linalg.solve(basis, want), 0) + 1e-9).astype(int)
    left, found = np.array(demand), []
    for j in np.argsort(-times):
        column = basis[:, j].astype(int)
        used = column > 0
        most = int(min(times[j], (left[used] // column[used]).min()))
        if most:
            left -= most * column
            found.append((column.tolist(), most))
    return found


class Plan:
    """Runs (length, first rank, last rank + 1, first sequence, documents per sequence) and the open room of each sequence range."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.capacity, self.left, self.next_rank = capacity, counts.astype(int).tolist(), [0] * (capacity + 1)
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.open: dict[int, list[tuple[int, int]]] = {}
        self.rooms: list[int] = []
        self.sequences = 0

    def take(self, length: int, n: int, sequence: int, per: int = 1) -> None:
        lo = self.next_rank[length]
        self.runs.append((length, lo, lo + n, sequence, per))
        self.next_rank[length] += n
        self.left[length] -= n

    def leave(self, room: int, sequence: int, n: int) -> None:
        if n and room:
            if not self.open.get(room):
                self.open[room] = []
                insort(self.rooms, room)
            self.open[room].append((sequence, n))

    def configure(self, share: int, groups: int) -> None:
        """Places large lengths, above capacity / share, by configurations of rounded sizes."""
        large = [n for n in range(self.capacity, self.capacity // share, -1) if self.left[n]]
        total = sum(self.left[n] for n in large)
        if not total:
            return
        most, members = -(-total // groups), [[]]  # runs [length, n] of each group, longest first
        for length in large:
            n = self.left[length]
            while n:
                room = most - sum(c for _, c in members[-1])
                if not room:
                    members.append([])
                    continue
                members[-1].append([length, min(n, room)])
                n -= min(n, room)
        sizes = [runs[0][0] for runs in members]
        merged: dict[int, list] = {}
        for size, runs in zip(sizes, members):
            merged.setdefault(size, []).extend(runs)
        sizes = list(merged)
        members = [merged[s] for s in sizes]
        for column, times in _configurations(sizes, [sum(c for _, c in runs) for runs in members], self.capacity):
            parts = [(self.sequences, times, self.capacity)]
            for group, copies in enumerate(column):
                for _ in range(copies):
                    filled = []
                    for sequence, n, room in parts:
                        while n:
                            run = members[group][0]
                            now = min(n, run[1])
                            self.take(run[0], now, sequence)
                            filled.append((sequence, now, room - run[0]))
                            sequence, n = sequence + now, n - now
                            run[1] -= now
                            if not run[1]:
                                members[group].pop(0)
                    parts = filled
            self.sequences += times
            for sequence, n, room in parts:
                self.leave(room, sequence, n)

    def best_fit(self) -> None:
        """Places all that is left, longest first, each document in the tightest sequence that has room."""
        for length in range(self.capacity, 0, -1):
            while self.left[length]:
                n, at = self.left[length], bisect_left(self.rooms, length)
                if at == len(self.rooms):
                    per = self.capacity // length
                    bins = -(-n // per)
                    sequence, room = self.sequences, self.capacity
                    self.sequences += bins
                else:
                    room = self.rooms[at]
                    sequence, bins = self.open[room].pop()
                    if not self.open[room]:
                        self.rooms.pop(at)
                    per = room // length
                full = min(bins, n // per)
                if full:
                    self.take(length, full * per, sequence, per)
                    self.leave(room - per * length, sequence, full)
                some = min(n - full * per, per) if full < bins else 0
                if some:
                    self.take(length, some, sequence + full, per)
                    self.leave(room - some * length, sequence + full, 1)
                rest = bins - full - bool(some)
                self.leave(room, sequence + full + bool(some), rest)


def plan(counts: np.ndarray, capacity: int) -> Plan:
    """The best of a few groupings; counts[n] is the number of documents of length n."""
    best = None
    for share in LARGE_SHARES:
        for groups in GROUPS:
            tried = Plan(counts, capacity)
            tried.configure(share, groups)
            tried.best_fit()
            if best is None or tried.sequences < best.sequences:
                best = tried
    return best


# ---- placement


def _look_up(runs: list[tuple[int, int, int, int, int]]) -> Callable:
    ordered = sorted(runs)
    table = np.array(ordered, dtype=np.int64).reshape(-1, 5)
    keys = table[:, 0] * (1 << 48) + table[:, 1]

    @flat.tidy
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            run = table[np.searchsorted(keys, length * (1 << 48) + rank, side="right") - 1]
            sequence = run[:, 3] + (rank - run[:, 1]) // np.maximum(run[:, 4], 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence)], names=[*batch.schema.names, "sequence_id"])

    return of


def pack(parts: DataFrame, capacity: int = 2048) -> DataFrame:
    """``parts`` (k, t, piece, start, length, ids_crc32) with sequence_id and offset; no sequence holds more than ``capacity``.

    The parts are written once, so that ranks and places rest on the same rows. The histogram that comes to the driver has at most
    ``capacity`` rows. Documents of one length are ranked in cells of a bounded number of rows, however many share that length.
    """
    parts = settle(parts, "pieces")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row["length"]] = row["n"]
    cells = max(8, int(-(-counts.max() // PER_CELL)))
    dealt = parts.withColumn("cell", F.pmod(F.xxhash64("k", "t", "piece"), F.lit(cells)))
    before = dealt.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = before.select("length", "cell", (F.sum("n").over(Window.partitionBy("length").orderBy("cell")) - F.col("n")).alias("before"))
    mine = F.row_number().over(Window.partitionBy("length", "cell").orderBy("k", "t", "piece"))
    ranked = dealt.withColumn("own", mine).join(before, ["length", "cell"]).select(*parts.columns, (F.col("before") + F.col("own") - 1).alias("rank"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema)
    placed = ranked.mapInArrow(_look_up(plan(counts, capacity).runs), f"{schema}, rank bigint, sequence_id bigint")
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(*parts.columns, "sequence_id", F.coalesce(F.sum("length").over(order), F.lit(0)).alias("offset"))


def sequences(placed: DataFrame, with_ids: DataFrame) -> DataFrame:
    """(sequence_id, ids): the tokens of each sequence, from placed parts and the same parts with their ids."""
    own = placed.select("k", "t", "piece", "sequence_id", "offset").join(with_ids.select("k", "t", "piece", "ids"), ["k", "t", "piece"])
    return own.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every document."""
    placed = pack(pieces(docs, path, capacity, end_id, key, text), capacity)
    return placed.select(F.when(F.col("k") != NULL_ID, F.col("k")).alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
