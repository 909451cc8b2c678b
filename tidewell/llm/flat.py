"""Texts of an Arrow batch as one run of bytes: words, word hashes and hashes of word runs, all by array operations.

A word is a maximal run of bytes other than space and 0x09-0x0D. Hashes are polynomial sums over a ring of 64 bits, so a hash of
any run of words costs two look-ups once the running sums are there.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache, wraps

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
CHUNK_BYTES = 1 << 19
_RING = (1 << 64) - 1
_BYTE_BASE, _WORD_BASE, _WORD_BASE_2 = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


def release() -> None:
    """Gives memory that a worker no longer uses back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A map over batches that releases memory when its task ends, as workers are used again by other stages."""

    @wraps(function)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            release()

    return run


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = values.astype(np.uint64, copy=True)
    x += np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & _RING)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@cache
def byte_values(fold_case: bool) -> np.ndarray:
    """A scrambled value for each byte; with fold_case, A-Z have those of a-z."""
    table = mix(np.arange(256, dtype=np.uint64), 7)
    if fold_case:
        table[65:91] = table[97:123]
    return table


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse, modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        n = max(n, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(n, b, dtype=np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        have = _POWERS[base] = (both[0], both[1])
    return have[0][:n], have[1][:n]


class RunHash:
    """Hashes of any run [start, stop) of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, base: int):
        n = len(values)
        up, self.down = powers(base, n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * up[:n], out=self.sums[1:])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.down[start]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row starts (n + 1 offsets); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    n = len(column)
    if n == 0 or places is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(n + 1, dtype=np.int64)
    offsets = np.frombuffer(places, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of some rows: byte starts and stops, first word of each row (n + 1), row of each word, 64-bit hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, fold_case: bool = False):
        self.data, self.offsets = data, offsets
        inside = np.zeros(len(data) + 2, dtype=bool)
        np.logical_not(SPACE[data], out=inside[1:-1])
        starts = inside[1:-1] & ~inside[:-2]
        stops = inside[1:-1] & ~inside[2:]
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        starts[inner] = inside[1 + inner]  # a row's first byte starts a word, whatever ends the row before
        stops[inner - 1] = inside[inner]
        self.starts = np.flatnonzero(starts)
        self.stops = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offsets) - 1), self.counts)
        runs = RunHash(byte_values(fold_case)[data], _BYTE_BASE)
        self.hashes = mix(runs(self.starts, self.stops) ^ mix((self.stops - self.starts).astype(np.uint64), 3))

    def __len__(self) -> int:
        return len(self.starts)

    def runs(self) -> RunHash:
        return RunHash(self.hashes, _WORD_BASE)

    def second_runs(self) -> RunHash:
        """Hashes independent of those of runs(); both together have 128 bits."""
        return RunHash(mix(self.hashes, 11), _WORD_BASE_2)


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each, one row at least."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1
        hi = min(max(hi, lo + 1), n, lo + 4096)
        yield lo, hi
        lo = hi


def word_chunks(column: pa.Array, fold_case: bool = False) -> Iterator[tuple[int, int, Words]]:
    """The words of a batch, some rows at a time, so that scratch arrays stay small."""
    data, offsets = bytes_of(column)
    for lo, hi in chunks(offsets):
        yield lo, hi, Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], fold_case)


def signed(values: np.ndarray) -> pa.Array:
    """64-bit hashes as an Arrow column of bigint."""
    return pa.array(values.view(np.int64))
