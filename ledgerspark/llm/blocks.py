"""Whole texts as numpy arrays: byte blocks, words, rolling hashes, sliding minima.

Used inside Arrow tasks. A block holds the texts of consecutive rows, about half
a megabyte, or one longer text; texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19
#: Positions in a block take the low bits of packed minima (a text has less than 2 GB).
POS_BITS = 31
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Letters lower-cased, bytes of other scripts kept, everything else a space.
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)
U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, hence invertible modulo 2^64
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a lane's base and of its inverse modulo 2^64, at least ``n`` of each."""
    if lane not in _tables or len(_tables[lane][0]) < n:
        size = max(n, BLOCK + 4096)
        out = []
        for b in (_BASES[lane], pow(_BASES[lane], -1, 1 << 64)):
            p = np.full(size, U(b))
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _tables[lane] = tuple(out)
    return _tables[lane]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Rolling:
    """Hashes of any ranges of a sequence, from one prefix sum. Equal ranges have equal hashes."""

    def __init__(self, values: np.ndarray, lane: int = 0):
        n = len(values)
        self.power, self.inverse = _powers(lane, n + 1)
        self.sums = np.zeros(n + 1, U)
        np.cumsum(values * self.power[:n], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(U) * U(0xA0761D6478BD642F))

    def windows(self, width: int) -> np.ndarray:
        """Of every window of ``width``."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, U)
        return mix((self.sums[width:] - self.sums[:n]) * self.inverse[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width``, by doubling."""
    have = 1
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:n], x[width - have:width - have + n]) if have < width else x


def runs(length: np.ndarray, offsets: np.ndarray, values: np.ndarray, width: int, part: int):
    """Windows of ``width`` grouped by anchor.

    A window's anchor is the leftmost of its part windows with the least hash, so
    equal windows have equal anchors at equal places. ``values`` are the hashes
    of the windows of ``part`` over the block, ``offsets`` where each text begins
    and ends. Returns (first window, number of windows, anchor position) of each
    run of windows that share an anchor.
    """
    none = np.zeros(0, np.int64)
    if length < width:
        return none, none, none
    at = np.arange(len(values), dtype=U)
    low = sliding_min((values >> U(POS_BITS) << U(POS_BITS)) | at, width - part + 1)
    begin, last = offsets[:-1], offsets[1:] - width
    fit = last >= begin
    if not fit.any():
        return none, none, none
    mark = np.zeros(length + 2, np.int64)
    np.add.at(mark, begin[fit], 1)
    np.add.at(mark, last[fit] + 1, -1)
    start = np.flatnonzero(np.cumsum(mark[:len(low)]) > 0)
    anchor = (low[start] & U((1 << POS_BITS) - 1)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1))))
    count = np.diff(np.append(new, len(start)))
    return start[new], count, anchor[new]


class Block:
    """Rows of an Arrow batch with their texts as one byte array."""

    def __init__(self, rows: pa.RecordBatch, column: str = "text"):
        self.rows = rows
        text = rows.column(rows.schema.get_field_index(column)).cast(pa.large_binary())
        n = len(text)
        off = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + n + 1] if n else np.zeros(1, np.int64)
        data = text.buffers()[2]
        self.bytes = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
        self.offsets = off - off[0]

    def lower(self) -> None:
        """Lower-case A to Z."""
        self.bytes = _LOWER[self.bytes]

    def letters(self) -> None:
        """Lower-case A to Z and make words of letters only."""
        self.bytes = _LETTERS[self.bytes]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte and end of every word, and where each text's words begin and end."""
        space, n = _SPACE[self.bytes], len(self.bytes)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(self.offsets), np.int64)
        edge = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        before = np.concatenate(([True], space[:-1]))
        before[edge] = True
        after = np.concatenate((space[1:], [True]))
        after[edge - 1] = True
        start = np.flatnonzero(before & ~space)
        end = np.flatnonzero(after & ~space) + 1
        return start, end, np.searchsorted(start, self.offsets)

    def word_hashes(self, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
        return Rolling(self.bytes.astype(U) + U(1), lane).ranges(start, end)


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK) -> Iterator[Block]:
    """The rows of Arrow batches in blocks."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
        off = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        i = 0
        while i < len(text):
            j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
            yield Block(batch.slice(i, j - i), column)
            i = j
