"""Words of UTF-8 text as 64-bit hashes, whole Arrow batches at a time.

A word's hash is a polynomial over its bytes modulo 2**64, taken from one running sum over the block,
so the cost per byte is the same for short and long words. All values are fixed by ``SEED``: every
executor and every retry computes the same hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEED = 20240229
#: Bytes of text that are hashed at a time; temporary arrays take some forty times as much.
BLOCK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 3)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(fold: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(SEED))
    if fold:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


def is_space() -> np.ndarray:
    """For each byte, whether it separates words: blank and the control characters 9 to 13."""
    out = np.zeros(256, dtype=bool)
    out[[0x20, *range(0x09, 0x0E)]] = True
    return out


def is_not_word() -> np.ndarray:
    """For each byte, whether it is ASCII but neither letter nor digit."""
    out = np.zeros(256, dtype=bool)
    out[:128] = True
    for first, last in ("09", "az", "AZ"):
        out[ord(first) : ord(last) + 1] = False
    return out


@dataclass(frozen=True)
class WordBlock:
    """Consecutive rows ``first`` to ``last`` (exclusive) and their words.

    Row ``first + k`` has the bytes from ``offsets[k]`` on and the words from ``at[k]`` on, each to the next entry.
    """

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray
    words: np.ndarray
    start: np.ndarray
    end: np.ndarray
    at: np.ndarray

    def rows(self) -> Iterator[tuple[int, np.ndarray]]:
        """Number of each row and its word hashes."""
        for k in range(self.last - self.first):
            yield self.first + k, self.words[self.at[k] : self.at[k + 1]]


class WordHasher:
    """Cuts text at separator bytes and hashes the words between them."""

    def __init__(self, separators: np.ndarray, fold: bool = False) -> None:
        self.separators, self.values = separators, _byte_values(fold)
        self._up = self._down = np.ones(1, dtype=np.uint64)

    def __getstate__(self) -> dict:
        """Without the powers, which every worker makes for itself."""
        return self.__dict__ | {"_up": np.ones(1, np.uint64), "_down": np.ones(1, np.uint64)}

    def _powers(self, n: int) -> None:
        if len(self._up) <= n:
            size = max(n + 1, BLOCK_BYTES + 4096)
            for name, base in (("_up", _BASE), ("_down", _INVERSE)):
                powers = np.full(size, base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers, dtype=np.uint64))

    def bounds(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end of each word of ``data``."""
        inside = np.empty(len(data) + 2, dtype=np.int8)
        inside[0] = inside[-1] = 0
        np.logical_not(self.separators[data], out=inside[1:-1].view(bool))
        change = np.flatnonzero(inside[1:] != inside[:-1])
        return change[::2], change[1::2]

    def hashes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first byte and end of each word; ``data`` is hashed as one piece."""
        start, end = self.bounds(data)
        self._powers(len(data))
        total = np.empty(len(data) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(self.values[data] * self._up[: len(data)], out=total[1:])
        raw = (total[end] - total[start]) * self._down[start]
        return mix(raw + (end - start).astype(np.uint64)), start, end

    def texts(self, column: pa.Array) -> Iterator[WordBlock]:
        """The rows of ``column`` in blocks. NULL has no words. A row longer than a block is hashed in several pieces
        that are cut between words."""
        for first, last, data, offsets in text_blocks(column):
            found = [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))]
            for lo, hi in self._pieces(data):
                h, start, end = self.hashes(data[lo:hi])
                found.append((h, start + lo, end + lo))
            words, start, end = map(np.concatenate, zip(*found, strict=True))
            yield WordBlock(first, last, data, offsets, words, start, end, np.searchsorted(start, offsets))

    def beginnings(self, block: WordBlock, size: int) -> np.ndarray:
        """Hashes of the first ``size`` bytes of each word of a block, or of the whole of shorter words."""
        ends = np.minimum(block.end, block.start + size)
        out = np.zeros(len(ends), np.uint64)
        for k in range(size):
            at = block.start + k
            inside = at < ends
            out = np.where(inside, out + self.values[block.data[np.minimum(at, len(block.data) - 1)]] * self._power(k), out)
        return mix(out + np.minimum(size, block.end - block.start).astype(np.uint64))

    def _power(self, k: int) -> np.uint64:
        self._powers(k)
        return self._up[k]

    def _pieces(self, data: np.ndarray) -> Iterator[tuple[int, int]]:
        lo = 0
        while lo < len(data):
            hi = min(len(data), lo + BLOCK_BYTES)
            while hi < len(data) and not self.separators[data[hi]]:
                step = np.flatnonzero(self.separators[data[hi : hi + BLOCK_BYTES]])
                hi = hi + int(step[0]) if len(step) else min(len(data), hi + BLOCK_BYTES)
            yield lo, hi
            lo = hi


def text_blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of about ``size`` bytes, joined by one line feed each: first row, end row, bytes, row starts.

    The starts have one entry more than rows; a row's bytes end one before the next row's start.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, buffer, body = column.buffers()
    ends = np.frombuffer(buffer, np.int64, n + 1, column.offset * 8)
    body = np.frombuffer(body, np.uint8) if body is not None and body.size else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + size, side="right")) - 1)
        last = min(last, n)
        lengths = np.diff(ends[first : last + 1])
        offsets = np.zeros(last - first + 1, np.int64)
        np.cumsum(lengths + 1, out=offsets[1:])
        data = np.full(int(offsets[-1]), 10, np.uint8)
        at = np.ones(len(data), bool)
        at[offsets[1:] - 1] = False
        data[at] = body[ends[first] : ends[last]]
        yield first, last, data, offsets
        first = last


def text_slices(batch: pa.RecordBatch, column: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` whose texts have about ``size`` bytes together, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first, n = 0, batch.num_rows
    while first < n:
        done = ends[first - 1] if first else 0
        last = min(n, max(first + 1, int(np.searchsorted(ends, done + size, side="right"))))
        yield batch.slice(first, last - first)
        first = last

