"""Texts as flat byte arrays: whole-column numpy steps for the tasks that read text.

A column of texts is one byte buffer and its offsets, as Arrow holds it. Words, shingles and windows are
found for all texts of a slice at once; no step loops over characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # texts are handled in slices of about this size, so that temporaries stay small

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

BASE = 0x9E3779B97F4A7C15 | 1  # odd, so its powers have inverses modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole rows of about `size` bytes; a longer row is a run of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last
        first = last


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            have = np.full(max(n, SLICE_BYTES + 4096), base, np.uint64)
            have[0] = 1
            have = np.multiply.accumulate(have)
        if n <= 4 * SLICE_BYTES:  # those of a single very long text are not kept
            _powers[base] = have
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Spans:
    """Byte spans [start, end) in a buffer, and the row that each lies in."""

    def __init__(self, start: np.ndarray, end: np.ndarray, row: np.ndarray):
        self.start, self.end, self.row = start, end, row

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        """A 64-bit value of each span's bytes: a polynomial over them, scrambled. Starts must not fall."""
        out = np.empty(len(self), np.uint64)
        if not len(self):
            return out
        # a stretch of the data at a time, so that temporaries stay small
        cuts = np.searchsorted(self.start, np.arange(self.start[0], self.start[-1] + SLICE_BYTES, SLICE_BYTES))
        for a, b in zip(cuts, np.append(cuts[1:], len(self))):
            if b > a:
                low = int(self.start[a])
                part = data[low: int(self.end[a:b].max())]
                sums = np.zeros(len(part) + 1, np.uint64)
                np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(part)), out=sums[1:])
                start = self.start[a:b] - low
                out[a:b] = (sums[self.end[a:b] - low] - sums[start]) * powers(INVERSE, len(part) + 1)[start]
        return mixed(out)


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Spans:
    """Maximal runs of bytes where `inside` holds; no run crosses a row's border."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return Spans(none, none, none)
    fresh = np.zeros(len(data) + 1, bool)  # the places where a row begins, and the end
    fresh[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | fresh[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | fresh[1:-1]
    first = np.flatnonzero(start)
    return Spans(first, np.flatnonzero(end) + 1, np.searchsorted(offsets, first, "right") - 1)


def rolling(values: np.ndarray, n: int, base: int = BASE) -> np.ndarray:
    """A 64-bit value of every n values in a row, by doubling; as many as there are full windows."""
    done, length = values.astype(np.uint64), 1
    out, out_length = None, 0
    rest = n
    while rest:
        if rest & 1:
            if out is None:
                out, out_length = done, length
            else:
                m = len(values) - out_length - length + 1
                if m <= 0:
                    return np.zeros(0, np.uint64)
                out = out[:m] * np.uint64(pow(base, length, 1 << 64)) + done[out_length: out_length + m]
                out_length += length
        rest >>= 1
        if rest:
            m = len(done) - length
            if m <= 0:
                return np.zeros(0, np.uint64)
            done = done[:m] * np.uint64(pow(base, length, 1 << 64)) + done[length: length + m]
            length *= 2
    return out


def sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    """The smallest of every n values in a row."""
    done, length = values, 1
    while 2 * length <= n:
        done = np.minimum(done[:-length], done[length:])
        length *= 2
    if length < n:
        done = np.minimum(done[: len(values) - n + 1], done[n - length: n - length + len(values) - n + 1])
    return done


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... for count[0] values, then the same for the next ones."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(count)
    return np.arange(total) - np.repeat(ends - count, count) + np.repeat(start, count)


def batches(stream: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
