"""Words, word hashes and window hashes of many texts at once.

A batch of texts is one run of UTF-8 bytes with offsets, as Arrow keeps it. Everything below is a handful of passes
over that run, so no Python object is made per word. Hashes are 64 bits: sums of keyed bytes times powers of an odd
base, which prefix sums give for any span, then a finalizer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


KEYED = mix(np.arange(1, 257, dtype=U) * U(BYTE_BASE))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, up to n."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        size = max(1 << 16, 1 << int(n + 1).bit_length())
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, U)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        have = _powers[base] = (tables[0], tables[1])
    return have


def span_sums(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each span the sum of value times base to the power of its place in the span."""
    up, down = powers(base, len(values))
    total = np.zeros(len(values) + 1, U)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of text, so that arrays stay small; no row is cut."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


class Words:
    """The words of a batch: byte spans, hashes, and for each row the range of its words."""

    def __init__(self, column: pa.Array, separator: np.ndarray = SPACE, fold: np.ndarray | None = None) -> None:
        self.raw, self.offsets = texts_of(column)
        if fold is not None:
            self.raw = fold[self.raw]
        inside = ~separator[self.raw]
        row_start = np.zeros(len(self.raw) + 1, bool)
        row_start[self.offsets] = True
        before = np.zeros(len(self.raw), bool)
        before[1:] = inside[:-1]
        before[row_start[:-1]] = False
        after = np.zeros(len(self.raw), bool)
        after[:-1] = inside[1:]
        after[row_start[1:]] = False
        self.inside = inside
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.hashes = mix(span_sums(KEYED[self.raw], BYTE_BASE, self.starts, self.ends) + (self.ends - self.starts).astype(U))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Start word and hash of every run of ``size`` words that lies in one row."""
        return windows(self.hashes, self.bounds, size)


def windows(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    counts = np.maximum(np.diff(bounds) - size + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    starts = bounds[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    return starts, mix(span_sums(hashes, WORD_BASE, starts, starts + size) + U(size))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def cover(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in one of the spans."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values over the rows' ranges; empty ranges give 0."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
