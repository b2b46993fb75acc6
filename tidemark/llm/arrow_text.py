"""Vectorised text work on Arrow batches inside a Spark task.

The operators of this package send narrow columns through `mapInArrow`. A batch's texts lie one after the other in
one byte buffer, so splitting into words, hashing them and hashing runs of words are a few array passes over that
buffer. Texts are cut into slices of bounded bytes first, so that scratch arrays stay small whatever a batch holds;
one text longer than a slice is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_STEP = 0xD6E8FEB86659FD93


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of 256 flags, true inside the given closed ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Bytes of words that white space separates.
NOT_SPACE = ~byte_set((0x20, 0x20), (0x09, 0x0D))
#: Bytes of words of digits, lower-case letters and everything outside ASCII.
ALPHANUMERIC = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes stay."""
    return _LOWER[data]


def flat_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array and the n + 1 offsets of the texts in it; a null text is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    marks = np.frombuffer(offsets, dtype=np.int64, count=n + 1, offset=8 * column.offset)
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return held[marks[0] : marks[-1]], marks - marks[0]


def slices(marks: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most `limit` bytes together, or of one longer text."""
    at, n = 0, len(marks) - 1
    while at < n:
        end = int(np.searchsorted(marks, marks[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def word_spans(data: np.ndarray, marks: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of `inside` bytes in each text, and the number of words before each text."""
    flags = inside[data]
    before = np.empty_like(flags)
    after = np.empty_like(flags)
    if len(flags):
        before[0], after[-1] = False, False
        before[1:], after[:-1] = flags[:-1], flags[1:]
        edges = marks[(marks > 0) & (marks < len(flags))]
        before[edges] = False
        after[edges - 1] = False
    starts = np.flatnonzero(flags & ~before)
    ends = np.flatnonzero(flags & ~after) + 1
    return starts, ends, np.searchsorted(starts, marks)


_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    held = _powers.get(base)
    if held is None or len(held) < n:
        size = max(n, SLICE_BYTES + 1)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        held = np.multiply.accumulate(steps)
        if size <= 2 * SLICE_BYTES:
            _powers[base] = held
    return held[:n]


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective finisher on 64 bits, so that every bit depends on all others."""
    z = values.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, variant: int = 0) -> np.ndarray:
    """64-bit hash of the bytes of each span: a polynomial in an odd base, so a difference of two prefix sums.

    The two variants have different bases; together they give 128 bits.
    """
    n, base = len(data), _BASES[variant]
    terms = (data.astype(np.uint64) + np.uint64(1)) * _power_table(base, n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(terms, out=sums[1:])
    down = _power_table(pow(base, -1, 1 << 64), n + 1)
    return mix((sums[ends] - sums[starts]) * down[starts])


def sequence_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, variant: int = 0) -> np.ndarray:
    """64-bit hash of each span of a sequence of 64-bit values, as `span_hashes` has it for bytes."""
    base, n = _BASES[variant], len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(mix(values + np.uint64(variant)) * _power_table(base, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power_table(pow(base, -1, 1 << 64), n + 1)[starts])


def run_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of `k` consecutive values; n - k + 1 of them, runs across texts included."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = hashes[:n].copy()
    for j in range(1, k):
        total *= np.uint64(_STEP)
        total += hashes[j : j + n]
    return mix(total)


def cut_out(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The stretches of a byte buffer as texts; they may overlap."""
    sizes = ends - starts
    upto = np.concatenate(([0], np.cumsum(sizes)))
    flat = data[np.repeat(starts - upto[:-1], sizes) + np.arange(upto[-1])]
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(upto.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat)))


def counts_of(bounds: np.ndarray) -> np.ndarray:
    return np.diff(bounds)


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Array of lists from flat values and the length of each list."""
    marks = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=marks[1:])
    return pa.ListArray.from_arrays(pa.array(marks, pa.int32()), pa.array(values, kind))


def short_batches(batches: Iterator[pa.RecordBatch], column: int, limit: int = 4 * SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts have at most `limit` bytes together, or are one longer text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        marks = np.zeros(len(sizes) + 1, dtype=np.int64)
        np.cumsum(sizes, out=marks[1:])
        for first, last in slices(marks, limit):
            yield batch.slice(first, last - first)
