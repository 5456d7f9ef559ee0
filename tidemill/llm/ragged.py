"""Texts of an Arrow batch as flat numpy arrays.

A batch becomes one byte array with document offsets, its words become start and end
positions with word offsets per document, and every later step (hashes, n-grams, counts per
document) is a whole-array operation. Work goes in slices of bounded bytes, so memory follows
the slice size or the longest single text, never the batch or the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

SLICE_BYTES = 3 << 19
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

# Words are runs of bytes other than blank, tab, line feed, vertical tab, form feed, return.
WORD_BYTE = np.ones(256, dtype=bool)
WORD_BYTE[[0x20, *range(0x09, 0x0E)]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every bit depends on all of them."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins; NULL is empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    elif pa.types.is_string(column.type):
        kind = np.int32
    else:
        column, kind = column.cast(pa.large_string()), np.int64
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of parts of ``batch``; a part holds about ``size`` bytes of text."""
    data, offsets = text_buffer(batch.column(column))
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        part = offsets[first : last + 1]
        yield batch.slice(first, last - first), data[part[0] : part[-1]], part - part[0]
        first = last


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs that start inside hand Python Arrow batches of ``size`` bytes; the session's setting returns after."""
    before = spark.conf.get(_BATCH_BYTES)
    spark.conf.set(_BATCH_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_BYTES, before)


class Words:
    """Words of the texts of one slice: ``starts``, ``ends``, and ``first`` per document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray = WORD_BYTE):
        self.data, self.offsets = data, offsets
        inside = word_byte[data]
        begins, finishes = inside.copy(), inside.copy()
        if len(data):
            begins[1:] &= ~inside[:-1]
            finishes[:-1] &= ~inside[1:]
            filled = offsets[1:] > offsets[:-1]
            heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
            begins[heads] = inside[heads]
            finishes[tails] = inside[tails]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(finishes) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def documents(self) -> np.ndarray:
        """Number of the document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes."""
    if not len(starts):
        return np.empty(0, np.uint64)
    powers, inverses = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts])


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each position on; the last ``n - 1`` positions have none."""
    size = max(len(words) - n + 1, 0)
    total = np.zeros(size, np.uint64)
    for k in range(n):
        total *= np.uint64(0xD6E8FEB86659FD93)
        total += words[k : k + size]
    return mix(total)


def ngram_starts(first: np.ndarray, n: int) -> np.ndarray:
    """Word positions at which a run of ``n`` words ends inside its document."""
    if first[-1] < n:
        return np.empty(0, np.int64)
    ok = np.ones(first[-1], bool)
    for k in range(1, n):
        at = first[1:] - k
        ok[at[at >= first[:-1]]] = False
    return np.flatnonzero(ok)


def per_document(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over the items ``first[d]`` to ``first[d + 1]`` of each document."""
    sums = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def sorted_runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of sorted ``keys`` and how often each occurs."""
    if not len(keys):
        return keys, np.empty(0, np.int64)
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[heads], np.diff(np.append(heads, len(keys)))
