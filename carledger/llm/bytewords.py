"""Words and shingles of whole Arrow batches, found and hashed on the UTF-8 bytes with numpy.

A `table` of 256 entries says what each byte is: 0 separates words, any other value is the (lower-cased) byte of a word.
Word hashes are 64 bits of a polynomial over random byte values, mixed at the end. They are the same in every task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 512 << 10  # bytes hashed at once; a longer document is a chunk of its own, whole
_BASE = 0x9E3779B97F4A7C15  # odd
_MASK = (1 << 64) - 1


def space_table() -> np.ndarray:
    """Words are runs of anything but space and \\x09-\\x0D; A-Z are lower-cased."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[[0x20, 9, 10, 11, 12, 13]] = 0
    return table


def alnum_table() -> np.ndarray:
    """Words are runs of 0-9, letters and anything beyond ASCII; A-Z are lower-cased."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    keep = np.zeros(256, bool)
    keep[0x30:0x3A] = keep[0x61:0x7B] = keep[65:91] = keep[128:] = True
    table[~keep] = 0
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Hashes segments of a byte buffer through prefix sums of its polynomial."""

    def __init__(self, seed: int = 7):
        values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)) | np.uint64(1)
        self.values = values
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
            ones = np.ones(n, np.uint64)
            ones[1:] = base
            self.powers = np.cumprod(ones)
            ones[1:] = inverse
            self.inverses = np.cumprod(ones)

    def segments(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash for each data[start:end]."""
        self._reach(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])
        raw = (sums[end] - sums[start]) * self.inverses[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words(NamedTuple):
    """The words of some consecutive documents."""

    first: int  # index of the first document
    docs: int  # number of documents
    doc: np.ndarray  # of each word: its document, from 0
    start: np.ndarray  # byte range of each word in `data`
    end: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray  # words of document d: offsets[d]:offsets[d + 1]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a text column; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about `size` bytes together, at least one document each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def batch_words(column: pa.Array, table: np.ndarray, hasher: Hasher) -> Iterator[Words]:
    """The words of a text column, chunk by chunk; every document of the column occurs in exactly one chunk."""
    data, offsets = text_buffer(column)
    for i, j in chunks(offsets):
        lo = offsets[i]
        part, ends = table[data[lo : offsets[j]]], offsets[i + 1 : j + 1] - lo
        starts_at = offsets[i:j] - lo
        inside = part != 0
        opens, closes = inside.copy(), np.zeros(len(part) + 1, bool)
        opens[1:] &= ~inside[:-1]
        first = starts_at[starts_at < ends]  # of documents that aren't empty
        opens[first] = inside[first]
        closes[1:] = inside
        closes[1:-1] &= ~inside[1:]
        edge = ends[starts_at < ends]
        closes[edge] = inside[edge - 1]
        start, end = np.flatnonzero(opens), np.flatnonzero(closes)
        bounds = np.zeros(j - i + 1, np.int64)
        bounds[1:] = np.searchsorted(start, ends, "left")
        doc = np.repeat(np.arange(j - i), np.diff(bounds))
        yield Words(i, j - i, doc, start, end, hasher.segments(part, start, end), bounds)


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of each run of `width` words of one document."""
    n = len(words.hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(words.doc[:n] == words.doc[width - 1 :])
    return at, run_hash(words.hashes, at, width)


def run_hash(hashes: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """A hash of hashes[i : i + width] for each i of `at`."""
    total = np.full(len(at), np.uint64(width))
    for k in range(width):
        total = mix(total * np.uint64(0xD1B54A32D192ED03) + hashes[at + k])
    return total


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs values[starts[i] : starts[i] + sizes[i]] for each i of `which`, one after the other."""
    n = sizes[which]
    shift = starts[which] - (np.cumsum(n) - n)
    return values[np.repeat(shift, n) + np.arange(n.sum())]


def slices(batch: pa.RecordBatch, sizes: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose sizes add up to about `most`, at least one row each."""
    size, first = 0, 0
    for i, n in enumerate(sizes.to_pylist()):
        size += n or 0
        if size >= most:
            yield batch.slice(first, i + 1 - first)
            size, first = 0, i + 1
    if first < batch.num_rows:
        yield batch.slice(first)


def tidied(run):
    """`run` over the batches of a partition, after which the worker, which lives on, gives unused memory back."""

    def inner(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return inner


def list_array(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from all values in order and the size of each list."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
