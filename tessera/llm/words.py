"""Word spans and 64-bit word hashes of Arrow string columns, vectorised.

Works on the UTF-8 bytes of whole texts. A word is a maximal run of bytes
that a 256-entry table marks; A-Z are folded to a-z before hashing. A word's
hash is a polynomial over random byte values mod 2**64 (taken from one prefix
sum), then mixed. Rows are handled in blocks of at most ``max_bytes`` (one
longer row makes a block of its own), so memory does not follow the batch."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20

_rng = np.random.default_rng(20240229)
_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUES[65:91] = _VALUES[97:123]          # A-Z hash as a-z
_BASE = int(_rng.integers(2**62, 2**63)) | 1
_BASE_INV = pow(_BASE, -1, 2**64)

#: [^\x20\x09-\x0D]+
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, 9, 10, 11, 12, 13]] = False
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64, kept between calls up to a block's size."""
    have = _powers.get(base)
    if have is not None and len(have) >= n:
        return have[:n]
    size = max(n, 1 << 16)
    out = np.full(size, np.uint64(base), np.uint64)
    out[0] = 1
    out = np.multiply.accumulate(out)
    if size <= 2 * BLOCK_BYTES:
        _powers[base] = out
    return out[:n]


def text_array(column) -> pa.Array:
    """A plain string array with nulls read as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column, "")


def raw(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string array without nulls."""
    n = len(array)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = array.buffers()
    kind = np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else np.int32
    offsets = np.frombuffer(off, kind)[array.offset:array.offset + n + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` (or one row)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def spans(data: np.ndarray, offsets: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts and ends (byte positions) and the number of the first word
    of each row (len(rows) + 1 values); words end at row ends."""
    inside = marks[data]
    if not inside.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    begins[cuts] = inside[cuts]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    stops[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes (A-Z as a-z)."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_VALUES[data] * powers(_BASE, len(data)), out=sums[1:])
    out = sums[ends] - sums[starts]
    del sums
    out *= powers(_BASE_INV, len(data))[starts]
    return mix(out + (ends - starts).astype(np.uint64))


def rows_words(array: pa.Array, marks: np.ndarray, max_bytes: int = BLOCK_BYTES):
    """For each block of rows: (first row, past-last row, word hashes, first
    word of each row)."""
    data, offsets = raw(array)
    for i, j in blocks(offsets, max_bytes):
        part = data[offsets[i]:offsets[j]]
        s, e, first = spans(part, offsets[i:j + 1] - offsets[i], marks)
        yield i, j, hashes(part, s, e), first


def grams(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words that stay within a row, and the number of
    the first one of each row."""
    n = len(h) - k + 1
    counts = np.diff(first)
    each = np.maximum(counts - k + 1, 0)
    begin = np.concatenate([[0], np.cumsum(each)])
    if n <= 0 or begin[-1] == 0:
        return np.zeros(0, np.uint64), begin * 0
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j:n + j]
        out ^= out >> np.uint64(29)
    keep = np.repeat(first[:-1], each) + (np.arange(begin[-1]) - np.repeat(begin[:-1], each))
    return mix(out[keep]), begin


@lru_cache(maxsize=1)
def _malloc_trim():
    try:
        return ctypes.CDLL(None).malloc_trim       # glibc
    except (OSError, AttributeError):
        return None


def release() -> None:
    """Give memory that is free in this process back to the system."""
    pa.default_memory_pool().release_unused()
    trim = _malloc_trim()
    if trim is not None:
        trim(0)


def tidy(run):
    """``run`` over batches, with free memory given back when it ends: Spark
    keeps its Python workers, so what they hold on to adds to later stages."""
    @wraps(run)
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            release()
    return tidied


def small_batches(spark, rows: int = 512) -> None:
    """Arrow batches of at most ``rows`` rows: bounded memory in the workers
    however long the texts are."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows or int(spark.conf.get(key, "10000")) <= 0:
        spark.conf.set(key, str(rows))
