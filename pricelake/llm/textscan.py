"""Vectorised scans over whole Arrow string columns.

A batch is taken as one byte buffer and its offsets; words, their 64-bit hashes and word n-grams
come from a few numpy passes over that buffer, with no Python work per word.  ``pieces`` cuts a
batch so that a pass holds about ``limit`` bytes of text (a longer text is a piece of its own), so
working memory is a constant multiple of max(limit, longest text).

A word is a run of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased.  Word hashes are
``sum(T[byte] * B^i) mod 2^64`` over random ``T``, mixed with the word's length; two different
words share one with a probability of about 2^-60.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_rng = np.random.default_rng(20240917)
BYTE_CODE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_CODE = BYTE_CODE[LOWER]
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 2**64)
_powers: list[np.ndarray] = [np.ones(1, dtype=U), np.ones(1, dtype=U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^i and B^-i for i < n, kept for the next call while they are small."""
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    out = []
    for base in (BASE, _INVERSE):
        p = np.full(n, base, dtype=U)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    if n <= 1 << 21:
        _powers[:] = out
    return out[0], out[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in short slices (no copies), so that what a task makes of one stays small."""
    for batch in batches:
        for lo in range(0, len(batch), rows):
            yield batch.slice(lo, rows)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if pa.types.is_large_string(column.type) \
        or pa.types.is_large_binary(column.type) else column.cast(pa.binary())
    if column.null_count:
        column = column.fill_null(b"")
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[
        column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of consecutive pieces of the column."""
    data, offsets = text_buffers(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end (exclusive) byte of every word, and the index of the first word of each row
    (one more entry than rows)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    gap = SEPARATOR[data]
    cut = np.zeros(n + 1, dtype=bool)       # a row begins here
    cut[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = True
    before[1:] = gap[:-1]
    before |= cut[:n]
    after = np.empty(n, dtype=bool)
    after[-1] = True
    after[:-1] = gap[1:]
    after |= cut[1:]
    word = ~gap
    starts = np.flatnonzero(word & before)
    ends = np.flatnonzero(word & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, A-Z lower-cased."""
    if len(starts) == 0:
        return np.zeros(0, U)
    up, down = powers(len(data))
    total = np.empty(len(data) + 1, dtype=U)
    total[0] = 0
    np.cumsum(BYTE_CODE[data] * up, out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words (runs over row ends included)."""
    if len(h) < n:
        return np.zeros(0, U)
    out = np.zeros(len(h) - n + 1, dtype=U)
    for k in range(n):
        out = mix(out * U(BASE) + h[k:len(h) - n + 1 + k] + U(k + 1))
    return out
