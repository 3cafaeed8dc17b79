"""Vectorised words and shingles of Arrow text columns, for use inside tasks.

A word is a maximal run of digits, ASCII letters (lower-cased) and bytes of 0x80 and more, that is
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` over the UTF-8 text after lower-casing A-Z. A null text has no words.
Texts are handled as one flat byte buffer with offsets, a few MB at a time, and never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of text that are worked on at once; a longer text makes a chunk of its own.
CHUNK_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output bits."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z."""
    return _LOWER[data]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            row = np.full(size, base, U64)
            row[0] = 1
            _powers[i] = np.cumprod(row, dtype=U64)
    return _powers[0][:n], _powers[1][:n]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string or binary column; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    n, start = len(column), column.offset
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1 + start)[start:]
    data = column.buffers()[2]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `limit` bytes of text each."""
    _, offsets = flat(batch.column(text))
    at, n = 0, batch.num_rows
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(n, max(at + 1, to))
        yield batch.slice(at, to - at)
        at = to


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every word: row, first byte, byte after its end (both in `data`), 64-bit hash."""
    n = len(data)
    if not n:
        e = np.empty(0, np.int64)
        return e, e, e, np.empty(0, U64)
    low = _LOWER[data]
    is_word = _IS_WORD[low]
    first = is_word.copy()
    first[1:] &= ~is_word[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = is_word[heads]
    last = is_word.copy()
    last[:-1] &= ~is_word[1:]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[tails] = is_word[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    return row, starts, ends, spans_hash(low, starts, ends)


def word_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words of each row."""
    is_word = _IS_WORD[_LOWER[data]]
    first = is_word.copy()
    first[1:] &= ~is_word[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = is_word[heads]
    return np.diff(np.searchsorted(np.flatnonzero(first), offsets)).astype(np.int64)


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal strings get equal hashes wherever they stand."""
    n = len(data)
    power, inverse = powers(n + 1)
    sums = np.empty(n + 1, U64)
    sums[0] = 0
    np.cumsum((data.astype(U64) + U64(1)) * power[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U64))


def grams(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words, and the index of the first word of each; none crosses a row."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U64), np.empty(0, np.int64)
    acc = h[:n].copy()
    for j in range(1, k):
        acc = acc * U64(0x2545F4914F6CDD1D) + h[j : j + n]
    at = np.flatnonzero(row[:n] == row[k - 1 :])
    return mix(acc[at]), at


def shingles(h: np.ndarray, row: np.ndarray, rows: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes and their rows, in order; a row of fewer than k words, but not none, has one of all its words."""
    g, at = grams(h, row, k)
    grow = row[at]
    count = np.bincount(row, minlength=rows)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        begin = np.searchsorted(row, short)
        acc = np.zeros(len(short), U64)
        for j in range(k - 1):
            live = j < count[short]
            acc[live] = acc[live] * U64(0x2545F4914F6CDD1D) + h[np.minimum(begin + j, len(h) - 1)][live] + U64(1)
        g, grow = np.concatenate([g, mix(acc)]), np.concatenate([grow, short])
        order = np.argsort(grow, kind="stable")
        g, grow = g[order], grow[order]
    return g, grow


def minimizers(h: np.ndarray, row: np.ndarray, window: int) -> np.ndarray:
    """Indices chosen so that `window` consecutive entries of one row hold one at least: the rightmost least of each window.

    A row with fewer entries than `window` keeps its least entry.
    """
    n = len(h)
    if not n:
        return np.empty(0, np.int64)
    low, at, span = h.copy(), np.arange(n), 1
    while span < window:  # least of each run of `span` entries, doubling
        step = min(span, window - span)
        m = n - step
        if m > 0:
            same = row[:m] == row[step:]
            better = same & (low[step:] <= low[:m])
            low[:m][better] = low[step:][better]
            at[:m][better] = at[step:][better]
        span += step
    count = np.bincount(row - row[0])
    count = count[row - row[0]]
    begin = np.searchsorted(row, row)
    full = (np.arange(n) - begin + window <= count) | ((np.arange(n) == begin) & (count < window))
    return np.unique(at[full])
