"""Vectorised word and shingle hashing over Arrow text columns.

One pass of numpy over the UTF-8 bytes of a batch finds the words (maximal
runs of non-separator bytes) of every text and a 64-bit hash for each. Texts
are taken in chunks of about half a MB, so memory stays bounded whatever the size of
an Arrow batch; a text is never cut, a longer one forms a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
CHUNK_BYTES = 1 << 19

_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective)."""
    h = h ^ (h >> np.uint64(33))
    h = h * _M1
    h ^= h >> np.uint64(33)
    h *= _M2
    h ^= h >> np.uint64(33)
    return h


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, ``n`` at least; kept unless a single long text asks for more."""
    global _powers
    if n > 4 * CHUNK_BYTES:
        return tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)])) for b in (_BASE, _INV))
    if len(_powers[0]) < n:
        _powers = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)]))
                        for b in (_BASE, _INV))
    return _powers


def byte_tables(separators: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(is separator, random value) per byte; ``lower`` gives A-Z the values of a-z."""
    sep = np.zeros(256, bool)
    sep[list(separators)] = True
    val = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    if lower:
        val[65:91] = val[97:123]
    return sep, val


SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
WORDS = byte_tables(SPACES, lower=False)
LOWER_WORDS = byte_tables(SPACES, lower=True)
#: Lower-cased words without ASCII punctuation, which separates too.
BARE_WORDS = byte_tables(SPACES + bytes(b for b in range(33, 127) if not chr(b).isalnum()), lower=True)


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; NULL counts as empty."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not (pa.types.is_string(a.type) or pa.types.is_large_string(a.type)):
        a = a.cast(pa.large_string())
    if a.null_count:
        a = a.fill_null("")
    if len(a) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    # the batch's own buffers, not a copy
    kind = np.int64 if pa.types.is_large_string(a.type) else np.int32
    off = np.frombuffer(a.buffers()[1], kind)[a.offset:a.offset + len(a) + 1].astype(np.int64)
    data = np.frombuffer(a.buffers()[2] or b"", np.uint8)
    return data, off


def chunks(off: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) of about ``size`` bytes, one row at least."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, side="right")) - 1)
        yield lo, hi
        lo = hi


def word_spans(data, off, lo, hi, tables):
    """Of rows [lo, hi): bytes, word starts and ends in them, words' first index per row (hi - lo + 1)."""
    base = off[lo]
    buf, bounds = data[base:off[hi]], off[lo:hi + 1] - base
    sep = tables[0][buf]
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return buf, z, z, np.zeros(hi - lo + 1, np.int64)
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = True, sep[:-1]
    after[-1], after[:-1] = True, sep[1:]
    inner = bounds[(bounds > 0) & (bounds < n)]
    before[inner], after[inner - 1] = True, True
    word = ~sep
    starts, ends = np.flatnonzero(word & before), np.flatnonzero(word & after) + 1
    return buf, starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data, off, lo, hi, tables, prefixes: tuple[int, ...] = ()):
    """Of rows [lo, hi): word hashes, words' first index per row (hi - lo + 1).

    Each of ``prefixes`` adds a hash for every word: that of its first so many bytes.
    """
    buf, starts, ends, first = word_spans(data, off, lo, hi, tables)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), first * (1 + len(prefixes))
    up, down = _pow(len(buf) + 1)
    total = np.empty(len(buf) + 1, np.uint64)
    total[0] = 0
    np.cumsum(tables[1][buf] * up[:len(buf)], out=total[1:])
    h = [mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))]
    for k in prefixes:
        h.append(mix((total[np.minimum(starts + k, ends)] - total[starts]) * down[starts] - np.uint64(k)))
    return (h[0], first) if len(h) == 1 else (np.column_stack(h).reshape(-1), first * len(h))


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word windows and their first index per row; a row
    with fewer words has one of its whole sequence, one without words none."""
    n = np.diff(first)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    out_first = np.concatenate([[0], np.cumsum(count)])
    factor = [np.uint64(pow(_BASE, 2 * j + 3, 1 << 64)) for j in range(size)]
    out = np.empty(out_first[-1], np.uint64)
    full = np.repeat(n >= size, count)
    if len(words) >= size and full.any():
        m = len(words) - size + 1
        h = np.zeros(m, np.uint64)
        for j in range(size):
            h += words[j:j + m] * factor[j]
        start = np.repeat(first[:-1] - out_first[:-1], count) + np.arange(out_first[-1])
        out[full] = mix(h[start[full]])
    for k in range(1, size):
        rows = np.flatnonzero(n == k)
        if len(rows):
            h = np.full(len(rows), k, np.uint64) * np.uint64(_BASE)
            for j in range(k):
                h += words[first[rows] + j] * factor[j]
            out[out_first[rows]] = mix(~h)
    return out, out_first


def text_rows(batch: pa.RecordBatch, text: str, tables, size: int | None = None, prefixes: tuple[int, ...] = ()):
    """Yields (row, hashes) per row: word (and prefix) hashes, or shingle hashes if ``size`` is given."""
    data, off = text_buffers(batch.column(text))
    for lo, hi in chunks(off):
        h, first = word_hashes(data, off, lo, hi, tables, prefixes)
        if size:
            h, first = shingle_hashes(h, first, size)
        for i in range(hi - lo):
            yield lo + i, h[first[i]:first[i + 1]]
