"""Vectorised word hashing of Arrow string columns (numpy, used inside tasks).

A word's 64-bit hash is a polynomial over per-byte random values, read off a running
sum of the byte buffer, so a batch needs no Python loop over words. Buffers are handled
in blocks cut between words: memory is a few times ``BLOCK`` (or the longest word).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20  # bytes hashed at once

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = ~SPACE
# Letters and digits of ASCII, and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
for _lo, _hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
    ALNUM[_lo:_hi] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = BLOCK if n <= BLOCK else n
    if size not in _powers:
        one = np.ones(1, np.uint64)
        with np.errstate(over="ignore"):
            tables = tuple(np.cumprod(np.concatenate([one, np.full(size, p, np.uint64)]))
                           for p in (_P, _P_INV))
        if size > BLOCK:
            return tables  # a single huge word: not kept
        _powers[size] = tables
    return _powers[size]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    off = off.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def row_slices(column: pa.Array, size: int = 1 << 20) -> list[tuple[int, int]]:
    """Consecutive row ranges of about ``size`` text bytes (one row at least), so that a
    batch's temporary arrays stay small whatever the batch holds."""
    off = text_buffer(column)[1]
    cuts, at = [], 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1)
        cuts.append((at, end))
        at = end
    return cuts


def _hash_block(raw: np.ndarray, m: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                lower: bool) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    pow_up, pow_down = _power_tables(len(raw))
    with np.errstate(over="ignore"):
        values = (_BYTE[LOWER] if lower else _BYTE)[raw]
        values *= pow_up[:len(raw)]
        total = np.cumsum(values)
        before = np.where(starts > 0, total[np.maximum(starts - 1, 0)], np.uint64(0))
        h = (total[ends - 1] - before) * pow_down[starts]
        return mix(h + (ends - starts).astype(np.uint64))


def word_hashes(column: pa.Array, word_bytes: np.ndarray = NOT_SPACE,
                lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of the column in order, first word index of each row + total).

    ``word_bytes``: which bytes belong to words; ``lower``: fold A-Z.
    """
    raw, off = text_buffer(column)
    parts: list[np.ndarray] = []
    counts = np.zeros(len(off), np.int64)  # words that start before each row's offset
    n_words, at, size = 0, 0, len(raw)
    while at < size:
        end = min(at + BLOCK, size)
        while end < size:  # cut between words: at a row start or at a non-word byte
            cut = off[np.searchsorted(off, end, "right") - 1]
            if cut > at:
                end = int(cut)
                break
            gaps = np.flatnonzero(~word_bytes[raw[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(end + BLOCK, size)
        block = raw[at:end]
        m = word_bytes[block]
        lo, hi = np.searchsorted(off, at, "left"), np.searchsorted(off, end, "left")
        inner = off[lo:hi] - at  # row starts inside the block
        prev = np.empty(len(m), bool)
        prev[0] = False
        prev[1:] = m[:-1]
        prev[inner] = False
        starts = np.flatnonzero(m & ~prev)
        stop = np.empty(len(m), bool)
        stop[-1] = True
        stop[:-1] = ~m[1:]
        stop[inner[inner > 0] - 1] = True
        ends = np.flatnonzero(m & stop) + 1
        counts[lo:hi] = n_words + np.searchsorted(starts, inner, "left")
        parts.append(_hash_block(block, m, starts, ends, lower))
        n_words += len(starts)
        at = end
    counts[np.searchsorted(off, size, "left"):] = n_words
    counts[-1] = n_words
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), counts


# Fixed odd multipliers that make a window's hash depend on word positions.
POSITION = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def window_hashes(words: np.ndarray, offsets: list[int]) -> np.ndarray:
    """Hash of words[i + o] for o in offsets, for every i with the whole window inside."""
    n = len(words) - offsets[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for k, o in enumerate(offsets):
            h += words[o:o + n] * POSITION[k]
        return mix(h)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of a row's ``width``-word windows; a shorter, non-empty row
    is one shingle of its whole word sequence."""
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < width:
        with np.errstate(over="ignore"):
            return mix(window_hashes(words, list(range(len(words)))) + np.uint64(len(words)))
    return np.unique(window_hashes(words, list(range(width))))
