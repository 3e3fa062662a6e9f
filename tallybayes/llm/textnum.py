"""Vectorised word and n-gram hashing over Arrow string columns (numpy).

Words are maximal runs of bytes other than space and 0x09-0x0D; A-Z count as
a-z.  A word's hash is a polynomial over its bytes modulo 2**64, then mixed.
Rows are handled in blocks of about ``BLOCK`` bytes, and a longer text is read
in pieces cut at white space, so memory does not depend on the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
PIECE = 1 << 22
GAMMA = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_P = np.uint64(0x5851F42D4C957F2D)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Kinds of bytes: a word ends where the kind changes; kind 0 is between words.
WORDS = np.where(_SPACE, 0, 1).astype(np.uint8)
WORD_PUNCT = WORDS.copy()
WORD_PUNCT[[b for b in range(33, 127) if not chr(b).isalnum()]] = 2
_BYTE = np.random.default_rng(20240229).integers(1, 2**64 - 1, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_BYTE[_SPACE] = 0


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def step(i: int) -> np.uint64:
    """The i-th value of a fixed sequence of odd strides, for seeds."""
    return np.uint64(i * int(GAMMA) % 2**64)


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, bytes)`` of a string column; a null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not (pa.types.is_string(col.type) or pa.types.is_large_string(col.type)):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if len(col) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]:offsets[-1]]


def blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes, one row at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def _piece(data: np.ndarray, starts_of_rows: np.ndarray, kinds: np.ndarray = WORDS,
           prefix: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and word start positions of one buffer; hashes of the words'
    first ``prefix`` bytes if that isn't 0."""
    kind = kinds[data]
    first = kind != 0
    first[1:] &= kind[1:] != kind[:-1]
    rows = starts_of_rows[starts_of_rows < len(data)]
    first[rows] = kind[rows] != 0
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    at = np.arange(len(data), dtype=np.int64)
    at -= np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(data)]))
    powers = np.cumprod(np.full(int(at.max()) + 1, _P, np.uint64))
    values = np.where(kind != 0, _BYTE[data] * powers[at], np.uint64(0))
    if prefix:
        values[at >= prefix] = 0
    return mix(np.add.reduceat(values, starts)), starts


def word_hashes(offsets: np.ndarray, data: np.ndarray, lo: int, hi: int,
                kinds: np.ndarray = WORDS, prefix: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of rows ``lo..hi`` and each row's first word (with the end)."""
    base, end = offsets[lo], offsets[hi]
    rows = offsets[lo:hi] - base
    if hi - lo > 1 or end - base <= PIECE:
        h, starts = _piece(data[base:end], rows, kinds, prefix)
        return h, np.r_[np.searchsorted(starts, rows), len(h)]
    found, at = [], base
    while at < end:
        cut = min(at + PIECE, end)
        while cut < end and not _SPACE[data[cut - 1]]:
            step = np.flatnonzero(_SPACE[data[cut:min(cut + PIECE, end)]])
            cut = cut + int(step[0]) + 1 if len(step) else min(cut + PIECE, end)
        found.append(_piece(data[at:cut], np.zeros(1, np.int64), kinds, prefix)[0])
        at = cut
    h = np.concatenate(found)
    return h, np.array([0, len(h)])


def shingles(h: np.ndarray, ends: np.ndarray, k: int) -> list[np.ndarray]:
    """Each row's sorted distinct ``k``-word shingles; a shorter text is one shingle."""
    def run(w: int) -> np.ndarray:
        n = len(h) - w + 1
        acc = h[:n].copy()
        for j in range(1, w):
            acc = acc * _P + h[j:n + j]
        return mix(acc + step(w))

    full = run(k) if len(h) >= k else None
    short = {}
    out = []
    for a, b in zip(ends[:-1], ends[1:]):
        n = int(b - a)
        if n >= k:
            out.append(np.unique(full[a:b - k + 1]))
        elif n:
            if n not in short:
                short[n] = run(n)
            out.append(short[n][a:a + 1])
        else:
            out.append(h[:0])
    return out
