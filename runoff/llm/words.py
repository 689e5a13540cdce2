"""Vectorised words and shingles of Arrow text columns.

A word is a run of bytes other than space and \\x09-\\x0D, with A-Z
lower-cased; words and shingles are 64-bit fingerprints (polynomial hashes
over random byte values, then mixed).
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240601))
BYTE = _rng.integers(1, 1 << 63, 256, dtype=U)
BYTE[65:91] = BYTE[97:123]
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
BASE = 0x9E3779B97F4A7C15
BACK = pow(BASE, -1, 1 << 64)
ODD = _rng.integers(1, 1 << 63, 5, dtype=U) | U(1)
SEGMENT = 1 << 19
_pow: list = [np.ones(1, U), np.ones(1, U)]


def mix(x):
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int):
    if len(_pow[0]) < n:
        for i, base in enumerate((BASE, BACK)):
            p = np.full(max(n, SEGMENT + 1), base, U)
            p[0] = 1
            _pow[i] = np.multiply.accumulate(p)
    return _pow


def _hash_segment(b: np.ndarray, cuts: np.ndarray, space: np.ndarray):
    """(fingerprint, start) of the words in bytes ``b``; no word spans a cut."""
    up, back = _powers(len(b))
    word = ~space[b]
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    cuts = cuts[(cuts > 0) & (cuts < len(b))]
    before[cuts] = False
    after[cuts - 1] = False
    first = np.flatnonzero(word & ~before)
    last = np.flatnonzero(word & ~after)
    total = np.zeros(len(b) + 1, U)
    np.cumsum(BYTE[b] * up[:len(b)], out=total[1:])
    h = (total[last + 1] - total[first]) * back[first]
    return mix(h + (last - first + 1).astype(U) * U(BASE)), first


def text_words(column: pa.Array, space: np.ndarray = SPACE):
    """Yields (first row, fingerprints, word offsets by row) over consecutive
    rows of a text column (null: no words), some 0.5 MB of text at a time; a
    longer text is hashed in parts cut between words, and yielded whole.
    ``space``: which bytes part words."""
    for i, h, cut, _, _ in text_segments(column, space):
        yield i, h, cut


def text_segments(column: pa.Array, space: np.ndarray = SPACE):
    """As ``text_words``, with the rows' bytes and their offsets in these."""
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        column, width = column.cast(pa.string()), np.int32
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, width, n + 1, column.offset * np.dtype(width).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if column.null_count:
        ends = off[1:].copy()
        ok = column.is_valid().to_numpy(zero_copy_only=False)
        begins = np.where(ok, off[:-1], ends)
        if (begins != off[:-1]).any() and (off[1:] != off[:-1])[~ok].any():
            column = pa.array(column.to_pylist(), pa.large_string())
            yield from text_segments(column.fill_null(""), space)
            return
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + SEGMENT, "right")) - 1)
        lo, hi = int(off[i]), int(off[j])
        if hi - lo <= 2 * SEGMENT:
            if hi > lo:
                h, first = _hash_segment(raw[lo:hi], off[i:j] - lo, space)
            else:
                h, first = np.zeros(0, U), np.zeros(0, np.int64)
            yield i, h, np.searchsorted(first, off[i:j + 1] - lo), raw[lo:hi], off[i:j + 1] - lo
        else:
            parts, at = [], lo
            while at < hi:
                to = min(at + SEGMENT, hi)
                while to < hi and not space[raw[to]]:
                    step = np.flatnonzero(space[raw[to:to + SEGMENT]])
                    to = to + int(step[0]) if len(step) else min(to + SEGMENT, hi)
                parts.append(_hash_segment(raw[at:to], np.zeros(0, np.int64), space)[0])
                at = to
            h = np.concatenate(parts)
            yield i, h, np.array([0, len(h)]), raw[lo:hi], off[i:j + 1] - lo
        i = j


def text_shingles(column: pa.Array, k: int = 5):
    """Yields (row, sorted distinct shingle fingerprints) for every row: all
    runs of ``k`` words, or the whole sequence if there are fewer."""
    for i, h, cut in text_words(column):
        if len(h) >= k:
            s = np.zeros(len(h) - k + 1, U)
            for j in range(k):
                s += h[j:len(h) - k + 1 + j] * ODD[j % 5]
            s = mix(s)
        for r in range(len(cut) - 1):
            a, b = int(cut[r]), int(cut[r + 1])
            if b - a >= k:
                yield i + r, np.unique(s[a:b - k + 1])
            elif b > a:
                w = h[a:b]
                yield i + r, mix((w * ODD[np.arange(b - a) % 5]).sum(keepdims=True) ^ U(b - a))
            else:
                yield i + r, h[:0]


def set_signature(tokens: np.ndarray) -> int:
    """A signed 64-bit fingerprint of a set."""
    if not len(tokens):
        return 0
    return int(mix(mix(tokens * U(BACK)).sum(keepdims=True) + U(len(tokens))).view(np.int64)[0])
