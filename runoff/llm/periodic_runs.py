"""Runs of repeated words, found with suffix trees.

A run is a stretch of consecutive words with smallest period q, at least
``exponent`` periods and ``min_words`` words long, that no neighbouring word
extends.  In a string, every such stretch has a Lyndon root: the longest
Lyndon word that starts at some position under the order of words or its
reverse.  That word ends before the next smaller (or greater) suffix, so each
position gives two candidates (position, period).  A candidate is extended to
the right by the longest common extension of the two suffixes one period
apart, and to the left by that of the reversal.  Both are string depths of
lowest common ancestors in the suffix trees (Ukkonen) of string and reversal,
read as range minima over the trees' Euler tours in constant time.

Trees are built only where a run can be.  With k = min_words // 3, any k
consecutive words of a run come again within it, less than its length /
``exponent`` away.  Words that no such repetition covers (found by sorting
64-bit fingerprints of all k-grams of a document) are in no run, and
stretches between them are independent: a run lies in one of them whole, and
in the trees words are compared as they are.  A stretch's trees take some
1 KB a word in the task, documents without repetitions next to nothing.

``collapsed`` is the text without what runs repeat: a word goes if some run
holds it after that run's first period; the others are joined by one space.

Defined cases: null, empty and white-space texts have no words, no runs and
an empty collapsed text; words are runs of bytes other than space and
\\x09-\\x0D and compared with case; repeated rows and null ids are rows like
others; an empty table gives no rows; only id and text are read, so no other
column can clash.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runoff.llm.words import BASE, U, mix, text_words

MIN_WORDS, EXPONENT = 24, 3
#: Bytes of text in an Arrow batch.
BATCH_BYTES = 4 << 20
#: Tour entries of a block of the range minima.
BLOCK = 16


class SuffixTree:
    """Ukkonen's suffix tree of ``symbols`` (0 to ``size`` - 1) and a last
    symbol that is smaller than all; nodes are numbered as they are made."""

    def __init__(self, symbols: list[int], size: int):
        s = [c + 1 for c in symbols]
        s.append(0)
        n, width = len(s), size + 1
        first, last, link, depth, leaves = [0], [0], [0], [0], []
        child: dict[int, int] = {}  # by node * width + first symbol of the edge
        node = edge = length = waiting = 0
        for pos, c in enumerate(s):
            waiting += 1
            fresh = 0  # the inner node that still has no suffix link
            while waiting:
                if not length:
                    edge = pos
                key = node * width + s[edge]
                to = child.get(key)
                if to is None:
                    child[key] = len(first)
                    if fresh:
                        link[fresh] = node
                        fresh = 0
                else:
                    span = last[to] - first[to]
                    if length >= span:
                        edge += span
                        length -= span
                        node = to
                        continue
                    if s[first[to] + length] == c:
                        length += 1
                        if fresh:
                            link[fresh] = node
                        break
                    inner = len(first)
                    child[key] = inner
                    first.append(first[to])
                    first[to] += length
                    last.append(first[to])
                    link.append(0)
                    depth.append(depth[node] + length)
                    child[inner * width + s[first[to]]] = to
                    child[inner * width + c] = inner + 1
                    if fresh:
                        link[fresh] = inner
                    fresh = inner
                # leaves come in the order of their suffixes
                leaves.append(len(first))
                first.append(pos)
                last.append(n)
                link.append(0)
                depth.append(n - len(leaves) + 1)
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = pos - waiting + 1
        self.leaves = np.array(leaves)
        self.depth = np.array(depth, np.int32)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        nodes = np.fromiter(child.values(), np.int64, len(child))
        order = np.argsort(keys)  # by parent, then by symbol
        self.children = nodes[order].tolist()
        self.begin = np.searchsorted(keys[order] // width, np.arange(len(first) + 1)).tolist()

    def tour(self) -> list[int]:
        """The nodes on an Euler tour that visits children in their order."""
        begin, children = self.begin, self.children
        at, stack, out, node = list(begin), [], [0], 0
        ends = begin[1:]
        while True:
            if at[node] < ends[node]:
                stack.append(node)
                at[node] += 1
                node = children[at[node] - 1]
            elif stack:
                node = stack.pop()
            else:
                return out
            out.append(node)


class Minima:
    """Minimum of any range of ``values`` in constant time: a sparse table
    over blocks, running minima within them."""

    def __init__(self, values: np.ndarray):
        n = -(-len(values) // BLOCK)
        full = np.full(n * BLOCK, np.iinfo(values.dtype).max, values.dtype)
        full[:len(values)] = values
        self.rows = full.reshape(n, BLOCK)
        self.left = np.minimum.accumulate(self.rows, axis=1).ravel()
        self.right = np.minimum.accumulate(self.rows[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [self.rows.min(axis=1)]
        while (1 << len(self.table)) <= n:
            half = 1 << (len(self.table) - 1)
            t = self.table[-1]
            self.table.append(np.minimum(t[:-half], t[half:]))

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """min(values[a..b]) of each pair a <= b."""
        i, j = a // BLOCK, b // BLOCK
        out = np.minimum(self.right[a], self.left[b])
        same = np.flatnonzero(i == j)
        if len(same):
            rows, col = self.rows[i[same]], np.arange(BLOCK)
            inside = (col >= (a[same] % BLOCK)[:, None]) & (col <= (b[same] % BLOCK)[:, None])
            out[same] = np.where(inside, rows, np.iinfo(rows.dtype).max).min(axis=1)
        gap = np.maximum(j - i - 1, 0)  # whole blocks between
        for level, t in enumerate(self.table):
            own = np.flatnonzero((gap >> level) == 1)
            if len(own):
                x, y = i[own] + 1, j[own] - (1 << level)
                out[own] = np.minimum(out[own], np.minimum(t[x], t[y]))
        return out


class Extensions:
    """Longest common extensions of suffixes, and the suffixes' ranks."""

    def __init__(self, symbols: list[int], size: int):
        tree = SuffixTree(symbols, size)
        tour = np.array(tree.tour())
        place = np.empty(len(tree.depth), np.int64)
        place[tour] = np.arange(len(tour))  # a leaf comes once
        self.place = place[tree.leaves]
        self.minima = Minima(tree.depth[tour])
        self.rank = np.empty(len(self.place), np.int64)
        self.rank[np.argsort(self.place)] = np.arange(len(self.place))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes a <> b."""
        x, y = self.place[a], self.place[b]
        return self.minima.between(np.minimum(x, y), np.maximum(x, y))


def _next_smaller(rank: list[int]) -> np.ndarray:
    """By position, the next one with a smaller rank; 0 if there is none."""
    out, stack = [0] * len(rank), []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out)


def string_runs(symbols: list[int], min_words: int = MIN_WORDS, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    n = len(symbols)
    if n < min_words:
        return []
    size = max(symbols) + 1
    ahead = Extensions(symbols, size)
    back = Extensions(symbols[::-1], size)
    rank = ahead.rank
    found = []
    for r in (rank, -rank):
        end = _next_smaller(r.tolist())[:n]
        start = np.flatnonzero((end > 0) & (end < n) & (exponent * (end - np.arange(n)) <= n))
        if not len(start):
            continue
        end = end[start]
        right = end + ahead.common(start, end)
        # suffix n - i of the reversal reads leftwards from word i - 1
        left = start - back.common(n - start, n - end)
        period = end - start
        ok = right - left >= np.maximum(min_words, exponent * period)
        found.append(np.stack([left[ok], (right - left)[ok], period[ok]], axis=1))
    if not found:
        return []
    runs = np.unique(np.concatenate(found), axis=0)
    return [tuple(x) for x in runs[np.lexsort((runs[:, 2], runs[:, 0]))].tolist()]


def stretches(h: np.ndarray, cut: np.ndarray, min_words: int, exponent: int) -> dict[int, list[tuple[int, int]]]:
    """By row, the ranges of words (first, end) that can hold runs, of rows
    whose words have the fingerprints ``h`` and the offsets ``cut``."""
    k = min_words // 3 if exponent >= 3 else 1
    if len(h) < min_words:
        return {}
    gram = np.zeros(len(h) - k + 1, U)
    for j in range(k):
        gram += h[j:len(gram) + j] * U(pow(BASE, j, 1 << 64))
    row = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
    pos = np.flatnonzero(row[:len(gram)] == row[k - 1:])
    key = mix(gram[pos] + row[pos].astype(U) * mix(np.full(1, 7, U)))
    again = np.sort(key)
    again = np.unique(again[1:][again[1:] == again[:-1]])
    if not len(again):
        return {}
    at = np.searchsorted(again, key)
    at[at == len(again)] = 0
    some = np.flatnonzero(again[at] == key)
    pos, key = pos[some], key[some]
    # distance to the nearest occurrence of the same words in the row
    order = np.argsort(key, kind="stable")
    gap = np.diff(pos[order])
    gap[np.diff(key[order]) != 0] = len(h)
    near = np.empty(len(pos), np.int64)
    near[order] = np.minimum(np.r_[gap, len(h)], np.r_[len(h), gap])
    while len(pos):
        apart = (np.diff(pos) != 1) | (np.diff(row[pos]) != 0)
        first = np.r_[0, np.flatnonzero(apart) + 1]
        count = np.diff(np.r_[first, len(pos)])
        words = count + k - 1
        keep = (near <= np.repeat(words // exponent, count)) & np.repeat(words >= min_words, count)
        if keep.all():
            out: dict[int, list[tuple[int, int]]] = {}
            for p, n in zip(pos[first].tolist(), words.tolist()):
                start = p - int(cut[row[p]])
                out.setdefault(int(row[p]), []).append((start, start + n))
            return out
        pos, near = pos[keep], near[keep]
    return {}


def word_runs(words: list[bytes], ranges: list[tuple[int, int]], min_words: int, exponent: int) -> list[tuple[int, int, int]]:
    """The runs of ``words`` within ``ranges``, by start, then period."""
    out = []
    for a, z in ranges:
        number: dict[bytes, int] = {}
        symbols = [number.setdefault(w, len(number)) for w in words[a:z]]
        out += [(a + start, length, period) for start, length, period in string_runs(symbols, min_words, exponent)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    kept, at = [], 0
    for a, z in sorted((start + period, start + length) for start, length, period in runs):
        kept += words[at:a]
        at = max(at, z)
    return b" ".join(kept + words[at:])


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])
_OUT_SQL = ("doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
            "collapsed string")


def _find(min_words: int, exponent: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            ids, text = b.column("doc_id"), b.column("text")
            where: dict[int, list[tuple[int, int]]] = {}
            for i, h, cut in text_words(text):
                where |= {i + r: v for r, v in stretches(h, cut, min_words, exponent).items()}
            n, runs, collapsed, held, first = [], [], [], 0, 0
            for r, t in enumerate(text):
                words = t.as_buffer().to_pybytes().split() if t.is_valid else []
                found = word_runs(words, where[r], min_words, exponent) if r in where else []
                n.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), x)) for x in found])
                collapsed.append(collapse(words, found))
                held += len(collapsed[-1])
                if held >= BATCH_BYTES or r == len(text) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(first, len(n)), pa.array(n, pa.int64()), pa.array(runs, pa.list_(_RUN)),
                         pa.array(collapsed, pa.binary()).cast(pa.string())], schema=_OUT)
                    first, n, runs, collapsed, held = r + 1, [], [], [], 0
    return run


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, exponent: int = EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period)
    and collapsed text of every row of ``docs`` (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _find(min_words, exponent), _OUT_SQL)
