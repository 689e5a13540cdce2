"""Brute-force versions and small fixtures for the operators' tests."""
from __future__ import annotations

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def shingles(text, k=5):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


class Sets:
    """Union-find; the root of a set is its least member."""

    def __init__(self, n):
        self.up = list(range(n))

    def root(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a


def components(n, linked, ids):
    """Least non-null id of each member's component."""
    s = Sets(n)
    for a, b in linked:
        s.join(a, b)
    out = {}
    for i in range(n):
        if ids[i] is not None:
            r = s.root(i)
            out[r] = min(out.get(r, ids[i]), ids[i])
    return [out.get(s.root(i)) for i in range(n)]


def docs(spark, rows):
    """rows: (doc_id, text[, source])."""
    return spark.createDataFrame(
        [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows], DOCS)


def near_copies(rng, base, n, changes=2):
    """``base`` (a list of words) with a few words replaced, n times."""
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(changes):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out
