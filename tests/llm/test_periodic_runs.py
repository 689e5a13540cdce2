import hashlib
import random
import zlib

import numpy as np
import pytest

from runoff.llm import periodic_runs as pr
from runoff.llm.queries import QUERIES
from tests.llm.helpers import SF, docs

import re


def brute_force(words, min_words=24, exponent=3):
    """Every maximal stretch with period q, for every q, whose smallest period is q."""
    out, n = [], len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(min_words, exponent * q) and not any(
                    all(words[x] == words[x + p] for x in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def strings():
    rng = random.Random(1)
    for n in (1, 2, 3, 10, 40):
        yield [0] * n
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 90:
        fib.append(fib[-1] + fib[-2])
    yield fib[-1]
    for _ in range(250):
        size = rng.choice([1, 2, 2, 3, 5])
        s = [rng.randrange(size) for _ in range(rng.randrange(1, 60))]
        for _ in range(rng.randrange(3)):
            a = rng.randrange(len(s))
            unit = s[a:a + rng.randrange(1, 8)]
            s[a:a] = (unit * rng.randrange(1, 9))[:rng.randrange(1, 40)]
        yield s


@pytest.mark.parametrize("min_words,exponent", [(2, 2), (6, 3), (24, 3)])
def test_runs_of_strings_equal_brute_force(min_words, exponent):
    for s in strings():
        dense = {c: i for i, c in enumerate(dict.fromkeys(s))}
        assert pr.string_runs([dense[c] for c in s], min_words, exponent) == brute_force(s, min_words, exponent), s


def test_common_extensions_equal_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        s = [rng.randrange(2) for _ in range(rng.randrange(2, 120))]
        e = pr.Extensions(s, 2)
        suffixes = sorted(range(len(s) + 1), key=lambda i: s[i:])
        assert e.rank.tolist() == np.argsort(suffixes).tolist()
        a = np.array([rng.randrange(len(s) + 1) for _ in range(50)])
        b = np.array([rng.randrange(len(s) + 1) for _ in range(50)])
        a, b = a[a != b], b[a != b]
        want = []
        for x, y in zip(a.tolist(), b.tolist()):
            n = 0
            while max(x, y) + n < len(s) and s[x + n] == s[y + n]:
                n += 1
            want.append(n)
        assert e.common(a, b).tolist() == want


def split(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def test_documents_equal_brute_force(spark):
    rng = random.Random(3)
    unit = [f"w{i}" for i in range(40)]
    texts = [None, "", " \t\n", "a", "a " * 23, "a " * 24, "A a " * 12, "\x0b".join(["a"] * 30), "é ü " * 20,
             " ".join(unit * 3), " ".join(unit * 2 + unit[:39]), " ".join((["x"] * 30 + ["y"]) * 4),
             " ".join(unit + ["b", "c"] * 20 + unit), "a\x1cb " * 30, "w " * 30_000]
    for _ in range(60):
        words = [f"t{rng.randrange(9)}" for _ in range(rng.randrange(10, 60))]
        for _ in range(3):
            a = rng.randrange(len(words))
            words[a:a] = words[a:a + rng.randrange(1, 15)] * rng.randrange(2, 6)
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a " * 24), (5, "a " * 24)]
    df = docs(spark, rows).selectExpr("*", "1 AS runs", "2 AS collapsed", "3 AS n_words")
    got = pr.periodic_runs(df.repartition(2)).collect()
    assert len(got) == len(rows)
    by_text = {}
    for doc, text in rows:
        if text is None or len(text) < 50_000:
            words = split(text)
            runs = brute_force(words)
            by_text.setdefault(doc, (len(words), runs, collapsed(words, runs).decode()))
        else:
            by_text[doc] = (30_000, [(0, 30_000, 1)], "w")
    for r in got:
        assert (r.n_words, [tuple(x) for x in r.runs], r.collapsed) == by_text[r.doc_id]
    assert pr.periodic_runs(docs(spark, [])).collect() == []


def test_stretches_hold_every_run():
    """Rows of one segment, one of them longer than a segment of fingerprints."""
    import pyarrow as pa

    rng = random.Random(4)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(80))) for _ in range(200)]
    texts.append(" ".join([f"u{i}" for i in range(150_000)] + ["z", "y"] * 30 + [f"v{i}" for i in range(1000)]))
    where = {}
    for i, h, cut in pr.text_words(pa.array(texts)):
        where |= {i + r: v for r, v in pr.stretches(h, cut, 24, 3).items()}
    for r, t in enumerate(texts[:-1]):
        assert pr.word_runs(t.encode().split(), where.get(r, []), 24, 3) == brute_force(t.split())
    assert pr.word_runs(texts[-1].encode().split(), where[200], 24, 3) == [(150_000, 60, 2)]
    assert sum(z - a for a, z in where[200]) == 60


def test_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(rows)
    planted = 0
    for row in rows:
        words = split(row.text)
        h = zlib.crc32(str(row.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        # brute force over all periods is quadratic, so only up to the longest that fits
        runs = brute_force(words) if n < 1200 else pr.word_runs(words, [(0, n)], 24, 3)
        top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        r = got[row.doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *top)
        assert r.exponent_milli == (top[1] and 1000 * top[1] // top[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs)).hexdigest()
    assert planted > 5 and any(r.n_runs for r in got.values())
