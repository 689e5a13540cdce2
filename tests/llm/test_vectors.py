import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from runoff.llm import collision_search as C
from runoff.llm import subspace_join as S
from runoff.llm.queries import QUERIES
from tests.llm.helpers import SF, components

ODD = [(9001, None), (9002, []), (9003, [0.0] * 8), (9004, [1.0, float("nan")] + [0.0] * 6), (None, None),
       (9005, [float("inf")] + [1.0] * 7), (9006, [1.0, None] + [0.0] * 6)]


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2)
                                  for i, v in rows], "vec_id long, embedding array<double>, id long, copies int")


def clusters(rng, n, dim=8, spread=0.05):
    centres = rng.standard_normal((6, dim))
    x = centres[rng.integers(0, 6, n)] + spread * rng.standard_normal((n, dim)) * rng.choice([0.1, 1, 4], (n, 1))
    return x * rng.choice([0.5, 1, 3], (n, 1))


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute_join(rows, cosine=0.95):
    links = []
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if usable(a) and usable(b) and len(a) == len(b):
                if np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine:
                    links.append((i, j))
    n = np.bincount(np.array(links, int).ravel(), minlength=len(rows)) if links else np.zeros(len(rows), int)
    comp = components(len(rows), links, [r[0] for r in rows])
    return sorted((str(r[0]), int(k), str(c), r[0] == c) for r, k, c in zip(rows, n, comp))


def joined(df, **options):
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept)
                  for r in S.near_duplicates(df, **options).collect())


def test_join_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = clusters(rng, 250).tolist()
    rows = [(i * 3, v) for i, v in enumerate(x)] + [(700, x[5]), (700, x[5]), (None, x[6]), (701, [2 * c for c in x[7]])]
    rows += ODD + [(800, [1.0, 2.0]), (801, [1.0, 2.1]), (802, [1.0]), (803, [3.0])]
    want = brute_join(rows)
    assert joined(frame(spark, rows)) == want
    for cell in (30, 4):  # slabs in one and in two dimensions, cells joined piece by piece
        monkeypatch.setattr(S, "CELL", cell)
        assert joined(frame(spark, rows)) == want
    monkeypatch.setattr(S, "TILE", (7, 9))
    monkeypatch.setattr(S, "SLABS", 1000)  # too many for any dimension: pieces only
    assert joined(frame(spark, rows)) == want


def test_near_cells_equal_brute_force():
    rng = np.random.default_rng(4)
    cuts = np.sort(rng.standard_normal((2, S.SLABS - 1)), axis=1)
    edge = np.hstack([np.full((2, 1), -np.inf), cuts, np.full((2, 1), np.inf)])
    for budget in (0.0, 0.1, 0.7, 9.0):
        for cell in range(S.SLABS ** 2):
            want = []
            for other in range(S.SLABS ** 2):
                gaps = [max(0.0, edge[k, o] - edge[k, c + 1], edge[k, c] - edge[k, o + 1])
                        for k, (c, o) in enumerate(zip(divmod(cell, S.SLABS), divmod(other, S.SLABS)))]
                if sum(g * g for g in gaps) <= budget:
                    want.append(other)
            assert sorted(S.near_cells(cell, cuts, budget)) == want


def test_join_query_equals_brute_force(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op9_subspace_join"](spark, SF)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in got.collect()) == brute_join(rows)


def test_join_without_rows(spark):
    assert joined(frame(spark, [])) == []
    assert joined(frame(spark, ODD[:2])) == [("9001", 0, "9001", True), ("9002", 0, "9002", True)]


def brute_search(rows, k, query):
    """{query id: its (vec_id, score) by rank}; of queries with one id, theirs one after another by their vectors."""
    known = [(i, v) for i, v in rows if usable(v)]
    out = {}
    for at, (q, own) in sorted(enumerate(known), key=lambda r: r[1][1]):
        if q is None or not query(q):
            continue
        best = sorted((-float(np.dot(v, own)), i is None, i or 0) for j, (i, v) in enumerate(known) if j != at and len(v) == len(own))
        out.setdefault(q, []).extend((None if none else i, -s) for s, none, i in best[:k])
    return out


def searched(df, k, query):
    out = {}
    for r in C.nearest(df, query, k).orderBy("query_id", "rank").collect():
        own = out.setdefault(r.query_id, [])
        own.append((r.vec_id, r.score))
        assert r["rank"] == len(own)
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in v}) for q, v in want.items())
    return hits / max(1, sum(len(v) for v in want.values()))


def test_search_recall_order_and_scores(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = np.vstack([clusters(rng, 400, 24, 0.3), rng.standard_normal((1200, 24))])
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    want = brute_search(rows, 10, lambda i: i % 20 == 0)
    for shard, queries in ((8192, 1024), (300, 16)):
        monkeypatch.setattr(C, "SHARD", shard)
        monkeypatch.setattr(C, "QUERIES", queries)
        got = searched(frame(spark, rows), 10, F.col("vec_id") % 20 == 0)
        assert set(got) == set(want) and recall(got, want) >= 0.9
        for q, found in got.items():
            assert len(found) == 10 and q not in [i for i, _ in found]
            assert found == sorted(found, key=lambda p: (-p[1], p[0]))
            for i, s in found:
                assert s == pytest.approx(float(np.dot(x[i], x[q])), rel=1e-12, abs=1e-12)


def test_search_edges_ties_and_few_candidates(spark):
    rows = [(0, [1.0, 0.0]), (20, [2.0, 0.0]), (3, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [-1.0, 0.0]),
            (40, [1.0, 1.0, 1.0]), (5, [0.0, 1e-300])] + ODD + [(None, [1.0, 0.0])]
    query = lambda i: i % 20 == 0
    want = brute_search(rows, 20, query)
    got = searched(frame(spark, rows), 20, F.col("vec_id") % 20 == 0)
    assert got == {q: v for q, v in want.items() if v}
    assert searched(frame(spark, []), 20, F.col("vec_id") % 20 == 0) == {}
    assert searched(frame(spark, [(1, [1.0])]), 20, F.col("vec_id") % 20 == 0) == {}


def test_search_takes_every_row_for_a_candidate(spark):
    rows = [(20, [1.0, 0.0]), (1, [0.9, 0.1]), (1, [0.8, 0.2]), (None, [0.9, 0.1]), (None, [0.95, 0.0]), (20, [1.0, 0.0]), (3, None)]
    got = C.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 4).collect()
    own = [(1, 20, 1.0), (2, None, 0.95), (3, 1, 0.9), (4, None, 0.9)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"] or 0, r["score"]) for r in got) == sorted(
        (20, a, b or 0, c) for a, b, c in own * 2)
    # one id for a third of all rows
    rng = np.random.default_rng(5)
    x = clusters(rng, 600, 12, 0.4)
    many = [(7 if i % 3 == 0 else None if i % 50 == 1 else i, v) for i, v in enumerate(x.tolist())]
    want = brute_search(many, 10, lambda i: i % 20 == 0)
    scores = lambda found: {q: [s for _, s in v] for q, v in found.items()}
    got, want = scores(searched(frame(spark, many), 10, F.col("vec_id") % 20 == 0)), scores(want)
    hits = sum(a == pytest.approx(b, rel=1e-12) for q in want for a, b in zip(got[q], want[q]))
    assert set(got) == set(want) and hits >= 0.9 * sum(map(len, want.values()))


def test_search_query_recall(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute_search(rows, 20, lambda i: i % 20 == 0)
    got = {}
    for r in QUERIES["op3_collision_search"](spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert recall(got, want) >= 0.9 and all(len(v) == 20 for v in got.values())


def test_join_holds_no_pairs():
    """A cell of near copies: the pairs a task finds are folded, not kept (8 million are 128 MB)."""
    n = 4000
    x = np.array([1.0] + [0.0] * 7) + 1e-3 * np.random.default_rng(3).standard_normal((n, 8))
    zero = np.zeros(n, np.int64)
    table = pa.table({"id": np.arange(n) + 5, "copies": np.full(n, 2), "low": zero, "high": zero, "i": zero, "j": zero,
                      "vec": x.tolist(), "dim": np.full(n, 8, np.int32), "block": np.zeros(n, np.int32),
                      "side": np.zeros(n, np.int32)})
    tracemalloc.start()
    try:
        found = S._link(0.95, 0)(table)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found["links"].to_pylist() == [2 * (n - 1)] * n and set(found["root"].to_pylist()) == {5}
    assert peak < 16 * n * (n - 1) // 2
