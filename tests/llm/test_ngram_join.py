import random

import numpy as np
import pytest

from runoff.llm import ngram_join as J
from tests.llm.helpers import components, docs, near_copies, shingles


def brute(rows, percent=75):
    sets = [shingles(r[1]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    comp = components(len(rows), links, [r[0] for r in rows])
    key = lambda t: tuple(-1 if x is None else x for x in t)
    return sorted(((r[0], len(s), c) for r, s, c in zip(rows, sets, comp)), key=key)


def got(df):
    key = lambda t: tuple(-1 if x is None else x for x in t)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=key)


def corpus(seed, n_base=25):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for b in range(n_base):
        base = [f"b{rng.randrange(400)}" for _ in range(rng.choice([3, 5, 8, 40, 150]))]
        if b % 3 == 0:
            base += passage  # a passage that many documents share
        rows += [" ".join(base)] * rng.choice([1, 1, 3])
        if len(base) > 5:
            rows += near_copies(rng, base, rng.choice([0, 2, 12]), rng.choice([1, 2, 4]))
            rows.append(" ".join(base[:int(len(base) * 0.8)]))  # a prefix: similarity near the threshold
    rng.shuffle(rows)
    return [(i * 7 % 1009, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed)
    assert got(J.jaccard_join(docs(spark, rows))) == brute(rows)


def test_block_pairs_and_small_windows_change_nothing(spark, monkeypatch):
    rows = corpus(3)
    monkeypatch.setattr(J, "TASK_TOKENS", 300)   # clusters are joined block by block
    monkeypatch.setattr(J, "WINDOW_TOKENS", 900)
    monkeypatch.setattr(J, "WINDOW_DOCS", 9)
    assert got(J.jaccard_join(docs(spark, rows))) == brute(rows)


def test_hot_shingles_stay_with_their_window(spark, monkeypatch):
    rng = random.Random(4)
    hot = [f"h{i}" for i in range(30)]
    rows = [(i, " ".join(hot + [f"u{rng.randrange(10**6)}" for _ in range(rng.choice([2, 40]))])) for i in range(150)]
    assert got(J.jaccard_join(docs(spark, rows))) == brute(rows)


def test_edge_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "a b c d e"), (8, "A b c D e"),
            (None, "a b c d e"), (9, long), (10, long), (10, long), (None, "lonely words here"), (11, "é b c d e")]
    assert got(J.jaccard_join(docs(spark, rows))) == brute(rows)
    assert got(J.jaccard_join(docs(spark, []))) == []


def test_one_document_of_each_group_stays(spark):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, "x y z"), (1, None), (1, None), (2, "")]
    df = docs(spark, rows).selectExpr("*", "1 AS keep", "2 AS sig", "'t' AS text_hash", "0 AS component_id")
    kept = J.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 1, 2, 3, 4]


def test_link_members_connects_as_all_pairs_do():
    # near copies in a chain: neighbours link, the ends do not
    sets = [np.arange(i * 2, i * 2 + 40).astype(np.uint64) for i in range(12)]
    members = [(i, 40, 11, s, np.full(40, 2, np.uint32), 0) for i, s in enumerate(sets)]
    links = J.link_members(members, 75)
    assert components(12, links, list(range(12))) == [0] * 12 and len(links) == 11
