import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from runoff.llm import merkle
from runoff.llm.queries import QUERIES
from runoff.session import scratch_path
from tests.llm.helpers import docs


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def climb(nodes, arity):
    """Levels from ``nodes`` to one node."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def siblings(tree, i, arity):
    """(siblings left, siblings right) of node i, level by level."""
    out = []
    for level in tree[:-1]:
        a = i // arity * arity
        out.append((level[a:i], level[i + 1:a + arity]))
        i //= arity
    return out


def brute_force(rows, arity):
    """rows: (group, id, leaf, presented or None) -> sorted result rows."""
    def first_null(x):
        return (x is not None, x if x is not None else 0)

    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (first_null(r[1]), r[2], r[3] or ""))
        trees[g] = climb([r[2] for r in groups[g]], arity)
    top = climb([trees[g][-1][0] for g in names], arity)
    out = []
    for j, g in enumerate(names):
        for i, (_, key, leaf, shown) in enumerate(groups[g]):
            steps = siblings(trees[g], i, arity) + siblings(top, j, arity)
            at = shown or leaf
            for left, right in steps:
                at = H(*left, at, *right)
            out.append((str(key), leaf, i, "".join(x for left, right in steps for x in left + right),
                        trees[g][-1][0], top[-1][0], at))
    return sorted(out)


def manifest(spark, rows, arity):
    df = spark.createDataFrame(rows, "g string, k long, leaf string, shown string").selectExpr(
        "*", "1 AS grp", "2 AS n", "3 AS lo", "4 AS id", "5 AS digest", "6 AS item").repartition(3)
    found = merkle.manifest(df, F.col("g"), F.col("k"), F.col("leaf"), F.col("shown"), arity).collect()
    return sorted((str(r.id), r.leaf, r.lo, r.proof, r.subroot, r.root, r.folded_root) for r in found)


@pytest.mark.parametrize("arity,block", [(2, 1024), (2, 4), (3, 9), (5, 5)])
def test_manifest_equals_brute_force(spark, monkeypatch, arity, block):
    """With small blocks the trees have many buckets of levels."""
    monkeypatch.setattr(merkle, "BLOCK", block)
    rng = random.Random(arity * block)
    rows = []
    for g, n in ((None, 3), ("", 1), ("en", 140), ("dé", 17), ("z", 1), ("=", 8)):
        for _ in range(n):
            k = rng.choice([None, rng.randrange(-5, 60)])
            leaf = H(str(rng.randrange(50)))
            rows.append((g, k, leaf, H("other" + leaf) if k is not None and k % 7 == 0 else None))
    assert manifest(spark, rows, arity) == brute_force(rows, arity)


def test_one_leaf_one_group_and_no_rows(spark):
    one = [("g", 1, H("a"), None)]
    assert manifest(spark, one, 2) == brute_force(one, 2) == [("1", H("a"), 0, "", H("a"), H("a"), H("a"))]
    many = [("g", i, H(str(i)), None) for i in range(9)]
    assert manifest(spark, many, 2) == brute_force(many, 2)
    assert manifest(spark, [], 2) == []
    with pytest.raises(ValueError):
        merkle.manifest(spark.range(1), F.lit("g"), F.col("id"), F.lit(""), arity=1)


def test_alike_rows_are_one_class_until_they_are_unfolded(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 16)
    rows = [("g", 5, H("same"), None)] * 700 + [("g", i, H(str(i)), None) for i in range(10)] + [(None, None, H("x"), None)] * 40
    assert manifest(spark, rows, 2) == brute_force(rows, 2)
    counted = spark.createDataFrame([("=g", 5, 10**6), ("=g", 6, 3), ("=h", 1, 2)], "grp string, id long, copies long")
    got = merkle.ranked(counted, ["id"]).groupBy("grp", "id").agg(
        F.min("lo").alias("a"), F.max("lo").alias("z"), F.count("*").alias("k"), F.max("n").alias("n")).collect()
    assert sorted(tuple(r) for r in got) == [("=g", 5, 0, 10**6 - 1, 10**6, 10**6 + 3),
                                             ("=g", 6, 10**6, 10**6 + 2, 3, 10**6 + 3), ("=h", 1, 0, 1, 2, 2)]


def test_digest_of_fields(spark):
    rows = [(1, "é\n", "en", "s", None), (None, None, None, None, 3), (2, "", "", "", 0), (3, "x" * 200_000, "en", "a:b", 5)]
    df = spark.createDataFrame([(i, t, g, s, n) for i, t, g, s, n in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    got = df.select("doc_id", merkle.digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]).alias("d"))
    want = {i: H("".join(map(field, (i, s, g, n, t)))) for i, t, g, s, n in rows}
    assert {r.doc_id: r.d for r in got.collect()} == want


def test_tampering_is_found_wherever_it_is(spark):
    rows = [(i, "same text") for i in range(60)]
    path = scratch_path(spark, "merkle-test")
    docs(spark, rows).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    got = {r.doc_id: r.verified for r in QUERIES["op11_merkle_manifest"](spark, path).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 7 != 0 for i, _ in rows}
