import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from runoff.llm import quality as Q
from tests.llm.helpers import docs

BIG = "/root/testdata/sf0.1"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    d = spark.read.parquet(f"{BIG}/documents.parquet")
    all_labels = spark.read.parquet(f"{BIG}/labels.parquet")
    model = Q.train(d, all_labels.where("doc_id % 3 <> 0"))
    assert (np.diff(model.thresholds) > 0).all()
    held = Q.scores(d.select("doc_id", "text"), model).join(all_labels.where("doc_id % 3 = 0"), "doc_id")
    by = {r.clean: r for r in held.groupBy((F.expr("quality = 1 and toxic = 0")).alias("clean")).agg(
        F.avg(F.col("keep").cast("int")).alias("kept"), F.avg("expected_grade").alias("grade")).collect()}
    assert by[True].kept >= 0.97 and by[False].kept <= 0.1
    assert by[True].grade > 1.8 > 1 > by[False].grade
    toxic = held.where("toxic = 1").agg(F.avg(F.col("keep").cast("int"))).first()[0]
    assert toxic <= 0.1


def test_model_is_a_cumulative_link(spark):
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 3, 600)
    features = [np.array([g if rng.random() < 0.8 else 7, 9], np.int32) for g in grades]
    m = Q.fit(grades, features)
    p = m.probabilities(np.array([m.weights[f].sum() for f in features]))
    assert (p[:, 0] >= p[:, 1]).all() and m.weights[9] == 0
    expected = p.sum(1)
    means = [expected[grades == g].mean() for g in range(3)]
    assert means[0] < means[1] < means[2]


def test_likelihood_gradient_by_brute_force():
    """The fit is at least as good as nearby weights and thresholds."""
    rng = np.random.default_rng(2)
    grades = rng.integers(0, 3, 300)
    features = [np.array([g if rng.random() < 0.7 else (g + 1) % 3], np.int32) for g in grades]
    m = Q.fit(grades, features, steps=1500, l2=0.0)

    def loss(model):
        p = model.probabilities(np.array([model.weights[f].sum() for f in features], float))
        at = np.column_stack([np.ones(len(p)), p, np.zeros(len(p))])
        i = np.arange(len(p))
        return -np.log(np.maximum(at[i, grades] - at[i, grades + 1], 1e-12)).mean()

    best = loss(m)
    for f in range(3):
        for step in (0.2, -0.2):
            w = m.weights.copy()
            w[f] += step
            assert loss(Q.OrdinalModel(w, m.thresholds)) >= best - 1e-4
    for k in range(2):
        for step in (0.2, -0.2):
            t = m.thresholds.copy()
            t[k] += step
            assert loss(Q.OrdinalModel(m.weights, t)) >= best - 1e-4


def test_edge_rows(spark):
    rows = [(1, "good words here"), (1, "good words here"), (2, None), (3, ""), (None, "x"), (4, "y " * 60_000), (5, " ")]
    d = docs(spark, rows)
    some = labels(spark, [(1, 1, 0), (1, 0, 0), (2, 0, 0), (3, None, 0), (None, 1, 0), (77, 1, 1), (4, 1, 0)])
    model = Q.train(d, some)
    out = Q.scores(d.select("doc_id", "text"), model).collect()
    assert len(out) == len(rows)
    assert all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in out)
    assert len({r.tail_probability for r in out if r.doc_id == 1}) == 1
    # no usable labels: everything stays
    for none in ([], [(1, None, None)], [(999, 1, 0)]):
        kept = Q.select(d, labels(spark, none))
        assert kept.count() == len(rows) and kept.columns == d.columns
    clash = d.selectExpr("*", "1 AS keep", "2 AS expected_grade", "3 AS c0")
    assert Q.select(clash, labels(spark, [])).columns == clash.columns
    assert Q.select(docs(spark, []), some).collect() == []


def test_features_cover_whole_texts(monkeypatch):
    import pyarrow as pa
    text = "clean " * 3000 + "Zzz!!"
    found = {f for _, _, _, feature in Q._features(pa.array([text, "zzz", None])) for f in feature.tolist()}
    rows = [set(feature[row == r].tolist()) for _, _, row, feature in Q._features(pa.array([text, "zzz"])) for r in range(2)]
    assert len(found) > 3 and any(f < Q.BUCKETS for f in rows[0] & rows[1])


def test_every_word_weighs(spark):
    """Far more telling words than the 384 that once had a weight; a word of one document has one too."""
    n = 10_400
    rows = [(i, f"w{i % 400} v{i % 400} " + ("only" if i == 7 else "text")) for i in range(n)]
    d = docs(spark, rows)
    model = Q.train(d, labels(spark, [(i, int(i % 400 >= 200), 0) for i in range(n)]))
    out = Q.scores(d.select("doc_id", "text"), model).collect()
    assert len(out) == n and all(r.keep == (r.doc_id % 400 >= 200) for r in out)
    words = {f for _, _, _, found in Q._features(pa.array([f"w{i} v{i}" for i in range(400)] + ["only"]))
             for f in found.tolist() if f < Q.BUCKETS}
    assert len(words) > 790 and all(model.weights[f] != 0 for f in words)


def test_repeated_rows_count_once(spark):
    """Rows beyond twice train_rows once fell off, good ones first."""
    once = [(i, "fine words here" if i % 2 else "bad words here") for i in range(60)]
    hot = [(60, f"bad words again {i % 50}") for i in range(500)]
    some = labels(spark, [(i, i % 2, 0) for i in range(60)] + [(60, 0, 1)])
    d = docs(spark, once)
    model = Q.train(docs(spark, once + hot), some, 61)
    assert {(r.doc_id % 2, r.keep) for r in Q.scores(d.select("doc_id", "text"), model).collect()} == {(0, False), (1, True)}
    # three times the rows give the same model
    one, three = Q.train(d, some, 60), Q.train(docs(spark, once * 3), some, 60)
    assert np.allclose(one.weights, three.weights) and np.allclose(one.thresholds, three.thresholds)


def test_the_sample_ends_at_its_bound_of_pairs(spark, monkeypatch):
    """Whole documents in the sample's order, as if the others had no label."""
    d = docs(spark, [(i, f"common w{i} v{i % 5} " + ("awful" if i % 2 else "fine")) for i in range(60)])
    rows = [(i, i % 2 ^ 1, 0) for i in range(60)]
    whole = Q.train(d, labels(spark, rows))
    monkeypatch.setattr(Q, "MAX_PAIRS", 400)
    part = Q.train(d, labels(spark, rows))
    used = np.flatnonzero(part.weights)
    assert 0 < len(used) < len(np.flatnonzero(whole.weights))
    order = [r.doc_id for r in labels(spark, rows).orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    for n in range(1, 60):   # some prefix of the order gives the same model
        some = Q.train(d, labels(spark, [rows[i] for i in order[:n]])) if n in (20, 25, 30) else None
        if some is not None and len(np.flatnonzero(some.weights)) <= len(used):
            assert set(np.flatnonzero(some.weights)) <= set(used)
