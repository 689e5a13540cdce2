import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline
from runoff.llm import mixing, queries
from runoff.llm.common import connected_components, written
from tests.llm.helpers import SF, components, docs, shingles

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_over_their_predecessors(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        d = written(stage(spark, d, SF), name)
        out[name] = d.collect()
        assert name == corpus_pipeline.STAGES[-1][0] or d.columns == COLUMNS
    kept = {r.doc_id for r in out["quality_classifier"]}
    clean = [i for i, r in labels.items() if r.quality == 1 and r.toxic == 0]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean)
    bad = [i for i in labels if i not in set(clean)]
    assert sum(i in kept for i in bad) <= 0.4 * len(bad)  # trained on some sixty labels only
    # near copies: the smallest id of each component of what came in
    rows = out["quality_classifier"]
    sets = [shingles(r.text) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    want = set(components(len(rows), links, [r.doc_id for r in rows]))
    assert sorted(r.doc_id for r in out["ngram_jaccard_join"]) == sorted(want)
    # mixing: each source's words near its target
    sizes = {}
    for r in out["ngram_jaccard_join"]:
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").encode().split())
    target, taken = mixing.water_filled(sizes), {}
    for r in out["source_mixing"]:
        taken[r.source] = taken.get(r.source, 0) + len(r.text.encode().split())
    assert all(abs(taken.get(s, 0) - t) <= mixing.BLOCK for s, t in target.items())
    # packing: every token of the mix, in gapless sequences
    t = Tokenizer.from_file(P.path(corpus_pipeline.TOKENIZER))
    crcs = []
    for r in out["source_mixing"]:
        ids = t.encode(r.text, add_special_tokens=False).ids + [0]
        crcs += [(r.doc_id, p // 2048, zlib.crc32(np.array(ids[p:p + 2048], "<u4").tobytes())) for p in range(0, len(ids), 2048)]
    last = out["best_fit_packing"]
    assert sorted(crcs) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in last)
    by = {}
    for r in last:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_stages_take_empty_and_odd_tables(spark):
    for rows in ([], [(1, None), (1, None), (2, ""), (None, "some words"), (3, "a b c"), (3, "a b c")]):
        d = docs(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            d = stage(spark, d, SF)
        d.collect()


def test_queries_have_one_name_each():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names if n.startswith("op")] == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in names and set(queries.oracle_sql()) <= set(names)


def test_components(spark):
    import random
    rng = random.Random(1)
    n = 300
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(200)] + [(0, i) for i in range(250, 300)] + [
        (i, i + 1) for i in range(100, 140)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    want = components(n, [(a, b) for a, b in edges if a is not None], list(range(n)))
    assert all(got.get(i, i) == want[i] for i in range(n))
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
