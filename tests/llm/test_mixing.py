import random

import pytest
from pyspark.sql import functions as F

from runoff.llm import mixing
from runoff.llm.common import located, running
from runoff.llm.queries import QUERIES
from tests.llm.helpers import SF, docs, words


def test_targets_by_hand():
    # weights a 3, b 1, c 2, null 3 (last) share 150 % of 1000 words; a, then the null source, then c stop
    # at twice their size, b gets the rest
    t = mixing.water_filled({"b": 500, "a": 100, "c": 300, None: 100})
    assert t == {"a": 200, "b": 500, "c": 600, None: 200}
    assert mixing.water_filled({}) == {} and mixing.water_filled({"a": 0}) == {"a": 0.0}
    # code points, not a locale's order
    assert list(mixing.water_filled({"ä": 1, "a": 1, "Z": 1, None: 1})) == ["Z", "a", "ä", None]


def summary(rows, block=mixing.BLOCK):
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        size, source_size, target, taken = by.get(r.source, (0, r.source_size, r.target, 0))
        by[r.source] = (size + r.size, r.source_size, r.target, taken + r.taken)
    for size, source_size, target, taken in by.values():
        assert size == source_size and target <= 2 * size and abs(taken - target) < block + 1
    return by


def test_query_meets_its_targets_and_reruns_agree(spark):
    q = QUERIES["op1_source_mixing"]
    first = q(spark, SF).collect()
    source = {r.doc_id: (r.source, len(words(r.text))) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(first) == len(source) and all(r["size"] == source[r.doc_id][1] for r in first)
    rows = mixing.Mix(spark.read.parquet(f"{SF}/documents.parquet")).documents().collect()
    by = summary(rows)
    want = mixing.water_filled({s: v[0] for s, v in by.items()})
    assert {s: v[2] for s, v in by.items()} == pytest.approx(want)
    again = q(spark, SF).repartition(5).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_slots_and_blocks_are_whole(spark):
    rows = [(i, " ".join(["w"] * (i % 37)), f"s{i % 4}" if i % 5 else "big") for i in range(300)]
    mix = mixing.Mix(docs(spark, rows), block=8, shard=16)
    slots = mix.slots().collect()
    need = {r[0]: r[5] for r in mix.sources}
    assert sorted(r.slot for r in slots) == list(range(sum(need.values())))
    assert all(r.shard == r.slot // 16 for r in slots)
    for sid, n in need.items():
        assert sorted(r.k for r in slots if r.sid == sid) == list(range(n))
    blocks = mix.blocks().collect()
    assert sorted(r.slot for r in blocks) == sorted(r.slot for r in slots)
    assert len({(r.sid, r["pass"], r.block) for r in blocks}) == len(blocks)
    summary(mix.documents().collect(), 8)
    # a shard's counts are drawn: they differ between shards
    drawn = {}
    for r in slots:
        drawn.setdefault(r.shard, []).append(r.sid)
    assert len({tuple(sorted(v)) for v in drawn.values()}) > 1


def test_edge_rows(spark):
    rows = [(1, None, "a"), (1, None, "a"), (2, "", None), (3, " \t ", "b"), (4, "x y", None), (4, "x y", None),
            (None, "p q r", "a"), (5, "long " * 3000, "b"), (6, "solo", "c")]
    df = docs(spark, rows).selectExpr("*", "1 AS size", "2 AS target", "3 AS sid", "4 AS start", "5 AS taken")
    out = mixing.Mix(df, block=4).documents().collect()
    assert sorted((str(r.doc_id), r.size) for r in out) == sorted(
        (str(r[0]), len(words(r[1]))) for r in rows)
    summary(out, 4)
    assert mixing.Mix(docs(spark, [])).documents().collect() == []
    only_empty = mixing.Mix(docs(spark, [(1, None, "a")])).documents().collect()
    assert [(r.taken, r.target) for r in only_empty] == [(0, 0.0)]


def test_mixed_texts_hold_the_words_taken(spark):
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(3 * i % 50)), f"s{i % 3}") for i in range(120)]
    rows += [(5, rows[5][1], "s2"), (None, "n1 n2 n3", None)]
    df = docs(spark, rows)
    mix = mixing.Mix(df, block=8)
    taken = {}
    for r in mix.documents().collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    out = mixing.mixed_texts(df.selectExpr("*", "1 AS words", "2 AS size", "3 AS copy"), block=8)
    assert out.columns == [*df.columns, "words", "size", "copy"]
    got, texts = {}, {r[0]: r[1] for r in rows}
    for r in out.collect():
        own = r.text.split()
        got[r.doc_id] = got.get(r.doc_id, 0) + len(own)
        source = texts[r.doc_id].split()
        at = iter(source)
        assert all(w in at for w in own)  # in order
        assert len(own) < len(source) or r.text == texts[r.doc_id]
        assert r.n_chars == len(r.text)
    assert got == {k: v for k, v in taken.items() if v}


def test_no_python_in_the_plan(spark):
    plan = mixing.Mix(docs(spark, [(1, "a b c", "s")])).documents()._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_targets_of_a_table_as_of_a_dict(spark):
    rng = random.Random(3)
    for n, limit in ((1, 2), (7, 2), (60, 2), (200, 1.75)):
        sizes = {f"s{i:03}": int(rng.paretovariate(0.6)) if rng.random() < 0.9 else 0 for i in range(n)}
        table = spark.createDataFrame([(i, s, sizes[s]) for i, s in enumerate(sorted(sizes))], "sid int, source string, source_size long")
        got = {r.source: r.target for r in mixing.with_targets(table, limit=limit).collect()}
        assert got == pytest.approx(mixing.water_filled(sizes, limit=limit), rel=1e-12)
        assert limit != 2 or got == mixing.water_filled(sizes)


def test_as_many_sources_as_documents(spark):
    rows = [(i, " ".join(["w"] * (i % 23)), f"s{i}") for i in range(mixing.FEW + 900)] + [(-1, "a b c", None)]
    mix = mixing.Mix(docs(spark, rows), block=8, shard=64)
    slots = mix.slots()
    # the driver has no list of them, nor has the plan
    assert len(slots._jdf.queryExecution().toString()) < 150_000
    need, got = {r[0]: r[5] for r in mix.sources}, {}
    for r in slots.collect():
        got.setdefault(r.sid, []).append((r.k, r.slot))
    assert {sid: n for sid, n in need.items() if n} == {sid: len(v) for sid, v in got.items()}
    assert all(sorted(k for k, _ in v) == list(range(need[sid])) for sid, v in got.items())
    assert sorted(s for v in got.values() for _, s in v) == list(range(sum(need.values())))
    by = summary(mix.documents().collect(), 8)
    assert {s: v[2] for s, v in by.items()} == pytest.approx(mixing.water_filled({s: v[0] for s, v in by.items()}))


def test_running_sums_and_places(spark):
    sizes = [3, 0, 5, 1, 0, 12, 4]
    spans = running(spark.createDataFrame(list(enumerate(sizes)), "sid int, length long"), "sid", ["length"], stretch=3)
    assert [r.length_before for r in spans.orderBy("sid").collect()] == [sum(sizes[:i]) for i in range(len(sizes))]
    spans = spans.withColumnRenamed("length_before", "start")
    line = [i for i, n in enumerate(sizes) for _ in range(n)]
    df = spark.createDataFrame([(i, i if i < len(line) else None) for i in range(len(line) + 5)], "id long, at long")
    for parts in (1, 4, 100):
        out = located(df, F.col("at"), len(line), spans, ["sid"], parts, spread="id").collect()
        assert sorted(r.id for r in out) == list(range(len(line) + 5))
        assert all(r.sid == line[r.at] for r in out if r["at"] is not None)


def test_texts_of_more_sources_than_an_alias_table_holds(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FEW", 3)
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(3 * i % 50)), f"s{i % 41}") for i in range(120)]
    sizes, taken = {}, {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + len(r[1].split())
    for r in mixing.mixed_texts(docs(spark, rows), block=8).collect():
        own, source = r.text.split(), iter(rows[r.doc_id][1].split())
        assert all(w in source for w in own)
        taken[r.source] = taken.get(r.source, 0) + len(own)
    assert all(abs(taken.get(s, 0) - t) <= 8 for s, t in mixing.water_filled(sizes).items())
