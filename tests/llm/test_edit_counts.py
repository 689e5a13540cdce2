import random

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from runoff.llm import edit_counts as E
from runoff.llm.queries import QUERIES, derived_edits
from runoff.llm.tokens import WordEncoder
from tests.llm.helpers import SF, docs

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def apply(text, edits):
    text = text or ""
    for start, end, new in edits or []:
        a = min(max(start or 0, 0), len(text))
        b = min(max(end or 0, a), len(text))
        text = text[:a] + (new or "") + text[b:]
    return text


def test_trees_count_as_the_whole_text_does(monkeypatch, whole):
    monkeypatch.setattr(E, "LEAF", 12)
    enc = WordEncoder(open(PATH, encoding="utf-8").read())
    count = lambda s: len(enc.encode(s.encode())) // 4
    rng = random.Random(5)
    parts = ["hello", "wor", "ld's", "  ", "\n", " ", "x", "it's", "Ünï", "42", "!!", "naïve", " ", "日本", " "]
    for _ in range(150):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(60)))
        t = E.CountedText(text, count)
        assert t.text() == text and t.tokens.total() == whole(text)
        for _ in range(6):
            a = rng.randint(-2, len(text) + 3)
            e = (a, a + rng.choice([-1, 0, 0, 1, 10, 40]), "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 20]))))
            t.edit(*e)
            text = apply(text, [e])
            assert (t.text(), t.tokens.total(), t.chars.total()) == (text, whole(text), len(text))
            if rng.random() < 0.3:  # a kept tree goes on
                t = E.CountedText(text, count, (t.chars.heap, t.tokens.heap))


def test_only_touched_leaves_are_encoded():
    asked = []
    t = E.CountedText("word " * 20_000, lambda s: asked.append(len(s)) or len(s.split()))
    asked.clear()
    t.edit(50_000, 50_003, "x")
    assert sum(asked) == t.reencoded <= 3 * E.LEAF and t.tokens.total() == 20_000


def test_sums():
    s = E.Sums([3, 0, 2, 5])
    assert [s.find(i) for i in (0, 2, 3, 4, 5, 9)] == [(0, 0), (0, 2), (2, 0), (2, 1), (3, 0), (3, 4)]
    s.put(1, 4)
    assert s.total() == 14 and s.find(3) == (1, 0)


def test_query_equals_whole_encoding(spark, whole):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    text = {}
    for r in derived_edits(d).select("doc_id", "text", "edits").collect():
        text[r.doc_id] = (r.text or "", apply(r.text, [tuple(e) for e in r.edits]))
    rows = QUERIES["op6_edit_counts"](spark, SF).collect()
    assert len(rows) == len(text)
    for r in rows:
        before, after = text[r.doc_id]
        assert (r.n_tokens_before, r.n_tokens_after, r.n_chars) == (whole(before), whole(after), len(after))
    assert sum(r.n_reencoded for r in rows) < 0.7 * sum(len(a) for _, a in text.values())


def test_edge_rows(spark, whole):
    edit = "array<struct<start: int, end: int, text: string>>"
    long = "long words " * 30_000
    rows = [(1, None, None), (1, None, []), (2, "", [(5, 9, "new text")]), (3, "a b", [None, (None, None, None), (0, 1, "")]),
            (None, "it's", [(2, 3, " ")]), (4, long, [(7, 2, "x"), (0, 10**6, "")]), (4, long, [(3, 8, "")])]
    df = spark.createDataFrame(rows, f"doc_id long, text string, edits {edit}").selectExpr("*", "1 AS n_chars", "2 AS k0")
    trees = E.with_trees(df, PATH)
    out = E.edited(trees, PATH)
    assert set(out.columns) >= {"doc_id", "k0", "n_tokens", "n_chars", "n_reencoded", "text", "tree"}
    key = lambda t: tuple(map(str, t))
    want = sorted(((r[0], apply(r[1], [e for e in r[2] or [] if e is not None])) for r in rows), key=key)
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=key)
    assert got == want
    assert all(r.n_tokens == whole(r.text) for r in out.collect())
    # edited texts and trees go into the next round
    more = out.withColumn("edits", F.expr("array(named_struct('start', 0, 'end', 1, 'text', 'Z '))"))
    assert all(r.n_tokens == whole(r.text) for r in E.edited(more, PATH).collect())
    empty = E.with_trees(docs(spark, []), PATH)
    assert empty.collect() == []
