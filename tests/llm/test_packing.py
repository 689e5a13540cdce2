import math
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from runoff.llm import packing
from runoff.llm.queries import QUERIES
from runoff.llm import tokens
from runoff.llm.tokens import ColumnEncoder, WordEncoder
from tests.llm.helpers import SF, docs

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_encoder_equals_the_library(tokenizer):
    enc = WordEncoder(open(PATH, encoding="utf-8").read())
    for text in odd_texts():
        assert np.frombuffer(enc.encode(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def odd_texts():
    rng = random.Random(1)
    parts = ["Hello", "it's", "WE'LL", "don't!", "42nd", "naïve", "ÜBER", "Σίσυφος", "ΟΔΟΣ", "日本語", "éte", " ",
             "\x1c", " ", "\x85", "½", "ª", "<|endoftext|>", "😀", "́", "İstanbul", "ﬁ", "$%&", "''s", " ", "\n", "\t", ""]
    return ["".join(rng.choice(parts) + rng.choice(["", " ", "  ", "\n"]) for _ in range(rng.randrange(12)))
            for _ in range(300)]


@pytest.mark.parametrize("segment,pieces", [(1 << 20, 10**6), (40, 20)])
def test_column_encoder_equals_the_library(tokenizer, monkeypatch, segment, pieces):
    """Also with segments smaller than rows, and pieces forgotten all the time."""
    monkeypatch.setattr(tokens, "SEGMENT", segment)
    monkeypatch.setattr(tokens, "PIECES", pieces)
    texts = odd_texts() + [None, "", "  ", "J̌A̧ ÀÉ×÷ßÿ", "a" * 300]
    texts += [t for t in texts if t][:50] + [" ".join(t for t in texts if t)]
    enc = ColumnEncoder(open(PATH, encoding="utf-8").read())
    column = pa.array(["x", *texts])[1:]
    got = {r: ids.tolist() for r, ids in enc.rows(column)}
    assert got == {r: tokenizer.encode(t or "", add_special_tokens=False).ids for r, t in enumerate(texts)}
    assert len(enc.known) <= pieces + max(len(set((t or "").split())) for t in texts) * 3


def check(rows, n_tokens):
    """Gapless sequences of at most 2048 tokens."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r.length for r in rows) == n_tokens
    return len(by)


def test_query_round_trip_and_number_of_sequences(spark, tokenizer):
    rows = QUERIES["op8_best_fit_packing"](spark, SF).collect()
    got = {}
    for r in rows:
        assert got.setdefault((r.doc_id, r.piece), (r.start, r.length, r.ids_crc32)) == (r.start, r.length, r.ids_crc32)
    want, total = {}, 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        for p in range(0, len(ids), 2048):
            part = ids[p:p + 2048]
            want[(r.doc_id, p // 2048)] = (p, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    assert got == want
    assert check(rows, total) <= math.ceil(total / 2048) + 1


def test_edge_rows(spark):
    rows = [(1, None), (1, None), (None, ""), (2, "word"), (2, "word"), (3, "w " * 5000)]
    df = docs(spark, rows).selectExpr("*", "1 AS length", "2 AS piece", "3 AS start", "4 AS ids")
    pieces = packing.token_pieces(df, PATH).cache()
    out = packing.pack(pieces, ["doc_id", "piece", "length", "ids"]).collect()
    assert sorted((str(r.doc_id), r.piece, r.start, r.length) for r in out) == sorted(
        [("1", 0, 0, 1)] * 2 + [("None", 0, 0, 1)] + [("2", 0, 0, 2)] * 2
        + [("3", 0, 0, 2048), ("3", 1, 2048, 2048), ("3", 2, 4096, 905)])
    check(out, sum(r.length for r in out))
    assert b"".join(r.ids for r in sorted(out, key=lambda r: r.piece) if r.doc_id == 3)[-4:] == b"\0\0\0\0"
    none = packing.token_pieces(docs(spark, []), PATH)
    assert packing.pack(none, ["doc_id"]).collect() == []


def test_ids_digest_in_the_engine(spark):
    r = packing.token_pieces(docs(spark, [(1, "a b")]), PATH).select("ids", F.crc32("ids").alias("c")).first()
    assert zlib.crc32(r.ids) == r.c


def subset_best(lengths, room):
    best = {0}
    for x in lengths:
        best |= {b + x for b in best if b + x <= room}
    return max(best)


def test_fullest_combination_equals_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randrange(1, 40): rng.randrange(1, 5) for _ in range(rng.randrange(1, 7))}
        room = rng.randrange(1, 90)
        found = packing.fullest(counts, room)
        assert all(n <= counts[k] for k, n in found.items())
        total = sum(k * n for k, n in found.items())
        assert total == subset_best([k for k, n in counts.items() for _ in range(n)], room)


def test_bins_hold_every_piece():
    rng = random.Random(3)
    counts = {rng.randrange(1, 2049): rng.randrange(1, 300) for _ in range(150)} | {1: 5000}
    bins = packing.minimum_bin_slack(dict(counts), 2048)
    used = {}
    for times, mix in bins:
        assert sum(k * n for k, n in mix.items()) <= 2048
        for k, n in mix.items():
            used[k] = used.get(k, 0) + n * times
    assert used == counts and len(bins) <= 2 * len(counts)
