import heapq
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from runoff.llm import histogram_packing as hp
from runoff.llm.queries import QUERIES
from tests.llm.helpers import SF, docs

PATH = P.path("word_bpe_49k.json")


def loads(places):
    """Length of each sequence; asserts that it has no gap and no overlap."""
    by = {}
    for seq, offset, n in places:
        by.setdefault(seq, []).append((offset, n))
    out = {}
    for seq, parts in by.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at, (seq, sorted(parts))
            at += n
        out[seq] = at
    return out


def check_loads(found, total, capacity):
    assert sorted(found) == list(range(total // capacity + (total % capacity).bit_count()))
    assert all(n == capacity or (n < capacity and n.bit_count() == 1) for n in found.values())
    assert sum(found.values()) == total


def brute_force(counts, capacity):
    """One piece at a time into the pack with the most room: sorted rooms, and
    how many of each length find none."""
    total = sum(k * n for k, n in counts.items())
    unopened, rest = divmod(total, capacity)
    heap = [-(1 << b) for b in range(rest.bit_length()) if rest >> b & 1]
    heapq.heapify(heap)
    unplaced = {}
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            if heap and -heap[0] >= length:
                heapq.heapreplace(heap, heap[0] + length)
            elif unopened:
                unopened -= 1
                heapq.heappush(heap, length - capacity)
            else:
                unplaced[length] = unplaced.get(length, 0) + 1
    return sorted([-r for r in heap if r] + [capacity] * unopened), unplaced


def histograms():
    rng = random.Random(5)
    yield from ({}, {1: 1}, {5: 3}, {7: 9, 2: 4}, {8: 5, 5: 8})
    for _ in range(150):
        yield {rng.randrange(1, 33): rng.randrange(0, 30) for _ in range(rng.randrange(0, 12))}


@pytest.mark.parametrize("capacity", [32, 50])
def test_patterns_equal_one_piece_at_a_time(capacity):
    for counts in histograms():
        packing = hp.shortest_pack_first(counts, capacity)
        rooms, unplaced = brute_force(counts, capacity)
        assert sorted(int(g[2]) for g in packing.gaps for _ in range(g[1])) == rooms
        assert {k: n - packing.whole[k] for k, n in counts.items() if n and n > packing.whole[k]} == unplaced


@pytest.mark.parametrize("capacity", [32, 50])
def test_every_rank_has_its_place(capacity):
    for counts in histograms():
        packing = hp.shortest_pack_first(counts, capacity)
        places = []
        for length, n in counts.items():
            for rank in range(n):
                if rank < packing.whole[length]:
                    seq, off = hp.locate(packing, np.array([length]), np.array([rank]))
                    places.append((int(seq[0]), int(off[0]), length))
                else:
                    done = 0
                    for at, k, seq, off in hp.spread(packing, length, rank):
                        assert at == done
                        done += k
                        places.append((seq, off, k))
                    assert done == length
        check_loads(loads(places), sum(k * n for k, n in counts.items()), capacity)


def test_many_lengths_cut_few_and_stay_small():
    rng = random.Random(6)
    counts = {k: rng.randrange(1, 200) for k in range(1, 2049)}
    packing = hp.shortest_pack_first(counts, 2048)
    assert sum(n - packing.whole[k] for k, n in counts.items()) < 0.03 * sum(counts.values())
    huge = {k: int(1e12 / k**2) for k in range(1, 2049)}
    assert sum(map(len, hp.shortest_pack_first(huge, 2048).events.values())) < 60_000


def round_trip(spark, rows, out, end_id=1, ids_of=None):
    """``out`` holds every token of ``rows`` (doc_id, text) once, in gapless sequences without padding."""
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    total = 0
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        total += len(ids)
        at = 0
        for r in sorted(by[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            body = np.array(ids[at:at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(body)
            if ids_of is not None:
                assert bytes(r.ids) == body
            at += r.length
        assert at == len(ids)
    check_loads(loads([(r.sequence_id, r.offset, r.length) for r in out]), total, 2048)


def test_query_round_trip(spark):
    out = QUERIES["op13_histogram_packing"](spark, SF).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    round_trip(spark, rows, out)


def test_edge_rows(spark):
    rng = random.Random(8)
    rows = [(1, None), (None, ""), (2, "word"), (3, "w " * 5000), (4, " \n"), (5, "x" * 9000)]
    rows += [(i, " ".join("word" for _ in range(rng.choice([1400, 1500])))) for i in range(10, 40)]
    df = docs(spark, rows).selectExpr("*", "1 AS length", "2 AS part", "3 AS start", "4 AS ids", "5 AS nth").repartition(3)
    out = hp.pack(hp.token_pieces(df, PATH)).collect()
    round_trip(spark, rows, out, ids_of=True)
    assert len({r.doc_id for r in out if r.length != r.doc_tokens} - {3}) > 3  # some are cut over gaps
    none = hp.pack(hp.token_pieces(docs(spark, []), PATH))
    assert none.collect() == []


def test_repeated_rows_are_packed_once_each(spark):
    out = hp.pack(hp.token_pieces(docs(spark, [(1, "a b c")] * 700 + [(None, None)] * 5), PATH)).collect()
    assert sum(r.length for r in out) == 700 * 4 + 5
    check_loads(loads([(r.sequence_id, r.offset, r.length) for r in out]), 2805, 2048)
