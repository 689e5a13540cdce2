"""Packing by shortest-pack-first over the histogram of lengths.

Documents are tokenised and closed by an end id.  Only the full blocks of a
longer one and its tail are pieces at first, so a piece has at most
``capacity`` tokens, and their histogram (at most ``capacity`` numbers,
whatever the corpus) is all that the driver takes.  There, lengths are placed
longest first, each into the pack that is the shortest so far (has the most
room); packs that are alike are one pattern with a count, which an addition
moves as a whole or splits in two.  A new pack is opened if a piece fits into
none, and as many are allowed as the tokens fill: ``total // capacity`` full
sequences, and one for each binary digit of the rest (those have a power of
two as their length, so they need no padding either).  A piece that would
need a pack beyond these is cut over the room that is left in the others.  So
there is no padding at all, and few documents are cut.

A piece's rank among those of its length, numbered by written part, tells its
pattern, sequence and offset; the ranks to be cut are laid end to end along
the gaps, also by arithmetic on ranks.  Ids are read again for the lengths
that have ranks to be cut.

Defined cases: null and empty texts have only the end id; repeated rows are
packed once each; null ids are kept; an empty table gives no rows; only id
and text are read, so no other column can clash.
"""
from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runoff.llm.common import written
from runoff.llm.tokens import column_encoder

CAPACITY = 2048
#: Bytes of ids in an Arrow batch.
BATCH_BYTES = 4 << 20

_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("doc_tokens", pa.int64()),
    ("ids", pa.binary()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64())])
_PIECES_SQL = ("doc_id long, start long, length int, doc_tokens long, ids binary, ids_crc32 long, "
               "part int, nth long")


def _cut(spec, capacity: int, end_id: int, with_ids: bool):
    import zlib

    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]):
        enc = column_encoder(spec.value)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        rows, held = [], 0
        for b in batches:
            docs = b.column("doc_id").to_pylist()
            for r, found in enc.rows(b.column("text")):
                ids = found.astype("<u4", copy=False).tobytes() + end
                for at in range(0, len(ids), 4 * capacity):
                    body = ids[at:at + 4 * capacity]
                    n = len(body) // 4
                    kept = body if with_ids or n < capacity else None
                    rows.append((docs[r], at // 4, n, len(ids) // 4, kept, zlib.crc32(body), part, int(seen[n])))
                    seen[n] += 1
                held += len(ids)
                if held >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1,
                 with_ids: bool = True) -> DataFrame:
    """A written table of the documents' full blocks and tails, numbered
    within part and length.  ``ids`` are little-endian unsigned 32-bit; full
    blocks are never cut again, so they need theirs only ``with_ids``.
    ``tokenizer`` is the path of a tokenizer file on the driver; its text (a
    few MB, whatever the corpus) is broadcast."""
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                   .mapInArrow(_cut(spec, capacity, end_id, with_ids), _PIECES_SQL), "blocks")


@dataclass
class Packing:
    """What the histogram's packing says about ranks.

    whole: by length, how many pieces stay whole (the first ranks).
    events: by length, rows (first rank, packs, first sequence, offset): ranks
    from the first on lie one in each of the packs, then one more in each.
    cut: by length, where its cut ranks begin on the line of gaps.
    gaps: rows (place on the line, gaps, size, first sequence, offset).
    """
    whole: dict[int, int] = field(default_factory=dict)
    events: dict[int, np.ndarray] = field(default_factory=dict)
    cut: dict[int, int] = field(default_factory=dict)
    gaps: np.ndarray | None = None


def shortest_pack_first(counts: dict[int, int], capacity: int) -> Packing:
    """Packs ``counts`` pieces of each length (1 to ``capacity``)."""
    total = sum(length * n for length, n in counts.items())
    unopened, rest = divmod(total, capacity)
    opened = 0
    # packs that are alike: (-room, first sequence, packs, capacity), the shortest on top
    heap = [(-(1 << bit), unopened + rest.bit_count() - 1 - (rest & ((1 << bit) - 1)).bit_count(), 1, 1 << bit)
            for bit in range(rest.bit_length()) if rest >> bit & 1]
    heapq.heapify(heap)
    out, line = Packing(), 0
    for length in sorted((k for k, n in counts.items() if n), reverse=True):
        left, rank, events = counts[length], 0, []
        while left:
            if heap and -heap[0][0] >= length:
                room, first, packs, size = heapq.heappop(heap)
                room = -room
            elif opened < unopened:
                # a new pack takes what fits before the next is opened
                packs = min(max(1, left // (capacity // length)), unopened - opened)
                first, room, size = opened, capacity, capacity
                opened += packs
            else:
                break
            if left < packs:
                heapq.heappush(heap, (-room, first + left, packs - left, size))
                packs = left
            # pieces go on to these packs for as long as they stay the shortest
            next_room = -heap[0][0] if heap else 0
            more = min(1 + max(0, room - next_room) // length, room // length, left // packs)
            events.append((rank, packs, first, size - room))
            rank += packs * more
            left -= packs * more
            room -= length * more
            if room:
                heapq.heappush(heap, (-room, first, packs, size))
        out.whole[length] = rank
        if events:
            out.events[length] = np.array(events, np.int64)
        if left:
            out.cut[length] = line
            line += left * length
    gaps, at = [], 0
    if unopened > opened:
        heapq.heappush(heap, (-capacity, opened, unopened - opened, capacity))
    while heap:
        room, first, packs, size = heapq.heappop(heap)
        gaps.append((at, packs, -room, first, size + room))
        at -= room * packs
    out.gaps = np.array(gaps, np.int64).reshape(-1, 5)
    return out


def locate(packing: Packing, length: np.ndarray, rank: np.ndarray):
    """(sequence, offset) of whole pieces."""
    seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
    for k in np.unique(length):
        own = np.flatnonzero(length == k)
        table = packing.events[int(k)]
        row = table[np.searchsorted(table[:, 0], rank[own], "right") - 1]
        nth = rank[own] - row[:, 0]
        seq[own] = row[:, 2] + nth % row[:, 1]
        off[own] = row[:, 3] + nth // row[:, 1] * k
    return seq, off


def spread(packing: Packing, length: int, rank: int) -> list[tuple[int, int, int, int]]:
    """(start within the piece, length, sequence, offset) of the parts of a
    piece that is cut over the gaps."""
    at = packing.cut[length] + (rank - packing.whole[length]) * length
    out, done = [], 0
    g = int(np.searchsorted(packing.gaps[:, 0], at, "right")) - 1
    while done < length:
        place, packs, size, first, offset = packing.gaps[g].tolist()
        nth, inside = divmod(at + done - place, size)
        if nth >= packs:
            g += 1
            continue
        n = min(size - inside, length - done)
        out.append((done, n, first + nth, offset + inside))
        done += n
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, doc_tokens, sequence_id, offset, ids_crc32 and
    ids of every piece of ``token_pieces``' table."""
    spark = pieces.sparkSession
    sizes = written(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "sizes")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    packing = shortest_pack_first(counts, capacity)
    shared = spark.sparkContext.broadcast(packing)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_base"))
    ranked = (pieces.join(base, ["part", "length"])
              .withColumn("_rank", F.col("_base") + F.col("nth")).drop("part", "nth", "_base"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        seq, off = locate(shared.value, length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": seq, "offset": off})

    columns = ["doc_id", "start", F.col("length").cast("long").alias("length"), "doc_tokens"]
    if not packing.cut:
        whole, some = ranked, None
    else:
        # a literal: at most one number a length
        limit = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for k in packing.cut for x in (k, packing.whole[k])]),
                                        F.col("length")), F.lit(2**62))
        whole, some = ranked.where(F.col("_rank") < limit), ranked.where(F.col("length").isin(list(packing.cut)))
        some = some.where(F.col("_rank") >= limit)
    out = whole.withColumn("_p", place("length", "_rank")).select(
        *columns, "_p.sequence_id", "_p.offset", "ids_crc32", "ids")
    if some is None:
        return out

    def parts(batches: Iterator[pa.RecordBatch]):
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        for b in batches:
            rows = []
            for doc, start, n, tokens, rank, ids in zip(*(b.column(c).to_pylist() for c in (
                    "doc_id", "start", "length", "doc_tokens", "_rank", "ids"))):
                for at, k, seq, off in spread(shared.value, n, rank):
                    rows.append((doc, start + at, k, tokens, seq, off, ids[4 * at:4 * (at + k)]))
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=pa.schema(
                [(c, pa.int64()) for c in names[:-1]] + [("ids", pa.binary())]))

    some = some.drop("ids_crc32").mapInArrow(
        parts, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
    return out.unionByName(some.withColumn("ids_crc32", F.crc32("ids")))
