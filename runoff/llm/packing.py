"""Best-fit packing by minimum bin slack.

Documents are tokenised and closed by an end id; longer ones are cut into
pieces of the capacity.  Only the histogram of piece lengths (at most
``capacity`` numbers, whatever the corpus) goes to the driver.  There, bin by
bin, the longest remaining length is the seed, and a subset-sum dynamic
programme over the available lengths, on bitsets, finds the fullest
combination that fits beside it; the combination is taken out as often as
its lengths last (it stays the fullest until one runs out), so there are at
most ``capacity`` different ones.  A piece's rank among those of its length
then gives its sequence and offset.

Defined cases: null and empty texts have only the end id; repeated rows are
packed once each; null ids are kept; an empty table gives no rows; extra
columns are not read, and a column of the input cannot clash as only id and
text are taken.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runoff.llm.common import tasks, tidied, with_start
from runoff.llm.tokens import column_encoder

CAPACITY = 2048
#: Bytes of ids in an Arrow batch.
BATCH_BYTES = 4 << 20


def _cut(spec, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]):
        enc = column_encoder(spec.value)
        names = ["doc_id", "piece", "start", "length", "ids"]
        rows, held = [], 0
        for b in batches:
            docs = b.column("doc_id").to_pylist()
            for r, found in enc.rows(b.column("text")):
                doc, ids = docs[r], found.astype("<u4", copy=False).tobytes() + end
                for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                    body = ids[at:at + 4 * capacity]
                    rows.append((doc, p, at // 4, len(body) // 4, body))
                held += len(ids)
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=_PIECES)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=_PIECES)
    return run


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                     ("length", pa.int32()), ("ids", pa.binary())])


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian unsigned 32-bit) of
    every piece.  ``tokenizer`` is the path of a tokenizer file on the driver;
    its text (a few MB, whatever the corpus) is broadcast."""
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        tidied(_cut(spec, capacity, end_id)), "doc_id long, piece int, start long, length int, ids binary")


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum up to
    ``room``: subset sums as bits of an integer, long lengths first."""
    full, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted(counts, reverse=True):
        left, take = min(counts[length], room // length), 1
        while left > 0:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & full
            left -= take
            take *= 2
        if reach >> room:
            break
    total, out = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            out[length] = out.get(length, 0) + take
    return out


def minimum_bin_slack(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of bins, {length: how many in each bin}) for all pieces."""
    left, bins = {k: v for k, v in counts.items() if v}, []
    while left:
        seed = max(left)
        rest = dict(left)
        rest[seed] -= 1
        mix = fullest({k: v for k, v in rest.items() if v and k <= capacity - seed}, capacity - seed)
        mix[seed] = mix.get(seed, 0) + 1
        times = min(left[k] // n for k, n in mix.items())
        for k, n in mix.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
        bins.append((times, mix))
    return bins


def _places(bins: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, number in each bin, first sequence, offset)."""
    used: dict[int, int] = {}
    out: dict[int, list] = {}
    first = 0
    for times, mix in bins:
        offset = 0
        for length in sorted(mix, reverse=True):
            n = mix[length]
            out.setdefault(length, []).append((used.get(length, 0), n, first, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        first += times
    return {k: np.array(v, np.int64) for k, v in out.items()}


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``capacity``) with sequence_id and
    offset: their places in as few gapless sequences as the method finds.
    Rows that agree in the ``order`` columns must be alike.  ``pieces`` is
    read twice, so pass a written table."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = spark.sparkContext.broadcast(_places(minimum_bin_slack(counts, capacity)))
    ranked = with_start(pieces, ["length"], [F.col(c) for c in order], F.lit(1), "_rank", tasks(spark))

    def place(frames: Iterator[pd.DataFrame]):
        for f in frames:
            seq, off = np.zeros(len(f), np.int64), np.zeros(len(f), np.int64)
            rank, length = f["_rank"].to_numpy(), f["length"].to_numpy()
            for k in np.unique(length):
                own = np.flatnonzero(length == k)
                table = places.value[int(k)]
                row = table[np.searchsorted(table[:, 0], rank[own], "right") - 1]
                nth = rank[own] - row[:, 0]
                seq[own] = row[:, 2] + nth // row[:, 1]
                off[own] = row[:, 3] + nth % row[:, 1] * k
            yield f.drop(columns="_rank").assign(sequence_id=seq, offset=off)

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.select(*pieces.columns, "_rank").mapInPandas(place, f"{kind}, sequence_id long, offset long")
