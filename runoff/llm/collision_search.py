"""Approximate nearest neighbours by collision counting.

Every vector is projected on ``PROJECTIONS`` single directions (random
orthogonal bases); the index of a shard of vectors is, for each direction,
the sorted array of its projections.  A query opens a window around its own
projection in each array.  Vectors in at least a threshold number of windows
are verified, that is scored in double precision on the original vectors.
If fewer than k verified vectors lie within the radius that the windows
stand for, virtual rehashing widens them by a factor, on the same arrays.
The threshold lets a vector at exactly that radius through with probability
of 0.95, nearer ones with more, so that is the least expected recall.

Largest inner product is nearest on the unit sphere: vectors are scaled by
the largest norm and get one more dimension that makes up their norm.

Every shard starts at a radius that holds some k of its vectors, guessed for
each query from a bounded sample of the shard (at most ``SAMPLE`` vectors).
Shards and blocks of queries have bounded sizes, one task takes a block
against a shard, and a query's shard results are merged by rank.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part.  Every other row is a candidate of its own, whatever
its id: rows without one come out with a null vec_id, and of rows with one id
each is met by the others (a query by its copies too, and of queries with one
id each has its own k, ranked from 1).  Queries meet vectors of their length
only; ties go to the smaller id, null last; with fewer than k candidates all
are given; an empty table gives no rows; other columns are not read.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runoff.llm.common import written
from runoff.llm.vectors import matrix, rotation, usable

PROJECTIONS = 128
#: Half width of a window, in standard deviations of the projected
#: difference of two vectors at the radius.
WIDTH = 1.5
#: Standard deviations of the count by which the threshold is below its mean at the radius.
MARGIN = 1.645
WIDEN = 1.1
SHARD, QUERIES, SAMPLE = 8192, 1024, 512


def _directions(dim: int) -> np.ndarray:
    parts = [rotation(dim, 300 + i) for i in range(-(-PROJECTIONS // dim))]
    return np.hstack(parts)[:, :PROJECTIONS]


def _quantile(p: float) -> float:
    """The standard normal quantile, by bisection."""
    low, high = -9.0, 9.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if 0.5 * math.erfc(-mid / math.sqrt(2)) < p else (low, mid)
    return low


def search_shard(x: np.ndarray, ids: np.ndarray, rows: np.ndarray, q: np.ndarray, q_rows: np.ndarray, norm: float, k: int):
    """Yields (query number, places in x, scores) of each query's k nearest
    found, nearest first, ties by id; ``rows`` and ``q_rows`` tell whether a
    candidate is the query's own row."""
    def lifted(v, size):
        v = v / size
        return np.hstack([v, np.sqrt(np.maximum(0, 1 - (v * v).sum(1)))[:, None]])

    points = lifted(x, norm)
    queries = np.hstack([q / np.linalg.norm(q, axis=1)[:, None], np.zeros((len(q), 1))])
    dim = points.shape[1]
    directions = _directions(dim)
    p, at = points @ directions, queries @ directions
    order = np.argsort(p, axis=0, kind="stable")
    rank = np.empty(p.T.shape, np.uint16)
    for j in range(PROJECTIONS):
        rank[j, order[:, j]] = np.arange(len(x), dtype=np.uint16)
    arrays = np.sort(p, axis=0).T
    # a radius that some k vectors are within: a normal law for the sample's inner products
    near = queries @ points[::max(1, len(x) // SAMPLE)].T
    z = _quantile(min(0.5, 1.5 * (k + 1) / len(x)))
    radius = np.sqrt(np.maximum(2 - 2 * (near.mean(1) - z * near.std(1)), 1e-6))
    p1 = math.erf(WIDTH / math.sqrt(2))
    least = math.ceil(PROJECTIONS * p1 - MARGIN * math.sqrt(PROJECTIONS * p1 * (1 - p1)))
    count = np.empty(rank.shape, np.uint16)
    half = (WIDTH / math.sqrt(dim) * radius)[:, None]
    first = [np.array([np.searchsorted(a, v, side) for a, v in zip(arrays, edge.T)]).T.astype(np.uint16)
             for edge, side in ((at - half, "left"), (at + half, "right"))]
    for i in range(len(q)):
        r, seen, found, scores = float(radius[i]), np.zeros(len(x), bool), np.zeros(0, np.int64), np.zeros(0)
        seen[rows == q_rows[i]] = True  # the query's own row is no candidate
        while True:
            if r >= 2:
                new = np.flatnonzero(~seen)  # every vector is within this radius
            else:
                if r == radius[i]:
                    low, high = first[0][i], first[1][i]
                else:
                    w = WIDTH * r / math.sqrt(dim)
                    low = np.array([np.searchsorted(a, v) for a, v in zip(arrays, at[i] - w)], np.uint16)
                    high = np.array([np.searchsorted(a, v, "right") for a, v in zip(arrays, at[i] + w)], np.uint16)
                # ranks from low to high - 1: below low they wrap around
                np.subtract(rank, low[:, None], out=count)
                hits = (count < (high - low)[:, None]).view(np.uint8).sum(0, dtype=np.uint16)
                new = np.flatnonzero((hits >= least) & ~seen)
            seen[new] = True
            found = np.concatenate([found, new])
            scores = np.concatenate([scores, x[new] @ q[i]])
            best = np.lexsort((ids[found], -scores))[:k]
            within = scores[best] / (norm * np.linalg.norm(q[i]))
            if r >= 2 or (len(best) == k and 2 - 2 * within[-1] <= r * r):
                break
            r *= WIDEN
        exact = np.einsum("ij,j->i", x[found[best]], q[i])
        yield i, found[best], exact


_FOUND = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
_NO_ID = np.iinfo(np.int64).max


def _search(k: int, norm: float):
    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        x = matrix(table.column("vec"), table.column("dim")[0].as_py())
        missing = table.column("id").is_null().to_numpy()
        ids, rows = table.column("id").fill_null(_NO_ID).to_numpy(), table.column("row").to_numpy()
        if asks.all() or not asks.any():
            return _FOUND.empty_table()
        out = [[], [], [], [], []]
        own, none = ids[~asks], missing[~asks]
        for i, at, scores in search_shard(x[~asks], own, rows[~asks], x[asks], rows[asks], norm, k):
            for column, found in zip(out, (np.full(len(at), rows[asks][i]), np.full(len(at), ids[asks][i]), own[at], scores, none[at])):
                column.append(found)
        row, query, found, score, none = map(np.concatenate, out)
        return pa.Table.from_arrays([pa.array(row), pa.array(query), pa.array(found, mask=none), pa.array(score)], schema=_FOUND)
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score (inner product) of each
    query's k nearest vectors found, itself not among them."""
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"),
                           F.coalesce(is_query, F.lit(False)).alias("asks"))
            .where(usable(F.col("vec"))).withColumn("vec", F.col("vec").cast("array<double>")))
    # the number tells rows apart, and spreads those that are alike; it is written once
    rows = written(rows.withColumn("dim", F.size("vec")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    n, asked, top = rows.agg(F.count("*"), F.sum(F.col("asks").cast("long")), F.max(F.sqrt(square))).first()
    shards, blocks = max(1, -(-n // SHARD)), max(1, -(-(asked or 0) // QUERIES))
    candidates = (rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
                  .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
                  .select("dim", "shard", "block", "row", "id", "vec", F.lit(False).alias("asks")))
    queries = (rows.where("asks").withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
               .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
               .select("dim", F.col("shard").cast("long").alias("shard"), "block", "row", "id", "vec", "asks"))
    # norms a rounding above the largest would leave the sphere
    norm = float(top or 1.0) * (1 + 1e-12)
    found = (candidates.union(queries).groupBy("dim", "shard", "block")
             .applyInArrow(_search(k, norm), "query_row long, query_id long, vec_id long, score double"))
    by = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
