"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine of at least c have a squared distance of at most
2 - 2c.  All vectors are rotated alike and split into blocks of few
dimensions; each block gets a budget of that squared distance in proportion
to its dimensions.  If every block exceeded its budget the whole distance
would exceed its own, so each linked pair is within budget in some block.

Each block is range-joined.  Its leading dimensions are cut into ``SLABS``
slabs at quantiles of a bounded sample (at most ``SAMPLE`` vectors; cuts only
steer the work), as many dimensions as leave some ``CELL`` vectors to a cell.
A vector is in one cell, and two cells meet only if the gaps between their
slabs fit into the budget, so there is no replica whose pairs would have to be
found again; each further dimension leaves some three quarters of the pairs.
A cell of more than ``CELL`` vectors (near copies fill one cell) is dealt out
to pieces, and each pair of pieces is a task of its own.  A task sorts its
vectors by the block's next dimension, compares only what lies within the
radius there, and verifies candidates within the block's budget exactly, in
double precision on the original vectors.  A pair counts only in its first
block within budget, so there is no set of pairs to remove repetitions from:
tasks fold pairs into link counts and roots as they find them, and return
those, a row for each vector.

How much a block prunes depends on the vectors.  Where they are close to
random directions (as most of the test data are) no subspace of few dimensions
tells them apart, and the work stays near-quadratic, one multiplication of
block-wide vectors a pair and block.

Equal vectors are one class with its number of rows.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths do not link;
repeated rows and equal vectors link, each row counting; a null id never is
a component's id unless all its ids are null; an empty table gives no rows;
other columns are not read.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runoff.llm.common import connected_components, written
from runoff.llm.vectors import by_length, matrix, rotation, usable

BLOCKS = 4
CELL = 26_000
SLABS, SAMPLE = 8, 20_000
#: Vectors of a tile, and candidate pairs verified at a time and held until they are folded.
TILE, PAIRS, HELD = (256, 4096), 100_000, 500_000
SEED = 9


def _split(dim: int):
    """(first, end) of each block's dimensions."""
    n = min(BLOCKS, dim)
    cut = [dim * i // n for i in range(n + 1)]
    return list(zip(cut[:-1], cut[1:]))


def _budget(cosine: float, dim: int, block: tuple) -> float:
    """The block's share of the squared distance, with room for rounding."""
    return (2 - 2 * cosine) * (block[1] - block[0]) / dim * (1 + 1e-9) + 1e-12


def _unit(x: np.ndarray):
    return x / np.linalg.norm(x, axis=1)[:, None]


def _rotated(batches):
    """Yields (batch, length, rows, unit vectors rotated) by length."""
    for b in batches:
        for d, rows, x in by_length(b.column("vec")):
            yield b, d, rows, _unit(x) @ rotation(d, SEED)


def _cuts(sample: DataFrame, dims: int) -> dict[tuple[int, int], np.ndarray]:
    """By (length, block): the inner cuts between slabs, a row for each of the
    leading dimensions, from at most ``SAMPLE`` vectors."""
    out: dict[tuple[int, int], np.ndarray] = {}
    if dims:
        for _, d, _, z in _rotated(sample.limit(SAMPLE).toArrow().to_batches()):
            for t, (a, e) in enumerate(_split(d)):
                at = np.arange(1, SLABS) / SLABS
                out[d, t] = np.quantile(z[:, a:min(e, a + dims)], at, axis=0).T
    return out


def _cells(cuts: dict, slim: bool):
    """Every vector with its cell (slab numbers as digits) in each block."""
    def run(batches):
        for b, d, rows, z in _rotated(batches):
            for t, (a, e) in enumerate(_split(d)):
                cell = np.zeros(len(rows), np.int64)
                for c, cut in enumerate(cuts.get((d, t), ())):
                    cell = cell * SLABS + np.searchsorted(cut, z[:, a + c], "right")
                n = len(rows)
                columns = [pa.array(np.full(n, d, np.int32)), pa.array(np.full(n, t, np.int32)), pa.array(cell)]
                if not slim:
                    columns += [b.column(c).take(pa.array(rows)) for c in ("id", "copies", "vec")]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["dim", "block", "cell", "id", "copies", "vec"][:len(columns)])
    return run


def near_cells(cell: int, cuts: np.ndarray, budget: float) -> list[int]:
    """The cells whose slabs are within ``budget`` (squared) of a cell's."""
    digits = [cell // SLABS ** k % SLABS for k in range(len(cuts))][::-1]
    found = [(0, 0.0)]
    for own, cut in zip(digits, cuts):
        edge = np.r_[-np.inf, cut, np.inf]
        grown = []
        for other in range(SLABS):
            gap = max(0.0, edge[other] - edge[own + 1], edge[own] - edge[other + 1])
            grown += [(code * SLABS + other, far + gap * gap) for code, far in found if far + gap * gap <= budget]
        found = grown
    return [code for code, _ in found]


def _near(cuts: dict, cosine: float):
    def run(batches):
        for b in batches:
            rows = [(d, t, c, n, v) for d, t, c, n in zip(*(x.to_pylist() for x in b.columns)) for v in near_cells(
                c, cuts.get((d, t), np.zeros((0, SLABS - 1))), _budget(cosine, d, _split(d)[t]) * (1 + 1e-6))]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(
                (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64()))], names=["dim", "block", "cell", "pieces", "other"])
    return run


def _joined(x: np.ndarray, side: np.ndarray, cosine: float, block: int, two: bool, dims: int):
    """Yields the pairs of a task's vectors (rows of ``x``) that it counts,
    some ``HELD`` at a time; ``two``: only pairs of different sides."""
    d = x.shape[1]
    unit = _unit(x)
    z, parts = unit @ rotation(d, SEED), _split(d)
    budgets = [_budget(cosine, d, p) for p in parts]
    a, e = parts[block]
    by = a + min(dims, e - a - 1)  # slabs settle the dimensions before it
    order = np.argsort(z[:, by], kind="stable")
    first, second = (order[side[order] == 0], order[side[order] == 1]) if two else (order, order)
    if not len(first) or not len(second):
        return
    # one product gives all squared distances: |u|^2 + |v|^2 - 2 u v
    zb, square, one = z[:, a:e], (z[:, a:e] ** 2).sum(1)[:, None], np.ones((len(z), 1))
    left = np.hstack([-2 * zb, square, one]).astype(np.float32)[first]
    right = np.ascontiguousarray(np.hstack([zb, one, square]).astype(np.float32)[second].T)
    limit = np.float32(budgets[block] + 1e-5)
    radius = math.sqrt(budgets[block]) * (1 + 1e-6) + 1e-9
    key, keys = z[first, by], z[second, by]
    us, vs, held = [], [], 0
    for i in range(0, len(first), TILE[0]):
        stop = min(i + TILE[0], len(first))
        begin = int(np.searchsorted(keys, key[i] - radius)) if two else i
        end = int(np.searchsorted(keys, key[stop - 1] + radius, "right"))
        for j in range(begin, end, TILE[1]):
            width = min(j + TILE[1], end) - j
            hit = np.flatnonzero((left[i:stop] @ right[:, j:j + width]).ravel() <= limit)
            p, q = hit // width + i, hit % width + j
            if not two:
                p, q = p[q > p], q[q > p]
            p, q = first[p], second[q]
            for s in range(0, len(p), PAIRS):
                u, v = p[s:s + PAIRS], q[s:s + PAIRS]
                ok = np.einsum("ij,ij->i", unit[u], unit[v]) >= cosine
                u, v = u[ok], v[ok]
                gap = (z[u] - z[v]) ** 2
                ok = gap[:, a:e].sum(1) <= budgets[block]
                for t in range(block):
                    ok &= gap[:, parts[t][0]:parts[t][1]].sum(1) > budgets[t]
                us.append(u[ok])
                vs.append(v[ok])
                held += len(us[-1])
                if held >= HELD:
                    yield np.concatenate(us), np.concatenate(vs)
                    us, vs, held = [], [], 0
    if held:
        yield np.concatenate(us), np.concatenate(vs)


def _rooted(root: np.ndarray, p: np.ndarray, q: np.ndarray):
    """Joins the sets of ``p`` and ``q`` in ``root``, where each points at its set's least."""
    p, q = root[p], root[q]
    while (p != q).any():
        apart = p != q
        p, q = p[apart], q[apart]
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        while (root != root[root]).any():
            root[:] = root[root]
        p, q = root[p], root[q]


_FOUND = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def _link(cosine: float, dims: int):
    def run(table: pa.Table) -> pa.Table:
        ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
        block, low, high, i, j = (table.column(c)[0].as_py() for c in ("block", "low", "high", "i", "j"))
        x = matrix(table.column("vec"), table.column("dim")[0].as_py())
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        # pairs are folded into counts and roots as they are found, never held together
        for p, q in _joined(x, table.column("side").to_numpy(), cosine, block, (low, i) != (high, j), dims):
            links += (np.bincount(p, copies[q], len(ids)) + np.bincount(q, copies[p], len(ids))).astype(np.int64)
            _rooted(root, p, q)
        some = links > 0
        return pa.Table.from_arrays([pa.array(ids[some]), pa.array(links[some]), pa.array(ids[root[some]])], schema=_FOUND)
    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    cosine: float = 0.95) -> DataFrame:
    """One row per row of ``vectors``: its id, n_links (other rows with a
    cosine of at least ``cosine``), component_id (smallest id reachable by
    links) and kept (whether it is its component's)."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vid"),
                          F.when(usable(F.col(vec_col)), F.col(vec_col)).alias("vec"))
    classes = written(rows.where("vec is not null").groupBy("vec")
                      .agg(F.count("*").alias("copies"), F.min("vid").alias("first"))
                      .withColumn("id", F.monotonically_increasing_id()), "vectors")
    n = classes.count()
    dims = int(math.log(max(n / CELL, 1), SLABS) + 1e-9)
    source = classes.select("id", "copies", "vec")
    cuts = _cuts(source, dims)
    keys = ["dim", "block", "cell"]
    sizes = (source.mapInArrow(_cells(cuts, True), "dim int, block int, cell long").groupBy(*keys)
             .agg(F.ceil(F.count("*") / CELL).cast("int").alias("pieces")))
    if dims:
        sizes = written(sizes, "cells")
    near = sizes.mapInArrow(_near(cuts, cosine), "dim int, block int, cell long, pieces int, other long").join(
        sizes.select("dim", "block", F.col("cell").alias("other"), F.col("pieces").alias("others")), ["dim", "block", "other"])
    kind = classes.schema["vec"].dataType.simpleString()
    own = F.struct(F.col("cell").alias("c"), F.expr("int(pmod(xxhash64(id), pieces))").alias("p"))
    placed = (source.mapInArrow(_cells(cuts, False), f"dim int, block int, cell long, id long, copies long, vec {kind}")
              .join(near, keys).withColumn("own", own)
              .withColumn("met", F.explode(F.expr("transform(sequence(0, others - 1), q -> struct(other AS c, q AS p))"))))
    low, high = F.least("own", "met"), F.greatest("own", "met")
    member = placed.select("dim", "block", low["c"].alias("low"), high["c"].alias("high"), low["p"].alias("i"),
                           high["p"].alias("j"), "id", "copies", "vec", (F.col("own") > F.col("met")).cast("int").alias("side"))
    found = written(member.groupBy("dim", "block", "low", "high", "i", "j")
                    .applyInArrow(_link(cosine, dims), "id long, links long, root long"), "linked")
    joined = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    of = (classes.join(links, "id", "left").join(joined, F.col("node") == F.col("id"), "left")
          .select("vec", "first", F.coalesce("component", "id").alias("root"),
                  (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    roots = of.groupBy("root").agg(F.min("first").alias("least"))
    of = of.join(roots, "root").select(F.col("vec").alias("_vec"), "n_links", "least")
    component = F.when(F.col("vec").isNull(), F.col("vid")).otherwise(F.col("least"))
    return (rows.join(of, F.col("vec") == F.col("_vec"), "left")
            .select(F.col("vid").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    component.alias("component_id"), F.col("vid").eqNullSafe(component).alias("kept")))
