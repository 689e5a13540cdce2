"""Merkle manifest of a table, with nested-interval labels.

Rows are leaves of a tree for each group, in the groups' order of rows; the
groups' roots are leaves of one more tree.  A node is labelled by the
interval of leaf ranks that it covers, [lo, hi).  Its ancestors are the nodes
whose intervals contain its own; its siblings cover what is left of the
parent's interval when its own is taken out.

Levels come in buckets of ``span`` (as many as make at most ``BLOCK`` nodes):
nodes at a bucket's lower edge have intervals of at most arity^(span * s)
leaves, so ``lo`` divided by the width of the next edge is the same for a
node and the one that contains it there.  That number is the key of the
containment join.

* Up: nodes of a bucket are grouped by that key, at most ``BLOCK`` to a group,
  and hashed level by level to the node at the upper edge.
* Down: the ancestors' proofs at an upper edge join the nodes below it by the
  same key, and every node's proof is its siblings', level by level, then its
  ancestor's.

So work is four shuffles of digests whatever the number of levels, and a
task holds a block.  Ranks come from one range partitioning; alike rows are
counted first and unfolded after, so no key needs a task of its own.

A digest is lower-case hexadecimal SHA-256 of the children's digests,
concatenated as text.  A proof is the siblings' digests, from the leaf's
level up and left to right; ``shape`` holds the number of left and of right
siblings of each level, one byte each, which is what folding needs.

Defined cases: null fields are "-", others their UTF-8 byte count, ":" and
value; null groups and null ids come first; rows that agree in group and id
are ordered by digest, so alike rows get consecutive leaves; a lone leaf is
its group's root, and a lone group's root the table's; an empty table gives
no rows; only the named columns are read, so no other column can clash.
"""
from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runoff.llm.common import tasks, written

#: Most nodes that are hashed together.
BLOCK = 1024


def digest(*fields: Column) -> Column:
    """Digest of a row's fields."""
    def text(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.sha2(F.concat(*[text(c) for c in fields]).cast("binary"), 256)


def span_of(arity: int) -> int:
    """Levels of a bucket."""
    span = 1
    while arity ** (span + 1) <= BLOCK:
        span += 1
    return span


def hashed(children: list[bytes]) -> bytes:
    return sha256(b"".join(children)).hexdigest().encode()


def levels(nodes: list[bytes], arity: int, upto: int | None) -> list[list[bytes]]:
    """``nodes`` and the levels above them: ``upto`` of them, or as many as lead to one node."""
    out = [nodes]
    while len(out) <= upto if upto is not None else len(out[-1]) > 1:
        below = out[-1]
        out.append([hashed(below[i:i + arity]) for i in range(0, len(below), arity)])
    return out


def proofs(tree: list[list[bytes]], arity: int, proof: bytes, shape: bytes) -> list[tuple[bytes, bytes]]:
    """(proof, shape) of each node of the lowest level, where the top node's are given."""
    out = [(proof, shape)]
    for below in tree[-2::-1]:
        found = []
        for i in range(len(below)):
            up = i // arity
            lo, hi = up * arity, min((up + 1) * arity, len(below))  # the parent's interval
            above, form = out[up]
            # less the node's own, [i, i + 1)
            found.append((b"".join(below[lo:i] + below[i + 1:hi]) + above, bytes((i - lo, hi - i - 1)) + form))
        out = found
    return out


def folded(leaf: bytes, proof: bytes, shape: bytes) -> bytes:
    """The root that a leaf and its proof lead to."""
    at = 0
    for i in range(0, len(shape), 2):
        left, right = 64 * shape[i], 64 * shape[i + 1]
        leaf = sha256(proof[at:at + left] + leaf + proof[at + left:at + left + right]).hexdigest().encode()
        at += left + right
    return leaf


def _numbered(batches):
    """Adds the part, and the copies before a row in its part and group; rows are sorted by group."""
    part, last, held = TaskContext.get().partitionId(), None, 0
    for b in batches:
        if not b.num_rows:
            continue
        group, copies = b.column("grp"), b.column("copies").to_numpy()
        code = group.dictionary_encode().indices.to_numpy()
        first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        before = np.r_[0, np.cumsum(copies)[:-1]]
        start = before - np.repeat(before[first], np.diff(np.r_[first, len(code)]))
        if group[0].as_py() == last:
            start[:first[1] if len(first) > 1 else len(code)] += held
        last, held = group[-1].as_py(), int(start[-1] + copies[-1])
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(np.full(len(code), part, np.int32)), pa.array(start)],
            names=[*b.schema.names, "part", "start"])


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (grp, copies, ...) with lo, the number of rows before them in
    their group by ``order``, each row as often as ``copies`` says, and n, the
    rows of the group.  ``rows`` is read twice, so pass a written table."""
    spark = rows.sparkSession
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    parted = written(rows.repartitionByRange(tasks(spark), "grp", *order).sortWithinPartitions("grp", *order)
                     .mapInArrow(_numbered, f"{kind}, part int, start long"), "ranked")
    sums = parted.groupBy("grp", "part").agg(F.sum("copies").alias("_size"))
    by = Window.partitionBy("grp")
    before = by.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("grp", "part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"),
                       F.sum("_size").over(by).alias("n"))
    first = F.col("_base") + F.col("start")
    return (parted.join(sums, ["grp", "part"])
            .withColumn("lo", F.explode(F.sequence(first, first + F.col("copies") - 1)))
            .drop("part", "start", "copies", "_base"))


_NODE = pa.schema([("grp", pa.string()), ("n", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("digest", pa.string())])
_NODE_SQL = "grp string, n long, lo long, hi long, digest string"


def _sorted(table: pa.Table) -> pa.Table:
    return table.take(pa.array(np.argsort(table.column("lo").to_numpy(), kind="stable")))


def _tree(table: pa.Table, arity: int, span: int, width: int) -> list[list[bytes]]:
    """The levels over a block's nodes, whose intervals are ``width`` wide."""
    one = -(-table.column("n")[0].as_py() // width) <= arity ** span
    return levels([d.encode() for d in table.column("digest").to_pylist()], arity, None if one else span)


def _up(arity: int, span: int, width: int):
    def run(table: pa.Table) -> pa.Table:
        table = _sorted(table)
        grp, n, lo = (table.column(c)[0].as_py() for c in ("grp", "n", "lo"))
        top = _tree(table, arity, span, width)[-1]
        return pa.Table.from_pylist([{"grp": grp, "n": n, "lo": lo, "hi": min(lo + width * arity ** span, n),
                                      "digest": top[0].decode()}], schema=_NODE)
    return run


_PATH = [("proof", pa.string()), ("shape", pa.binary()), ("subroot", pa.string()), ("root", pa.string())]
_PATH_SQL = "proof string, shape binary, subroot string, root string"


def _down(arity: int, span: int, width: int, items: bool):
    def run(nodes: pa.Table, above: pa.Table) -> pa.Table:
        schema = pa.schema([*([nodes.schema.field("item")] if items else []), *_NODE, *_PATH,
                            *([("folded_root", pa.string())] if items else [])])
        if not nodes.num_rows:
            return schema.empty_table()
        nodes = _sorted(nodes)
        grp, n, lo = (nodes.column(c)[0].as_py() for c in ("grp", "n", "lo"))
        proof, shape, subroot, root, hi = (above.column(c)[0].as_py() for c in ("proof", "shape", "subroot", "root", "hi"))
        k = nodes.num_rows
        los = nodes.column("lo").to_numpy()
        his = np.minimum(los + width, n)
        if above.num_rows != 1 or above.column("lo")[0].as_py() != lo or his[-1] != hi:
            raise ValueError(f"the nodes from {lo} of group {grp!r} are not covered by one ancestor")
        tree = _tree(nodes, arity, span, width)
        found = proofs(tree, arity, proof.encode(), shape)
        out = [pa.array([grp] * k), pa.array([n] * k), pa.array(los), pa.array(his), nodes.column("digest"),
               pa.array([p.decode() for p, _ in found]), pa.array([s for _, s in found], pa.binary()),
               pa.array([subroot or tree[0][i].decode() for i in range(k)]), pa.array([root] * k)]
        if items:
            out = [nodes.column("item"), *out]
            shown = [s.encode() if s else d for s, d in zip(nodes.column("presented").to_pylist(), tree[0])]
            out.append(pa.array([folded(s, p, form).decode() for s, (p, form) in zip(shown, found)]))
        return pa.Table.from_arrays(out, schema=schema)
    return run


def _key(width: int) -> Column:
    """The bucket of the interval that contains a node's at the next edge."""
    return F.expr(f"lo div {width}").alias("bucket")


class Forest:
    """The trees over ``leaves`` (grp, n, lo, digest, and item and presented
    for those at the bottom), as nodes at every bucket's edge."""

    def __init__(self, leaves: DataFrame, arity: int):
        self.arity, self.span = arity, span_of(arity)
        block = arity ** self.span
        self.edges = [(leaves, 1)]
        most = leaves.agg(F.max("n")).first()[0] or 0
        width = 1
        while width < most:
            nodes = self.edges[-1][0].select("grp", "n", "lo", "digest", _key(width * block))
            top = written(nodes.groupBy("grp", "bucket").applyInArrow(_up(arity, self.span, width), _NODE_SQL), "nodes")
            width *= block
            self.edges.append((top, width))

    def roots(self) -> DataFrame:
        """grp, n, digest."""
        return self.edges[-1][0].select("grp", "n", "digest")

    def down(self, above: DataFrame, item: str | None = None) -> DataFrame:
        """The leaves with proof, shape, subroot and root, where ``above``
        (grp, lo, hi, proof, shape, subroot, root) gives them for the trees' roots."""
        block = self.arity ** self.span
        below = self.edges[:-1][::-1] or [(self.edges[0][0], 1)]
        for nodes, width in below:
            items = item is not None and nodes is self.edges[0][0]
            columns = ["grp", "n", "lo", "digest", _key(width * block)] + (["item", "presented"] if items else [])
            out = f"item {item}, {_NODE_SQL}, {_PATH_SQL}, folded_root string" if items else f"{_NODE_SQL}, {_PATH_SQL}"
            above = (nodes.select(*columns).groupBy("grp", "bucket")
                     .cogroup(above.select("grp", "lo", "hi", "proof", "shape", "subroot", "root", _key(width * block))
                              .groupBy("grp", "bucket"))
                     .applyInArrow(_down(self.arity, self.span, width, items), out))
        return above


def manifest(rows: DataFrame, group: Column, order: Column, leaf: Column, presented: Column | None = None,
             arity: int = 2) -> DataFrame:
    """One row per row of ``rows``: id (``order``), leaf, lo (its rank in the
    group), proof, shape, subroot, root, and folded_root: what ``presented``
    (a digest; null or not given: the leaf) and the proof lead to."""
    if arity < 2 or arity > 255:
        raise ValueError("arity must be from 2 to 255")
    spark = rows.sparkSession
    name = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))  # null first, bytewise
    named = rows.select(name.alias("grp"), order.cast("long").alias("id"), leaf.alias("digest"),
                        (F.lit(None).cast("string") if presented is None else presented).alias("presented"))
    classes = written(named.groupBy("grp", "id", "digest", "presented").agg(F.count("*").alias("copies")), "leaves")
    leaves = ranked(classes, ["id", "digest", "presented"]).select(
        "grp", "n", "lo", "digest", F.struct("id").alias("item"), "presented")
    forest = Forest(leaves, arity)
    subroots = written(forest.roots().select("grp", "n", "digest").distinct(), "subroots")
    tops = ranked(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("n").alias("leaves"),
                                  "digest", F.lit(1).cast("long").alias("copies")), ["name"])
    tops = written(tops.select("grp", "n", "lo", "digest", F.struct("name", "leaves").alias("item"),
                               F.lit(None).cast("string").alias("presented")), "tops")
    top = Forest(tops, arity)
    start = top.roots().select("grp", F.lit(0).cast("long").alias("lo"), F.col("n").alias("hi"), F.lit("").alias("proof"),
                               F.lit("").cast("binary").alias("shape"), F.lit(None).cast("string").alias("subroot"),
                               F.col("digest").alias("root")).distinct()
    above = top.down(start, "struct<name: string, leaves: long>").select(
        F.col("item.name").alias("grp"), F.lit(0).cast("long").alias("lo"), F.col("item.leaves").alias("hi"),
        "proof", "shape", F.col("digest").alias("subroot"), "root")
    return forest.down(written(above, "proofs"), "struct<id: long>").select(
        F.col("item.id").alias("id"), F.col("digest").alias("leaf"), "lo", "proof", "shape", "subroot", "root", "folded_root")
