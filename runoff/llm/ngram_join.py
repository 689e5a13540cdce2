"""N-gram Jaccard join by prefix filtering under several global orders.

A document's set holds its distinct five-word shingles.  Two sets with
Jaccard similarity of at least t share a token among the first
``n - ceil(t n) + 1`` tokens of each (the prefix), whatever the global order
of tokens.  The candidates here must share prefix tokens under three orders:

1. rarest first (document frequency, then fingerprint);
2. frequency on a log scale, then a second hash;
3. rare / frequent, then a third hash;

and only pairs that pass all three filters are verified exactly.  All orders
put the shingles of a single document first.  Those can link nothing, so
they only use up the prefix, and most documents drop out before any pair is
formed.

Steps, all on Spark:

* one pass fingerprints each text's set and counts the hottest shingles
  (bounded: the ``HOT`` most frequent; each other shingle is in less than
  1/HOT of all shingle occurrences, so no range of fingerprints is hot);
* a second pass cuts the documents into windows and sends each window's
  shingles, packed eight bytes each, to their fingerprint range; the range
  counts documents and returns the shared shingles to their windows.  Hot
  shingles, whose count is known, stay with their window;
* the classes (documents with equal sets) that still have shared shingles in
  their prefix are grouped into candidate clusters, connected by order-1
  prefix tokens; each cluster is joined in one task, or, beyond
  ``TASK_TOKENS`` tokens or ``TASK_CLASSES`` classes, block by block of its
  members, so that no task grows with a group;
* within a task, union-find skips pairs that are already connected: the
  components stay exact without all pairs of a group of near copies.

Fingerprints have 64 bits (shingles 48 and their range), sets are told apart
by a 64-bit signature; nothing else is approximate.

Defined cases: null, empty and white-space texts have an empty set and link
with nothing; fewer than five words make one shingle of the whole sequence;
repeated rows and documents with equal sets are copies of each other and
link; a null id never becomes a component's id unless all its ids are null;
an empty table gives no rows; other columns are not read.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runoff.llm.common import connected_components, parts_for, release, spread, tasks, tidied, written
from runoff.llm.words import BASE, U, mix, set_signature, text_shingles

#: Shingles that are handled apart as hot ones; bounds what is broadcast to 1 MB.
HOT = 65536
#: Shingles and documents of a window.
WINDOW_TOKENS, WINDOW_DOCS = 1_000_000, 60_000
#: Bytes of a group after which a worker gives memory back.
LARGE = 4 << 20
#: Shingles and classes of a verification task.
TASK_TOKENS, TASK_CLASSES = 2_000_000, 512
LOW = U((1 << 48) - 1)


def _ranged(h: np.ndarray, ranges: int):
    """Fingerprint range of each shingle, and the shingle's id: the range and
    48 more bits, mixed."""
    g = (h >> U(40)) % U(ranges)
    return g, mix((h & LOW) + g * U(BASE))


def _windows(batches, ranges: int):
    """Windows of consecutive documents: (sequence number, [(signature, n)],
    range, fingerprint, id and document of each shingle).  Repeated sets
    within a window come once."""
    docs, sets, held, seen, seq = [], [], 0, set(), 0

    def close():
        h = np.concatenate(sets) if sets else np.zeros(0, U)
        idx = np.repeat(np.arange(len(docs)), [len(s) for s in sets]).astype(U)
        return (seq, docs, *_ranged(h, ranges), h, idx)

    for b in batches:
        for _, s in text_shingles(b.column("text")):
            sig = set_signature(s)
            if not len(s) or sig in seen:
                continue
            seen.add(sig)
            docs.append((sig, len(s)))
            sets.append(s)
            held += len(s)
            if held >= WINDOW_TOKENS or len(docs) >= WINDOW_DOCS:
                yield close()
                docs, sets, held, seen, seq = [], [], 0, set(), seq + 1
    if docs:
        yield close()


def _scan():
    """Per text row (id, text_hash, signature, n); and, per window, the
    fingerprints of shingles that several of its documents hold, with their
    number."""
    def run(batches):
        def out(kind, a, b, c, n):
            k = len(n)
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(k, kind, np.int8)), a, b, c, pa.array(np.asarray(n, np.int32))],
                names=["kind", "id", "text_hash", "sig", "n"])

        held, size, seen = [], 0, set()

        def counts():
            ids, n = np.unique(np.concatenate(held), return_counts=True)
            ids, n = ids[n >= 3].view(np.int64), n[n >= 3]
            none = pa.nulls(len(n), pa.int64())
            return out(1, pa.array(ids), none, none, n)

        for b in batches:
            sig, n = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int32)
            for r, s in text_shingles(b.column("text")):
                sig[r], n[r] = set_signature(s), len(s)
                if len(s) and sig[r] not in seen:
                    seen.add(sig[r])
                    held.append(s)
                    size += len(s)
                    if size >= WINDOW_TOKENS:
                        yield counts()
                        held, size, seen = [], 0, set()
            yield out(0, b.column("id"), b.column("text_hash"), pa.array(sig), n)
        if held:
            yield counts()
    return run


def _post(ranges: int, hot):
    """Packed shingles by range, and what stays with its window: signatures,
    set sizes and hot shingles (under negative keys)."""
    def run(batches):
        ids, df = hot.value
        part = TaskContext.get().partitionId()
        for seq, docs, g, t, h, idx in _windows(batches, ranges):
            w = (part << 24) + seq
            at = np.searchsorted(ids, h)
            at[at == len(ids)] = 0
            is_hot = ids[at] == h if len(ids) else np.zeros(len(h), bool)
            meta = np.array(docs, np.int64)
            rows = [(-1 - w, w, meta[:, 0].tobytes(), meta[:, 1].tobytes(), b"", b"", b""),
                    (-1 - w, w, b"", b"", idx[is_hot].astype(np.uint16).tobytes(),
                     t[is_hot].tobytes(), df[at[is_hot]].tobytes())]
            g, v = g[~is_hot], ((h & LOW) << U(16) | idx)[~is_hot]
            order = np.argsort(g, kind="stable")
            g, v = g[order], v[order]
            cut = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
            for a, z in zip(cut, np.r_[cut[1:], len(g)]):
                rows.append((int(g[a]), w, b"", b"", b"", v[a:z].tobytes(), b""))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(_POST.names, r)) for r in rows], schema=_POST)
    return run


_POST = pa.schema([("g", pa.int64()), ("w", pa.int64()), ("sig", pa.binary()), ("n", pa.binary()),
                   ("idx", pa.binary()), ("tok", pa.binary()), ("df", pa.binary())])
_POST_SQL = "g long, w long, sig binary, n binary, idx binary, tok binary, df binary"


def _count(table: pa.Table) -> pa.Table:
    """A range's shingles that are in several documents, with their number of
    documents, back by window; a window's own rows pass through."""
    g = table.column("g")[0].as_py()
    if g < 0:
        return table
    w = table.column("w").to_numpy()
    blobs = [np.frombuffer(x.as_buffer(), U) for x in table.column("tok")]
    v = np.concatenate(blobs)
    w = np.repeat(w, [len(b) for b in blobs])
    order = np.argsort(v, kind="stable")
    v, w = v[order], w[order]
    tok = v >> U(16)
    new = np.flatnonzero(np.r_[True, tok[1:] != tok[:-1]])
    df = np.diff(np.r_[new, len(tok)])
    df = np.repeat(df, df)
    keep = df > 1
    v, w, df = v[keep], w[keep], df[keep].astype(np.uint32)
    order = np.argsort(w, kind="stable")
    v, w, df = v[order], w[order], df[order]
    tok = mix((v >> U(16)) + np.full(1, g, U) * U(BASE))
    idx = (v & U(0xFFFF)).astype(np.uint16)
    cut = np.flatnonzero(np.r_[True, w[1:] != w[:-1]]) if len(w) else np.zeros(0, np.int64)
    rows = [(g, int(w[a]), b"", b"", idx[a:z].tobytes(), tok[a:z].tobytes(), df[a:z].tobytes())
            for a, z in zip(cut, np.r_[cut[1:], len(w)])]
    if table.nbytes > LARGE:
        release()
    return pa.Table.from_pylist([dict(zip(_POST.names, r)) for r in rows], schema=_POST)


_CLASS = pa.schema([("sig", pa.int64()), ("n", pa.int32()), ("prefix", pa.int32()),
                    ("tok", pa.binary()), ("df", pa.binary())])
_CLASS_SQL = "sig long, n int, prefix int, tok binary, df binary"


def _prefixes(percent: int):
    """A window's documents whose prefix holds shared shingles: all their
    shared shingles, rarest first, and how many of these the prefix has."""
    def run(table: pa.Table) -> pa.Table:
        def joined(name, kind):
            return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(name)])

        sig, n = joined("sig", np.int64), joined("n", np.int64)
        idx, tok, df = joined("idx", np.uint16), joined("tok", U), joined("df", np.uint32)
        order = np.lexsort((tok, df, idx))
        idx, tok, df = idx[order], tok[order], df[order]
        cut = np.searchsorted(idx, np.arange(len(sig) + 1))
        shared = np.diff(cut)
        prefix = n - (percent * n + 99) // 100 + 1 - (n - shared)
        if table.nbytes > LARGE:
            release()
        rows = [{"sig": int(sig[i]), "n": int(n[i]), "prefix": int(prefix[i]),
                 "tok": tok[cut[i]:cut[i + 1]].tobytes(), "df": df[cut[i]:cut[i + 1]].tobytes()}
                for i in np.flatnonzero(prefix > 0)]
        return pa.Table.from_pylist(rows, schema=_CLASS)
    return run


def _prefix_rows(batches):
    for b in batches:
        for sig, p, tok in zip(b.column("sig").to_pylist(), b.column("prefix").to_pylist(), b.column("tok")):
            t = np.frombuffer(tok.as_buffer(), np.int64)[:p]
            yield pa.RecordBatch.from_arrays(
                [pa.array(t), pa.array(np.full(len(t), sig, np.int64))], names=["tok", "sig"])


def _orders(tok, df, own, prefix):
    """The prefix entries (member, token) of all members under each order."""
    out = []
    for level, hashed in ((df, tok), (np.log2(df).astype(np.int64), mix(tok ^ U(0xA5A5))),
                          (df > 8, mix(tok ^ U(0x5A5A5A)))):
        order = np.lexsort((hashed, level, own))
        first = np.r_[0, np.cumsum(np.bincount(own, minlength=len(prefix)))[:-1]]
        rank = np.arange(len(own)) - first[own[order]]
        out.append(order[rank < prefix[own[order]]])
    return out


def link_members(members: list, percent: int) -> list[tuple[int, int]]:
    """Edges that connect the members of a task as all links among them do:
    from each to the least signature that links lead to, so that connecting
    them takes no rounds within a task.
    members: (signature, n, prefix, tokens, frequencies, side); with two
    sides, only members of different sides are compared."""
    members = sorted(members, key=lambda m: (m[1], m[0]))
    n = np.array([m[1] for m in members])
    side = np.array([m[5] for m in members])
    two = side.min() != side.max()
    own = np.repeat(np.arange(len(members)), [len(m[3]) for m in members])
    ids, tok = np.unique(np.concatenate([m[3] for m in members]), return_inverse=True)
    df = np.concatenate([m[4] for m in members])
    prefix = np.array([m[2] for m in members])
    ends = np.cumsum([len(m[3]) for m in members])
    sets = [tok[e - len(m[3]):e] for e, m in zip(ends, members)]
    index = []
    for entry in _orders(ids[tok], df, own, prefix):
        by_tok = entry[np.argsort(tok[entry], kind="stable")]  # members ascend within a token
        start = np.searchsorted(tok[by_tok], np.arange(len(ids) + 1))
        index.append((own[by_tok], start, np.split(tok[entry], np.searchsorted(
            own[entry], np.arange(1, len(members))))))
    label = np.arange(len(members))
    group = {i: [i] for i in range(len(members))}
    mark = np.zeros(len(ids), bool)
    for x in range(len(members)):
        hits = None
        for lists, start, own_prefix in index:
            # members before x, with sets not too small to link, that share a prefix token
            found = [lists[start[t]:start[t + 1]] for t in own_prefix[x].tolist()]
            found = np.concatenate(found) if found else np.zeros(0, np.int64)
            found = np.unique(found[found < x])
            hits = found if hits is None else np.intersect1d(hits, found, assume_unique=True)
            if not len(hits):
                break
        hits = hits[100 * n[hits] >= percent * n[x]]
        if two:
            hits = hits[side[hits] != side[x]]
        hits = hits[label[hits] != label[x]][::-1]
        if not len(hits):
            continue
        mark[sets[x]] = True
        while len(hits):
            y = int(hits[0])
            both = int(mark[sets[y]].sum())
            if 100 * both >= percent * (n[x] + n[y] - both):
                a, b = sorted((int(label[x]), int(label[y])), key=lambda k: len(group[k]))
                label[group[a]] = b
                group[b] += group.pop(a)
            hits = hits[1:]
            hits = hits[label[hits] != label[x]]
        mark[sets[x]] = False
    stars = ([members[i][0] for i in own] for own in group.values() if len(own) > 1)
    return [(least, sig) for sigs in stars for least in [min(sigs)] for sig in sigs if sig != least]


def _verify(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        members = [(s, n, p, np.frombuffer(t, U), np.frombuffer(d, np.uint32), side) for s, n, p, t, d, side
                   in zip(pdf["sig"], pdf["n"], pdf["prefix"], pdf["tok"], pdf["df"], pdf["side"])]
        return pd.DataFrame(link_members(members, percent), columns=["a", "b"], dtype="int64")
    return run


def jaccard_links(texts: DataFrame, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """From (id, text_hash, text) rows: the rows' sets (id, text_hash, sig,
    n), and links (a, b) between signatures that connect the sets just as all
    pairs with Jaccard similarity of at least ``percent`` % do."""
    spark = texts.sparkSession
    scanned = written(texts.mapInArrow(
        tidied(_scan()), "kind byte, id long, text_hash long, sig long, n int"), "sets")
    rows = scanned.where("kind = 0").drop("kind")
    # ranges and partitions follow the number of shingles, so that a group keeps its size
    parts = parts_for(spark, 8 * (rows.agg(F.sum("n")).first()[0] or 0))
    ranges = min(2 * parts, 1 << 24)
    top = (scanned.where("kind = 1").groupBy("id").agg(F.sum("n").alias("df"))
           .orderBy(F.desc("df"), "id").limit(HOT).collect())
    hot = sorted((r["id"] % (1 << 64), min(r["df"], 2**32 - 1)) for r in top if r["df"] >= 64)
    hot = spark.sparkContext.broadcast((np.array([h[0] for h in hot], U),
                                        np.array([h[1] for h in hot], np.uint32)))
    posted = texts.select("text").mapInArrow(tidied(_post(ranges, hot)), _POST_SQL)
    counted = spread(posted, parts, "g").groupBy("g").applyInArrow(_count, _POST_SQL)
    shared = spread(counted, parts, "w").groupBy("w").applyInArrow(_prefixes(percent), _CLASS_SQL)
    classes = written(shared.dropDuplicates(["sig"]), "classes")
    # clusters: classes connected through tokens of their order-1 prefixes
    post = classes.select("sig", "prefix", "tok").mapInArrow(tidied(_prefix_rows), "tok long, sig long")
    hub = post.groupBy("tok").agg(F.min("sig").alias("a"), F.max("sig").alias("z")).where("a < z")
    near = post.join(hub, "tok").select("a", F.col("sig").alias("b"))
    cluster = connected_components(near)
    member = classes.join(cluster, F.col("node") == F.col("sig")).drop("node")
    blocks = member.groupBy("component").agg(F.greatest(
        F.ceil(F.sum(F.length("tok") / 8) / TASK_TOKENS), F.ceil(F.count("*") / TASK_CLASSES)).cast("int").alias("blocks"))
    member = member.join(blocks, "component").withColumn("block", F.expr("pmod(xxhash64(sig), blocks)"))
    tokens = classes.agg(F.sum(F.length("tok") / 8)).first()[0] or 0
    groups = max(4 * tasks(spark), int(4 * tokens / TASK_TOKENS))
    small = member.where("blocks = 1").select(
        F.pmod(F.xxhash64("component"), F.lit(groups)).alias("c"), F.lit(-1).alias("i"),
        F.lit(-1).alias("j"), "sig", "n", "prefix", "tok", "df", F.lit(0).alias("side"))
    large = (member.where("blocks > 1")
             .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
             .select(F.col("component").alias("c"), F.least("block", "other").cast("int").alias("i"),
                     F.greatest("block", "other").cast("int").alias("j"), "sig", "n", "prefix", "tok", "df",
                     F.expr("int(block > other)").alias("side")))
    links = written(spread(small.union(large), parts_for(spark, int(12 * tokens)), "c", "i", "j").groupBy("c", "i", "j")
                    .applyInPandas(_verify(percent), "a long, b long"), "links")
    return rows, links


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 percent: int = 75) -> DataFrame:
    """One row per row of ``docs``: id, text_hash (of the text), n_shingles,
    component_id (smallest id reachable by links) and keep (whether the row
    stays if one document of each component does; empty documents all stay,
    and alike rows all have the flag of their id and text)."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"),
                        F.col(text_col).alias("text"))
    rows, links = jaccard_links(texts, percent)
    first = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    classes = rows.where("n > 0").groupBy("sig").agg(F.min(first).alias("first"))
    joined = connected_components(links)
    classes = (classes.join(joined, F.col("node") == F.col("sig"), "left")
               .select("sig", "first", F.coalesce("component", "sig").alias("root")))
    roots = classes.groupBy("root").agg(F.min("first").alias("first"))
    of = classes.select("sig", "root").join(roots, "root").select(F.col("sig").alias("_sig"), "first")
    empty = F.col("n") == 0
    return (rows.join(of, F.col("_sig") == F.when(F.col("n") > 0, F.col("sig")), "left")
            .select(F.col("id").alias(id_col), "text_hash", F.col("n").cast("long").alias("n_shingles"),
                    F.when(empty, F.col("id")).otherwise(F.col("first.id")).alias("component_id"),
                    (empty | (F.col("id").eqNullSafe(F.col("first.id"))
                              & (F.col("text_hash") == F.col("first.text_hash")))).alias("keep")))


def deduplicate(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``docs`` with one row of each component of near-duplicate texts: that
    with the smallest id.  Documents without words stay."""
    kept = (jaccard_join(docs, percent=percent).where("keep")
            .select("doc_id", "text_hash", (F.col("n_shingles") == 0).alias("empty")).distinct())
    # the row's columns stay in one struct, so none of them can clash
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"),
                       F.xxhash64("text").alias("hash"))
    alike = Window.partitionBy("id", "hash").orderBy(F.lit(1))
    on = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
    return (rows.withColumn("nth", F.row_number().over(alike)).join(kept, on)
            .where("empty or nth = 1").select("row.*"))
