"""Helpers shared by the operators: written intermediate tables, connected
components and a prefix sum that never puts one hot group into one task."""
from __future__ import annotations

import ctypes
import gc
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runoff.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the session's checkpoint folder and read
    again: cuts the lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Gives back the memory that a Python worker has no more use for: workers
    are used again by later stages, and would keep it beside theirs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


def tidied(run):
    """``run`` (batches to batches), with ``release`` at the end of a task."""
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            release()
    return whole


def tasks(spark: SparkSession) -> int:
    """The session's shuffle parallelism."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_for(spark: SparkSession, size: int) -> int:
    """Shuffle partitions for ``size`` bytes: 16 MB each up to 8,192 of them,
    beyond that 256 MB; never fewer than the session's."""
    return max(tasks(spark), min(-(-size // (16 << 20)), 8192), -(-size // (256 << 20)))


def spread(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to ``parts`` partitions; left to the session
    (and to adaptive coalescing) where that has as many."""
    return df.repartition(parts, *keys) if parts > tasks(df.sparkSession) else df


def connected_components(edges: DataFrame) -> DataFrame:
    """(node long, component long) for undirected ``edges`` (a long, b long);
    the component is its smallest node.

    Alternates large-star and small-star steps (Kiveris et al., "Connected
    Components in MapReduce and Beyond"), which never enlarge the edge set and
    end after O(log^2 n) rounds; every round's edges are a written table.  It
    ends as soon as the edges are stars around their smallest nodes.  Minima
    are pre-aggregated map-side, and AQE splits the joins on a hot node.
    Nulls and self-loops carry no link.  No edges give no rows.
    """
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .where("u <> v").distinct(), "edges")
    while not _stars(e):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        e = (both.where("v > u").join(low, "u")
             .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = written(e.join(low, "u").select(F.explode(F.array(
            F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("s"))
            .select(F.col("s.v").alias("u"), F.col("s.m").alias("v")).where("u <> v").distinct(), "edges")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())


def _stars(e: DataFrame) -> bool:
    """Whether every u has one edge and no v is a u."""
    ends = e.select(F.explode(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                      F.struct(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("s"))
    by = ends.select("s.*").groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return by.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def with_start(df: DataFrame, keys: list[str], order: list[Column], size: Column, out: str,
               chunks: int) -> DataFrame:
    """Adds ``out``: the sum of ``size`` over the rows before this one in its
    group of ``keys``, in an order that depends on the rows' contents only.

    Rows go to ``chunks`` hash-chosen chunks of the group; chunk sums are added
    up over the few chunks, rows within their chunk.  So a group that holds a third of
    all rows is spread over all tasks.  ``order`` must tell apart all rows but
    those that are alike.
    """
    chunk = df.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks))).withColumn("_size", size)
    by = [*keys, "_chunk"]
    # null keys form a group of their own
    sums = chunk.groupBy(*by).agg(F.sum("_size").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(by)],
                       F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inner = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = chunk.withColumn("_in", F.coalesce(F.sum("_size").over(inner), F.lit(0)))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(by)]
    return (rows.join(base, on).withColumn(out, F.col("_base") + F.col("_in"))
            .drop("_chunk", "_size", "_in", "_base", *[f"_k{i}" for i in range(len(by))]))


def running(df: DataFrame, at: str, cols: list[str], stretch: int = 4096) -> DataFrame:
    """Adds ``<col>_before`` for each of ``cols``: its sum over the rows with a
    smaller ``at``, a whole number from 0 that no two rows share.  Sums of
    stretches of ``at`` are added up in one task, rows within their stretch."""
    rows = df.withColumn("_stretch", F.expr(f"`{at}` div {stretch}"))
    sums = rows.groupBy("_stretch").agg(*[F.sum(c).alias(c) for c in cols])
    past = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(F.col("_stretch").alias("_of"), *[F.coalesce(F.sum(c).over(past), F.lit(0)).alias(f"_{c}") for c in cols])
    inner = Window.partitionBy("_stretch").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    for c in cols:
        rows = rows.withColumn(f"{c}_before", F.coalesce(F.sum(c).over(inner), F.lit(0)))
    return (rows.join(base, F.col("_stretch") == F.col("_of"))
            .select(*df.columns, *[(F.col(f"{c}_before") + F.col(f"_{c}")).alias(f"{c}_before") for c in cols]))


def located(df: DataFrame, value: Column, total: int, spans: DataFrame, cols: list[str], parts: int,
            spread: str | None = None) -> DataFrame:
    """``df`` with the columns ``cols`` of the row of ``spans`` in whose stretch
    (``start`` and ``length``; together they cover 0 to ``total``) ``value``
    lies.  Rows and stretches meet in ``parts`` sections of the line, no pairs
    are made.  Rows without a value stay, with columns of no meaning; they are
    dealt to the sections by ``spread``."""
    width = max(1, -(-(total or 0) // parts))
    section = F.expr(f"_value div {width}")
    if spread:
        section = F.coalesce(section, F.pmod(F.xxhash64(spread), F.lit(parts)))
    rows = df.withColumn("_value", value).select(F.struct(*df.columns).alias("_row"), "_value", section.alias("_section"))
    ends = (spans.where("length > 0").select(F.struct(*cols).alias("_span"), F.col("start").alias("_value"), F.explode(
        F.expr(f"sequence(start div {width}, (start + length - 1) div {width})")).alias("_section")))
    both = rows.unionByName(ends, allowMissingColumns=True)
    upto = (Window.partitionBy("_section").orderBy("_value", F.col("_row").isNotNull())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (both.withColumn("_span", F.last("_span", ignorenulls=True).over(upto)).where("_row is not null")
            .select("_row.*", "_span.*"))
