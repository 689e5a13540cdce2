"""Mixing sources to target weights, in DataFrame operations only.

The words of a source's documents, one after another, are its stream, packed
into blocks of fixed length.  The mix is a sequence of slots in shards:

* every slot of a shard draws its source from the categorical distribution
  of the targets, so a shard's source counts are multinomial;
* over all shards a source must get exactly the slots that its target needs:
  slots that it drew beyond these go, in order, to sources that drew too few
  (a share in the order of 1/sqrt(slots));
* a source's k-th slot is mapped to one of its blocks through a pseudorandom
  permutation of the block numbers, another one for each pass over them (the
  rank of the block's hash);
* slots and blocks meet in a join by that index.

A target of x passes takes every block floor(x) times and some of them once
more; the last slot takes only the words still missing.  So a source's taken
words differ from its target by less than a block, and no document is taken
more often than its source's passes, rounded up.

No group of a source is ever in one task: positions and ranks come from
chunked prefix sums, draws from ranges, and the joins' keys are blocks.  There
may be as many sources as documents: they are a table too, and only its sums
come to the driver, a few numbers for each round of filling to the targets.
Up to ``FEW`` sources are drawn from an alias table, a literal in the plan; of
more, a slot's draw is looked up among the sources' stretches of a line.

Defined cases: null, empty and white-space texts have size 0 and nothing is
taken of them; a null source is a source of its own, ordered last; repeated
rows are separate documents; a source without words has target 0; an empty
table gives no rows; other columns are not read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runoff.llm.common import located, running, tasks, with_start, written

WEIGHTS = (3, 1, 2)
BLOCK = 128
#: Slots of a shard.
SHARD = 8192
UNIT = 1 << 53
#: Sources that an alias table holds at most.
FEW = 4096


def n_words(text: Column) -> Column:
    """Number of runs of characters other than space and \\x09-\\x0D."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def water_filled(sizes: dict, weights: tuple = WEIGHTS, share: float = 1.5, limit: float = 2) -> dict:
    """{source: target}: ``share`` times all sizes, split by the weights that
    repeat over the sources by code point, null last.  Targets stop at
    ``limit`` times their source's size; what is above is shared again by
    weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    left, free = share * sum(sizes.values()), {s for s in order if sizes[s]}
    while free:
        per = left / sum(w[s] for s in free)
        over = {s for s in free if per * w[s] > limit * sizes[s]}
        if not over:
            target.update({s: per * w[s] for s in free})
            break
        target.update({s: float(limit * sizes[s]) for s in over})
        left -= sum(target[s] for s in over)
        free -= over
    return target


def with_targets(sources: DataFrame, weights: tuple = WEIGHTS, share: float = 1.5, limit: float = 2) -> DataFrame:
    """``sources`` (sid from 0 by code point, null last; source_size) with
    ``target``: as ``water_filled`` has it.  The level only rises, so a round
    needs the sums of those below it; every round is one aggregate."""
    w = F.get(F.lit(list(weights)), F.pmod("sid", F.lit(len(weights))))
    rows = sources.withColumn("_weight", w)

    def over(level: float) -> Column:
        return F.lit(level) * F.col("_weight") > limit * F.col("source_size")

    def sums(level: float):
        full = over(level)
        return rows.where("source_size > 0").agg(
            F.count_if(full).alias("n"), F.coalesce(F.sum(F.when(full, F.col("source_size"))), F.lit(0)).alias("full"),
            F.sum(F.when(~full, F.col("_weight"))).alias("free"), F.sum("source_size").alias("size")).first()

    level, at = 0.0, sums(0.0)
    while at["free"]:
        up = max(level, (share * at["size"] - limit * at["full"]) / at["free"])
        after = sums(up)
        level, n, at = up, at["n"], after
        if after["n"] == n:
            break
    target = F.when(F.col("source_size") == 0, F.lit(0.0)).when(over(level), (limit * F.col("source_size")).cast("double"))
    return rows.withColumn("target", target.otherwise(level * F.col("_weight"))).drop("_weight")


def _uniform(seed: int, *cols: Column) -> Column:
    """A pseudorandom whole number from 0 to 2**53 - 1."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(UNIT))


def _alias(p: list[float]) -> tuple[list[float], list[int]]:
    """Walker's alias table: draws from ``p`` in constant time."""
    n, keep, other = len(p), [x * len(p) for x in p], list(range(len(p)))
    small, large = [i for i in range(n) if keep[i] < 1], [i for i in range(n) if keep[i] >= 1]
    while small and large:
        i, j = small.pop(), large[-1]
        other[i] = j
        keep[j] -= 1 - keep[i]
        if keep[j] < 1:
            small.append(large.pop())
    for i in small + large:
        keep[i] = 1.0
    return keep, other


def _numbered(sources: DataFrame) -> DataFrame:
    """``sources`` (a row for each) with ``sid``: their number from 0, by code
    point, null last; written."""
    order = [F.col("source").isNull(), F.col("source")]
    n = tasks(sources.sparkSession)
    ranges = written(sources.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id().cast("long")), "ranges")
    before = running(ranges.groupBy("part").agg(F.count("*").alias("n")), "part", ["n"]).select("part", "n_before")
    nth = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return written(ranges.withColumn("_nth", nth).join(before, "part").select(
        (F.col("n_before") + F.col("_nth") - 1).cast("int").alias("sid"), "source", "source_size"), "sources")


class Mix:
    """A mix of ``docs`` (source, text and doc_id columns)."""

    def __init__(self, docs: DataFrame, weights: tuple = WEIGHTS, share: float = 1.5, limit: float = 2,
                 block: int = BLOCK, shard: int = SHARD, seed: int = 1):
        self.spark, self.block, self.shard, self.seed = docs.sparkSession, block, shard, seed
        slim = written(docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"),
                                   n_words(F.col("text")).alias("size")), "sizes")
        sources = with_targets(_numbered(slim.groupBy("source").agg(F.sum("size").alias("source_size"))), weights, share, limit)
        # a target's whole passes, and of the words left the slots and the last slot's words
        words, rest = F.rint("target").cast("long"), F.col("_rest")
        self.table = (sources.withColumn("blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
                      .withColumn("_words", words).withColumn("_whole", F.expr("if(source_size > 0, _words div source_size, 0L)"))
                      .withColumn("_rest", F.expr("_words - _whole * source_size"))
                      .withColumn("_parts", F.expr(f"(_rest + {block - 1}) div {block}"))
                      .select("sid", "source", "source_size", "target", "blocks",
                              F.expr("_whole * blocks + _parts").alias("slots"),
                              (F.col("_whole") + (rest > 0).cast("int")).cast("int").alias("passes"),
                              F.when(rest > 0, rest - (F.col("_parts") - 1) * block).otherwise(block).cast("long").alias("cut")))
        self.total, self.n_sources = self.table.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count("*")).first()
        of = slim.withColumnRenamed("source", "_source").join(
            self.table.select("sid", "source", "source_size", "target"), F.col("_source").eqNullSafe(F.col("source"))).drop("_source")
        order = [F.col("doc_id"), F.col("text_hash"), F.col("size")]
        self.docs = written(with_start(of, ["sid"], order, F.col("size"), "start", 8 * tasks(self.spark)), "starts")

    @property
    def sources(self) -> list:
        """The rows of ``table`` by sid, at the driver: for few sources."""
        return self.table.orderBy("sid").collect()

    def _drawn(self) -> DataFrame:
        """shard, slot and the sid that it draws."""
        ids = self.spark.range(0, self.total, 1, tasks(self.spark)).select(
            F.expr(f"id div {self.shard}").alias("shard"), F.col("id").alias("slot"))
        if self.n_sources > FEW:
            spans = running(self.table.select("sid", F.col("slots").alias("length")), "sid", ["length"])
            spans = spans.withColumnRenamed("length_before", "start")
            at = F.pmod(F.xxhash64(F.lit(self.seed), F.lit("source"), "slot"), F.lit(self.total))
            return located(ids, at, self.total, spans, ["sid"], 8 * tasks(self.spark))
        keep, other = _alias([r["slots"] / self.total for r in self.sources])
        keep = F.lit([int(x * UNIT) for x in keep])
        column = F.pmod(F.xxhash64(F.lit(self.seed), F.lit("column"), "slot"), F.lit(len(other))).cast("int")
        return ids.withColumn("c", column).select(
            "shard", "slot", F.when(_uniform(self.seed, F.lit("keep"), F.col("slot")) < F.get(keep, F.col("c")), F.col("c"))
            .otherwise(F.get(F.lit(other), F.col("c"))).alias("sid"))

    def slots(self) -> DataFrame:
        """shard, slot, sid and k: every slot is the k-th of its source."""
        if not self.total:
            return self.spark.createDataFrame([], "shard long, slot long, sid int, k long")
        drawn = self._drawn()
        counts = written(drawn.groupBy("sid", "shard").agg(F.count("*").alias("n")), "draws")
        before = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        base = counts.select("sid", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
        # what a source drew beyond its slots, in one line, fills the others' gaps in one line
        got = counts.groupBy("sid").agg(F.sum("n").alias("got"))
        lines = written(running(
            self.table.select("sid", F.col("slots").alias("need")).join(got, "sid", "left").na.fill(0, ["got"])
            .withColumn("over", F.greatest(F.lit(0), F.col("got") - F.col("need")))
            .withColumn("gap", F.greatest(F.lit(0), F.col("need") - F.col("got"))), "sid", ["over", "gap"]), "lines")
        base = base.join(lines.select("sid", "need", "over_before"), "sid")
        nth = Window.partitionBy("sid", "shard").orderBy("slot")
        ranked = (drawn.withColumn("nth", F.row_number().over(nth)).join(base, ["sid", "shard"])
                  .withColumn("k", F.col("base") + F.col("nth") - 1)
                  .select("shard", "slot", "sid", "k", F.when(F.col("k") >= F.col("need"),
                                                              F.col("over_before") + F.col("k") - F.col("need")).alias("line")))
        gaps = lines.select(F.col("sid").alias("to"), "got", F.col("gap_before").alias("start"), F.col("gap").alias("length"))
        size = lines.agg(F.sum("gap")).first()[0]
        filled = located(ranked, F.col("line"), size, gaps, ["to", "got", "start"], 8 * tasks(self.spark), spread="slot")
        outside = F.col("line").isNotNull()
        return filled.select("shard", "slot", F.when(outside, F.col("to")).otherwise(F.col("sid")).alias("sid"),
                             F.when(outside, F.col("got") + F.col("line") - F.col("start")).otherwise(F.col("k")).alias("k"))

    def blocks(self) -> DataFrame:
        """shard, slot, sid, block, pass and words: which block each slot
        holds, and how many of its words, from the first, it takes."""
        chunks = 8 * tasks(self.spark)
        passes = (self.table.where("slots > 0")
                  .withColumn("part", F.explode(F.expr(f"sequence(0, least(blocks, {chunks}) - 1)")))
                  .repartition(tasks(self.spark), "sid", "part")
                  .withColumn("pass", F.explode(F.expr("sequence(0, passes - 1)")))
                  .withColumn("block", F.explode(F.expr(
                      f"sequence(part, blocks - 1, least(blocks, {chunks}))"))))
        hashed = passes.select("sid", "blocks", "slots", "cut", "pass", "block",
                               _uniform(self.seed, F.lit("block"), F.col("sid"), F.col("pass"), F.col("block")).alias("h"))
        # rank of the hash within (source, pass): hash ranges first, then within the range
        span = F.expr(f"int(h div {UNIT // chunks + 1})")
        sums = hashed.withColumn("range", span).groupBy("sid", "pass", "range").agg(F.count("*").alias("n"))
        before = Window.partitionBy("sid", "pass").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("sid", "pass", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
        inner = Window.partitionBy("sid", "pass", "range").orderBy("h", "block")
        ranked = (hashed.withColumn("range", span).withColumn("nth", F.row_number().over(inner))
                  .join(sums.hint("merge"), ["sid", "pass", "range"])
                  .withColumn("k", F.col("pass") * F.col("blocks") + F.col("base") + F.col("nth") - 1)
                  .where("k < slots")
                  .select("sid", "pass", "block", "k",
                          F.when(F.col("k") == F.col("slots") - 1, F.col("cut")).otherwise(self.block).alias("words")))
        # the planner takes what is exploded from few sources for few rows, and would broadcast it
        return ranked.hint("merge").join(self.slots(), ["sid", "k"]).select("shard", "slot", "sid", "block", "pass", "words")

    def spans(self) -> DataFrame:
        """sid, start (of the document in its source), pass, low and high: the
        document's words that a slot takes, counted from its first."""
        b = self.block
        pieces = (self.docs.where("size > 0")
                  .withColumn("block", F.explode(F.expr(f"sequence(start div {b}, (start + size - 1) div {b})")))
                  .select("sid", "start", "size", "block"))
        return (pieces.join(self.blocks().hint("merge"), ["sid", "block"])
                .select("sid", "start", "pass", "shard", "slot",
                        F.greatest(F.lit(0), F.col("block") * b - F.col("start")).alias("low"),
                        F.least(F.col("size"), F.col("block") * b + F.col("words") - F.col("start")).alias("high"))
                .where("low < high"))

    def documents(self) -> DataFrame:
        """doc_id, text_hash, source, size, source_size, target and taken (words, repeats
        counted) of every row."""
        taken = (self.spans().groupBy("sid", "start").agg(F.sum(F.col("high") - F.col("low")).alias("_taken"))
                 .select(F.col("sid").alias("_sid"), F.col("start").alias("_start"), "_taken"))
        on = (F.col("_sid") == F.col("sid")) & (F.col("_start") == F.when(F.col("size") > 0, F.col("start")))
        return self.docs.join(taken, on, "left").select(
            "doc_id", "text_hash", "source", "size", "source_size", "target",
            F.coalesce("_taken", F.lit(0)).alias("taken"))


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: for each document and pass a row of ``docs`` whose text
    is what the pass takes of it, as it stands if that is all of it, else its
    taken words, each joined to the next by one space.  ``n_chars``, if there, follows the text.
    Documents of which nothing is taken go."""
    mix = Mix(docs, **options)
    key = ["doc_id", "source", "text_hash"]
    copy = Window.partitionBy(*key).orderBy("start")
    taken = (mix.spans().groupBy("sid", "start", "pass")
             .agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("spans"),
                  F.sum(F.col("high") - F.col("low")).alias("words")))
    of = (mix.docs.where("size > 0").withColumn("copy", F.row_number().over(copy))
          .join(taken, ["sid", "start"]).select(*key, "copy", "size", "words", "spans"))
    # the row's columns stay in one struct, so none of them can clash
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("hash"))
    rows = rows.withColumn("nth", F.row_number().over(
        Window.partitionBy("row.doc_id", "row.source", "hash").orderBy(F.lit(1))))
    on = (F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & F.col("row.source").eqNullSafe(F.col("source"))
          & (F.col("hash") == F.col("text_hash")) & (F.col("nth") - F.col("copy") == 0))
    whole = F.col("words") == F.col("size")
    split = F.regexp_extract_all("row.text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    part = F.expr("array_join(flatten(transform(spans, s -> slice(split, int(s.low) + 1, int(s.high - s.low)))), ' ')")
    out = (rows.join(of, on).withColumn("split", F.when(~whole, split))
           .withColumn("taken", F.when(whole, F.col("row.text")).otherwise(part)))
    row = F.col("row").withField("text", F.col("taken"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("taken").cast(docs.schema["n_chars"].dataType))
    return out.select(row.alias("row")).select("row.*")
