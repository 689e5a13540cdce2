"""One ECL run as a set of lazy DataFrames.

``Book`` wires the phases together.  The only loan-level work is the feed
(scan -> join on the loan key -> partial + final aggregate).  The feed and
the disbursal rows come out of one pass and are materialised once with
``checkpoint()`` into the session's checkpoint directory (a shared, reliable folder on a cluster):
that cuts lineage, so an executor lost in a later phase never re-runs the
loan-level join, and every later phase reads a table of a few thousand rows.

A book can also begin at the published tables of a run (``from_published``,
``restore``): phases that it has are read, the later ones computed from them,
and neither loans nor performance are touched.
"""
from __future__ import annotations

import copy
import uuid
from datetime import date
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runoff.config import DEFAULT, EclConfig, SegmentRequest
from runoff.operators import ecl, feed, loss, triangle
from runoff.plans import driver_book
from runoff.plans.store import Store, config_from_text, input_state
from runoff.session import ensure_checkpoint_dir, scratch_path, without_shuffles
from runoff.sources import tables

#: The published tables that phases can begin at, as they are stored (the cohort as ISO text).
STATE = {
    "feed": "fy_quarter string, cohort_end string, segment int, mob int, dpd90_uc long, tpos_uc long",
    "feed_disbursal": "fy_quarter string, cohort_end string, segment int, lan_cnt long, disb_uc long",
    "feed_state": ("fy_quarter string, cohort_end string, segment int, mob int, lan_cnt long, amount_cents long, "
                   "dpd90_cents long, tpos_cents long"),
    "triangles": ("segment string, fy_quarter string, cohort_end string, mob int, is_observed boolean, disb_cr double, "
                  "dpd90_amt double, dpd90_rate double, tpos_amt double, tpos_rate double, lan_cnt long, disb_uc long, "
                  "max_mature_mob int, dpd90_uc long, tpos_uc long"),
    "loss": ("segment string, fy_quarter string, cohort_end string, anchor_mob int, disb_cr double, ninety_plus double, "
             "tpos_sum double, denominator double, loss_rate double, anchor_observed boolean"),
    "weighted": ("segment string, window string, fy_start string, fy_end string, anchor_mob int, n_quarters long, "
                 "n_observed_at_anchor long, total_disb double, simple_avg_lr double, weighted_avg_lr double, ecl_pct double"),
}


class Book:
    def __init__(self, spark: SparkSession, loans: DataFrame, perf: DataFrame,
                 cfg: EclConfig = DEFAULT, materialize: bool = True, loan_buckets: bool = False,
                 base: tuple[DataFrame, date] | None = None):
        """``loan_buckets``: ``perf`` is read partitioned by ``loan_no``
        (a table bucketed by it), so nothing needs to partition it again.
        ``base``: the feed's sums at an earlier as-of date; only what became
        known since then is read for the feed."""
        self.spark = spark
        self.loans = loans
        self.perf = perf
        self.cfg = cfg
        self.materialize = materialize
        self.loan_buckets = loan_buckets
        self.base = base
        self.rejects: DataFrame | None = None
        self._kept: list[DataFrame] = []

    # ------------------------------------------------------------- sources
    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str, cfg: EclConfig = DEFAULT,
                           **kw) -> "Book":
        loans = driver_book.driver_loans(spark, sf_dir, cfg)
        perf = driver_book.performance_from_loans(loans, cfg)
        return cls(spark, loans, perf, cfg, loan_buckets=True, **kw)  # expanded loan by loan

    @classmethod
    def from_parquet(cls, spark: SparkSession, loans_path: str, perf_path: str,
                     cfg: EclConfig = DEFAULT, **kw) -> "Book":
        return cls(spark, tables.read_loans(spark, loans_path),
                   tables.read_performance(spark, perf_path), cfg, **kw)

    @classmethod
    def from_tables(cls, spark: SparkSession, loans_table: str, perf_table: str,
                    cfg: EclConfig = DEFAULT, **kw) -> "Book":
        """Catalog tables, e.g. written bucketed by loan key (sources.layout;
        then pass ``loan_buckets=True``)."""
        return cls(spark, spark.table(loans_table), spark.table(perf_table), cfg, **kw)

    @classmethod
    def from_extract(cls, loans: DataFrame, perf: DataFrame, cfg: EclConfig = DEFAULT, **kw) -> "Book":
        """Warehouse extract: text keys, ISO dates, rupee amounts
        (sources.tables); ``rejects`` are the rows that could not be read."""
        book = cls(loans.sparkSession, tables.loans_from_extract(loans), tables.performance_from_extract(perf), cfg, **kw)
        book.rejects = tables.rejected_rows(loans, perf)
        return book

    @classmethod
    def from_published(cls, spark: SparkSession, out: str, as_of: date, run: str | None = None, **kw) -> "Book":
        """The accepted run of a quarter (or the named run), from its
        published tables, with the configuration that it had.  A phase it has
        no table of is computed from the one before; without a feed there is
        nothing to begin at."""
        store = Store(spark, out, as_of)
        own = store.accepted() if run is None else next((r for r in store.runs() if r.name == run), None)
        if own is None or not {"feed", "feed_disbursal"} <= set(own.tables):
            raise LookupError(f"run {run} of {as_of} under {out} has no complete feed")
        book = cls(spark, None, None, config_from_text(own.config), **kw)
        book.restore({name: store.read(name, T.StructType.fromDDL(kind), own)
                      for name, kind in STATE.items() if name in own.tables})
        return book

    @classmethod
    def roll_from(cls, spark: SparkSession, out: str, since: date, loans: DataFrame, perf: DataFrame,
                  cfg: EclConfig, **kw) -> "Book":
        """The accepted run of an earlier quarter, rolled forward to ``cfg``'s
        as-of date over a performance table by period (``sources.layout``).
        Loans keep their date, segment and amount; all else of the
        configuration must be as it was."""
        before = cls.from_published(spark, out, since)
        if before.cfg.with_(as_of=cfg.as_of) != cfg or not since < cfg.as_of:
            raise ValueError(f"the run of {since} cannot be rolled forward to {cfg.as_of}: its configuration differs")
        return cls(spark, loans, perf, cfg, base=(before.sums, since), **kw)

    def restore(self, published: dict[str, DataFrame]) -> None:
        """Phases begin at these published tables (names as in ``STATE``)."""
        def dated(name):
            return published[name].withColumn("cohort_end", F.to_date("cohort_end")).drop("fy_quarter")

        if {"feed", "feed_disbursal"} <= set(published):
            # back to the shape that the one loan-level job has
            mobs, loans = dated("feed"), dated("feed_disbursal")
            self._both = mobs.unionByName(loans, allowMissingColumns=True).select(
                "cohort_end", "segment", "mob", "lan_cnt", "disb_uc", "dpd90_uc", "tpos_uc")
            self.__dict__["_feed_both"] = feed.split_feed(self._both)
        for name, phase in (("feed_state", "sums"), ("triangles", "triangles"), ("loss", "loss")):
            if name in published:
                self.__dict__[phase] = dated(name)
        if "weighted" in published:
            self.__dict__["wavg"] = published["weighted"]

    @cached_property
    def input_state(self) -> str | None:
        """What the input files look like (``plans.store``), to know a run again."""
        return input_state(self.spark, self.loans, self.perf)

    @cached_property
    def perf_by_loan(self) -> DataFrame:
        """The performance table partitioned by loan: as it is read, or after
        the one exchange that all groupings and joins by loan share.  Rows
        without a key are no loan's, and would all go to one task."""
        perf = self.perf
        if "period" in perf.columns:
            perf = perf.filter(F.col("period") <= F.lit(self.cfg.as_of)).select(*tables.PERF_COLS)
        keyed = perf.filter(F.col("loan_no").isNotNull())
        return keyed if self.loan_buckets else keyed.repartition("loan_no")

    def whole_only(self) -> "Book":
        """The same run over the feed collapsed to cohorts: one group, ``all``."""
        other = Book(self.spark, self.loans, self.perf, self.cfg, self.materialize, self.loan_buckets, self.base)
        self._feed_both
        other.__dict__["grouped"] = feed.whole_feed(self._both)
        other._kept = self._kept    # released with this one
        return other

    def fork(self) -> "Book":
        """A book with the same phases, which can be restored to others; what
        either persists is given back by the one it was forked from."""
        return copy.copy(self)

    def release(self) -> None:
        """Give back the persisted tables (checkpoint files go with their
        references if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set)."""
        for df in self._kept:
            df.unpersist()
        self._kept.clear()
        for name in ("grouped", "columns", "triangles", "loss", "movements", "current", "wavg", "cells", "_feed_both", "sums"):
            self.__dict__.pop(name, None)
        self.__dict__.pop("_both", None)

    def _cut(self, df: DataFrame) -> DataFrame:
        """Materialise a phase table in the checkpoint directory (lineage cut)."""
        if not self.materialize:
            return df
        ensure_checkpoint_dir(self.spark)
        return df.checkpoint(eager=True)

    def _keep(self, df: DataFrame) -> DataFrame:
        """Keep a small, calendar-bounded table (cohorts x segments x MOBs)
        for reuse by later phases; if an executor holding it is lost it is
        recomputed from the checkpointed feed, never from the loan tables."""
        if not self.materialize:
            return df
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._kept.append(df)
        return df

    # --------------------------------------------------------------- phase 1
    @cached_property
    def sums(self) -> DataFrame:
        """The one loan-level job: exact sums of feed and disbursal from a
        single pass, of all rows or of those since ``base``."""
        state, since = self.base or (None, None)
        parts = feed.rounds(self.loans, self.perf, self.cfg) if since is None and "cohort_end" in self.perf.columns else []
        if len(parts) > 1 and self.materialize:
            # the cohort of a row's loan is the loan's, whatever the row's: rounds may share groups
            own = [self._written(feed.merged(feed.performance_rows(self.loans, part, self.cfg, hashed=not self.loan_buckets)))
                   for part in parts]
            new = feed.merged(*own, feed.loan_rows(self.loans, self.cfg))
        else:
            new = feed.feed_sums(self.loans, self.perf, self.cfg, since, hashed=not self.loan_buckets)
        return self._cut(new if state is None else feed.merged(state, new))

    def _written(self, df: DataFrame) -> DataFrame:
        """A small table written under the checkpoint folder, its shuffle given back."""
        path = scratch_path(self.spark, f"sums-{uuid.uuid4().hex}")
        with without_shuffles(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def _feed_both(self) -> tuple[DataFrame, DataFrame]:
        both = self._both = feed.rounded(self.sums)
        return feed.split_feed(both)

    @property
    def feed(self) -> DataFrame:
        """(cohort_end, segment int, mob, dpd90_uc, tpos_uc)"""
        return self._feed_both[0]

    @property
    def disb(self) -> DataFrame:
        """(cohort_end, segment int, lan_cnt, disb_uc)"""
        return self._feed_both[1]

    # Every later phase is keyed by segment group first (windows by (segment,
    # cohort) and (segment, mob), aggregates by (segment, ...)) and uses no
    # join.  Hash-partitioning the grouped feed once by segment satisfies all
    # of those distributions within a plan; one task per group, each bounded
    # by cohorts x MOB grid.
    @property
    def n_groups(self) -> int:
        return len(self.cfg.segments) + 1

    @cached_property
    def grouped(self) -> DataFrame:
        self._feed_both
        return self._keep(feed.group_feed(self._both, self.n_groups))

    @property
    def feed_g(self) -> DataFrame:
        """(segment text, cohort_end, mob, dpd90_uc, tpos_uc) incl. 'all'"""
        return self.grouped.filter(F.col("mob").isNotNull()).select(
            "segment", "cohort_end", "mob", "dpd90_uc", "tpos_uc")

    @property
    def disb_g(self) -> DataFrame:
        """(segment text, cohort_end, lan_cnt, disb_uc) incl. 'all'"""
        return self.grouped.filter(F.col("mob").isNull()).select(
            "segment", "cohort_end", "lan_cnt", "disb_uc")

    # --------------------------------------------------------------- phase 2
    @cached_property
    def cells(self) -> DataFrame:
        return triangle.triangle_cells(self.grouped, self.cfg)

    @cached_property
    def columns(self) -> DataFrame:
        """The triangles by (segment, mob): development factors and cells"""
        return self._keep(triangle.triangle_columns(self.cells))

    @property
    def factors(self) -> DataFrame:
        return self.columns.drop("cells")

    @cached_property
    def triangles(self) -> DataFrame:
        return self._keep(triangle.fill(self.columns))

    # --------------------------------------------------------------- phase 3
    @cached_property
    def loss(self) -> DataFrame:
        return self._keep(loss.loss_rates(self.triangles, self.cfg))

    @cached_property
    def movements(self) -> DataFrame:
        return loss.movements(self.triangles)

    @cached_property
    def current(self) -> DataFrame:
        return loss.current_tpos(self.triangles)

    # --------------------------------------------------------------- phase 4
    @cached_property
    def wavg(self) -> DataFrame:
        return ecl.weighted_loss_rate(self.loss, self.cfg)

    def headline(self, segment: str = "all") -> DataFrame:
        return ecl.headline(self.wavg, self.cfg, segment)

    def segment_ecl(self, segment, fy_start, fy_end, anchor) -> tuple[DataFrame, DataFrame]:
        """E4 + E5: (summary, detail) of a request."""
        ask = SegmentRequest.read(self.cfg, segment, fy_start, fy_end, anchor)
        own = self.loss.filter(F.col("segment") == ask.segment)
        return (ecl.weighted_loss_rate(own, self.cfg, windows=[ask.window]),
                ecl.window_detail(own, ask.segment, ask.window))

    def require_rows(self, segment, fy_start, fy_end, anchor) -> int:
        """The number of cohorts a request covers (one bounded action); raises where there are none."""
        ask = SegmentRequest.read(self.cfg, segment, fy_start, fy_end, anchor)
        covered = ecl.window_detail(self.loss, ask.segment, ask.window).count()
        if not covered:
            raise ValueError(f"segment {ask.segment} has no cohorts from {ask.window.start_label} to "
                             f"{ask.window.end_label}")
        return covered
