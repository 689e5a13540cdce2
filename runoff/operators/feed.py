"""Phase 1: the cohort feed.

The loan-level work is one join of the long performance table with the
window-filtered loans on the loan key, followed by a hash aggregation to
(cohort, segment, mob) with map-side partial aggregation.  The output has
at most cohorts x segments x 42 rows whatever the book size, so everything
downstream works on a tiny table.  Performance rows whose loan is missing or
outside the window drop out (inner join); loans without performance still
count in the loan-grain rows.
"""
from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runoff.config import EclConfig
from runoff.functions.calendar import cohort_end, fiscal_quarter_label, iso
from runoff.functions.joins import grid_column, with_loan
from runoff.functions.numeric import micro_crore, to_crore


def loans_in_window(loans: DataFrame, cfg: EclConfig, start=None, end=None) -> DataFrame:
    """Disbursal window, inclusive at both ends; adds the cohort key."""
    start = start or cfg.start
    end = end or cfg.end_disb
    return (loans.filter(F.col("disbursal_date").between(F.lit(start), F.lit(end)))
            .withColumn("cohort_end", cohort_end("disbursal_date")))


def known_rows(perf: DataFrame, cfg: EclConfig, after: date | None = None) -> DataFrame:
    """The performance rows that a run sees.  A table by period and cohort
    (``sources.layout.by_period``) is pruned to the periods up to the as-of
    date and after ``after`` (partitions), and to the cohorts of the disbursal
    window (row groups); of a plain one all rows count."""
    if "period" in perf.columns:
        perf = perf.filter(F.col("period") <= F.lit(cfg.as_of))
        if after is not None:
            perf = perf.filter(F.col("period") > F.lit(after))
    elif after is not None:
        raise ValueError("only a performance table by period can be read from a date on")
    if "cohort_end" in perf.columns:
        perf = perf.filter((F.col("cohort_end") >= F.lit(cfg.start))
                           & (F.col("cohort_end") <= cohort_end(F.lit(cfg.end_disb))))
    return (perf.select("loan_no", "mob", "tpos_cents", "dpd90_cents")
            .filter(F.col("mob").isin(list(cfg.extract_grid.mobs))))


SUMS = ["lan_cnt", "amount_cents", "dpd90_cents", "tpos_cents"]


def feed_sums(loans: DataFrame, perf: DataFrame, cfg: EclConfig, after: date | None = None,
              hashed: bool = False) -> DataFrame:
    """J1 + A2 in ONE aggregation pass: loan rows (``mob`` NULL: count and
    disbursal) are unioned with the joined performance rows (one per loan x
    MOB: 90+ and TPOS), and a single hash aggregate with map-side partial
    aggregation reduces both to (cohort_end, segment, mob).  Performance is
    scanned once, the loans twice (for the join and for their own rows); one
    join, one small exchange.

    The sums are exact cents, so those of disjoint rows merge to those of all
    (:func:`merged`).  ``after``: only of the loans disbursed and the
    performance known since then (which may be of any loan in the window).
    ``hashed``: of a table that is not kept by loan, the rows pass a hash of
    their loans; tasks need not sort what they were dealt."""
    return merged(performance_rows(loans, perf, cfg, after, hashed), loan_rows(loans, cfg, after))


def performance_rows(loans: DataFrame, perf: DataFrame, cfg: EclConfig, after: date | None = None,
                     hashed: bool = False) -> DataFrame:
    """The performance rows of :func:`feed_sums`, joined to their loans."""
    own_loans = loans_in_window(loans, cfg).select("loan_no", "cohort_end", "segment")
    rows = known_rows(perf, cfg, after)
    return ((with_loan(rows, own_loans) if hashed else rows.join(own_loans, "loan_no"))
            .select("cohort_end", "segment", "mob", F.lit(0).cast("long").alias("lan_cnt"),
                    F.lit(None).cast("long").alias("amount_cents"), "dpd90_cents", "tpos_cents"))


def loan_rows(loans: DataFrame, cfg: EclConfig, after: date | None = None) -> DataFrame:
    """The loan rows of :func:`feed_sums`."""
    own, none_l = loans_in_window(loans, cfg), F.lit(None).cast("long")
    if after is not None:
        own = own.filter(F.col("disbursal_date") > F.lit(after))
    return own.select("cohort_end", "segment", F.lit(None).cast("int").alias("mob"),
                      F.lit(1).cast("long").alias("lan_cnt"), "amount_cents",
                      none_l.alias("dpd90_cents"), none_l.alias("tpos_cents"))


#: Loans whose performance is joined at a time, of a table kept by cohort.
LOANS_A_ROUND = 5_000_000


def rounds(loans: DataFrame, perf: DataFrame, cfg: EclConfig) -> list[DataFrame]:
    """``perf`` (by period and cohort) in stretches of cohorts with some
    ``LOANS_A_ROUND`` loans each, or one cohort with more.  Each row is in one
    of them; what a join of one shuffles is all that is on disk at a time.  The
    calendar bounds the cohorts that are counted."""
    counts = (loans_in_window(loans, cfg).groupBy("cohort_end").count().orderBy("cohort_end").collect())
    ends, n = [], 0
    for r in counts[:-1]:
        n += r["count"]
        if n >= LOANS_A_ROUND:
            ends, n = [*ends, r["cohort_end"]], 0
    at, out = F.col("cohort_end"), []
    for low, high in zip([None, *ends], [*ends, None]):
        part = perf if low is None else perf.filter(at > F.lit(low))
        out.append(part if high is None else part.filter(at <= F.lit(high)))
    return out


def merged(*sums: DataFrame) -> DataFrame:
    """One row per (cohort_end, segment, mob) of all."""
    return (reduce(DataFrame.unionByName, sums).groupBy("cohort_end", "segment", "mob")
            .agg(*[F.sum(c).alias(c) for c in SUMS]))


def rounded(sums: DataFrame) -> DataFrame:
    """The sums with amounts rounded to micro-crore per group."""
    return sums.select("cohort_end", "segment", "mob", "lan_cnt", micro_crore("amount_cents").alias("disb_uc"),
                       micro_crore("dpd90_cents").alias("dpd90_uc"), micro_crore("tpos_cents").alias("tpos_uc"))


def feed_with_disbursal(loans: DataFrame, perf: DataFrame, cfg: EclConfig) -> DataFrame:
    """Feed and disbursal rows of a book; :func:`split_feed` separates them."""
    return rounded(feed_sums(loans, perf, cfg))


def split_feed(both: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(feed, disbursal) from :func:`feed_with_disbursal`."""
    feed = both.filter(F.col("mob").isNotNull()).select(
        "cohort_end", "segment", "mob", "dpd90_uc", "tpos_uc")
    disb = both.filter(F.col("mob").isNull()).select(
        "cohort_end", "segment", "lan_cnt", "disb_uc")
    return feed, disb


def whole_feed(both: DataFrame) -> DataFrame:
    """The feed collapsed to cohorts, as the one group ``'all'``."""
    return (both.groupBy("cohort_end", "mob")
            .agg(*[F.sum(c).alias(c) for c in ("lan_cnt", "disb_uc", "dpd90_uc", "tpos_uc")])
            .withColumn("segment", F.lit("all")))


def group_feed(both: DataFrame, n_groups: int) -> DataFrame:
    """Feed and disbursal rows of every segment group: each row is counted in
    its own segment and in ``'all'`` (the whole book is the sum of the
    already-rounded segment rows, the reference's order).  The rows are
    hash-partitioned once by group; the aggregate and every later phase keyed
    by (segment, ...) reuse that partitioning."""
    g = F.explode(F.array(F.col("segment").cast("string"), F.lit("all"))).alias("segment")
    return (both.select("cohort_end", "mob", "lan_cnt", "disb_uc", "dpd90_uc", "tpos_uc", g)
            .repartition(n_groups, "segment")
            .groupBy("segment", "cohort_end", "mob")
            .agg(*[F.sum(c).alias(c) for c in ("lan_cnt", "disb_uc", "dpd90_uc", "tpos_uc")]))


def segment_feed(feed: DataFrame, segment: int) -> DataFrame:
    """The feed of one segment."""
    return feed.filter(F.col("segment") == segment)


def collapse_to_cohort(feed_g: DataFrame, disb_g: DataFrame, cfg: EclConfig,
                       segment: str = "all") -> DataFrame:
    """A4: one row per (cohort, extraction MOB) of a group; a MOB no loan
    reached becomes 0 (the reference's pandas sum of all-NULL)."""
    d = disb_g.filter(F.col("segment") == segment).select(
        "*", grid_column(cfg.extract_grid).alias("mob"))
    f = feed_g.filter(F.col("segment") == segment)
    return (d
            .join(f, ["segment", "cohort_end", "mob"], "left")
            .select(fiscal_quarter_label("cohort_end").alias("fy_quarter"),
                    iso("cohort_end").alias("cohort_end"), F.col("mob").cast("long").alias("mob"),
                    F.col("lan_cnt").cast("long").alias("lan_cnt"),
                    F.round(to_crore("disb_uc"), 6).alias("disbursal_cr"),
                    F.round(to_crore(F.coalesce("dpd90_uc", F.lit(0))), 6).alias("dpd90_cr"),
                    F.round(to_crore(F.coalesce("tpos_uc", F.lit(0))), 6).alias("tpos_cr")))


def loan_mob_wide(perf_by_loan: DataFrame, cfg: EclConfig) -> DataFrame:
    """A1 / V1: one row per loan, one column per metric and extraction MOB
    (NULL where the loan has no row at that MOB).  Both aggregations of the
    pivot, by (loan, mob) and by loan, reuse the partitioning by loan."""
    mobs = list(cfg.extract_grid.mobs)
    p = (perf_by_loan.groupBy("loan_no").pivot("mob", mobs)
         .agg(F.sum("dpd90_cents").alias("overdue"), F.sum("tpos_cents").alias("outstanding")))
    names = [(f"{m}_{kind}", f"{kind}_at_{m}") for kind in ("overdue", "outstanding") for m in mobs]
    return p.select("loan_no", *[F.col(a).alias(b) for a, b in names])


def feed_wide(feed: DataFrame, disb: DataFrame, cfg: EclConfig) -> DataFrame:
    """A3: the published wide feed, pivoted over the small aggregate only."""
    mobs = list(cfg.extract_grid.mobs)
    p = (feed.groupBy("cohort_end", "segment").pivot("mob", mobs)
         .agg(F.first("dpd90_uc").alias("d"), F.first("tpos_uc").alias("t")))
    cols = [F.round(to_crore(F.col(f"{m}_d")), 6).alias(f"amt_90plus_settlement_{m}mob") for m in mobs]
    cols += [F.round(to_crore(F.col(f"{m}_t")), 6).alias(f"tpos_{m}mob") for m in mobs]
    # O1: published order is fiscal quarter (by its end date, century-safe)
    # then segment; a sort of cohorts x segments rows
    return (disb.join(p, ["cohort_end", "segment"], "left")
            .orderBy("cohort_end", "segment")
            .select(fiscal_quarter_label("cohort_end").alias("fy_quarter"),
                    F.col("segment").cast("long").alias("segment"),
                    F.col("lan_cnt").cast("long").alias("lan_cnt"),
                    F.round(to_crore("disb_uc"), 6).alias("disbursal_amt"), *cols))


def unpivot_feed(wide: DataFrame, cfg: EclConfig) -> DataFrame:
    """V2: wide feed back to long, observed (non-NULL) cells only."""
    mobs = list(cfg.extract_grid.mobs)
    ids = ["fy_quarter", "segment"]
    vals = [f"amt_90plus_settlement_{m}mob" for m in mobs] + [f"tpos_{m}mob" for m in mobs]
    long = wide.unpivot(ids, vals, "column", "amount_cr").filter(F.col("amount_cr").isNotNull())
    metric = F.when(F.col("column").startswith("tpos_"), F.lit("tpos")).otherwise(F.lit("dpd90"))
    mob = F.regexp_extract("column", r"_(\d+)mob$", 1).cast("long")
    return long.select(*ids, metric.alias("metric"), mob.alias("mob"), "amount_cr")
