"""Spot reconciliation (R9): the feed at one MOB against its sources, and
which loans make the difference.

``spot_check`` reads one MOB of performance (the filter reaches the scan) and
compares it, cohort by cohort, with the feed.  Where the feed's own input is at
hand, ``differing_loans`` finds the loans in which two performance tables
differ: checksums by key range first, one row a range, then only the ranges
that differ are read again, loan by loan.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runoff.config import MICRO_CRORE_MINOR_UNITS, MINOR_UNITS_PER_CRORE, EclConfig
from runoff.operators.feed import loans_in_window
from runoff.sources.ranges import in_ranges, range_cuts, range_of

RANGES = 256
_AMOUNTS = ("dpd90_cents", "tpos_cents")


def at_mob(perf: DataFrame, mob: int) -> DataFrame:
    return perf.filter(F.col("mob") == mob).select("loan_no", *_AMOUNTS)


def spot_check(loans: DataFrame, perf: DataFrame, feed: DataFrame, disb: DataFrame, cfg: EclConfig,
               mob: int) -> DataFrame:
    """Per (cohort_end, segment): loans, disbursal, 90+ and TPOS at ``mob`` as
    the feed has them and as the sources have them (exact minor units), the
    largest difference of amounts in cents and whether it is within the tolerance.  A
    cohort that only one side has is compared with zeros."""
    own = loans_in_window(loans, cfg).select("loan_no", "cohort_end", "segment", "amount_cents")
    # a loan's rows first: repeated ones must not count the loan again
    by_loan = at_mob(perf, mob).groupBy("loan_no").agg(*[F.sum(c).alias(c) for c in _AMOUNTS])
    zero, keys = F.lit(0).cast("long"), ["cohort_end", "segment"]
    source = (own.join(by_loan, "loan_no", "left").groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("source_loans"), F.sum("amount_cents").alias("source_disbursal"),
                   *[F.coalesce(F.sum(c), zero).alias(f"source_{c[:-6]}") for c in _AMOUNTS]))
    there = F.col("mob") == mob
    cents = lambda c: F.coalesce(F.sum(c), zero) * MICRO_CRORE_MINOR_UNITS
    told = (disb.select(*keys, "lan_cnt", "disb_uc").unionByName(
                feed.filter(there).select(*keys, "dpd90_uc", "tpos_uc"), allowMissingColumns=True)
            .groupBy(*keys).agg(F.coalesce(F.sum("lan_cnt"), zero).alias("feed_loans"), cents("disb_uc").alias("feed_disbursal"),
                                cents("dpd90_uc").alias("feed_dpd90"), cents("tpos_uc").alias("feed_tpos")))
    pairs = [(f"feed_{x}", f"source_{x}") for x in ("loans", "disbursal", "dpd90", "tpos")]
    both = told.join(source, keys, "full_outer").fillna(0, [c for p in pairs for c in p])
    loans_off, *amounts_off = [F.abs(F.col(a) - F.col(b)) for a, b in pairs]
    off = F.greatest(*amounts_off)
    return both.withColumn("off_cents", off).withColumn(
        "verdict", F.when((loans_off == 0) & (off <= cfg.tol * MINOR_UNITS_PER_CRORE), F.lit("PASS")).otherwise(F.lit("FAIL")))


def _sides(one: DataFrame, other: DataFrame, mob: int) -> DataFrame:
    return (at_mob(one, mob).withColumn("first", F.lit(True))
            .unionByName(at_mob(other, mob).withColumn("first", F.lit(False))))


def _compared(sides: DataFrame, by) -> DataFrame:
    """Rows, amounts and a checksum of both sides by ``by``; a sum of hashes,
    so that order does not matter and repeated rows count."""
    digest = F.xxhash64("loan_no", *_AMOUNTS).cast("decimal(38,0)")
    aggs = []
    for k, mine in ((1, F.col("first")), (2, ~F.col("first"))):
        aggs += [F.count_if(mine).alias(f"rows_{k}"), F.sum(F.when(mine, digest)).alias(f"_sum_{k}"),
                 *[F.sum(F.when(mine, F.coalesce(c, F.lit(0))).otherwise(0)).alias(f"{c}_{k}") for c in _AMOUNTS]]
    same = (F.col("rows_1") == F.col("rows_2")) & F.col("_sum_1").eqNullSafe(F.col("_sum_2"))
    return sides.groupBy(by).agg(*aggs).filter(~same).drop("_sum_1", "_sum_2")


def differing_ranges(one: DataFrame, other: DataFrame, mob: int, cuts: list) -> list:
    """Numbers of the key ranges in which the tables differ at ``mob`` (None:
    among rows without a key); at most one more than there are ranges."""
    sides = _sides(one, other, mob).withColumn("range", range_of(F.col("loan_no"), cuts))
    return [r["range"] for r in _compared(sides, F.col("range")).collect()]


def differing_loans(one: DataFrame, other: DataFrame, mob: int, keys: DataFrame | None = None) -> DataFrame:
    """loan_no, rows_1, rows_2, the amounts of both (0 without rows) and the reason (``missing``
    from the second table, ``added`` in it, ``rows``: another number of rows,
    ``amounts``) for each loan whose rows at ``mob`` differ.  Rows without a
    key are compared as those of one loan, NULL.  ``keys`` (loan_no): where the
    range cuts come from, such as the loan table; else the first table."""
    cuts = range_cuts(one.filter(F.col("mob") == mob) if keys is None else keys, "loan_no", RANGES)
    near = in_ranges(F.col("loan_no"), cuts, differing_ranges(one, other, mob, cuts))
    found = _compared(_sides(one.filter(near), other.filter(near), mob), F.col("loan_no"))
    reason = (F.when(F.col("rows_2") == 0, "missing").when(F.col("rows_1") == 0, "added")
              .when(F.col("rows_1") != F.col("rows_2"), "rows").otherwise("amounts"))
    return found.withColumn("reason", reason)
