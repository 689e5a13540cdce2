"""Segment requests from a table (P12, P13, E4): each is read by the same
rules as ``config.SegmentRequest``, and answered or told what is wrong."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runoff.config import WHOLE_BOOK, WHOLE_BOOK_SPELLINGS, EclConfig
from runoff.operators import ecl

ASKED = ("segment", "fy_start", "fy_end", "anchor")


def fiscal_year_of(spelling: Column, century_pivot: int) -> Column:
    """The four-digit ending year, or NULL where the text names none."""
    year = F.regexp_extract(spelling, r"(?i)^\s*(?:FY)?(\d{2}|\d{4})(?:-Q[1-4])?\s*$", 1)
    n = year.try_cast("int")
    return F.when(F.length(year) == 2, century_pivot + F.pmod(n - century_pivot, F.lit(100))).otherwise(n)


def segment_of(spelling: Column, segments) -> Column:
    """The segment's key, or NULL where the book has none of this name."""
    text = F.lower(F.regexp_replace(F.coalesce(spelling, F.lit("")), r"^\s+|\s+$", ""))
    return (F.when(text.isin(list(WHOLE_BOOK_SPELLINGS)), F.lit(WHOLE_BOOK))
            .when(text.isin([str(s) for s in segments]), text))


def answer(requests: DataFrame, loss: DataFrame, cfg: EclConfig) -> DataFrame:
    """``requests`` (text columns segment, fy_start, fy_end, anchor; others are
    kept) with the key asked for, the number of cohorts covered, the weighted
    rate, and ``problem``: NULL, or all that is wrong, in the order of the
    arguments.  A request in order that covers no cohort is wrong as well; a
    wrong one has 0 of them and no rate.  Each distinct window is looked up once in the
    loss table's running sums, and the answers meet the requests by key."""
    asked = requests.withColumns({
        "key": segment_of(F.col("segment"), cfg.segments),
        "_first": fiscal_year_of(F.col("fy_start"), cfg.century_pivot),
        "_last": fiscal_year_of(F.col("fy_end"), cfg.century_pivot),
        "_anchor": F.when(F.col("anchor").rlike(r"^\s*[+-]?\d+\s*$"), F.trim("anchor").try_cast("int"))})
    no_anchor = ~F.coalesce(F.col("_anchor").isin(list(cfg.anchors)), F.lit(False))
    wrong = F.array_compact(F.array(
        F.when(F.col("key").isNull(), "no such segment"), F.when(F.col("_first").isNull(), "no first fiscal year"),
        F.when(F.col("_last").isNull(), "no last fiscal year"), F.when(no_anchor, "no anchor"),
        F.when(F.col("_first") > F.col("_last"), "ends before it begins")))
    asked = asked.withColumn("_wrong", wrong).withColumn(
        "_window", F.when(F.size("_wrong") == 0, F.concat_ws("..", "_first", "_last")))
    windows = (asked.filter(F.col("_window").isNotNull())
               .select(F.col("_window").alias("window"), F.make_date(F.col("_first") - 1, F.lit(4), F.lit(1)).alias("first_day"),
                       F.make_date("_last", F.lit(3), F.lit(31)).alias("last_day"), F.col("_anchor").alias("anchor_mob"))
               .distinct())
    found = ecl.weighted_over_windows(loss, windows).select(
        F.col("segment").alias("_s"), F.col("window").alias("_w"), F.col("anchor_mob").alias("_a"), "n_quarters", "weighted_avg_lr")
    met = asked.join(found, (F.col("key") == F.col("_s")) & (F.col("_window") == F.col("_w"))
                     & (F.col("_anchor") == F.col("_a")), "left")
    empty = F.col("_window").isNotNull() & (F.coalesce("n_quarters", F.lit(0)) == 0)
    problem = F.when(empty, "covers no cohorts").when(F.size("_wrong") > 0, F.concat_ws("; ", "_wrong"))
    fine = F.col("problem").isNull()
    return met.withColumn("problem", problem).select(
        *requests.columns, "key", F.when(fine, F.col("n_quarters")).otherwise(0).alias("n_quarters"),
        F.when(fine, F.col("weighted_avg_lr")).alias("weighted_avg_lr"), "problem")
