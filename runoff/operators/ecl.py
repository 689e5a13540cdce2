"""Phase 4: disbursal-weighted loss rates per window and the ECL.

Windows are data: every loss row is paired with each configured window and
flagged when it lies inside; conditional aggregates do the rest.  No join.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from runoff.config import EclConfig, Window
from runoff.functions.numeric import safe_ratio, to_crore

WINDOW_SCHEMA = ("window string, fy_start string, fy_end string, anchor_mob int, "
                 "first_day date, last_day date")


def windows_df(spark, windows: tuple[Window, ...] | list[Window]) -> DataFrame:
    rows = [(w.name, w.start_label, w.end_label, w.anchor_mob, w.first_day, w.last_day)
            for w in windows]
    return spark.createDataFrame(rows, WINDOW_SCHEMA)


def weighted_loss_rate(loss: DataFrame, cfg: EclConfig, windows=None) -> DataFrame:
    """E2 (A7, A8, J4): per (segment, window): quarters, total disbursal,
    simple and disbursal-weighted average loss rate.  Every loss row is
    paired with each configured window (a config-sized explode) and flagged
    when its anchor and cohort fall in the window; conditional aggregates
    then give every (segment, window), so an empty window still yields a
    row (weighted 0, simple NULL, 0 quarters).  No join; keyed by segment
    first, so the loss table's partitioning is reused."""
    wins = F.explode(F.array(*[
        F.struct(F.lit(w.name).alias("window"), F.lit(w.start_label).alias("fy_start"),
                 F.lit(w.end_label).alias("fy_end"), F.lit(w.anchor_mob).alias("anchor_mob"),
                 F.lit(w.first_day).alias("first_day"), F.lit(w.last_day).alias("last_day"))
        for w in (windows or cfg.windows)]))                          # config-sized fan-out
    x = (loss.select("segment", "cohort_end", F.col("anchor_mob").alias("_a"), "loss_rate",
                     "disb_cr", "anchor_observed", wins.alias("w"))
         .select("segment", "cohort_end", "_a", "loss_rate", "disb_cr", "anchor_observed", "w.*"))
    inw = (F.col("_a") == F.col("anchor_mob")) & F.col("cohort_end").between(
        F.col("first_day"), F.col("last_day"))
    lr, w = F.when(inw, F.col("loss_rate")), F.when(inw, F.col("disb_cr"))
    return (x.groupBy("segment", "window", "fy_start", "fy_end", "anchor_mob")
            .agg(F.count_if(inw).alias("n_quarters"),
                 # cohorts whose anchor cell is observed, not projected: 0 means
                 # the window's rate rests on projections only (e.g. a young book)
                 F.count_if(inw & F.col("anchor_observed")).alias("n_observed_at_anchor"),
                 F.coalesce(F.sum(w), F.lit(0.0)).alias("total_disb"),
                 F.avg(lr).alias("simple_avg_lr"),
                 safe_ratio(F.sum(lr * w), F.sum(w)).alias("weighted_avg_lr"))
            .withColumn("ecl_pct", F.col("weighted_avg_lr")))


_RUNNING = ("n_quarters", "n_observed_at_anchor", "total_disb", "_lr", "_lr_disb")


def _quarter(day) -> Column:
    """Number of the calendar quarter of a day."""
    return F.year(day) * 4 + F.quarter(day)


def running_sums(loss: DataFrame) -> DataFrame:
    """Per (segment, anchor) and calendar quarter from the first cohort's to
    the last one's: what all cohorts up to that quarter add up to.  A quarter
    without a cohort has the sums of the one before; the calendar bounds all."""
    by = W.partitionBy("segment", "anchor_mob").orderBy("cohort_end")
    upto = by.rowsBetween(W.unboundedPreceding, 0)
    parts = {"n_quarters": F.lit(1), "n_observed_at_anchor": F.col("anchor_observed").cast("int"),
             # micro-crore, so that differences are exact and none of 0 is missed
             "total_disb": F.round(F.col("disb_cr") * 1e6).cast("long"), "_lr": F.col("loss_rate"), "_lr_disb": F.col("loss_rate") * F.col("disb_cr")}
    q = _quarter(F.col("cohort_end"))
    until = F.coalesce(F.lead(q).over(by) - 1, q)
    return (loss.select("segment", "anchor_mob", *[F.sum(x).over(upto).alias(k) for k, x in parts.items()],
                        q.alias("_q"), until.alias("_until"))
            .select("segment", "anchor_mob", *parts, F.explode(F.sequence("_q", "_until")).alias("quarter")))


def weighted_over_windows(loss: DataFrame, windows: DataFrame) -> DataFrame:
    """J4 + E2 for any number of windows, given as a table (window, anchor_mob,
    first_day, last_day): each is the difference of the running sums at its
    ends, so it takes two lookups a segment however many cohorts it spans, and
    loss rows never meet windows.  Every window gives a row for each segment
    that has its anchor; an empty one has 0 quarters, 0 disbursal, a weighted
    rate of 0 and no simple one."""
    sums = running_sums(loss)
    last = sums.groupBy("segment", "anchor_mob").agg(F.max("quarter").alias("_max"))
    end = _quarter(F.date_add("last_day", 1)) - 1          # the last quarter that ends inside
    begin = _quarter(F.col("first_day")) - 1               # the last one that ends before
    asked = (windows.join(last, "anchor_mob")
             .withColumns({"_end": F.least(F.greatest(end, begin), F.col("_max")), "_begin": F.least(begin, F.col("_max"))}))
    for at in ("_end", "_begin"):
        own = sums.select("segment", "anchor_mob", F.col("quarter").alias(at), *[F.col(c).alias(f"{at}{c}") for c in _RUNNING])
        asked = asked.join(own, ["segment", "anchor_mob", at], "left")
    zero = F.lit(0)
    n, seen, disb, lr, lr_disb = (F.coalesce(f"_end{c}", zero) - F.coalesce(f"_begin{c}", zero) for c in _RUNNING)
    return asked.select(
        "segment", "window", "anchor_mob", "first_day", "last_day", n.alias("n_quarters"), seen.alias("n_observed_at_anchor"),
        to_crore(disb).alias("total_disb"), F.when(n > 0, lr / n).alias("simple_avg_lr"),
        safe_ratio(lr_disb, to_crore(disb)).alias("weighted_avg_lr"))


def headline(wavg: DataFrame, cfg: EclConfig, segment: str = "all") -> DataFrame:
    """The headline window, selected by name (never by position)."""
    return wavg.filter((F.col("segment") == segment) & (F.col("window") == cfg.headline))


def window_detail(loss: DataFrame, segment: str, window: Window) -> DataFrame:
    """E5: per-cohort rows of one segment/window/anchor."""
    return loss.filter((F.col("segment") == segment)
                       & (F.col("anchor_mob") == window.anchor_mob)
                       & F.col("cohort_end").between(F.lit(window.first_day),
                                                     F.lit(window.last_day)))
