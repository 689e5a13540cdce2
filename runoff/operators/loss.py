"""Phase 3: movements and loss rates.

LR_A = 90+(A) / (disbursal + sum of TPOS at the yearly MOBs 12 .. A-12).
Anchors are data (a config-sized table), so every anchor is one pass.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runoff.config import YEAR_MOB, EclConfig
from runoff.functions.numeric import safe_ratio, to_crore


def movements(tri: DataFrame) -> DataFrame:
    """L1-L4: levels (not deltas) at the yearly MOBs, amount and % of disbursal."""
    disb = to_crore("disb_uc")
    return (tri.filter(F.col("mob") % YEAR_MOB == 0)
            .select("segment", "cohort_end", "mob", "is_observed", disb.alias("disb_cr"),
                    "tpos_amt", safe_ratio(F.col("tpos_amt"), disb).alias("tpos_pct"),
                    "dpd90_amt", safe_ratio(F.col("dpd90_amt"), disb).alias("dpd90_pct")))


def loss_rates(tri: DataFrame, cfg: EclConfig) -> DataFrame:
    """L5 + L6 (+ A6): per (segment, cohort, anchor): numerator, denominator,
    loss rate (0 on a zero denominator) and whether the anchor cell is observed."""
    mob, anchor = F.col("mob"), F.col("anchor_mob")
    at_anchor = mob == anchor
    in_den = (mob % YEAR_MOB == 0) & (mob < anchor)
    anchors = F.explode(F.array(*[F.lit(a) for a in cfg.anchors]))   # config-sized fan-out
    g = (tri.select("*", anchors.alias("anchor_mob"))
         .filter(at_anchor | in_den)
         .groupBy("segment", "cohort_end", "anchor_mob")
         .agg(F.max("disb_uc").alias("disb_uc"),
              F.max(F.when(at_anchor, F.col("dpd90_amt"))).alias("ninety_plus"),
              F.max(F.when(at_anchor, F.col("is_observed"))).alias("anchor_observed"),
              F.sum(F.when(in_den, F.col("tpos_amt"))).alias("tpos_sum")))
    disb = to_crore("disb_uc")
    den = disb + F.coalesce(F.col("tpos_sum"), F.lit(0.0))
    return g.select("segment", "cohort_end", "anchor_mob", disb.alias("disb_cr"),
                    F.coalesce("ninety_plus", F.lit(0.0)).alias("ninety_plus"),
                    F.coalesce("tpos_sum", F.lit(0.0)).alias("tpos_sum"),
                    den.alias("denominator"),
                    safe_ratio(F.col("ninety_plus"), den).alias("loss_rate"),
                    F.coalesce("anchor_observed", F.lit(False)).alias("anchor_observed"))


def loss_rate_flags(loss: DataFrame) -> DataFrame:
    """Projected anchor, or observed but above 100 %."""
    flag = (F.when(~F.col("anchor_observed"), F.lit("projected"))
            .when(F.col("loss_rate") > 1, F.lit("implausible"))
            .otherwise(F.lit("observed")))
    return loss.withColumn("flag", flag)


def loss_rate_stats(loss: DataFrame) -> DataFrame:
    """Min / median / max loss rate per (segment, anchor), count above 100 %."""
    return (loss.groupBy("segment", "anchor_mob")
            .agg(F.count(F.lit(1)).alias("n_cohorts"),
                 F.min("loss_rate").alias("min_lr"),
                 F.median("loss_rate").alias("median_lr"),
                 F.max("loss_rate").alias("max_lr"),
                 F.count_if(F.col("loss_rate") > 1).alias("n_above_100pct")))


def current_tpos(tri: DataFrame) -> DataFrame:
    """The diagonal: TPOS at each cohort's current MOB (0 if none)."""
    at_current = F.col("mob") == F.col("max_mature_mob")
    return (tri.groupBy("segment", "cohort_end")
            .agg(F.max("max_mature_mob").alias("current_mob"), F.max("disb_uc").alias("disb_uc"),
                 F.max(F.when(at_current, F.col("tpos_amt"))).alias("current_tpos"))
            .select("segment", "cohort_end", "current_mob", to_crore("disb_uc").alias("disb_cr"),
                    F.coalesce("current_tpos", F.lit(0.0)).alias("current_tpos")))


def portfolio_tpos(cur: DataFrame) -> DataFrame:
    """Sum of the diagonal per group (information only)."""
    return cur.groupBy("segment").agg(F.count(F.lit(1)).alias("n_cohorts"),
                                      F.sum("current_tpos").alias("portfolio_tpos"))


def monotonicity(tri: DataFrame) -> DataFrame:
    """Per group: cells, NULL cells left, and cells where the 90+ rate
    falls from the previous MOB (cumulative defaults must not fall)."""
    w = Window.partitionBy("segment", "cohort_end").orderBy("mob")
    disb = to_crore("disb_uc")
    r = safe_ratio(F.col("dpd90_amt"), disb)
    t = tri.withColumn("_r", r).withColumn("_prev", F.lag("_r").over(w))
    return (t.groupBy("segment")
            .agg(F.count(F.lit(1)).alias("n_cells"),
                 F.count_if(F.col("dpd90_amt").isNull() | F.col("tpos_amt").isNull()).alias("n_null"),
                 F.count_if(F.col("_r") < F.col("_prev") - F.lit(1e-9)).alias("n_decreasing")))
