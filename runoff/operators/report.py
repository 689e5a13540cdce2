"""Report tables (T1-T6): the workbook's content as DataFrames.

Pivots run over the small triangle tables only (cohorts x 40 MOBs), never
over loans.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runoff.config import EclConfig
from runoff.functions.calendar import fiscal_quarter_label, iso
from runoff.functions.joins import side_by_side
from runoff.functions.numeric import to_crore


def _mcols(cfg: EclConfig, fmt, dp: int):
    return [F.round(fmt(m), dp).alias(f"m{m}") for m in cfg.triangle_grid.mobs]


def raw_pivot(cells: DataFrame, metric: str, cfg: EclConfig) -> DataFrame:
    """T1 + A5: observed actuals (immature cells blank) and a Grand Total
    row (exact integer sums), one column per triangle MOB."""
    mobs = list(cfg.triangle_grid.mobs)
    v = F.when(F.col("is_observed"), F.col(f"{metric}_uc"))
    # disbursal counted once per cohort (on its first-MOB cell), so the
    # rollup's total row carries the book's disbursal too
    d = F.when(F.col("mob") == mobs[0], F.col("disb_uc"))
    rolled = (cells.select("mob", "cohort_end", v.alias("_v"), d.alias("_d"))
              .rollup("mob", "cohort_end")
              .agg(F.sum("_v").alias("_v"), F.sum("_d").alias("_d"))
              .filter(F.col("mob").isNotNull()))
    piv = (rolled.groupBy("cohort_end").pivot("mob", mobs)
           .agg(F.first("_v").alias("v"), F.first("_d").alias("d")))
    total = F.col("cohort_end").isNull()
    return piv.select(
        F.when(total, F.lit("Grand Total")).otherwise(fiscal_quarter_label("cohort_end"))
        .alias("fy_quarter"),
        iso("cohort_end").alias("cohort_end"),
        F.round(to_crore(f"{mobs[0]}_d"), 6).alias("disb_cr"),
        *_mcols(cfg, lambda m: to_crore(F.col(f"{m}_v")), 6))


def triangle_wide(tri: DataFrame, cfg: EclConfig) -> DataFrame:
    """Completed triangles, 90+ as rate and TPOS as amount."""
    mobs = list(cfg.triangle_grid.mobs)
    disb = to_crore("disb_uc")
    long = tri.select("cohort_end", "disb_uc", "mob", F.explode(F.array(
        F.struct(F.lit("dpd90_rate").alias("metric"),
                 F.round(F.when(disb == 0, F.lit(0.0)).otherwise(F.col("dpd90_amt") / disb), 8)
                 .alias("v")),
        F.struct(F.lit("tpos_amt").alias("metric"), F.round("tpos_amt", 6).alias("v")))).alias("x"))
    long = long.select("cohort_end", "disb_uc", "mob", "x.*")
    piv = long.groupBy("cohort_end", "disb_uc", "metric").pivot("mob", mobs).agg(F.first("v"))
    return piv.select(fiscal_quarter_label("cohort_end").alias("fy_quarter"),
                      iso("cohort_end").alias("cohort_end"), "metric",
                      F.round(to_crore("disb_uc"), 6).alias("disb_cr"),
                      *[F.col(str(m)).alias(f"m{m}") for m in mobs])


def loss_rate_report(loss: DataFrame, current: DataFrame, cfg: EclConfig) -> DataFrame:
    """T4: loss rate per anchor side by side, with current MOB and TPOS."""
    anchors = list(cfg.anchors)
    piv = (loss.groupBy("segment", "cohort_end", "disb_cr").pivot("anchor_mob", anchors)
           .agg(F.first("loss_rate")))
    j = piv.join(current.select("segment", "cohort_end", "current_mob", "current_tpos"),
                 ["segment", "cohort_end"], "left")
    return j.select(fiscal_quarter_label("cohort_end").alias("fy_quarter"),
                    iso("cohort_end").alias("cohort_end"), F.round("disb_cr", 6).alias("disb_cr"),
                    *[F.round(F.col(str(a)), 8).alias(f"lr_{a}m") for a in anchors],
                    F.col("current_mob").cast("long").alias("current_mob"),
                    F.round("current_tpos", 6).alias("current_tpos"))


def summary(book) -> DataFrame:
    """Key / value rows of the run summary (numbers and text apart)."""
    cfg = book.cfg
    h = book.headline("all")
    cur = book.current.filter(F.col("segment") == "all").agg(
        F.count(F.lit(1)).alias("n_cohorts"), F.sum("current_tpos").alias("portfolio_tpos"))
    one = side_by_side(h.select("weighted_avg_lr", "total_disb", "ecl_pct"), cur)
    num = lambda k, c: F.struct(F.lit(k).alias("key"), c.cast("double").alias("value_num"),
                                F.lit(None).cast("string").alias("value_text"))
    txt = lambda k, v: F.struct(F.lit(k).alias("key"), F.lit(None).cast("double").alias("value_num"),
                                F.lit(v).alias("value_text"))
    rows = F.array(
        txt("as_of", cfg.as_of.isoformat()),
        num("n_cohorts", F.col("n_cohorts")),
        txt("mob_grid", cfg.triangle_grid.text),
        txt("anchors", ", ".join(f"{a}M" for a in cfg.anchors)),
        txt("headline_window", cfg.headline),
        num("weighted_avg_lr", F.round("weighted_avg_lr", 8)),
        num("window_disb", F.round("total_disb", 6)),
        num("ecl_pct", F.round("ecl_pct", 8)),
        num("portfolio_tpos", F.round("portfolio_tpos", 6)))
    return one.select(F.explode(rows).alias("x")).select("x.*")
