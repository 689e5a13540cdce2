"""Data-quality, profile and reconciliation operators.

A reconciliation is a second, independently written plan over the same
sources, compared row by row with a FULL OUTER join (a row missing on either
side shows up as a difference) and reduced to measures: rows (check_id,
measure).  What a measure may be is data: ``definitions`` gives every check
its bound and what it means to exceed it, and ``judge`` turns all measures
into verdicts with one expression.  A measure that could not be taken (NULL:
nothing to compare) is beyond every bound.

Amount differences are taken in exact integer minor units and converted to
crore once, so they do not depend on summation order.

The reconciliation reads performance by loan.  Callers pass it partitioned by
``loan_no`` (``Book.perf_by_loan``: one exchange of a plain table, none of a
bucketed one); all groupings and joins here reuse that.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runoff.config import MINOR_UNITS_PER_CRORE, MICRO_CRORE_MINOR_UNITS, YEAR_MOB, EclConfig
from runoff.functions.calendar import iso
from runoff.functions.joins import side_by_side, with_loan
from runoff.functions.numeric import micro_crore, safe_ratio, to_crore
from runoff.operators import ecl
from runoff.operators.feed import loans_in_window

DIFF_DP = 10
#: Relative tolerance of a projected cell against the recurrence.
RECURRENCE_TOL = 1e-9


# ------------------------------------------------------------------ definitions
def definitions(cfg: EclConfig) -> dict[str, tuple[float, str]]:
    """{check id: (largest allowed measure, verdict beyond it)}."""
    return {
        "feed.loan_count": (0.0, "FAIL"),
        "feed.disbursal": (cfg.tol, "FAIL"),
        "feed.overdue": (cfg.tol, "FAIL"),
        "feed.outstanding": (cfg.tol, "FAIL"),
        **{f"loss_rate.{a}m": (cfg.tol, "FAIL") for a in cfg.anchors},
        "window.weighted_rate": (cfg.tol, "FAIL"),
        "window.rate_above_one": (0.0, "WARN"),
        "triangle.recurrence": (RECURRENCE_TOL, "FAIL"),
        "book.whole_run": (cfg.tol, "FAIL"),
        "sink.summary_rate": (cfg.tol, "FAIL"),
        "sink.rows": (0.0, "FAIL"),
        "source.rejected_rows": (0.0, "WARN"),
    }


def measures(one_row: DataFrame, by_id: dict[str, str]) -> DataFrame:
    """(check_id, measure) rows from the columns of one row; by_id: {check id: column}."""
    pairs = F.array(*[F.struct(F.lit(k).alias("check_id"), F.col(c).cast("double").alias("measure"))
                      for k, c in by_id.items()])
    return one_row.select(F.explode(pairs).alias("m")).select("m.*")


def judge(taken: DataFrame, cfg: EclConfig) -> DataFrame:
    """check_id, measure, bound, verdict.  An id's part after ``:`` names what
    it was taken of and does not matter to its definition."""
    entries = sorted(definitions(cfg).items())
    bounds = F.create_map(*[x for k, (b, _) in entries for x in (F.lit(k), F.lit(b))])
    beyond = F.create_map(*[x for k, (_, v) in entries for x in (F.lit(k), F.lit(v))])
    kind = F.substring_index("check_id", ":", 1)
    return (taken.withColumn("bound", bounds[kind])
            .withColumn("verdict", F.when(F.col("measure") <= F.col("bound"), F.lit("PASS"))
                        .otherwise(beyond[kind])))


def with_overall(verdicts: DataFrame) -> DataFrame:
    """The verdicts and an ``overall`` row with the gravest of them."""
    gravest = (F.when(F.count_if(F.col("verdict") == "FAIL") > 0, "FAIL")
               .when(F.count_if(F.col("verdict") == "WARN") > 0, "WARN").otherwise("PASS"))
    none = F.lit(None).cast("double")
    overall = verdicts.agg(gravest.alias("verdict")).select(
        F.lit("overall").alias("check_id"), none.alias("measure"), none.alias("bound"), "verdict")
    return verdicts.unionByName(overall)


def gate(verdicts: DataFrame) -> str:
    """The overall verdict on the driver (a one-row action); raises on FAIL."""
    overall = verdicts.filter(F.col("check_id") == "overall").first()["verdict"]
    if overall == "FAIL":
        bad = [r["check_id"] for r in verdicts.filter("verdict = 'FAIL' and check_id <> 'overall'").collect()]
        raise RuntimeError(f"run rejected; checks beyond their bounds: {', '.join(bad)}")
    return overall


# ------------------------------------------------------------------ S6
LOAN_FIELDS = ("loan_no", "customer_id", "segment", "disbursal_date", "amount_cents", "tenure_months")
PERF_FIELDS = ("loan_no", "mob", "tpos_cents", "dpd90_cents")


def _any_null(columns, fields):
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns if c in fields])


#: MOBs that a loan's rows note as bits: BITS longs of 63.
BITS = 3
#: So many loan keys are sent to every task; more are joined by an exchange.
FEW_LOANS = 100_000


def rows_by_loan(keyed: DataFrame) -> DataFrame:
    """One row per loan (p_no): rows, rows with NULL fields, and how many
    different MOBs there are, as far as bits can tell; ``p_odd``: rows whose
    MOB has no bit.  All of it merges map-side, so a loan key that a third of
    all rows repeat is a row a task in the one exchange."""
    mob = F.col("mob")
    bits = [F.bit_or(F.expr(f"CASE WHEN mob >= {63 * i} AND mob < {63 * (i + 1)} THEN shiftleft(1L, mob - {63 * i}) "
                            "ELSE 0L END")).alias(f"_b{i}") for i in range(BITS)]
    per = keyed.groupBy(F.col("loan_no").alias("p_no")).agg(
        F.count(F.lit(1)).alias("p_rows"), F.count_if(_any_null(PERF_FIELDS, PERF_FIELDS)).alias("p_nulls"),
        F.count_if(mob.isNull() | ~mob.between(0, 63 * BITS - 1)).alias("p_odd"), *bits)
    return per.select("p_no", "p_rows", "p_nulls", "p_odd",
                      reduce(lambda x, y: x + y, [F.bit_count(f"_b{i}") for i in range(BITS)]).alias("p_mobs"))


def key_violations(loans: DataFrame, perf: DataFrame, rejects: DataFrame | None = None) -> DataFrame:
    """Source constraints as a data-quality report (one row): both tables are
    reduced to a row for each loan and meet once.

    It must survive what it reports.  Rows without a loan key are counted
    apart, by MOB.  Repeated (loan, MOB) keys can only be where a loan has
    fewer MOBs than rows: how many such loans there are is known with the
    first row of totals, and just their rows are read again and counted by
    both keys (where the constraint holds, nothing is).  Every aggregate
    combines before its exchange.  ``rejects`` (``sources.tables``) are counted too."""
    keyed, unkeyed = (perf.filter(F.col("loan_no").isNotNull()), perf.filter(F.col("loan_no").isNull()))
    per = rows_by_loan(keyed)
    suspect = (F.col("p_rows") - F.col("p_odd") != F.col("p_mobs")) | (F.col("p_odd") > 1)
    more_than_one = F.count_if(F.col("n") > 1)
    without = unkeyed.groupBy("mob").agg(F.count(F.lit(1)).alias("n"))
    loan = loans.groupBy(F.col("loan_no").alias("l_no")).agg(
        F.count(F.lit(1)).alias("l_rows"), F.count_if(_any_null(loans.columns, LOAN_FIELDS)).alias("l_nulls"))
    # a NULL key is equal to no key: both sides keep it as unmatched
    both = loan.join(per, F.col("l_no") == F.col("p_no"), "full_outer")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    totals = both.agg(
        total("l_rows").alias("n_loans"), F.count_if(F.col("l_rows") > 1).alias("dup_loan_keys"),
        total("l_nulls").alias("null_loan_fields"), total("p_rows").alias("_rows"),
        total("p_nulls").alias("_nulls"), total(F.when(F.col("l_rows").isNull(), F.col("p_rows"))).alias("_orphans"),
        total(F.when(F.col("p_rows").isNull(), F.col("l_rows"))).alias("loans_without_perf"),
        F.count_if(suspect).alias("_suspects"))
    found = totals.first()
    repeated = loans.sparkSession.range(1).select(F.lit(0).cast("long").alias("_repeated"))
    if found["_suspects"]:
        suspects = per.filter(suspect).select("p_no")
        if found["_suspects"] <= FEW_LOANS:
            suspects = F.broadcast(suspects)
        repeated = (keyed.join(suspects, F.col("loan_no") == F.col("p_no"), "left_semi")
                    .groupBy("loan_no", "mob").agg(F.count(F.lit(1)).alias("n")).agg(more_than_one.alias("_repeated")))
    parts = [
        loans.sparkSession.createDataFrame([found], totals.schema).drop("_suspects"), repeated,
        without.agg(total("n").alias("_without"), more_than_one.alias("_repeated_without"))]
    told = ["n_loans", "dup_loan_keys", "null_loan_fields", (F.col("_rows") + F.col("_without")).alias("n_perf_rows"),
            (F.col("_repeated") + F.col("_repeated_without")).alias("dup_perf_keys"),
            (F.col("_nulls") + F.col("_without")).alias("null_perf_fields"),
            (F.col("_orphans") + F.col("_without")).alias("orphan_perf_rows"), "loans_without_perf"]
    if rejects is not None:
        parts.append(rejects.agg(*[F.count_distinct(F.when(F.col("table_name") == t, F.col("row_id"))).alias(f"rejected_{t}_rows")
                                   for t in ("loans", "performance")]))
        told += ["rejected_loans_rows", "rejected_performance_rows"]
    return side_by_side(*parts).select(*told)


# ------------------------------------------------------------ A10, A11
def book_profile(loans: DataFrame, perf: DataFrame) -> DataFrame:
    """One aggregate by customer gives the book's and the customers' figures."""
    by_customer = loans.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount_cents").alias("amt"),
        F.min("disbursal_date").alias("lo"), F.max("disbursal_date").alias("hi"))
    prof = side_by_side(
        by_customer.agg(F.sum("n").alias("n_loans"), F.sum("amt").alias("_amt"),
                        F.count("customer_id").alias("n_customers"), F.min("lo").alias("_lo"),
                        F.max("hi").alias("_hi"), F.max("n").alias("max_loans_per_customer")),
        perf.agg(F.count(F.lit(1)).alias("n_perf_rows")))
    return prof.select(
        "n_loans", "n_perf_rows",
        F.round(to_crore(micro_crore("_amt")), 6).alias("disbursal_cr"),
        "n_customers", iso("_lo").alias("first_disbursal"), iso("_hi").alias("last_disbursal"),
        F.round(safe_ratio("n_perf_rows", "n_loans"), 8).alias("avg_observed_mobs"),
        "max_loans_per_customer")


# ------------------------------------------------------------------ A12
def exact_median_of_small_domain(df: DataFrame, col: str) -> DataFrame:
    """Exact min / median / max of a column whose values come from a small
    domain (here a MOB grid): a histogram of at most |domain| rows is built
    with a partial aggregate, and the median is read off its cumulative
    counts (mean of the two middle values for an even count).  No task ever
    holds the column's values, however many rows there are."""
    h = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(col)   # over the histogram: bounded by the domain size
    h = (h.withColumn("cum", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("tot", F.sum("n").over(Window.partitionBy())))
    lo = F.floor((F.col("tot") + 1) / 2)
    hi = F.floor(F.col("tot") / 2) + 1
    first_at = lambda k: F.min(F.when(F.col("cum") >= k, F.col(col)))
    return h.agg(F.min(col).alias("min_v"), F.max(col).alias("max_v"),
                 ((first_at(lo) + first_at(hi)) / 2).cast("double").alias("median_v"))


# ------------------------------------------------------------------ R1-R4
def reconcile_feed(loans: DataFrame, perf_by_loan: DataFrame, feed_long: DataFrame, disb: DataFrame,
                   cfg: EclConfig) -> DataFrame:
    """R1-R4 (+R9): the feed against a loan-first recompute - a loan's
    performance is summed by MOB, then meets its loan, then both are summed by
    cohort and segment (the feed joins rows and sums once).  Compared per
    (cohort, segment, mob), loan count and disbursal on a MOB -1 row; segment
    is kept, so a loan filed under the wrong segment fails."""
    none = F.lit(None).cast("long")
    by_mob = (perf_by_loan.filter(F.col("mob").isin(list(cfg.extract_grid.mobs)))
              .groupBy("loan_no", "mob")
              .agg(F.sum("dpd90_cents").alias("e_d"), F.sum("tpos_cents").alias("e_t")))
    lw = loans_in_window(loans, cfg).select("loan_no", "cohort_end", "segment", "amount_cents")
    keys = ["cohort_end", "segment", "k"]
    amounts = (with_loan(by_mob, lw.drop("amount_cents"))
               .groupBy("cohort_end", "segment", F.col("mob").alias("k"))
               .agg(F.sum("e_d").alias("e_d"), F.sum("e_t").alias("e_t"))
               .select(*keys, none.alias("e_cnt"), none.alias("e_amt"), "e_d", "e_t"))
    counts = (lw.groupBy("cohort_end", "segment")
              .agg(F.count(F.lit(1)).alias("e_cnt"), F.sum("amount_cents").alias("e_amt"))
              .select("cohort_end", "segment", F.lit(-1).alias("k"), "e_cnt", "e_amt",
                      none.alias("e_d"), none.alias("e_t")))
    got = (feed_long.select("cohort_end", "segment", F.col("mob").alias("k"),
                            none.alias("lan_cnt"), none.alias("disb_uc"), "dpd90_uc", "tpos_uc")
           .unionByName(disb.select("cohort_end", "segment", F.lit(-1).alias("k"), "lan_cnt",
                                    "disb_uc", none.alias("dpd90_uc"), none.alias("tpos_uc"))))
    z, uc, cr = F.lit(0), MICRO_CRORE_MINOR_UNITS, F.lit(float(MINOR_UNITS_PER_CRORE))

    def gap(a, b):
        return F.max(F.abs(F.coalesce(a, z) - F.coalesce(b, z)))

    d = (got.join(counts.unionByName(amounts), keys, "full_outer")
         .agg(gap(F.col("lan_cnt"), F.col("e_cnt")).cast("double").alias("cnt"),
              (gap(F.col("disb_uc") * uc, F.col("e_amt")).cast("double") / cr).alias("amt"),
              (gap(F.col("dpd90_uc") * uc, F.col("e_d")).cast("double") / cr).alias("overdue"),
              (gap(F.col("tpos_uc") * uc, F.col("e_t")).cast("double") / cr).alias("outstanding")))
    return measures(d, {"feed.loan_count": "cnt", "feed.disbursal": "amt",
                        "feed.overdue": "overdue", "feed.outstanding": "outstanding"})


# ------------------------------------------------------------------ R5
def _wide_triangle(tri: DataFrame, cfg: EclConfig) -> DataFrame:
    mobs = [m for m in cfg.triangle_grid.mobs if m % YEAR_MOB == 0]
    return (tri.filter(F.col("mob") % YEAR_MOB == 0)
            .groupBy("segment", "cohort_end", "disb_uc")
            .pivot("mob", mobs)
            .agg(F.first("dpd90_amt").alias("d"), F.first("tpos_amt").alias("t")))


def reconcile_loss_rate(tri: DataFrame, loss_df: DataFrame, cfg: EclConfig) -> DataFrame:
    """Loss rate per anchor re-derived from the wide amount triangles
    (disbursal + the yearly TPOS columns summed left to right), all anchors
    in one pass, compared per (segment, cohort, anchor)."""
    w = _wide_triangle(tri, cfg)
    disb = to_crore("disb_uc")
    per_anchor = []
    for a in cfg.anchors:
        den = disb
        for m in range(YEAR_MOB, a, YEAR_MOB):
            den = den + F.col(f"{m}_t")
        per_anchor.append(F.struct(F.lit(a).alias("anchor_mob"),
                                   safe_ratio(F.col(f"{a}_d"), den).alias("lr_re")))
    re = (w.select("segment", "cohort_end", F.explode(F.array(*per_anchor)).alias("x"))
          .select("segment", "cohort_end", "x.*"))
    got = loss_df.select("segment", "cohort_end", "anchor_mob", "loss_rate")
    ad = F.abs(F.coalesce("lr_re", F.lit(0.0)) - F.coalesce("loss_rate", F.lit(0.0)))
    d = (re.join(got, ["segment", "cohort_end", "anchor_mob"], "full_outer")
         .agg(*[F.round(F.max(F.when(F.col("anchor_mob") == a, ad)), DIFF_DP).alias(f"d{a}")
                for a in cfg.anchors]))
    return measures(d, {f"loss_rate.{a}m": f"d{a}" for a in cfg.anchors})


# ------------------------------------------------------------------ R6
def reconcile_weighted(loss_df: DataFrame, wavg: DataFrame, cfg: EclConfig) -> DataFrame:
    """Every window's weighted average re-derived as sum(lr*w)/sum(w)
    over the cohorts inside its bounds, all windows in one pass."""
    wdf = ecl.windows_df(loss_df.sparkSession, cfg.windows)  # one row per configured window
    sel = loss_df.join(F.broadcast(wdf), (loss_df.anchor_mob == wdf.anchor_mob)
                       & loss_df.cohort_end.between(wdf.first_day, wdf.last_day))
    re = sel.groupBy("segment", "window").agg(
        safe_ratio(F.sum(F.col("loss_rate") * F.col("disb_cr")), F.sum("disb_cr")).alias("re"))
    got = wavg.select("segment", "window", "weighted_avg_lr")
    d = (re.join(got, ["segment", "window"], "full_outer")
         .agg(F.round(F.max(F.abs(F.coalesce("re", F.lit(0.0))
                                  - F.coalesce("weighted_avg_lr", F.lit(0.0)))), DIFF_DP).alias("d")))
    return measures(d, {"window.weighted_rate": "d"})


# ------------------------------------------------------------------ C11
def reconcile_chain_ladder(tri: DataFrame, cfg: EclConfig) -> DataFrame:
    """C11: every projected cell re-derived from the completed triangle by the
    recurrence (its previous-MOB value times the ratio of the sums over the
    cohorts above), per (segment, metric).  A triangle without projected
    cells has 0 of them and no difference."""
    above = (Window.partitionBy("segment", "mob").orderBy("cohort_end")
             .rowsBetween(Window.unboundedPreceding, -1))
    row = Window.partitionBy("segment", "cohort_end").orderBy("mob")
    disb = to_crore("disb_uc")
    first = cfg.triangle_grid.start
    out = []
    for m, wv in (("dpd90", F.col("dpd90_amt")), ("tpos", F.col("tpos_amt") * disb)):
        t = (tri.withColumn("_wv", wv)
             .withColumn("_s", F.coalesce(F.sum("_wv").over(above), F.lit(0.0)))
             .withColumn("_has_above", F.count(F.lit(1)).over(above) > 0)
             .withColumn("_s_prev", F.lag("_s").over(row))
             .withColumn("_v_prev", F.lag(f"{m}_amt").over(row)))
        expected = (F.when((F.col("mob") == first) | ~F.col("_has_above"), F.lit(0.0))
                    .when(F.col("_s_prev") == 0, F.lit(0.0))
                    .otherwise(F.col("_v_prev") * F.col("_s") / F.col("_s_prev")))
        projected = ~F.col("is_observed")
        off = F.abs(F.col(f"{m}_amt") - expected) / F.greatest(F.lit(1.0), F.abs(expected))
        out.append(t.groupBy("segment").agg(
            F.count_if(projected).alias("n_projected"),
            F.round(F.coalesce(F.max(F.when(projected, off)), F.lit(0.0)), DIFF_DP).alias("max_rel_diff"))
            .withColumn("metric", F.lit(m)))
    r = reduce(DataFrame.unionByName, out)
    return r.select("segment", "metric", "n_projected", "max_rel_diff",
                    F.when(F.col("max_rel_diff") <= RECURRENCE_TOL, F.lit("PASS")).otherwise(F.lit("FAIL"))
                    .alias("result"))


# ------------------------------------------------------------------ R7, R8
def _guarded(taken: DataFrame, feed: DataFrame) -> DataFrame:
    """No measure holds where the feed is empty: there was nothing to compare."""
    rows = feed.agg(F.count(F.lit(1)).alias("_n"))
    return (taken.select("*", F.lit(None).cast("long").alias("_n"))
            .unionByName(rows.select(F.lit(None).cast("string").alias("check_id"),
                                     F.lit(None).cast("double").alias("measure"), "_n"))
            .withColumn("_n", F.max("_n").over(Window.partitionBy()))  # one row per check
            .filter(F.col("check_id").isNotNull())
            .select("check_id", F.when(F.col("_n") > 0, F.col("measure")).alias("measure")))


def run_measures(book) -> DataFrame:
    """All numeric measures of a run and the plausibility of its rates."""
    cfg = book.cfg
    above_one = measures(
        book.wavg.filter(F.col("segment") == "all")
        .agg(F.round(F.max(F.greatest(F.lit(0.0), F.col("weighted_avg_lr") - 1)), DIFF_DP).alias("d")),
        {"window.rate_above_one": "d"})
    ladder = measures(reconcile_chain_ladder(book.triangles, cfg).agg(F.max("max_rel_diff").alias("d")),
                      {"triangle.recurrence": "d"})
    taken = reduce(DataFrame.unionByName, [
        reconcile_feed(book.loans, book.perf_by_loan, book.feed, book.disb, cfg),
        reconcile_loss_rate(book.triangles, book.loss, cfg),
        reconcile_weighted(book.loss, book.wavg, cfg), ladder, above_one])
    return _guarded(taken, book.feed)


def validation_checks(book) -> DataFrame:
    """R7 + R8: the verdicts on :func:`run_measures`, and the overall one."""
    return with_overall(judge(run_measures(book), book.cfg))


# ------------------------------------------------------------------ R10
def whole_run_measure(book) -> DataFrame:
    """The whole-book headline rate of the segment matrix against a run
    over the feed collapsed to cohorts (no segments at all)."""
    one = book.whole_only()
    return measures(side_by_side(
        book.headline("all").select(F.col("weighted_avg_lr").alias("a")),
        one.headline("all").select(F.col("weighted_avg_lr").alias("b"))).select(
        F.round(F.abs(F.col("a") - F.col("b")), DIFF_DP).alias("d")), {"book.whole_run": "d"})


# ------------------------------------------------------------------ R11
def published_rate_measure(summary: DataFrame, loss: DataFrame, cfg: EclConfig) -> DataFrame:
    """The rate in the published summary against the headline window's
    rate re-derived from the published loss table (as read back: cohort_end
    is ISO text)."""
    h = cfg.headline_window
    inside = loss.filter((F.col("segment") == "all") & (F.col("anchor_mob") == h.anchor_mob)
                         & F.col("cohort_end").between(h.first_day.isoformat(), h.last_day.isoformat()))
    rate = inside.agg(safe_ratio(F.sum(F.col("loss_rate") * F.col("disb_cr")), F.sum("disb_cr")).alias("b"))
    told = summary.filter(F.col("key") == "ecl_pct").select(F.col("value_num").alias("a"))
    return measures(side_by_side(told, rate).select(
        F.round(F.abs(F.col("a") - F.round("b", 8)), DIFF_DP).alias("d")), {"sink.summary_rate": "d"})
