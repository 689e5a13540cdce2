"""
-> DataFrame`` over the driver tables (orders mapped to a loan book).

Output conventions (shared with the DuckDB oracle in ``oracle.py``):
crore amounts rounded to 6 dp, rates and factors to 8 dp, dates as ISO
text, integers as BIGINT, ``segment`` as text ('all' = whole book).
"""
from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runoff.config import DEFAULT, YEAR_MOB, YOUNG_BOOK, EclConfig, MobList
from runoff.functions.calendar import (cohort_end, fiscal_quarter_label,
                                       fiscal_quarter_no, fiscal_year, iso)
from runoff.functions.joins import side_by_side, with_loan
from runoff.functions.numeric import safe_ratio, to_crore
from runoff.operators import checks, ecl, feed, loss, report, requests, spot, triangle
from runoff.plans import driver_book, pipeline
from runoff.plans.book import Book
from runoff.plans.store import Store
from runoff.session import scratch_path
from runoff.sources import layout

A6 = 6   # crore amounts
R8 = 8   # rates / factors

# as-of date at which every triangle cell of the driver's orders is observed
MATURE_BOOK = DEFAULT.with_(as_of=date(2012, 3, 31))
QUARTER_BEFORE = date(2005, 12, 31)
# months at unequal steps, with every year's end that the denominators need
UNEQUAL = MobList((1, 2, 3, 4, 6, 9, 12, 18, 24, 31, 36, 48, 53, 59, 60, 72, 84, 96, 108, 120))
UNEQUAL_BOOK = YOUNG_BOOK.with_(extract_grid=MobList((0, *UNEQUAL.mobs)), triangle_grid=UNEQUAL)
_BOOKS: dict = {}


def book(spark: SparkSession, sf_dir: str, cfg: EclConfig = DEFAULT) -> Book:
    """One Book per (session, data, config): the materialised feed is shared
    by the queries of one session.  Only the data last asked for is held: the
    books of other folders give back what they persisted."""
    data = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    for key in [k for k in _BOOKS if k[:2] != data]:
        old = _BOOKS.pop(key)
        if key[0] == data[0]:
            old.release()
    key = (*data, cfg)
    if key not in _BOOKS:
        _BOOKS[key] = Book.from_driver_tables(spark, sf_dir, cfg)
    return _BOOKS[key]


def _own(b: Book, like: Book) -> Book:
    """``b``, released with the shared book ``like``."""
    b._kept = like._kept
    return b


def _scratch(spark, name: str) -> str:
    """A new folder under the session's checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _a(c, name=None):
    if isinstance(c, str):
        name = name or c
        c = F.col(c)
    return F.round(c, A6).alias(name) if name else F.round(c, A6)


def _r(c, name=None):
    if isinstance(c, str):
        name = name or c
        c = F.col(c)
    return F.round(c, R8).alias(name) if name else F.round(c, R8)


def _big(c, name=None):
    return (F.col(c) if isinstance(c, str) else c).cast("long").alias(name or c)


def _labels():
    return [fiscal_quarter_label("cohort_end").alias("fy_quarter"),
            iso("cohort_end").alias("cohort_end")]


def _whole(df: DataFrame) -> DataFrame:
    return df.filter(F.col("segment") == "all")


# ----------------------------------------------------------------- sources
def q_scan_loans(spark, sf_dir):
    l = book(spark, sf_dir).loans
    return l.select("loan_no", "customer_id", _big("segment"), iso("disbursal_date").alias(
        "disbursal_date"), "amount_cents", _big("tenure_months"))


def q_scan_performance(spark, sf_dir):
    p = book(spark, sf_dir).perf
    return p.select("loan_no", _big("mob"), "tpos_cents", "dpd90_cents")


def q_amortisation_schedule(spark, sf_dir):
    b = book(spark, sf_dir)
    j = with_loan(b.perf, b.loans.select("loan_no", "tenure_months", "amount_cents"))
    return (j.groupBy("tenure_months", "mob")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("tpos_cents").alias("tpos_cents"),
                 F.sum("amount_cents").alias("amount_cents"))
            .select(_big("tenure_months"), _big("mob"), "n_rows", "tpos_cents", "amount_cents",
                    _r(safe_ratio("tpos_cents", "amount_cents"), "tpos_share")))


def q_default_exposure(spark, sf_dir):
    d = driver_book.default_exposure(book(spark, sf_dir).loans)
    return d.select("loan_no", _big("segment"), _big("tenure_months"), _big("default_mob"),
                    _big("oad_cents"))


def _by_segment_mob(perf, loans, col, flag_name):
    j = with_loan(perf, loans.select("loan_no", "segment"))
    return (j.groupBy("segment", "mob")
            .agg(F.count_if(F.col(col) > 0).alias(flag_name), F.sum(col).alias(col))
            .select(_big("segment"), _big("mob"), flag_name, col))


def q_default_carry_forward(spark, sf_dir):
    b = book(spark, sf_dir)
    return _by_segment_mob(b.perf, b.loans, "dpd90_cents", "n_in_default")


def q_tpos_frozen(spark, sf_dir):
    cfg = DEFAULT.with_(freeze_tpos_at_default=True)
    loans = driver_book.driver_loans(spark, sf_dir, cfg)
    perf = driver_book.performance_from_loans(loans, cfg)
    return _by_segment_mob(perf, loans, "tpos_cents", "n_outstanding")


def q_dq_key_violations(spark, sf_dir):
    b = book(spark, sf_dir)
    return checks.key_violations(b.loans, b.perf)


# ---------------------------------------------------------- calendar
def q_fiscal_quarter(spark, sf_dir):
    d = book(spark, sf_dir).loans.select("disbursal_date").distinct()
    return d.select(iso("disbursal_date").alias("disbursal_date"),
                    fiscal_quarter_label("disbursal_date").alias("fy_quarter"),
                    _big(fiscal_year("disbursal_date"), "fiscal_year"),
                    _big(fiscal_quarter_no("disbursal_date"), "fiscal_quarter"),
                    iso(cohort_end("disbursal_date")).alias("cohort_end"))


def q_cohort_calendar(spark, sf_dir):
    b = book(spark, sf_dir)
    c = triangle.cohort_calendar(b.disb_g, b.cfg)
    return c.select("segment", *_labels(), _big("months_on_book"), _big("max_mature_mob"),
                    _big("max_mature_mob", "current_mob"))


def q_cohort_calendar_unequal(spark, sf_dir):
    """P5 / P14 on a list of months at unequal steps."""
    b = book(spark, sf_dir, UNEQUAL_BOOK)
    c = triangle.cohort_calendar(b.disb_g, b.cfg)
    return c.select("segment", *_labels(), _big("months_on_book"), _big("max_mature_mob"))


def q_chain_ladder_unequal(spark, sf_dir):
    """C1-C7 on it: development from each month to the next, all segments."""
    t = triangle.with_rates(book(spark, sf_dir, UNEQUAL_BOOK).triangles)
    return t.select("segment", *_labels(), _big("mob"), "is_observed", _a("dpd90_amt"), _a("tpos_amt"), _r("dpd90_rate"))


def q_segment_ecl_unequal(spark, sf_dir):
    """L5-E6 on it."""
    return book(spark, sf_dir, UNEQUAL_BOOK).wavg.select(*_wavg_cols(with_segment=True))


def q_maturity_mask(spark, sf_dir):
    c = _whole(book(spark, sf_dir).cells)
    return c.select(*_labels(), _big("mob"), _big("max_mature_mob"), "is_observed")


def q_disbursal_window(spark, sf_dir):
    b = book(spark, sf_dir)
    w = b.cfg.headline_window
    l = feed.loans_in_window(b.loans, b.cfg, w.first_day, w.last_day)
    return (l.groupBy("cohort_end")
            .agg(F.count(F.lit(1)).alias("n_loans"), F.sum("amount_cents").alias("amount_cents"),
                 F.min("disbursal_date").alias("_lo"), F.max("disbursal_date").alias("_hi"))
            .select(*_labels(), "n_loans", "amount_cents", iso("_lo").alias("first_disbursal"),
                    iso("_hi").alias("last_disbursal")))


def q_segment_feed(spark, sf_dir):
    f = feed.segment_feed(book(spark, sf_dir).feed, 3)
    return f.select(*_labels(), _big("mob"), _a(to_crore("dpd90_uc"), "dpd90_cr"),
                    _a(to_crore("tpos_uc"), "tpos_cr"))


def q_mob_grid(spark, sf_dir):
    b = book(spark, sf_dir)
    cfg = b.cfg
    tri = list(cfg.triangle_grid.mobs)
    n_anchor = sum((F.col("mob") < a).cast("int") for a in cfg.anchors)
    return (b.perf.groupBy("mob").agg(F.count(F.lit(1)).alias("n_rows"))
            .select(_big("mob"), "n_rows", F.col("mob").isin(tri).alias("in_triangle"),
                    (F.col("mob") % YEAR_MOB == 0).alias("is_yearly"),
                    _big(F.when((F.col("mob") % YEAR_MOB == 0) & (F.col("mob") > 0), n_anchor)
                         .otherwise(0), "n_anchor_denominators")))


# ---------------------------------------------------------------- feed (A1-A4)
def _feed_long(b: Book) -> DataFrame:
    return b.feed.select(*_labels(), _big("segment"), _big("mob"),
                         _a(to_crore("dpd90_uc"), "dpd90_cr"), _a(to_crore("tpos_uc"), "tpos_cr"))


def q_feed_long(spark, sf_dir):
    return _feed_long(book(spark, sf_dir))


def q_feed_disbursal(spark, sf_dir):
    d = book(spark, sf_dir).disb
    return d.select(*_labels(), _big("segment"), "lan_cnt", _a(to_crore("disb_uc"), "disbursal_cr"))


def q_loan_mob_wide(spark, sf_dir):
    b = book(spark, sf_dir)
    w = feed.loan_mob_wide(b.perf_by_loan, b.cfg)
    # NULL = no row at that MOB; cents are exact in double (< 2**53)
    return w.select("loan_no", *[F.col(c).cast("double").alias(c) for c in w.columns[1:]])


def q_feed_wide(spark, sf_dir):
    b = book(spark, sf_dir)
    return feed.feed_wide(b.feed, b.disb, b.cfg)


def q_feed_by_quarter(spark, sf_dir):
    b = book(spark, sf_dir)
    return feed.collapse_to_cohort(b.feed_g, b.disb_g, b.cfg)


def q_unpivot_feed(spark, sf_dir):
    b = book(spark, sf_dir)
    return feed.unpivot_feed(feed.feed_wide(b.feed, b.disb, b.cfg), b.cfg)


# --------------------------------------------------------- profile
def q_book_profile(spark, sf_dir):
    b = book(spark, sf_dir)
    return checks.book_profile(b.loans, b.perf)


def q_observed_mob_spread(spark, sf_dir):
    p = book(spark, sf_dir).perf
    m = p.groupBy("loan_no").agg(F.max("mob").alias("max_mob"))
    return checks.exact_median_of_small_domain(m, "max_mob").select(
        _big("min_v", "min_max_mob"), F.col("median_v").alias("median_max_mob"),
        _big("max_v", "max_max_mob"))


def q_default_rate_by_segment(spark, sf_dir):
    b = book(spark, sf_dir)
    per_loan = b.perf.groupBy("loan_no").agg((F.max("dpd90_cents") > 0).alias("defaulted"))
    j = per_loan.join(b.loans.select("loan_no", "segment"), "loan_no")
    return (j.groupBy("segment")
            .agg(F.count(F.lit(1)).alias("n_loans"), F.count_if("defaulted").alias("n_defaulted"))
            .select(_big("segment"), "n_loans", "n_defaulted",
                    _r(safe_ratio("n_defaulted", "n_loans"), "default_rate")))


# --------------------------------------------------------- triangles
def q_triangle_observed(spark, sf_dir):
    c = _whole(book(spark, sf_dir).cells)
    obs = F.col("is_observed")
    return c.select(*_labels(), _big("mob"), "is_observed",
                    _a(F.when(obs, to_crore("dpd90_uc")), "dpd90_cr"),
                    _a(F.when(obs, to_crore("tpos_uc")), "tpos_cr"))


def q_dev_factor_90plus(spark, sf_dir):
    f = _whole(book(spark, sf_dir).factors)
    return f.select(_big("mob"), "n_mature", _a(to_crore("num_dpd90"), "num_cr"),
                    _a(to_crore("den_dpd90"), "den_cr"), _r("f_dpd90", "factor"),
                    F.col("degenerate_dpd90").alias("degenerate"))


def q_dev_factor_tpos(spark, sf_dir):
    f = _whole(book(spark, sf_dir).factors)
    return f.select(_big("mob"), "n_mature", F.col("num_tpos").cast("double").alias("num_amt_x_disb"),
                    F.col("den_tpos").cast("double").alias("den_amt_x_disb"),
                    _r("f_tpos", "factor"), F.col("degenerate_tpos").alias("degenerate"))


def _metric_tri(tri, m):
    t = triangle.with_rates(_whole(tri))
    return t.select(*_labels(), _big("mob"), "is_observed", _a(f"{m}_amt", "amount_cr"),
                    _r(f"{m}_rate", "rate"))


def q_chain_ladder_90plus(spark, sf_dir):
    return _metric_tri(book(spark, sf_dir).triangles, "dpd90")


def q_chain_ladder_tpos(spark, sf_dir):
    return _metric_tri(book(spark, sf_dir).triangles, "tpos")


def q_chain_ladder_young_book(spark, sf_dir):
    t = _whole(book(spark, sf_dir, YOUNG_BOOK).triangles)
    return t.select(*_labels(), _big("mob"), "is_observed", _a("dpd90_amt"), _a("tpos_amt"))


def q_triangle_rate(spark, sf_dir):
    t = triangle.with_rates(_whole(book(spark, sf_dir).triangles))
    return t.select(*_labels(), _big("mob"), "is_observed", _r("dpd90_rate"), _r("tpos_rate"))


def q_triangle_amount(spark, sf_dir):
    t = _whole(book(spark, sf_dir).triangles)
    return t.select(*_labels(), _big("mob"), "is_observed", _a("dpd90_amt"), _a("tpos_amt"))


def q_chain_ladder_by_segment(spark, sf_dir):
    t = book(spark, sf_dir).triangles
    return t.select("segment", *_labels(), _big("mob"), "is_observed", _a("dpd90_amt"),
                    _a("tpos_amt"))


def _by_metric(tri):
    return tri.select("segment", "cohort_end", "mob", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(f"{m}_amt").alias("amount"))
        for m in triangle.METRICS])).alias("x")).select("segment", "cohort_end", "mob", "x.*")


def q_chain_ladder_sequential(spark, sf_dir):
    """C6 on every triangle: the column sweep, both metrics."""
    s = _by_metric(book(spark, sf_dir).triangles)
    return s.select("segment", "metric", *_labels(), _big("mob"), _a("amount", "amount_cr"))


#: Loans of the young book are split into so many groups per segment, small
#: enough that columns occur whose mature cohorts have no 90+ amount before
#: they have one, above immature cohorts that do.
DEGENERATE_GROUPS = 4


def q_chain_ladder_degenerate(spark, sf_dir):
    """C6 where the factor switches on within a column: small loan groups."""
    b = book(spark, sf_dir, YOUNG_BOOK)
    group = (F.col("segment") * 100 + F.col("loan_no") % DEGENERATE_GROUPS).cast("int")
    fine = _own(Book(spark, b.loans.withColumn("segment", group), b.perf, b.cfg, loan_buckets=True), b)
    t = _by_metric(fine.triangles.filter("segment <> 'all' and not is_observed")).filter("metric = 'dpd90'")
    return t.select("segment", *_labels(), _big("mob"), _a("amount", "amount_cr"))


def q_triangle_cell_counts(spark, sf_dir):
    t = book(spark, sf_dir).cells
    return (t.groupBy("segment")
            .agg(F.countDistinct("cohort_end").alias("n_cohorts"), F.count(F.lit(1)).alias("n_cells"),
                 F.count_if("is_observed").alias("n_observed"),
                 F.count_if(~F.col("is_observed")).alias("n_projected")))


def q_triangle_sanity(spark, sf_dir):
    return loss.monotonicity(book(spark, sf_dir).triangles)


def q_reconcile_chain_ladder(spark, sf_dir):
    b = book(spark, sf_dir)
    return checks.reconcile_chain_ladder(b.triangles, b.cfg)


# ------------------------------------------------------ movements / loss
def _movement(spark, sf_dir, col, out):
    m = _whole(book(spark, sf_dir).movements)
    f = _a if col.endswith("_amt") else _r
    return m.select(*_labels(), _big("mob"), "is_observed", f(col, out))


def q_movement_tpos_amt(spark, sf_dir):
    return _movement(spark, sf_dir, "tpos_amt", "tpos_amt")


def q_movement_tpos_pct(spark, sf_dir):
    return _movement(spark, sf_dir, "tpos_pct", "tpos_pct")


def q_movement_90plus_amt(spark, sf_dir):
    return _movement(spark, sf_dir, "dpd90_amt", "dpd90_amt")


def q_movement_90plus_pct(spark, sf_dir):
    return _movement(spark, sf_dir, "dpd90_pct", "dpd90_pct")


def q_loss_rate_denominator(spark, sf_dir):
    l = _whole(book(spark, sf_dir).loss)
    return l.select(*_labels(), _big("anchor_mob"), _a("disb_cr"), _a("tpos_sum"),
                    _a("denominator"))


def q_loss_rate(spark, sf_dir):
    l = _whole(book(spark, sf_dir).loss)
    return l.select(*_labels(), _big("anchor_mob"), _a("ninety_plus"), _a("denominator"),
                    _r("loss_rate"), "anchor_observed")


def q_loss_rate_flags(spark, sf_dir):
    l = loss.loss_rate_flags(book(spark, sf_dir).loss)
    return l.select("segment", *_labels(), _big("anchor_mob"), _r("loss_rate"), "flag")


def q_loss_rate_stats(spark, sf_dir):
    s = loss.loss_rate_stats(book(spark, sf_dir).loss)
    return s.select("segment", _big("anchor_mob"), "n_cohorts", _r("min_lr"),
                    _r("median_lr"), _r("max_lr"), "n_above_100pct")


def q_current_tpos(spark, sf_dir):
    c = _whole(book(spark, sf_dir).current)
    return c.select(*_labels(), _big("current_mob"), _a("current_tpos"))


def q_portfolio_tpos(spark, sf_dir):
    p = loss.portfolio_tpos(book(spark, sf_dir).current)
    return p.select("segment", "n_cohorts", _a("portfolio_tpos"))


# ----------------------------------------------------------------- ECL
def _wavg_cols(with_segment=False):
    cols = [F.col("window").alias("window_name"), "fy_start", "fy_end", _big("anchor_mob"),
            "n_quarters", "n_observed_at_anchor", _a("total_disb"), _r("simple_avg_lr"),
            _r("weighted_avg_lr"), _r("ecl_pct")]
    return (["segment"] + cols) if with_segment else cols


def q_weighted_loss_rate(spark, sf_dir):
    return _whole(book(spark, sf_dir).wavg).select(*_wavg_cols())


def all_windows(b: Book) -> DataFrame:
    """Every window from a cohort's quarter to the same or a later one's, at every anchor."""
    ends = b.disb_g.filter("segment = 'all'").select("cohort_end").distinct()
    first = ends.select(F.add_months(F.trunc("cohort_end", "month"), -2).alias("first_day"))
    spans = first.select("first_day", F.explode(F.sequence(
        "first_day", F.lit(b.cfg.as_of), F.expr("interval 3 months"))).alias("_q")).select(
            "first_day", cohort_end("_q").alias("last_day"))
    return spans.select(F.concat_ws("..", iso("first_day"), iso("last_day")).alias("window"), "first_day", "last_day",
                        F.explode(F.array(*[F.lit(a) for a in b.cfg.anchors])).alias("anchor_mob"))


def q_weighted_over_windows(spark, sf_dir):
    """J4 / E2 for windows from a table: some thousands of them."""
    b = book(spark, sf_dir)
    w = ecl.weighted_over_windows(b.loss, all_windows(b))
    return w.select("segment", F.col("window").alias("window_name"), _big("anchor_mob"), _big("n_quarters"),
                    _big("n_observed_at_anchor"), _a("total_disb"), F.round("simple_avg_lr", 7).alias("simple_avg_lr"),
                    F.round("weighted_avg_lr", 7).alias("weighted_avg_lr"))


def q_headline_ecl(spark, sf_dir):
    return book(spark, sf_dir).headline().select(*_wavg_cols())


SEGMENT_ECL_ARGS = ("3", "FY97", "FY00", 84)


def q_segment_ecl(spark, sf_dir):
    s, _ = book(spark, sf_dir).segment_ecl(*SEGMENT_ECL_ARGS)
    return s.select(*_wavg_cols(with_segment=True))


def q_segment_ecl_detail(spark, sf_dir):
    _, d = book(spark, sf_dir).segment_ecl(*SEGMENT_ECL_ARGS)
    return d.select(*_labels(), _a("disb_cr"), _a("ninety_plus"), _a("denominator"),
                    _r("loss_rate"), "anchor_observed")


def asked_requests(b: Book) -> DataFrame:
    """Requests of every segment's cohorts, from a cohort's year to the last
    one's, in spellings that are right and wrong."""
    label = fiscal_quarter_label("cohort_end")
    year = fiscal_year("cohort_end")
    ask = lambda *texts: F.struct(*[t.cast("string").alias(c) for c, t in zip(requests.ASKED, texts)])
    seg, last, lit = F.col("segment"), F.lit("2001"), F.lit
    kinds = [ask(seg, label, last, lit("84")),
             ask(F.concat(lit(" "), F.upper("segment")), F.concat(lit("fy"), F.date_format("cohort_end", "yy")), label, lit(" 72 ")),
             ask(F.when(seg != "all", F.concat(seg, lit("x"))), year, year, lit("120")),
             ask(seg, last, label, F.month("cohort_end") * 12), ask(lit("9"), F.concat(label, lit("5")), lit("FY"), lit("84.0")),
             ask(seg, year + 40, year + 41, lit("84"))]
    each = F.posexplode(F.array(*kinds)).alias("kind", "asked")
    return b.disb_g.select(label.alias("cohort"), F.col("segment").alias("of"), each).select("cohort", "of", "kind", "asked.*")


def q_segment_requests(spark, sf_dir):
    """Requests from a table, answered or refused."""
    b = book(spark, sf_dir)
    told = requests.answer(asked_requests(b), b.loss, b.cfg)
    return told.select("cohort", "of", _big("kind"), "key", _big("n_quarters"),
                       F.round("weighted_avg_lr", 7).alias("weighted_avg_lr"), "problem")


def q_segment_ecl_matrix(spark, sf_dir):
    return book(spark, sf_dir).wavg.select(*_wavg_cols(with_segment=True))


def q_cohort_edges(spark, sf_dir):
    c = _whole(book(spark, sf_dir).disb_g)
    c = triangle.cohort_calendar(c, book(spark, sf_dir).cfg)
    up = F.row_number().over(Window.partitionBy("segment").orderBy("cohort_end"))
    down = F.row_number().over(Window.partitionBy("segment").orderBy(F.desc("cohort_end")))
    e = c.withColumn("_u", up).withColumn("_d", down).filter((F.col("_u") <= 3) | (F.col("_d") <= 3))
    return e.select(*_labels(), _big("max_mature_mob"),
                    F.when(F.col("_u") <= 3, F.lit("first")).otherwise(F.lit("last")).alias("edge"),
                    _big(F.when(F.col("_u") <= 3, F.col("_u")).otherwise(F.col("_d")), "edge_rank"))


# ----------------------------------------------------------- checks
def q_reconcile_feed(spark, sf_dir):
    b = book(spark, sf_dir)
    return checks.judge(checks.reconcile_feed(b.loans, b.perf_by_loan, b.feed, b.disb, b.cfg), b.cfg)


def q_spot_check(spark, sf_dir):
    """The feed at one MOB against the sources, cohort by cohort."""
    b = book(spark, sf_dir)
    found = spot.spot_check(b.loans, b.perf, b.feed, b.disb, b.cfg, YEAR_MOB)
    return found.select(*_labels(), _big("segment"), "feed_loans", "source_loans", "feed_disbursal", "source_disbursal",
                        "feed_dpd90", "source_dpd90", "feed_tpos", "source_tpos", "off_cents", "verdict")


#: Which loans differ in a second copy of performance: one in so many has another
#: 90+ amount, no row, or its row twice, at month 12; and one in so many at month 24.
RESTATED = {"amount": 211, "gone": 223, "twice": 227, "later": 5}


def restated(b: Book) -> DataFrame:
    n, at = F.col("loan_no"), F.col("mob") == YEAR_MOB
    changed = ((n % RESTATED["amount"] == 0) & at) | ((n % RESTATED["later"] == 0) & (F.col("mob") == 2 * YEAR_MOB))
    copies = F.when((n % RESTATED["gone"] == 0) & at, 0).when((n % RESTATED["twice"] == 0) & at, 2).otherwise(1)
    return (b.perf.withColumn("dpd90_cents", F.col("dpd90_cents") + changed.cast("long") * 100_000_000)
            .withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies))).drop("_copy"))


def q_spot_check_restated(spark, sf_dir):
    """The cohorts whose feed a second copy of performance does not give."""
    b = book(spark, sf_dir)
    found = spot.spot_check(b.loans, restated(b), b.feed, b.disb, b.cfg, YEAR_MOB).filter("verdict = 'FAIL'")
    return found.select(*_labels(), _big("segment"), "feed_dpd90", "source_dpd90", "feed_tpos", "source_tpos", "off_cents")


def q_spot_loans(spark, sf_dir):
    """The loans that make the difference, found by checksums of key ranges."""
    b = book(spark, sf_dir)
    return spot.differing_loans(b.perf, restated(b), YEAR_MOB, keys=b.loans)


def q_reconcile_loss_rate(spark, sf_dir):
    b = book(spark, sf_dir)
    return checks.judge(checks.reconcile_loss_rate(b.triangles, b.loss, b.cfg), b.cfg)


def q_reconcile_weighted(spark, sf_dir):
    b = book(spark, sf_dir)
    return checks.judge(checks.reconcile_weighted(b.loss, b.wavg, b.cfg), b.cfg)


def q_validation_checks(spark, sf_dir):
    return checks.validation_checks(book(spark, sf_dir))


def q_validation_checks_mature(spark, sf_dir):
    """A book without projected cells passes."""
    return checks.validation_checks(book(spark, sf_dir, MATURE_BOOK))


def q_reconcile_all_segment(spark, sf_dir):
    b = book(spark, sf_dir)
    return checks.judge(checks.whole_run_measure(b), b.cfg)


def q_reconcile_summary(spark, sf_dir):
    """R11 on a summary and a loss table that were published and read back."""
    b = book(spark, sf_dir)
    back, _ = pipeline.publish(b, _scratch(spark, "published"))
    return checks.judge(checks.published_rate_measure(back["summary"], back["loss"], b.cfg), b.cfg)


# ------------------------------------------------------------ sinks
def q_sink_round_trip(spark, sf_dir):
    """Rows of each phase table written and read back."""
    _, rows = pipeline.publish(book(spark, sf_dir), _scratch(spark, "published"))
    return spark.createDataFrame([(k, a, b) for k, (a, b) in rows.items()],
                                 "table_name string, rows_written long, rows_read long")


def q_published_checks(spark, sf_dir):
    """The checks table of a whole run, as published and read back."""
    return pipeline.run(book(spark, sf_dir), _scratch(spark, "run")).checks


def q_resume_from_published(spark, sf_dir):
    """S3: the segment matrix of a book that begins at the triangles that an
    interrupted run left."""
    b, out = book(spark, sf_dir), _scratch(spark, "interrupted")
    store = Store(spark, out, b.cfg)
    run = store.take_up(b.cfg, None)
    pipeline.stage(b.fork(), store, run, until="triangles")
    return Book.from_published(spark, out, b.cfg.as_of, run.name).wavg.select(*_wavg_cols(with_segment=True))


def q_roll_forward_feed(spark, sf_dir):
    """The feed of the quarter before, rolled forward by the rows
    that became known since, from a performance table by period."""
    b, path = book(spark, sf_dir), _scratch(spark, "periods")
    layout.write_by_period(b.perf, b.loans, path)
    perf = spark.read.parquet(path)
    before = Book(spark, b.loans, perf, b.cfg.with_(as_of=QUARTER_BEFORE))
    rolled = Book(spark, b.loans, perf, b.cfg, base=(before.sums, QUARTER_BEFORE))
    return _feed_long(rolled)


def q_accepted_quarter(spark, sf_dir):
    """The runs of a quarter as the journal has them, where the
    second one's loan counts are wrong: it leaves the accepted one in place."""
    b, out = book(spark, sf_dir), _scratch(spark, "quarter")
    wrong = b.fork()
    tables = pipeline.phase_tables(b, "feed")
    wrong.restore({"feed": tables["feed"],
                   "feed_disbursal": tables["feed_disbursal"].withColumn("lan_cnt", F.col("lan_cnt") + 1)})
    results = [pipeline.run(x, out, gate=False) for x in (b, wrong)]
    store = Store(spark, out, b.cfg)
    runs, quarter = {r.name: r for r in store.runs()}, store.accepted().name
    told = []
    for n, result in enumerate(results, 1):
        failed = F.array_sort(F.collect_set(F.when(F.expr("verdict = 'FAIL' and check_id <> 'overall'"), F.col("check_id"))))
        summary = result.tables["summary"].filter("key = 'ecl_pct'").select(F.col("value_num").alias("ecl_pct"))
        told.append(side_by_side(result.checks.agg(F.concat_ws(",", failed).alias("failed")), summary).select(
            F.lit(n).cast("long").alias("run"), F.lit(runs[result.run].verdict).alias("verdict"), "failed", "ecl_pct",
            F.lit(result.run == quarter).alias("is_the_quarter")))
    return told[0].unionByName(told[1])


# ---------------------------------------------------------- the extract
def extract_of(b: Book) -> tuple[DataFrame, DataFrame]:
    """The book in the shape of the warehouse's extract."""
    key = F.concat(F.lit("LAN"), F.col("loan_no").cast("string")).alias("distinct_loan_no")
    rupees = lambda cents: (F.col(cents) / F.lit(100.0))
    loans = b.loans.select(key, F.format_string("CUST%07d", "customer_id").alias("customer_id"),
                           iso("disbursal_date").alias("disbursal_date"),
                           rupees("amount_cents").alias("disbursal_amount"), "segment", "tenure_months")
    perf = b.perf.select(key, "mob", rupees("tpos_cents").alias("tpos"),
                         rupees("dpd90_cents").alias("amt_90plus_settlement"))
    return loans, perf


def q_headline_from_extract(spark, sf_dir):
    """The headline of the book read through its text-key extract."""
    b = book(spark, sf_dir)
    return _own(Book.from_extract(*extract_of(b), b.cfg), b).headline().select(*_wavg_cols())


#: Which loans' text is damaged: one in so many has a wrong date, amount, or TPOS at month 12.
DAMAGED = {"date": 97, "amount": 89, "tpos": 101}


def damaged_extract(b: Book) -> tuple[DataFrame, DataFrame]:
    """The extract with text that cannot be read."""
    loans, perf = extract_of(b)
    n = F.substring("distinct_loan_no", 4, 20).cast("long")
    loans = loans.withColumns({
        "disbursal_date": F.when(n % DAMAGED["date"] == 0, F.lit("2020-13-45")).otherwise(F.col("disbursal_date")),
        "disbursal_amount": F.when(n % DAMAGED["amount"] == 0, F.lit("12,5"))
        .otherwise(F.col("disbursal_amount").cast("string"))})
    perf = perf.withColumn("tpos", F.when((n % DAMAGED["tpos"] == 0) & (F.col("mob") == YEAR_MOB), F.lit("n/a"))
                           .otherwise(F.col("tpos").cast("string")))
    return loans, perf


def q_rejected_rows(spark, sf_dir):
    """What is not taken of a damaged extract, by field and reason."""
    b = book(spark, sf_dir)
    return (Book.from_extract(*damaged_extract(b), b.cfg).rejects.groupBy("table_name", "field", "raw", "reason")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("loan_no").alias("n_loans")))


def q_headline_from_damaged_extract(spark, sf_dir):
    """The rows of a damaged extract that can be read give the headline."""
    b = book(spark, sf_dir)
    return _own(Book.from_extract(*damaged_extract(b), b.cfg), b).headline().select(*_wavg_cols())


def q_dq_damaged_extract(spark, sf_dir):
    """The report on a damaged extract, rejected rows included."""
    b = book(spark, sf_dir)
    own = Book.from_extract(*damaged_extract(b), b.cfg)
    return checks.key_violations(own.loans, own.perf, own.rejects)


# ------------------------------------------------------------ report
def q_raw_pivot_90plus(spark, sf_dir):
    b = book(spark, sf_dir)
    return report.raw_pivot(_whole(b.cells), "dpd90", b.cfg)


def q_raw_pivot_tpos(spark, sf_dir):
    b = book(spark, sf_dir)
    return report.raw_pivot(_whole(b.cells), "tpos", b.cfg)


def q_triangle_wide(spark, sf_dir):
    b = book(spark, sf_dir)
    return report.triangle_wide(_whole(b.triangles), b.cfg)


def q_loss_rate_report(spark, sf_dir):
    b = book(spark, sf_dir)
    return report.loss_rate_report(_whole(b.loss), _whole(b.current), b.cfg)


def q_summary(spark, sf_dir):
    return report.summary(book(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)
}
