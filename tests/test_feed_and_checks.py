from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from runoff.config import EclConfig, Window
from runoff.operators import checks, feed
from runoff.plans.book import Book
from runoff.sources.tables import LOANS_SCHEMA, PERFORMANCE_SCHEMA

CFG = EclConfig(as_of=date(2001, 3, 31), start=date(1995, 1, 1),
                windows=(Window("FY01 @ 72M", 2001, 2001, 72),), headline="FY01 @ 72M")

LOANS = [
    # loan, customer, segment, date, cents, tenure
    (1, 10, 1, date(2000, 4, 1), 1_000_000_000, 24),   # first day of FY01-Q1
    (2, 10, 1, date(2000, 6, 30), 2_000_000_000, 24),  # last day, same quarter
    (3, 11, 2, date(2000, 3, 31), 500_000_000, 24),    # FY00-Q4, no performance
    (4, 12, 1, date(1994, 12, 31), 700_000_000, 24),   # before the window start
    (5, 13, 1, date(1995, 1, 1), 300_000_000, 24),     # window start, inclusive
]
PERF = [
    (1, 0, 1_000_000_000, 0), (1, 3, 900_000_000, 0),
    (2, 0, 2_000_000_000, 0), (2, 0, 5_400, 0),        # duplicate key: sums add
    (9, 0, 123_000, 0),                                 # no such loan: dropped
    (4, 0, 700_000_000, 0),                             # loan outside window: dropped
    (5, 3, 250_000_000, 40_000_000),
]


@pytest.fixture(scope="module")
def book(spark):
    loans = spark.createDataFrame(LOANS, LOANS_SCHEMA)
    perf = spark.createDataFrame(PERF, PERFORMANCE_SCHEMA)
    return Book(spark, loans, perf, CFG)


def test_feed_left_join_semantics(book):
    disb = {(r.cohort_end, r.segment): (r.lan_cnt, r.disb_uc) for r in book.disb.collect()}
    assert disb[(date(2000, 6, 30), 1)] == (2, 3_000_000)          # 3 crore in micro-crore
    assert disb[(date(2000, 3, 31), 2)] == (1, 500_000)            # loan without performance
    assert disb[(date(1995, 3, 31), 1)] == (1, 300_000)            # inclusive start
    assert all(k[0] != date(1994, 12, 31) for k in disb)           # outside the window
    f = {(r.cohort_end, r.segment, r.mob): (r.dpd90_uc, r.tpos_uc) for r in book.feed.collect()}
    # duplicate (loan, mob) rows add: 1e9 + 2e9 + 5400 cents -> rounded half-up per group
    assert f[(date(2000, 6, 30), 1, 0)] == (0, 3_000_005)
    assert f[(date(2000, 6, 30), 1, 3)] == (0, 900_000)
    assert f[(date(1995, 3, 31), 1, 3)] == (40_000, 250_000)
    assert len(f) == 3                                             # orphan / outside dropped


def test_segment_gap_keeps_own_cohorts(book):
    cal = {(r.segment, r.cohort_end) for r in book.disb_g.collect()}
    assert ("2", date(2000, 3, 31)) in cal and ("2", date(2000, 6, 30)) not in cal
    assert ("all", date(2000, 3, 31)) in cal and ("all", date(2000, 6, 30)) in cal


def test_key_violations(book):
    r = checks.key_violations(book.loans, book.perf).first()
    assert r.n_loans == 5 and r.dup_loan_keys == 0
    assert r.n_perf_rows == 7 and r.dup_perf_keys == 1
    assert r.orphan_perf_rows == 1 and r.loans_without_perf == 1


def test_key_violations_survive_what_they_report(spark):
    """Two thirds of all rows have no key or one key; MOBs beyond the bits, NULL MOBs and NULL fields."""
    keys = [(None, i % 50, 1, 1) for i in range(3000)] + [(7, i % 40, 1, None) for i in range(3000)]
    keys += [(i, 3 * j, 5, 0) for i in range(100, 150) for j in range(41)]
    keys += [(200, -1, 1, 1), (200, -1, 1, 1), (201, -1, 1, 1), (201, 5000, 1, 1), (202, None, 1, 1), (202, None, 1, 1),
             (203, 188, 1, 1), (203, 188, 1, 1), (203, 189, 1, 1), (204, None, 1, 1)]
    perf = spark.createDataFrame(keys, "loan_no long, mob int, tpos_cents long, dpd90_cents long").repartition(6)
    loans = spark.createDataFrame([(7, 1, 1, date(2000, 1, 1), 5, 12)] * 2 + [(None, 1, 1, date(2000, 1, 1), 5, 12)] * 3
                                  + [(i, 1, 1, date(2000, 1, 1), 5, 12) for i in range(100, 140)],
                                  "loan_no long, customer_id long, segment int, disbursal_date date, amount_cents long, tenure_months int")
    pairs = Counter(k[:2] for k in keys)
    known = {7, *range(100, 140)}
    want = dict(n_loans=45, dup_loan_keys=2, null_loan_fields=3, n_perf_rows=len(keys),
                dup_perf_keys=sum(n > 1 for n in pairs.values()), null_perf_fields=sum(None in k for k in keys),
                orphan_perf_rows=sum(k[0] not in known for k in keys), loans_without_perf=3)
    report = checks.key_violations(loans, perf)
    assert report.first().asDict() == want
    # a hot key is combined before the one exchange: a partial aggregate lies right under it
    plan = checks.rows_by_loan(perf)._jdf.queryExecution().executedPlan().toString().splitlines()
    at = [i for i, x in enumerate(plan) if "Exchange hashpartitioning" in x]
    assert len(at) == 1 and "HashAggregate" in plan[at[0] + 1] and "partial_bit_or" in plan[at[0] + 1]
    by_loan = checks.rows_by_loan(perf.filter("loan_no is not null"))
    assert by_loan.count() == len({k[0] for k in keys} - {None})


def _verdicts(taken, cfg=CFG):
    return {r.check_id: r for r in checks.judge(taken, cfg).collect()}


def test_reconcile_feed_passes_on_own_feed(book):
    rows = _verdicts(checks.reconcile_feed(book.loans, book.perf_by_loan, book.feed, book.disb, CFG))
    assert rows["feed.loan_count"].verdict == "PASS" and rows["feed.loan_count"].measure == 0
    # 400 cents rounded away in the 6-dp feed: 4e-7 crore, inside 1e-4
    assert rows["feed.outstanding"].measure == pytest.approx(4e-7)
    assert all(r.verdict == "PASS" for r in rows.values())


def test_reconcile_feed_fails_on_wrong_segment(spark, book):
    # the run files loan 2 under segment 2: totals per quarter are intact, but
    # the per-segment comparison must fail
    wrong = book.loans.withColumn("segment", F.when(F.col("loan_no") == 2, 2)
                                  .otherwise(F.col("segment")))
    bad = Book(spark, wrong, book.perf, CFG)
    rows = _verdicts(checks.reconcile_feed(book.loans, book.perf_by_loan, bad.feed, bad.disb, CFG))
    assert rows["feed.loan_count"].verdict == "FAIL" == rows["feed.disbursal"].verdict


def test_every_feed_check_fails_on_a_tampered_feed(book):
    more = lambda df, c: df.withColumn(c, F.col(c) + 1000)
    for feed_df, disb, check in ((more(book.feed, "dpd90_uc"), book.disb, "feed.overdue"),
                                 (more(book.feed, "tpos_uc"), book.disb, "feed.outstanding"),
                                 (book.feed, more(book.disb, "disb_uc"), "feed.disbursal"),
                                 (book.feed, more(book.disb, "lan_cnt"), "feed.loan_count"),
                                 (book.feed.limit(1), book.disb, "feed.outstanding")):
        rows = _verdicts(checks.reconcile_feed(book.loans, book.perf_by_loan, feed_df, disb, CFG))
        assert [k for k, r in rows.items() if r.verdict != "PASS" and k == check] == [check]


def test_later_checks_fail_on_tampered_tables(spark):
    b = Book.from_driver_tables(spark, "/root/testdata/sf0.001")
    cfg, bump = b.cfg, lambda df, c, d=0.01: df.withColumn(c, F.col(c) + d)
    taken = [
        (checks.reconcile_loss_rate(b.triangles, bump(b.loss, "loss_rate"), cfg), [f"loss_rate.{a}m" for a in cfg.anchors]),
        (checks.reconcile_weighted(b.loss, bump(b.wavg, "weighted_avg_lr"), cfg), ["window.weighted_rate"]),
        (checks.measures(checks.reconcile_chain_ladder(bump(b.triangles, "tpos_amt"), cfg)
                         .agg(F.max("max_rel_diff").alias("d")), {"triangle.recurrence": "d"}), ["triangle.recurrence"])]
    for df, ids in taken:
        rows = _verdicts(df, cfg)
        assert sorted(k for k, r in rows.items() if r.verdict == "FAIL") == sorted(ids)
    # the published rate: a changed summary does not agree with the loss table
    iso = b.loss.withColumn("cohort_end", F.date_format("cohort_end", "yyyy-MM-dd"))
    told = spark.createDataFrame([("ecl_pct", 0.5)], "key string, value_num double")
    assert _verdicts(checks.published_rate_measure(told, iso, cfg), cfg)["sink.summary_rate"].verdict == "FAIL"
    # the whole-book run: a feed row lost from one segment only
    b.__dict__["wavg"] = bump(b.wavg, "weighted_avg_lr")
    assert _verdicts(checks.whole_run_measure(b), cfg)["book.whole_run"].verdict == "FAIL"


def test_empty_book_fails_and_the_gate_names_the_checks(spark):
    empty = Book(spark, spark.createDataFrame([], LOANS_SCHEMA), spark.createDataFrame([], PERFORMANCE_SCHEMA), CFG)
    verdicts = checks.validation_checks(empty).cache()
    rows = {r.check_id: r for r in verdicts.collect()}
    assert rows["overall"].verdict == "FAIL" and rows["feed.loan_count"].measure is None
    with pytest.raises(RuntimeError, match="feed.loan_count"):
        checks.gate(verdicts)


def test_warnings_do_not_reject(spark):
    df = checks.with_overall(checks.judge(spark.createDataFrame(
        [("window.rate_above_one", 0.2), ("sink.rows:feed", 0.0)], "check_id string, measure double"), CFG))
    assert {r.check_id: r.verdict for r in df.collect()} == {
        "window.rate_above_one": "WARN", "sink.rows:feed": "PASS", "overall": "WARN"}
    assert checks.gate(df) == "WARN"


def test_loan_mob_wide_and_unpivot(spark, book):
    w = {r.loan_no: r for r in feed.loan_mob_wide(book.perf_by_loan, CFG).collect()}
    assert w[2].outstanding_at_0 == 2_000_005_400 and w[2].outstanding_at_3 is None
    wide = feed.feed_wide(book.feed, book.disb, CFG)
    long = feed.unpivot_feed(wide, CFG)
    assert long.filter("metric = 'tpos' and mob = 0").count() == 1
