"""Plans that must hold at scale."""
from runoff.config import DEFAULT
from runoff.operators import checks, feed
from runoff.plans import driver_book
from runoff.plans.book import Book

SF001 = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_triangles_and_rates_run_without_python_or_joins(spark):
    b = Book.from_driver_tables(spark, SF001, DEFAULT, materialize=False)
    b.__dict__["grouped"] = spark.createDataFrame(
        [], "segment string, cohort_end date, mob int, lan_cnt long, disb_uc long, dpd90_uc long, tpos_uc long")
    for df in (b.triangles, b.loss, b.wavg):
        plan = _plan(df)
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Join"))


def test_building_a_run_starts_no_job_after_the_feed(spark):
    b = Book.from_driver_tables(spark, SF001, DEFAULT)
    b.feed
    sc = spark.sparkContext
    sc.setJobGroup("building", "")
    b.wavg, b.movements, b.current
    assert len(sc.statusTracker().getJobIdsForGroup("building")) == 0
    sc.setJobGroup("", "")


def test_joins_without_broadcast_give_the_same_result(spark):
    cols = ["segment", "window", "n_quarters", "weighted_avg_lr"]

    def rows(df):
        return sorted((r.segment, r.window, r.n_quarters, round(r.weighted_avg_lr, 8)) for r in df.select(*cols).collect())

    want = rows(Book.from_driver_tables(spark, SF001, DEFAULT).wavg)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(Book.from_driver_tables(spark, SF001, DEFAULT).wavg) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_more_loans_are_expanded_by_more_tasks(spark, monkeypatch):
    """What a task holds does not grow with the book."""
    monkeypatch.setattr(driver_book, "LOANS_A_TASK", 7)
    b = Book.from_driver_tables(spark, SF001, DEFAULT)
    n = b.loans.count()
    assert "hashpartitioning(loan_no#" in _plan(b.perf) and f", {-(-n // 7)}), REPARTITION_BY_NUM" in _plan(b.perf)


def test_rows_meet_their_loan_without_a_sort(spark):
    """Neither the feed of a table not kept by loan nor its reconciliation sorts performance rows."""
    b = Book.from_driver_tables(spark, SF001, DEFAULT)
    feed_plan = _plan(feed.feed_sums(b.loans, b.perf, b.cfg, hashed=True))
    checked = _plan(checks.reconcile_feed(b.loans, b.perf_by_loan, b.feed, b.disb, b.cfg))
    for plan in (feed_plan, checked):
        assert "ShuffledHashJoin [loan_no" in plan and "SortMergeJoin [loan_no" not in plan
