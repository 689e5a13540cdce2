import glob
import re
from datetime import date

import pytest
from runoff.config import DEFAULT
from runoff.operators import checks, feed
from runoff.plans import driver_book
from runoff.plans.book import Book
from runoff.sources import layout, tables

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The driver's book as bucketed tables and as plain parquet; no broadcast."""
    base = tmp_path_factory.mktemp("book")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS runoff_t LOCATION '{base}/wh'")
    loans = driver_book.driver_loans(spark, SF001, DEFAULT)
    perf = driver_book.performance_from_loans(loans, DEFAULT)
    layout.publish_book(loans.repartition(7), perf.repartition(7), "runoff_t.loans", "runoff_t.perf", buckets=4)
    loans.select(*tables.LOAN_COLS).write.parquet(f"{base}/loans")
    perf.select(*tables.PERF_COLS).write.parquet(f"{base}/perf")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # the large-table plans
    yield (Book.from_tables(spark, "runoff_t.loans", "runoff_t.perf", DEFAULT, loan_buckets=True),
           Book.from_parquet(spark, f"{base}/loans", f"{base}/perf", DEFAULT), str(base))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _by_loan(plan):
    """Exchanges by the loan key (with or without others), by table."""
    return [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\((loan_no|l_no|p_no)", line)]


def test_bucketed_tables_join_without_exchange(spark, stored):
    bucketed, plain, base = stored
    f = feed.feed_with_disbursal(bucketed.loans, bucketed.perf, DEFAULT)
    plan = _plan(f)
    assert "SortMergeJoin" in plan and not _by_loan(plan)
    assert sorted(map(str, f.collect())) == sorted(map(str, feed.feed_with_disbursal(plain.loans, plain.perf, DEFAULT).collect()))
    # one file for each bucket, though seven tasks held the rows
    for table in ("loans", "perf"):
        assert 0 < len(glob.glob(f"{base}/wh/{table}/part-*.parquet")) <= 4


@pytest.mark.parametrize("make", [
    lambda b: checks.reconcile_feed(b.loans, b.perf_by_loan, b.feed, b.disb, DEFAULT),
    lambda b: feed.loan_mob_wide(b.perf_by_loan, DEFAULT)])
def test_validation_partitions_performance_once(stored, make):
    bucketed, plain, _ = stored
    assert not _by_loan(_plan(make(bucketed)))
    # of a plain book: performance once, and the loans once where they take part
    lines = _by_loan(_plan(make(plain)))
    assert sum("REPARTITION" in x for x in lines) == 1 and len(lines) <= 2
    assert sorted(map(str, make(bucketed).collect())) == sorted(map(str, make(plain).collect()))


def test_key_report_exchanges_combined_rows(stored):
    """Loan by loan, a bucketed table needs no exchange; a plain one's rows are combined before it."""
    bucketed, plain, _ = stored
    report = lambda b: checks.key_violations(b.loans, b.perf)
    assert not _by_loan(_plan(checks.rows_by_loan(bucketed.perf))) and "REPARTITION" not in _plan(report(plain))
    assert report(bucketed).first() == report(plain).first()


def test_unreadable_fields_are_rejected_with_their_reason(spark):
    loans = spark.createDataFrame(
        [("A", "c", "1999-12-31", "1.5", "3", "60"), ("B", "c", "2020-13-45", "12,5", "3", "60"),
         ("C", "c", None, "1e3", "x", "60.5"), (None, None, "31/12/1999", "99999999999999999999", "3.0", ""),
         ("B", "c", "2020-13-45", "12,5", "3", "60")],
        "distinct_loan_no string, customer_id string, disbursal_date string, disbursal_amount string, segment string, tenure_months string")
    perf = spark.createDataFrame([("A", 3, 1.0, float("nan")), ("A", None, 2.0, None)],
                                 "distinct_loan_no string, mob int, tpos double, amt_90plus_settlement double")
    assert [tuple(r)[:1] + tuple(r)[2:] for r in tables.loans_from_extract(loans).collect()] == [
        ("A", 3, date(1999, 12, 31), 150, 60)]
    assert [tuple(r) for r in tables.performance_from_extract(perf).collect()] == [("A", None, 200, None)]
    out = tables.rejected_rows(loans, perf).collect()
    assert sorted((r.table_name, str(r.loan_no), r.field, r.raw, r.reason) for r in out) == sorted(
        [("loans", "B", "disbursal_date", "2020-13-45", "not a date"), ("loans", "B", "disbursal_amount", "12,5", "not an amount")] * 2
        + [("loans", "C", "segment", "x", "not a whole number"), ("loans", "C", "tenure_months", "60.5", "not a whole number"),
           ("loans", "None", "disbursal_date", "31/12/1999", "not a date"),
           ("loans", "None", "disbursal_amount", "99999999999999999999", "not an amount"),
           ("loans", "None", "tenure_months", "", "not a whole number"),
           ("performance", "A", "amt_90plus_settlement", "NaN", "not an amount")])
    assert len({r.row_id for r in out}) == 5          # alike rows stay two rows
    empty = tables.rejected_rows(loans.limit(0), perf.limit(0))
    assert empty.collect() == [] and empty.columns == ["table_name", "row_id", "loan_no", "field", "raw", "reason"]


def test_extract_round_trip_is_exact(spark):
    rows = [("LAN1", "C1", "1999-12-31", 1234567.89, 3, 60), ("LAN2", "C2", "2000-01-01", 0.05, 1, 12),
            ("LAN3", "C3", None, 1e9 + 0.01, 5, 24)]
    loans = tables.loans_from_extract(spark.createDataFrame(
        rows, "distinct_loan_no string, customer_id string, disbursal_date string, disbursal_amount double, segment int, tenure_months int"))
    assert [(r.loan_no, r.amount_cents, str(r.disbursal_date)) for r in loans.collect()] == [
        ("LAN1", 123456789, "1999-12-31"), ("LAN2", 5, "2000-01-01"), ("LAN3", 100000000001, "None")]
    perf = tables.performance_from_extract(spark.createDataFrame(
        [("LAN1", 3, 0.285, 1.005)], "distinct_loan_no string, mob int, tpos double, amt_90plus_settlement double"))
    assert perf.select("tpos_cents", "dpd90_cents").first() == (29, 101)  # half up


def test_jdbc_options():
    # no database can be started here: the options are what is tested
    assert tables.jdbc_options("jdbc:x", "loans", "loan_no", 8, (1, 900)) == {
        "url": "jdbc:x", "dbtable": "loans", "partitionColumn": "loan_no", "lowerBound": "1", "upperBound": "900",
        "numPartitions": "8"}
    assert tables.jdbc_options("jdbc:x", "loans", "loan_no", 8) == {"url": "jdbc:x", "dbtable": "loans"}


def test_parquet_sources_with_fixed_schemas(spark, tmp_path):
    # The loan and performance tables read back with explicit schemas
    # (no inference) give the same weighted rates as the derived tables
    src = Book.from_driver_tables(spark, SF001, DEFAULT)
    src.loans.select(*tables.LOAN_COLS).write.parquet(str(tmp_path / "loans"))
    src.perf.select(*tables.PERF_COLS).write.parquet(str(tmp_path / "perf"))
    b = Book.from_parquet(spark, str(tmp_path / "loans"), str(tmp_path / "perf"), DEFAULT)
    assert b.loans.schema == tables.LOANS_SCHEMA or \
        [f.dataType for f in b.loans.schema] == [f.dataType for f in tables.LOANS_SCHEMA]
    cols = ["segment", "window", "n_quarters", "weighted_avg_lr"]
    key = lambda df: sorted((r.segment, r.window, r.n_quarters, round(r.weighted_avg_lr, 10))
                            for r in df.select(*cols).collect())
    assert key(b.wavg) == key(src.wavg)
