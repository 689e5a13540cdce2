import re

import pytest
from pyspark.sql import functions as F

from runoff.config import DEFAULT
from runoff.operators import spot
from runoff.plans.book import Book
from runoff.sources import tables
from runoff.sources.tables import PERFORMANCE_SCHEMA

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("spot"))
    b = Book.from_driver_tables(spark, SF001, DEFAULT)
    b.loans.select(*tables.LOAN_COLS).write.parquet(f"{base}/loans")
    b.perf.select(*tables.PERF_COLS).write.parquet(f"{base}/perf")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")    # plans told in full
    yield Book.from_parquet(spark, f"{base}/loans", f"{base}/perf", DEFAULT)
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def _pushed(df):
    return re.findall(r"PushedFilters: \[([^\]]*)\]", df._jdf.queryExecution().executedPlan().toString())


def test_an_untouched_book_agrees_and_the_month_reaches_the_scan(stored):
    b = stored
    found = spot.spot_check(b.loans, b.perf, b.feed, b.disb, b.cfg, 12)
    assert any("EqualTo(mob,12)" in f for f in _pushed(found))
    rows = found.collect()
    assert rows and all(r["verdict"] == "PASS" for r in rows)
    assert sum(r["source_loans"] for r in rows) == sum(r["lan_cnt"] for r in b.disb.collect())
    # a table is no different from itself, and then no range is read again
    assert spot.differing_ranges(b.perf, b.perf, 12, [100, 1000]) == []
    assert spot.differing_loans(b.perf, b.perf, 12).isEmpty()


def test_a_tampered_row_fails_its_cohort_and_is_named(stored):
    b = stored
    loan = b.perf.filter("mob = 12 and tpos_cents > 0").orderBy("loan_no").collect()[17]["loan_no"]
    other = b.perf.withColumn("tpos_cents", F.when((F.col("loan_no") == loan) & (F.col("mob") == 12), F.col("tpos_cents") + 200_000)
                              .otherwise(F.col("tpos_cents")))
    bad = spot.spot_check(b.loans, other, b.feed, b.disb, b.cfg, 12).filter("verdict = 'FAIL'").collect()
    assert len(bad) == 1 and abs(bad[0]["off_cents"] - 200_000) <= 1_000
    assert spot.spot_check(b.loans, other, b.feed, b.disb, b.cfg, 24).filter("verdict = 'FAIL'").isEmpty()
    named = spot.differing_loans(b.perf, other, 12, keys=b.loans)
    row = named.collect()
    assert [(r["loan_no"], r["reason"], r["tpos_cents_2"] - r["tpos_cents_1"]) for r in row] == [(loan, "amounts", 200_000)]
    # only the range of that loan is read the second time
    assert any("GreaterThanOrEqual(loan_no," in f and "EqualTo(mob,12)" in f for f in _pushed(named))


def test_rows_gone_added_repeated_and_without_key(spark):
    make = lambda rows: spark.createDataFrame(rows, PERFORMANCE_SCHEMA.fieldNames()).select(
        F.col("loan_no").cast("long"), F.col("mob").cast("int"), F.col("tpos_cents").cast("long"), F.col("dpd90_cents").cast("long"))
    same = [(i, 12, 10 * i, 0) for i in range(100, 140)]
    one = make([(1, 12, 5, 0), (2, 12, 5, 0), (3, 12, 5, 0), (None, 12, 7, 0), (5, 24, 1, 0), (6, 12, 0, 0), *same])
    two = make([(2, 12, 5, 0), (2, 12, 5, 0), (3, 12, 5, 0), (4, 12, 9, 0), (None, 12, 8, 0), (5, 24, 2, 0), (6, 12, None, 0), *same])
    got = {r["loan_no"]: (r["reason"], r["rows_1"], r["rows_2"]) for r in spot.differing_loans(one, two, 12).collect()}
    # a NULL amount is not an amount of 0
    assert got == {1: ("missing", 1, 0), 2: ("rows", 1, 2), 4: ("added", 0, 1), None: ("amounts", 1, 1), 6: ("amounts", 1, 1)}
    text = lambda df: df.withColumn("loan_no", F.concat(F.lit("L'"), "loan_no"))
    assert {r["loan_no"] for r in spot.differing_loans(text(one), text(two), 12).collect()} == {"L'1", "L'2", "L'4", None, "L'6"}
    empty = one.limit(0)
    assert spot.differing_loans(empty, empty, 12).isEmpty()
    assert spot.differing_loans(empty, one, 12).filter("reason <> 'added'").isEmpty()
