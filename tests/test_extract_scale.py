"""An extract is read at scale: few decimals, each field once a row."""
from datetime import date

from pyspark.sql import functions as F

from runoff.config import DEFAULT
from runoff.operators import feed
from runoff.plans.book import Book
from runoff.plans.queries import book
from runoff.sources import layout, tables

ODD = ["12.345", "0.005", "-0.005", "1.115", "1.0049999", "0.0049995", "12d", "12f", "0x1p3", "NaN", "Infinity", "-inf", "1e3",
       "1E-3", " 7.10 ", "", " ", "n/a", "12,5", "+4.25", ".5", "5.", "99999999999999999", "123456789012345678901234567890",
       "3.3D", "1_0", "-17.995", "0.1", "200000.07"]


def test_cents_are_those_of_decimals(spark):
    """F3, F7, F13, F17"""
    rows = spark.createDataFrame([(x,) for x in [*ODD, None]], "s string").withColumn("d", F.col("s").try_cast("double"))
    exact = lambda c: F.round(F.col(c).try_cast("decimal(24,6)") * 100, 0).try_cast("long")
    for c in ("s", "d"):
        kind = rows.schema[c].dataType
        got = rows.select(F.col(c).alias("x"), tables._cents(F.col(c), kind).alias("got"), exact(c).alias("want")).collect()
        assert all(r.got == r.want for r in got), [r for r in got if r.got != r.want]


def test_a_field_is_read_once_for_each_row(spark):
    """the filter on unreadable rows does not read the fields again."""
    perf = spark.createDataFrame([("LAN1", 12, "5.25", 1.0), ("LAN1", 15, "n/a", 1.0), (None, 3, None, None)],
                                 "distinct_loan_no string, mob int, tpos string, amt_90plus_settlement double")
    read = tables.performance_from_extract(perf)
    plan = read._jdf.queryExecution().executedPlan().toString()
    filters = [x for x in plan.splitlines() if "Filter" in x]
    assert filters and not any("cast" in x for x in filters)
    assert sorted(map(tuple, read.collect()), key=str) == sorted([("LAN1", 12, 525, 100), (None, 3, None, None)], key=str)


def test_a_large_cohort_is_written_in_slices(spark, tmp_path, monkeypatch):
    """F12"""
    loans = spark.range(40).selectExpr("id loan_no", "1 segment", "date'2000-01-05' disbursal_date")
    perf = spark.range(40).selectExpr("id loan_no", "3 mob", "id tpos_cents", "0L dpd90_cents")
    monkeypatch.setattr(layout, "LOANS_A_TASK", 4)
    monkeypatch.setattr(layout, "LOANS_A_SLICE", 5)
    layout.write_by_period(perf, loans, str(tmp_path / "p"))
    back = spark.read.parquet(str(tmp_path / "p"))
    assert back.count() == 40 and len(back.inputFiles()) > 1
    assert sorted(r.loan_no for r in back.collect()) == list(range(40))


def test_rows_by_period_are_those_of_the_join(spark, tmp_path, monkeypatch):
    """r04 F3: a loan's rows travel as one; none is lost, repeated keys and nulls included."""
    loans = spark.createDataFrame([(i, date(2000, 1 + i % 12, 5)) for i in range(60)] + [(3, date(2000, 4, 5)), (3, date(2001, 4, 5)), (None, date(2000, 1, 5)), (61, None)],
                                  "loan_no long, disbursal_date date")
    perf = spark.createDataFrame([(i, m, i * m, None if i % 7 else 1) for i in range(64) for m in (0, 3, 3, 14)] + [(5, None, 1, 1), (None, 3, 1, 1)],
                                 "loan_no long, mob int, tpos_cents long, dpd90_cents long")
    monkeypatch.setattr(layout, "LOANS_A_TASK", 4)
    monkeypatch.setattr(layout, "LOANS_A_SLICE", 6)
    kept = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(kept, None)
    layout.write_by_period(perf, loans, str(tmp_path / "p"))
    assert spark.conf.get(kept, None) == before
    back, want = spark.read.parquet(str(tmp_path / "p")), layout.by_period(perf, loans)
    assert sorted(map(str, back.select(want.columns).collect())) == sorted(map(str, want.collect()))
    # cohorts in order fill a task, a large one is cut; a loan has one task
    many = spark.range(100).selectExpr("id loan_no", "if(id < 50, date'2000-01-05', add_months(date'2000-01-05', 3 * int(id))) disbursal_date")
    writers, number = layout._dealt(many)
    of = [(r[0], r[1]) for r in many.select("disbursal_date", number).collect()]
    tasks = [n for _, n in of]
    assert 0 <= min(tasks) and max(tasks) < writers and max(tasks.count(n) for n in set(tasks)) <= 20
    assert len({n for d, n in of if d == date(2000, 1, 5)}) > 5 and len(set(tasks)) < 40


def test_cohorts_are_joined_in_rounds(spark, tmp_path, monkeypatch):
    """r04 F3: with the sums of one join, also where a loan's rows have another cohort."""
    cfg = DEFAULT
    b = book(spark, "/root/testdata/sf0.001")
    loans = b.loans.unionByName(b.loans.where("loan_no % 9 = 0").withColumn("disbursal_date", F.expr("add_months(disbursal_date, 7)")))
    layout.write_by_period(b.perf, loans, str(tmp_path / "p"))
    perf = spark.read.parquet(str(tmp_path / "p"))
    want = sorted(map(str, feed.feed_sums(loans, perf, cfg).collect()))
    assert len(feed.rounds(loans, perf, cfg)) == 1
    monkeypatch.setattr(feed, "LOANS_A_ROUND", 300)
    parts = feed.rounds(loans, perf, cfg)
    assert len(parts) > 3 and sum(p.count() for p in parts) == perf.count()
    assert sorted(map(str, Book(spark, loans, perf, cfg).sums.collect())) == want
