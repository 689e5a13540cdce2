"""The feed rolled forward from quarter to quarter, and what its scans leave out."""
from datetime import date

import pytest
from pyspark.sql import functions as F

from runoff.config import DEFAULT
from runoff.operators import feed
from runoff.plans import pipeline
from runoff.plans.book import Book
from runoff.plans.queries import book as shared
from runoff.sources import layout

SF001 = "/root/testdata/sf0.001"
QUARTERS = [date(2005, 6, 30), date(2005, 9, 30), date(2005, 12, 31), date(2006, 3, 31)]


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The driver's book, its loans as parquet and its performance by period."""
    b, base = shared(spark, SF001), tmp_path_factory.mktemp("periods")
    b.loans.select("loan_no", "customer_id", "segment", "disbursal_date", "amount_cents", "tenure_months").write.parquet(f"{base}/loans")
    layout.write_by_period(b.perf, b.loans, f"{base}/perf")
    return spark.read.parquet(f"{base}/loans"), spark.read.parquet(f"{base}/perf")


def test_quarter_by_quarter_equals_the_full_run(spark, stored):
    loans, perf = stored
    state = None
    for before, as_of in zip([None, *QUARTERS], QUARTERS):
        cfg = DEFAULT.with_(as_of=as_of)
        rolled = Book(spark, loans, perf, cfg, base=state and (state, before))
        state = rolled.sums
        # a plain table that ends at this quarter
        whole = Book.from_driver_tables(spark, SF001, cfg)
        assert rows(rolled.feed) == rows(whole.feed) and rows(rolled.disb) == rows(whole.disb)
        assert rows(rolled.sums) == rows(feed.feed_sums(loans, perf, cfg))


def test_only_new_partitions_are_read(spark, stored):
    loans, perf = stored
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = feed.known_rows(perf, DEFAULT, QUARTERS[-2])
        plan = feed.feed_sums(loans, perf, DEFAULT, QUARTERS[-2])._jdf.queryExecution().executedPlan().toString()
        scan = next(x for x in plan.splitlines() if "FileScan" in x and "tpos_cents" in x)
        assert "(period#" in scan and "<= 2006-03-31)" in scan and "> 2005-12-31)" in scan.split("PartitionFilters")[1]
        assert new.count() == perf.filter("period = '2006-03-31'").filter(F.col("mob").isin(list(DEFAULT.extract_grid.mobs))).count()
        # a late window reaches the performance scan without any join or broadcast
        late = DEFAULT.with_(start=date(1999, 4, 1))
        plan = feed.feed_sums(loans, perf, late)._jdf.queryExecution().executedPlan().toString()
        scan = next(x for x in plan.splitlines() if "FileScan" in x and "tpos_cents" in x)
        assert "GreaterThanOrEqual(cohort_end,1999-04-01)" in scan.split("PushedFilters")[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    plain = Book.from_driver_tables(spark, SF001, DEFAULT)
    late = DEFAULT.with_(start=date(1999, 4, 1))
    assert rows(feed.feed_sums(loans, perf, late)) == rows(feed.feed_sums(plain.loans, plain.perf, late))
    with pytest.raises(ValueError):
        feed.known_rows(plain.perf, DEFAULT, QUARTERS[0])


def test_an_accepted_run_is_rolled_forward(spark, stored, tmp_path):
    loans, perf = stored
    out = str(tmp_path / "ecl")
    before = DEFAULT.with_(as_of=QUARTERS[-2])
    pipeline.run(Book(spark, loans, perf, before), out)
    rolled = Book.roll_from(spark, out, QUARTERS[-2], loans, perf, DEFAULT)
    result = pipeline.run(rolled, out)
    assert result.status == "PASS"   # its feed against all rows, loan first
    whole = shared(spark, SF001)
    assert rows(rolled.feed) == rows(whole.feed)
    assert rolled.headline().first()["weighted_avg_lr"] == pytest.approx(whole.headline().first()["weighted_avg_lr"], abs=1e-12)
    with pytest.raises(ValueError):
        Book.roll_from(spark, out, QUARTERS[-2], loans, perf, DEFAULT.with_(start=date(1996, 1, 1)))
    with pytest.raises(LookupError):
        Book.roll_from(spark, out, QUARTERS[0], loans, perf, DEFAULT)
