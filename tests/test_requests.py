from pyspark.sql import functions as F

from runoff.config import DEFAULT, SegmentRequest
from runoff.operators import requests
from runoff.plans.book import Book

SF001 = "/root/testdata/sf0.001"


def test_the_table_is_read_as_single_requests_are(spark):
    b = Book.from_driver_tables(spark, SF001, DEFAULT)
    asked = [(s, y1, y2, a) for s in ("3", " ALL ", None, "*", "", "7", "none", "3x") for y1, y2 in (
        ("FY97", "2000"), ("fy97-Q2", " 00 "), ("1999", "98"), ("FY97-Q5", "00"), (None, "x"), ("49", "50"), ("2050", "2051"))
        for a in ("84", " 72 ", "60", "84.0", None, "+120")]
    table = spark.createDataFrame(asked, "segment string, fy_start string, fy_end string, anchor string")
    got = {tuple(r[:4]): r for r in requests.answer(table, b.loss, b.cfg).collect()}
    assert len(got) == len(asked)
    held = {(r["segment"], r["cohort_end"]) for r in b.disb_g.collect()}
    for ask in asked:
        row = got[ask]
        try:
            request = SegmentRequest.read(b.cfg, *ask)
        except (ValueError, TypeError):
            assert row["problem"] not in (None, "covers no cohorts") and row["n_quarters"] == 0, ask
            continue
        n = sum(s == request.segment and request.window.first_day <= d <= request.window.last_day for s, d in held)
        assert row["key"] == request.segment and row["n_quarters"] == n, ask
        assert row["problem"] == (None if n else "covers no cohorts") and (row["weighted_avg_lr"] is None) == (n == 0)


def test_requests_agree_with_the_book_and_keep_their_columns(spark):
    b = Book.from_driver_tables(spark, SF001, DEFAULT)
    table = spark.createDataFrame([("3", "FY97", "FY00", "84", "x")], "segment string, fy_start string, fy_end string, anchor string, who string")
    row = requests.answer(table.union(table), b.loss, b.cfg).collect()
    want, _ = b.segment_ecl("3", "FY97", "FY00", 84)
    assert len(row) == 2 and row[0] == row[1] and row[0]["who"] == "x"
    assert abs(row[0]["weighted_avg_lr"] - want.first()["weighted_avg_lr"]) < 1e-9
    assert requests.answer(table.filter(F.lit(False)), b.loss, b.cfg).isEmpty()
