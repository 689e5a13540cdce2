from datetime import date

import pytest

from runoff.config import DEFAULT
from runoff.plans import pipeline
from runoff.plans.book import Book

SF001 = "/root/testdata/sf0.001"


def test_pipeline_publishes_reads_back_and_gates(spark, tmp_path):
    book = Book.from_driver_tables(spark, SF001, DEFAULT)
    res = pipeline.run(book, str(tmp_path / "ecl"))
    assert res.status in ("PASS", "WARN")
    names = {r.check_id for r in res.checks.collect()}
    assert {"feed.loan_count", "book.whole_run", "sink.summary_rate", "sink.rows:feed", "overall"} <= names
    assert all(a == b > 0 for a, b in res.rows.values())
    w = res.tables["weighted"].filter("segment = 'all'").collect()
    assert len(w) == len(DEFAULT.windows)
    # a second quarter lands in its own partition; the first one is kept
    young = DEFAULT.with_(as_of=date(2001, 9, 30))
    pipeline.run(Book.from_driver_tables(spark, SF001, young), str(tmp_path / "ecl"))
    parts = {r.as_of for r in spark.read.parquet(str(tmp_path / "ecl" / "summary"))
             .select("as_of").distinct().collect()}
    assert {str(p) for p in parts} == {"2006-03-31", "2001-09-30"}


def test_feed_wide_is_ordered(spark):
    from runoff.plans.queries import q_feed_wide
    rows = q_feed_wide(spark, SF001).select("fy_quarter", "segment").collect()
    keys = [(r.fy_quarter, r.segment) for r in rows]
    assert keys[0][0] == "FY95-Q4" and keys[-1][0] == "FY02-Q2"


def test_segment_requests_need_rows(spark):
    book = Book.from_driver_tables(spark, SF001, DEFAULT)
    with pytest.raises(ValueError):
        book.segment_ecl("9", 97, 2000, 84)
    with pytest.raises(ValueError):
        book.require_rows("3", 1980, 1981, 84)       # empty window
    assert book.require_rows("all", "FY97", "FY00", 84) == 16


def test_a_failed_run_is_published_and_raises(spark, tmp_path, monkeypatch):
    book = Book.from_driver_tables(spark, SF001, DEFAULT)
    monkeypatch.setattr(pipeline, "sink_measures", lambda s, rows: s.createDataFrame(
        [("sink.rows:feed", 3.0)], "check_id string, measure double"))
    with pytest.raises(RuntimeError, match="sink.rows:feed"):
        pipeline.run(book, str(tmp_path / "ecl"))
    rows = spark.read.parquet(str(tmp_path / "ecl" / "checks")).collect()
    assert {r.check_id: r.verdict for r in rows}["overall"] == "FAIL"


def test_command_line_over_an_extract(spark, tmp_path, capsys):
    from runoff.plans.queries import book, extract_of
    loans, perf = extract_of(book(spark, SF001))
    loans.write.parquet(str(tmp_path / "loans"))
    perf.write.parquet(str(tmp_path / "perf"))
    res = pipeline.main(["--loans", str(tmp_path / "loans"), "--perf", str(tmp_path / "perf"), "--extract",
                         "--out", str(tmp_path / "out")])
    assert res.status == "PASS" and "validation: PASS" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        pipeline.main(["--out", str(tmp_path / "out")])


def test_a_damaged_extract_is_published_with_a_warning(spark, tmp_path):
    from runoff.plans.queries import book, damaged_extract
    damaged = Book.from_extract(*damaged_extract(book(spark, SF001)), DEFAULT)
    res = pipeline.run(damaged, str(tmp_path / "out"))
    found = {r.check_id: r for r in res.checks.collect()}
    n = res.tables["rejected_rows"].select("row_id").distinct().count()
    assert res.status == "WARN" and found["source.rejected_rows"].measure == n > 0
    assert found["feed.loan_count"].verdict == "PASS"


def test_release_gives_back_persisted_tables(spark):
    book = Book.from_driver_tables(spark, SF001, DEFAULT)
    first = book.headline().collect()
    kept = list(book._kept)
    assert kept and all(df.storageLevel.useMemory for df in kept)
    book.release()
    assert not any(df.storageLevel.useMemory for df in kept)
    assert book.headline().collect() == first
