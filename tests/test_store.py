"""Staged publish, the journal's verdicts, and runs that begin at published tables."""
from datetime import date

import pytest
from pyspark.sql import functions as F

from runoff.config import DEFAULT, YOUNG_BOOK
from runoff.plans import pipeline, store
from runoff.plans.book import Book
from runoff.plans.queries import book as shared
from runoff.plans.queries import extract_of
from runoff.plans.store import Store

SF001 = "/root/testdata/sf0.001"


def rows(df):
    """Sorted rows; sums of doubles depend on the order of rows in the last bits."""
    return sorted((tuple(round(x, 10) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


def wrong_loans(b):
    tables = pipeline.phase_tables(b, "feed")
    out = b.fork()
    out.restore({"feed": tables["feed"],
                 "feed_disbursal": tables["feed_disbursal"].withColumn("lan_cnt", F.col("lan_cnt") + 1)})
    return out


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    """The rows of every table of a run without interruption."""
    result = pipeline.run(shared(spark, SF001), str(tmp_path_factory.mktemp("whole") / "ecl"))
    return {name: rows(df) for name, df in result.tables.items()}


def test_a_rejected_rerun_leaves_the_accepted_quarter(spark, tmp_path):
    b, out = shared(spark, SF001), str(tmp_path / "ecl")
    first = pipeline.run(b, out)
    kept = rows(first.tables["summary"])
    with pytest.raises(RuntimeError, match="feed.loan_count"):
        pipeline.run(wrong_loans(b), out)
    s = Store(spark, out, b.cfg)
    assert s.accepted().name == first.run
    assert [r.verdict for r in s.runs()] == ["accepted", "rejected"]
    assert rows(first.tables["summary"]) == kept
    assert rows(Book.from_published(spark, out, b.cfg.as_of).wavg) == rows(b.wavg)
    # the evidence lies beside it
    bad = s.runs()[-1]
    checks = s.read("checks", first.checks.schema, bad).filter("verdict = 'FAIL'").collect()
    assert {r.check_id for r in checks} == {"feed.loan_count", "overall"} and bad.tables["summary"] == 9


@pytest.mark.parametrize("until", ["feed", "loss"])
def test_an_interrupted_run_goes_on_with_what_it_has(spark, tmp_path, until, monkeypatch, whole):
    b, out = shared(spark, SF001), str(tmp_path / "ecl")
    s = Store(spark, out, b.cfg)
    left = s.take_up(b.cfg, b.input_state)
    pipeline.stage(b.fork(), s, left, until=until)
    done = {n for p in list(pipeline.PHASES)[:list(pipeline.PHASES).index(until) + 1] for n in pipeline.PHASES[p]}
    made = []
    real = store.write_table
    monkeypatch.setattr(store, "write_table", lambda df, path: (made.append((path, df)), real(df, path))[1])
    # the book of the second attempt has no feed of its own
    fresh = Book.from_driver_tables(spark, SF001, DEFAULT)
    result = pipeline.run(fresh, out)
    assert result.run == left.name and "_feed_both" not in fresh.__dict__
    assert {p.split("/as_of=")[0].rsplit("/", 1)[-1] for p, _ in made} == set(result.rows) - done | {"checks"}
    # later phases read published tables, not loans
    for path, df in made:
        if "/checks/" not in path:
            assert "orders.parquet" not in " ".join(df.inputFiles())
    assert {name: rows(df) for name, df in result.tables.items()} == whole


def test_a_book_begins_at_any_phase_without_loans(spark, tmp_path):
    b, out = shared(spark, SF001), str(tmp_path / "ecl")
    want = {"wavg": rows(b.wavg), "loss": rows(b.loss.drop("cohort_end")), "current": rows(b.current)}
    for until in pipeline.PHASES:
        s = Store(spark, f"{out}/{until}", b.cfg)
        run = s.take_up(b.cfg, None)
        pipeline.stage(b.fork(), s, run, until=until)
        got = Book.from_published(spark, f"{out}/{until}", b.cfg.as_of, run.name)
        assert got.loans is None and got.cfg == b.cfg
        assert rows(got.wavg) == want["wavg"] and rows(got.current) == want["current"]
        assert rows(got.loss.select(*[c for c in b.loss.columns if c != "cohort_end"])) == want["loss"]
        assert got.wavg.select("segment", "window").count() == len(want["wavg"])
        if until != "feed":
            plan = got.loss._jdf.queryExecution().executedPlan().toString()
            assert "/feed/" not in plan and "orders" not in plan


def test_nothing_to_begin_at(spark, tmp_path):
    out = str(tmp_path / "ecl")
    with pytest.raises(LookupError):
        Book.from_published(spark, out, DEFAULT.as_of)
    s = Store(spark, out, DEFAULT)
    run = s.take_up(DEFAULT, "x")
    s.note(run, store.WRITTEN, "summary", 9)
    assert s.take_up(DEFAULT, "x").name == run.name       # unfinished: taken up
    with pytest.raises(LookupError):
        Book.from_published(spark, out, DEFAULT.as_of, run.name)
    s.note(run, store.REJECTED)
    assert s.take_up(DEFAULT, "x").name != run.name       # its verdict stands
    assert Store(spark, out, date(2001, 9, 30)).runs() == []


def test_fingerprints(spark, tmp_path):
    assert store.config_from_text(store.config_text(YOUNG_BOOK)) == YOUNG_BOOK
    assert store.fingerprint(DEFAULT, "x") == store.fingerprint(DEFAULT, "x")
    assert len({store.fingerprint(c, s) for c in (DEFAULT, YOUNG_BOOK) for s in ("x", "y", None, None)}) == 8
    path = str(tmp_path / "a b=1")
    spark.range(5).write.parquet(path)
    one = store.input_state(spark, spark.read.parquet(path).where("id > 2"))
    assert one == store.input_state(spark, spark.read.parquet(path)) and one is not None
    spark.range(1).write.mode("append").parquet(path)
    assert store.input_state(spark, spark.read.parquet(path)) != one
    assert store.input_state(spark, spark.range(3)) is None


def test_an_extract_is_known_again(spark, tmp_path):
    loans, perf = extract_of(shared(spark, SF001))
    loans.write.parquet(str(tmp_path / "loans"))
    perf.write.parquet(str(tmp_path / "perf"))
    read = [spark.read.parquet(str(tmp_path / n)) for n in ("loans", "perf")]
    a, b = Book.from_extract(*read, DEFAULT), Book.from_extract(*read, DEFAULT)
    assert a.input_state == b.input_state is not None
