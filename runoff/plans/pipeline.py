"""The whole quarterly run: compute, stage phase tables, validate, accept.

The phase tables are staged beside those of other runs (``plans.store``):
their rows are counted while they are written and again when they are read
back (S3, S4, S7), and the staged summary is held against the staged loss
table (R11).  The checks are staged with the rest (S5).  Only a run without a
FAIL is accepted, by one entry of the journal; a FAIL raises and leaves the
accepted quarter as it was, with the evidence beside it (R8).  A run that was
interrupted goes on with the tables that it has.

On a cluster, with the master and resources that spark-submit gives:

    spark-submit --py-files runoff.zip run.py --loans risk.loans --perf risk.performance \
        --bucketed --out s3a://lake/ecl --checkpoint s3a://lake/tmp

where run.py calls :func:`main`; ``--extract`` reads the warehouse's extract
(text keys, ISO dates, rupees) instead of the internal tables.
"""
from __future__ import annotations

import argparse
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runoff.config import DEFAULT
from runoff.operators import checks, feed, report, triangle
from runoff.plans.book import STATE, Book
from runoff.plans.store import ACCEPTED, REJECTED, Run, Store
from runoff.sources.tables import read_any


@dataclass
class RunResult:
    status: str
    tables: dict[str, DataFrame]       # read back from storage
    checks: DataFrame
    rows: dict[str, tuple[int, int]]   # written, read back
    run: str                           # its name in the journal


#: What each phase of a run leaves behind; a run can start again after any of them.
PHASES = {"feed": ("feed_state", "feed", "feed_disbursal", "feed_wide"), "triangles": ("triangles", "movements"),
          "loss": ("loss", "by_quarter"), "weighted": ("weighted", "summary")}


def phase_tables(book: Book, phase: str | None = None) -> dict[str, DataFrame]:
    """The tables of one phase, or of all."""
    cfg = book.cfg
    lab = triangle.label_cols
    make = {
        "feed_state": lambda: book.sums.select(*lab(), "segment", "mob", *feed.SUMS),
        "feed": lambda: book.feed.select(*lab(), "segment", "mob", "dpd90_uc", "tpos_uc"),
        "feed_disbursal": lambda: book.disb.select(*lab(), "segment", "lan_cnt", "disb_uc"),
        "feed_wide": lambda: feed.feed_wide(book.feed, book.disb, cfg),
        "triangles": lambda: triangle.with_rates(book.triangles).select(
            "segment", *lab(), "mob", "is_observed", "disb_cr", "dpd90_amt", "dpd90_rate", "tpos_amt", "tpos_rate",
            "lan_cnt", "disb_uc", "max_mature_mob", "dpd90_uc", "tpos_uc"),
        "movements": lambda: book.movements.select("segment", *lab(), "mob", "disb_cr", "tpos_amt",
                                                   "tpos_pct", "dpd90_amt", "dpd90_pct"),
        "loss": lambda: book.loss.select("segment", *lab(), "anchor_mob", "disb_cr", "ninety_plus", "tpos_sum",
                                         "denominator", "loss_rate", "anchor_observed"),
        "by_quarter": lambda: report.loss_rate_report(book.loss.filter("segment = 'all'"),
                                                      book.current.filter("segment = 'all'"), cfg),
        "weighted": lambda: book.wavg,
        "summary": lambda: report.summary(book),
    }
    out = {name: make[name]() for p in PHASES if phase in (None, p) for name in PHASES[p]}
    if book.rejects is not None and phase in (None, "feed"):
        out["rejected_rows"] = book.rejects
    return out


def stage(book: Book, store: Store, run: Run, until: str | None = None) -> tuple[dict[str, DataFrame], dict[str, tuple[int, int]]]:
    """The phase tables staged and read back, phase by phase, to ``until`` or
    the end; rows written and read, by table.  Each phase goes on from the
    staged tables of those before it, so ``book`` is restored to them."""
    back, rows = {}, {}
    for phase in PHASES:
        tables = phase_tables(book, phase)
        written = store.stage(run, tables)
        back |= {name: store.read(name, df.schema, run) for name, df in tables.items()}
        rows |= {name: (written[name], back[name].count()) for name in tables}
        book.restore({name: back[name] for name in tables if name in STATE})
        if phase == until:
            break
    return back, rows


def publish(book: Book, out: str) -> tuple[dict[str, DataFrame], dict[str, tuple[int, int]]]:
    """The phase tables of a new run, staged and read back."""
    store = Store(book.spark, out, book.cfg)
    return stage(book.fork(), store, store.take_up(book.cfg, None))


def sink_measures(spark: SparkSession, rows: dict[str, tuple[int, int]]) -> DataFrame:
    """Rows written and not read back, or read and not written, by table."""
    return spark.createDataFrame([(f"sink.rows:{k}", float(abs(a - b))) for k, (a, b) in sorted(rows.items())],
                                 "check_id string, measure double")


def rejected_measure(rejects: DataFrame) -> DataFrame:
    """Rows of the extract that were not taken."""
    rows = rejects.agg(F.count_distinct("table_name", "row_id").alias("n"))
    return checks.measures(rows, {"source.rejected_rows": "n"})


def run(book: Book, out: str, gate: bool = True) -> RunResult:
    """Stages, validates and accepts a run, or goes on with the unfinished one
    of the same configuration and input.  ``gate``: whether a FAIL raises; it
    is never accepted."""
    spark, cfg = book.spark, book.cfg
    store = Store(spark, out, cfg)
    own = store.take_up(cfg, book.input_state)
    book = book.fork()
    book.restore({name: store.read(name, T.StructType.fromDDL(STATE[name]), own) for name in STATE if name in own.tables})
    back, rows = stage(book, store, own)
    taken = reduce(DataFrame.unionByName, [
        checks.run_measures(book), checks.whole_run_measure(book),
        checks.published_rate_measure(back["summary"], back["loss"], cfg), sink_measures(spark, rows),
        *([rejected_measure(back["rejected_rows"])] if "rejected_rows" in back else [])])
    verdicts = checks.with_overall(checks.judge(taken, cfg))
    store.stage(own, {"checks": verdicts})
    published = store.read("checks", verdicts.schema, own)
    status = published.filter("check_id = 'overall'").first()["verdict"]
    store.note(own, REJECTED if status == "FAIL" else ACCEPTED)
    if gate:
        checks.gate(published)
    return RunResult(status, back, published, rows, own.name)


def main(argv=None) -> RunResult:
    ap = argparse.ArgumentParser(description="Quarterly ECL run on Spark")
    ap.add_argument("--loans", help="loan table: parquet path or catalog table")
    ap.add_argument("--perf", help="performance table: parquet path or catalog table")
    ap.add_argument("--extract", action="store_true", help="the tables have the warehouse extract's shape")
    ap.add_argument("--bucketed", action="store_true", help="the tables are bucketed by loan_no")
    ap.add_argument("--roll-from", type=date.fromisoformat, help="roll the accepted run of this date forward; --perf is "
                    "a table by period")
    ap.add_argument("--sf-dir", help="instead of a book: folder of the test tables")
    ap.add_argument("--out", required=True, help="folder of the published tables")
    ap.add_argument("--checkpoint", help="shared folder for intermediate tables (else spark.checkpoint.dir)")
    ap.add_argument("--as-of", type=date.fromisoformat, default=DEFAULT.as_of)
    ap.add_argument("--start", type=date.fromisoformat, default=DEFAULT.start)
    a = ap.parse_args(argv)
    if bool(a.sf_dir) == bool(a.loans and a.perf):
        ap.error("give either --loans and --perf, or --sf-dir")
    spark = SparkSession.builder.appName("runoff").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if a.checkpoint:
        spark.sparkContext.setCheckpointDir(a.checkpoint)
    cfg = DEFAULT.with_(as_of=a.as_of, start=a.start)
    if a.sf_dir:
        book = Book.from_driver_tables(spark, a.sf_dir, cfg)
    else:
        loans, perf = read_any(spark, a.loans), read_any(spark, a.perf)
        book = (Book.from_extract(loans, perf, cfg) if a.extract
                else Book.roll_from(spark, a.out, a.roll_from, loans, perf, cfg) if a.roll_from
                else Book(spark, loans, perf, cfg, loan_buckets=a.bucketed))
    result = run(book, a.out)
    result.tables["weighted"].filter("segment = 'all'").show(truncate=False)
    result.checks.show(100, truncate=False)
    print("validation:", result.status)
    book.release()
    return result


if __name__ == "__main__":
    main()
