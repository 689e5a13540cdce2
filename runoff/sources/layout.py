"""Storage layout for the two loan-level tables at scale.

The feed's only heavy operator is the join of ``performance`` (~40 rows per
loan) with ``loans`` on the loan key.  Written once as tables bucketed and
sorted by ``loan_no`` with the same bucket count, both sides are read already
co-partitioned: the join runs with no exchange of either table, and only the
(cohort, segment, mob) partial aggregates are shuffled.

A bucketed scan gives one task per bucket, so a bucket is what one task must
hold and sort: choose the count so that a bucket of ``performance`` has some
256-512 MB (100 TB: 200-400 thousand buckets, one file each; where that many
files are too many, 1 GB buckets and as much more memory per task).  Rows are
partitioned by the bucket key before they are written, so a bucket is one
file, whatever the number of tasks that read the source.

A quarter adds a thirtieth of the performance rows or less.  Where runs roll
forward (``Book.roll_from``) or windows leave cohorts out, the table is better
kept by period: partitioned by the quarter in which a row became known, and
sorted by the loan's cohort within.  A run then reads only the partitions since
the last one, and only the row groups of its disbursal window.  (The two
layouts exclude each other: a bucketed table's files hold all periods.)
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runoff.functions.calendar import cohort_end
from runoff.functions.joins import with_loan
from runoff.session import without_shuffles
from runoff.sources.tables import LOAN_COLS, PERF_COLS

#: Loans that one task writes of a table by period, at least and at most: those of
#: a few cohorts, or a slice of a large cohort's.
LOANS_A_TASK, LOANS_A_SLICE = 25_000, 100_000


def write_bucketed(df: DataFrame, table: str, buckets: int, key: str = "loan_no") -> None:
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def publish_book(loans: DataFrame, perf: DataFrame, loans_table: str, perf_table: str,
                 buckets: int) -> None:
    """Write both tables with the same bucketing on the loan key."""
    write_bucketed(loans.select(*LOAN_COLS), loans_table, buckets)
    write_bucketed(perf.select(*PERF_COLS), perf_table, buckets)


def by_period(perf: DataFrame, loans: DataFrame) -> DataFrame:
    """Performance with its loan's ``cohort_end``, and ``period``: the end of
    the quarter in which the row's month on book falls.  Rows without a loan
    have neither, and no run needs them."""
    return _dated(with_loan(perf.select(*PERF_COLS), loans.select("loan_no", "disbursal_date")))


def _dated(rows: DataFrame) -> DataFrame:
    known = F.add_months(F.trunc("disbursal_date", "month"), F.col("mob"))
    return rows.select(*PERF_COLS, cohort_end("disbursal_date").alias("cohort_end"), cohort_end(known).alias("period"))


def _dealt(loans: DataFrame):
    """(writers, number): how many tasks write the table, and the number from 0
    of the one that has a loan.  Cohorts in order fill a task, large ones are
    cut in even slices; the calendar bounds how many cohorts there are."""
    cohort = cohort_end("disbursal_date").cast("string")
    counts = {r[0]: r[1] for r in loans.groupBy(cohort).count().collect()}
    each = math.ceil(sum(counts.values()) / loans.sparkSession.sparkContext.defaultParallelism)
    most = min(LOANS_A_SLICE, max(LOANS_A_TASK, each))
    slices = {c: math.ceil(counts[c] / most) for c in sorted(counts, key=lambda c: (c is not None, c or ""))}
    first, writers, room = {}, 0, 0
    for c, n in slices.items():
        if n > 1 or room < counts[c]:
            first[c], writers, room = writers, writers + n, most - counts[c] if n == 1 else 0
        else:
            first[c], room = writers - 1, room - counts[c]
    place = F.create_map(*[F.lit(x) for c in first if c is not None for x in (c, f"{first[c]},{slices[c]}")] or [F.lit(""), F.lit("")])
    place = F.split(F.coalesce(F.try_element_at(place, cohort), F.lit("0,1")), ",")
    return max(writers, 1), place[0].cast("int") + F.pmod(F.xxhash64("loan_no"), place[1].cast("long")).cast("int")


def write_by_period(perf: DataFrame, loans: DataFrame, path: str) -> None:
    """A task writes the rows of a few cohorts' loans, or of a slice of them
    that it can sort in memory, so a file spans few cohorts.  On the way there
    a loan's rows are one row of arrays: a third of the bytes of rows apart."""
    own = loans.select("loan_no", "disbursal_date")
    writers, number = _dealt(own)
    rows = with_loan(perf.select(*PERF_COLS), own)
    fields = [c for c in PERF_COLS if c != "loan_no"]
    packed = (rows.groupBy("loan_no", "disbursal_date").agg(F.collect_list(F.struct(*fields)).alias("_rows"))
              .select("loan_no", "disbursal_date", *[F.col("_rows")[c].alias(c) for c in fields])
              .repartitionById(writers, number))
    rows = (packed.select("loan_no", "disbursal_date", F.explode(F.arrays_zip(*fields)).alias("_row"))
            .select("loan_no", "disbursal_date", *[F.col("_row")[c].alias(c) for c in fields]))
    # encoded as differences: a period's loans are in order
    with without_shuffles(perf.sparkSession):
        (_dated(rows).sortWithinPartitions("period", "cohort_end", "loan_no").write.partitionBy("period")
         .option("parquet.writer.version", "PARQUET_2_0").option("compression", "zstd").parquet(path))
