"""Fixture: the driver's ``orders`` table as a loan book (FIXTURES.md).

Orders play the loans; tenure and default attributes are hashes of the key,
and the performance history is the deterministic amortisation schedule of
each loan (X1-X5).  Nothing here is needed for a real book.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runoff.config import (DEFAULT_HASH_MULT, DEFAULT_MOB_HASH_MULT,
                           DEFAULT_MOB_SPREAD_LONG,
                           DEFAULT_MOB_SPREAD_REFERENCE_LIKE,
                           SEGMENT_DEFAULT_PER_MILLE, EclConfig)
from runoff.functions.calendar import whole_months
from runoff.functions.joins import grid_column

# the columns of the driver's orders table that the loan mapping reads
ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType()),
])

#: Loans that one task expands and holds.  A loan becomes some forty rows: left
#: to itself, Spark sizes the tasks by the loans' bytes, before they are expanded.
LOANS_A_TASK = 25_000


def orders_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/orders.parquet"


def _default_per_mille(segment):
    expr = None
    for seg, pm in SEGMENT_DEFAULT_PER_MILLE.items():
        expr = (F.when(segment == seg, F.lit(pm)) if expr is None
                else expr.when(segment == seg, F.lit(pm)))
    return expr.otherwise(F.lit(0))


def loans_from_orders(orders: DataFrame, cfg: EclConfig) -> DataFrame:
    """``orders`` mapped onto the loan table, plus the deterministic default
    attributes that drive the performance schedule (is_default, default_mob)."""
    key = F.col("o_orderkey")
    segment = F.substring("o_orderpriority", 1, 1).cast("int")
    if cfg.tenor == "long":
        tenure = (F.lit(24) * (F.lit(1) + key % 6)).cast("int")
        spread = DEFAULT_MOB_SPREAD_LONG
    else:
        tenure = (F.lit(12) * (F.lit(1) + key % 5)).cast("int")
        spread = DEFAULT_MOB_SPREAD_REFERENCE_LIKE
    return orders.select(
        key.alias("loan_no"),
        F.col("o_custkey").alias("customer_id"),
        segment.alias("segment"),
        F.col("o_orderdate").cast("date").alias("disbursal_date"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("amount_cents"),
        tenure.alias("tenure_months"),
        ((key * DEFAULT_HASH_MULT) % 1000 < _default_per_mille(segment)).alias("is_default"),
        F.least(F.lit(3) + (key * DEFAULT_MOB_HASH_MULT) % spread, tenure).cast("int")
        .alias("default_mob"))


def driver_loans(spark: SparkSession, sf_dir: str, cfg: EclConfig) -> DataFrame:
    return loans_from_orders(spark.read.schema(ORDERS_SCHEMA).parquet(orders_path(sf_dir)), cfg)


# ------------------------------------------ schedule expansion
def _amortised(amount, tenure, mob):
    """Exact half-up ``amount * (tenure - mob) / tenure`` in minor units."""
    return F.expr(f"({amount} * ({tenure} - {mob}) * 2 + {tenure}) div (2 * {tenure})")


def default_exposure(loans: DataFrame) -> DataFrame:
    """Balance outstanding at default (0 if the default month is at or after
    maturity) for each defaulted loan."""
    return (loans.filter("is_default")
            .select("loan_no", "segment", "tenure_months", "default_mob",
                    F.when(F.col("default_mob") < F.col("tenure_months"),
                           _amortised("amount_cents", "tenure_months", "default_mob"))
                    .otherwise(F.lit(0).cast("long")).alias("oad_cents")))


def loan_tasks(loans: DataFrame) -> int:
    """Tasks for the rows of these loans: as many more as there are more loans."""
    return max(math.ceil(loans.count() / LOANS_A_TASK), loans.sparkSession.sparkContext.defaultParallelism)


def performance_from_loans(loans: DataFrame, cfg: EclConfig) -> DataFrame:
    """X1 + X2 + X4 (+ X5): loan x observed-MOB rows.

    Each loan expands to the extraction grid up to its age at the as-of date
    (only observed months exist); TPOS amortises linearly to zero at tenure,
    the 90+ amount is the balance at default, carried forward from the
    default month.  The loans are dealt out by key, so many to a task that
    what is made of them fits its memory; their expansion is narrow.
    """
    g = cfg.extract_grid
    # spread the loans first, by the key they are joined on
    loans = loans.repartition(loan_tasks(loans), "loan_no")
    age = whole_months("disbursal_date", cfg.as_of)
    oad = F.when(F.col("is_default") & (F.col("default_mob") < F.col("tenure_months")),
                 _amortised("amount_cents", "tenure_months", "default_mob")).otherwise(F.lit(0))
    base = (loans.filter(age >= g.start)
            .select("loan_no", "amount_cents", "tenure_months", "is_default", "default_mob",
                    oad.cast("long").alias("_oad"),
                    grid_column(g, upto=age).alias("mob")))
    tpos = F.when(F.col("mob") >= F.col("tenure_months"), F.lit(0).cast("long")).otherwise(
        _amortised("amount_cents", "tenure_months", "mob"))
    defaulted = F.col("is_default") & (F.col("mob") >= F.col("default_mob"))
    dpd90 = F.when(defaulted, F.col("_oad")).otherwise(F.lit(0).cast("long"))
    if cfg.freeze_tpos_at_default:
        tpos = F.when(defaulted, F.col("_oad")).otherwise(tpos)
    return base.select("loan_no", F.col("mob").cast("int").alias("mob"),
                       tpos.cast("long").alias("tpos_cents"),
                       dpd90.cast("long").alias("dpd90_cents"))
