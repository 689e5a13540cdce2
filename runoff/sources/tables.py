"""Loan book sources.

Two input tables, the same shape as a bank warehouse extract:

``loans``        one row per loan: loan_no, customer_id, segment,
                 disbursal_date (DATE), amount_cents (BIGINT minor units),
                 tenure_months
``performance``  one row per loan x observed month on book: loan_no, mob,
                 tpos_cents, dpd90_cents

They are read from parquet with a fixed schema, from catalog tables, from the
warehouse over JDBC (partitioned), or from the warehouse's extract with text
keys, ISO dates and rupee amounts.  An extract's row with a date, number or
amount that cannot be read does not end the run: it is kept apart with the
reason (``rejected_rows``), and the run goes on with the others.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runoff.sources.ranges import range_cuts, range_predicates

LOANS_SCHEMA = T.StructType([
    T.StructField("loan_no", T.LongType(), False),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("segment", T.IntegerType(), False),
    T.StructField("disbursal_date", T.DateType(), False),
    T.StructField("amount_cents", T.LongType(), False),
    T.StructField("tenure_months", T.IntegerType(), False),
])

PERFORMANCE_SCHEMA = T.StructType([
    T.StructField("loan_no", T.LongType(), False),
    T.StructField("mob", T.IntegerType(), False),
    T.StructField("tpos_cents", T.LongType(), False),
    T.StructField("dpd90_cents", T.LongType(), False),
])

PERF_COLS = [f.name for f in PERFORMANCE_SCHEMA.fields]
LOAN_COLS = [f.name for f in LOANS_SCHEMA.fields]


# ----------------------------------------------------------------- readers
def read_loans(spark: SparkSession, path: str) -> DataFrame:
    """Parquet loan table with a fixed schema (no inference)."""
    return spark.read.schema(LOANS_SCHEMA).parquet(path)


def read_performance(spark: SparkSession, path: str) -> DataFrame:
    """Long performance table; callers select only the columns they use,
    so the scan is pruned to them."""
    return spark.read.schema(PERFORMANCE_SCHEMA).parquet(path)


def jdbc_options(url: str, table: str, key: str, parts: int, numeric_bounds: tuple[int, int] | None = None) -> dict:
    """Options of a partitioned read: split into ``parts`` ranges of a numeric
    key between its bounds; without bounds Spark reads one partition."""
    own = {"url": url, "dbtable": table}
    if numeric_bounds:
        own |= {"partitionColumn": key, "lowerBound": str(numeric_bounds[0]),
                "upperBound": str(numeric_bounds[1]), "numPartitions": str(parts)}
    return own


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, parts: int,
              numeric_bounds: tuple[int, int] | None = None, key_sample: DataFrame | None = None,
              properties: dict | None = None) -> DataFrame:
    """S1 / S2 from the warehouse, loans or performance, split on the loan
    key: by bounds of a numeric one, or into ranges that hold alike many of
    the keys in ``key_sample`` (a table with a column ``key``, numbers or text,
    such as the loans or those of the quarter before)."""
    if key_sample is not None:
        cuts = range_cuts(key_sample, key, parts)
        return spark.read.jdbc(url, table, predicates=range_predicates(key, cuts), properties=properties or {})
    return spark.read.format("jdbc").options(
        **jdbc_options(url, table, key, parts, numeric_bounds), **(properties or {})).load()


# ------------------------------------------------------------ the warehouse's extract
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _whole_number(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, _INTEGRAL):
        return c.try_cast("int")
    exact = c.try_cast("decimal(20,6)")
    return F.when(exact == F.floor(exact), exact).try_cast("int")


def _cents(c: Column, kind: T.DataType, cents: Column | None = None) -> Column:
    """Whole cents of a rupee amount, half up, exact in decimals.  Decimals are
    slow; where the double's cents are within a quarter of a whole number (its
    own error is below a hundredth), that number is what decimals give.
    ``cents``: that double, where it is at hand."""
    exact = F.round(c.try_cast("decimal(24,6)") * 100, 0).try_cast("long")
    if not isinstance(kind, (T.DoubleType, T.StringType)):
        return exact
    if cents is None:
        cents = c.try_cast("double") * 100
    near = (F.abs(cents) < 1e12) & (F.abs(cents - F.rint(cents)) < 0.25)
    if isinstance(kind, T.StringType):
        # no amounts, though they are doubles: 12d, 12f, 0x1p3
        near &= F.substring(c, -1, 1).between("0", "9") & ~c.contains("x") & ~c.contains("X")
    return F.when(near, F.rint(cents).cast("long")).otherwise(exact)


#: How a field's text is read, and what is wrong with text that cannot be.
KINDS = {
    "text": (lambda c, _: c.cast("string"), "not a text"),
    "number": (_whole_number, "not a whole number"),
    "date": (lambda c, _: F.try_to_date(c.cast("string"), "yyyy-MM-dd"), "not a date"),
    "amount": (_cents, "not an amount"),
}
#: (field, column of the extract, kind)
LOANS_EXTRACT = (
    ("loan_no", "distinct_loan_no", "text"), ("customer_id", "customer_id", "text"), ("segment", "segment", "number"),
    ("disbursal_date", "disbursal_date", "date"), ("amount_cents", "disbursal_amount", "amount"),
    ("tenure_months", "tenure_months", "number"))
PERFORMANCE_EXTRACT = (
    ("loan_no", "distinct_loan_no", "text"), ("mob", "mob", "number"), ("tpos_cents", "tpos", "amount"),
    ("dpd90_cents", "amt_90plus_settlement", "amount"))


def _read(extract: DataFrame, fields) -> dict[str, Column]:
    """The fields as they can be read; the rest is NULL."""
    return {field: KINDS[kind][0](F.col(source), extract.schema[source].dataType) for field, source, kind in fields}


def _marked(extract: DataFrame, fields, keep) -> DataFrame:
    """The columns ``keep(read)``, whether a row has text that cannot be read
    (``_bad``: more fields are NULL than have none), and its place (``_at``).
    A filter that also asks for the place stays above this step, so a field is
    read once for each row, not once more for the filter."""
    amounts = [(field, source) for field, source, kind in fields
               if kind == "amount" and isinstance(extract.schema[source].dataType, (T.DoubleType, T.StringType))]
    step = extract.select("*", *[(F.col(source).try_cast("double") * 100).alias(f"_cents_{field}")
                                 for field, source in amounts])
    read = _read(extract, fields) | {field: _cents(F.col(source), extract.schema[source].dataType, F.col(f"_cents_{field}"))
                                     for field, source in amounts}
    nulls = lambda columns: reduce(lambda a, b: a + b, [F.isnull(c).cast("int") for c in columns])
    bad = nulls(read.values()) > nulls([F.col(source) for _, source, _ in fields])
    return step.select(*keep(read), bad.alias("_bad"), F.monotonically_increasing_id().alias("_at"))


def _parsed(extract: DataFrame, fields) -> DataFrame:
    """The fields as they can be read (the rest NULL), and ``_bad``: those
    that have text which cannot.  A field without text is NULL and not bad."""
    read = _read(extract, fields)
    bad = F.array(*[F.when(F.col(source).isNotNull() & read[field].isNull(), F.struct(
        F.lit(source).alias("field"), F.col(source).cast("string").alias("raw"), F.lit(KINDS[kind][1]).alias("reason")))
        for field, source, kind in fields])
    return extract.select(*[c.alias(field) for field, c in read.items()], F.array_compact(bad).alias("_bad"))


def _valid(extract: DataFrame, fields) -> DataFrame:
    """The rows without such a field.  Most rows are: no list is made for them."""
    marked = _marked(extract, fields, lambda read: [c.alias(field) for field, c in read.items()])
    return marked.filter(~F.col("_bad") & (F.col("_at") >= 0)).drop("_bad", "_at")


def loans_from_extract(extract: DataFrame) -> DataFrame:
    """Loans with text keys, ISO text dates and rupee amounts as the loan
    table; the key stays text (it is only grouped and joined on).  Rows with
    a field that cannot be read are left to :func:`rejected_rows`."""
    return _valid(extract, LOANS_EXTRACT)


def performance_from_extract(extract: DataFrame) -> DataFrame:
    return _valid(extract, PERFORMANCE_EXTRACT)


def rejected_rows(loans: DataFrame, perf: DataFrame) -> DataFrame:
    """The rows of both extracts that are not taken: table_name, row_id (of
    the row, whatever its key), loan_no, field, raw text and reason, a row for
    each field that cannot be read."""
    def of(name: str, extract: DataFrame, fields) -> DataFrame:
        source = [F.col(c).cast("string") for _, c, _ in fields]
        # equal rows are told apart by place only, and stay apart; only the few bad ones need an id
        bad = _marked(extract, fields, lambda _: [c for _, c, _ in fields]).filter(F.col("_bad") & (F.col("_at") >= 0))
        tagged = _parsed(bad.drop("_bad").withColumn("_id", F.concat_ws(":", F.xxhash64(*source), "_at")),
                         (*fields, ("row_id", "_id", "text")))
        return (tagged.filter(F.size("_bad") > 0).select("row_id", "loan_no", F.explode("_bad").alias("b"))
                .select(F.lit(name).alias("table_name"), "row_id", "loan_no", "b.*"))

    return of("loans", loans, LOANS_EXTRACT).unionByName(of("performance", perf, PERFORMANCE_EXTRACT))


def read_any(spark: SparkSession, place: str) -> DataFrame:
    """A parquet path (it has a slash) or a catalog table."""
    return spark.read.parquet(place) if "/" in place else spark.table(place)
