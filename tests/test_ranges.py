import pytest
from pyspark.sql import functions as F

from runoff.sources import ranges


def test_predicates():
    assert ranges.range_predicates("k", ["M", "D'x"]) == [
        "k < 'D''x'", "k >= 'D''x' AND k < 'M'", "k >= 'M'", "k IS NULL"]
    assert ranges.range_predicates("k", [30, 7]) == ["k < 7", "k >= 7 AND k < 30", "k >= 30", "k IS NULL"]
    assert ranges.range_predicates("k", []) == ["1 = 1"]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_ranges_are_even_however_the_keys_are_spread(spark, kind):
    # nine keys of ten in a hundredth of the span; one key a third of all rows; some without key
    n = F.col("id")
    spread = F.when(n % 10 < 9, n).otherwise(n * 100)
    keys = spark.range(40_000).select((spread if kind == "long" else F.concat(F.lit("L'"), F.lpad(spread.cast("string"), 9, "0"))).alias("k"))
    rows = keys.union(keys.limit(1).join(spark.range(20_000)).select("k")).union(keys.limit(5).select(F.lit(None).cast(kind)))
    cuts = ranges.range_cuts(rows, "k", 16)
    assert len(cuts) == 15 and cuts == sorted(set(cuts)) == ranges.range_cuts(rows.repartition(7), "k", 16)
    told = rows.distinct().select("k", ranges.range_of(F.col("k"), cuts).alias("r"))
    sizes = {r["r"]: r["count"] for r in told.groupBy("r").count().collect()}
    assert sizes.pop(None) == 1 and set(sizes) == set(range(16))
    assert max(sizes.values()) < 2 * 40_000 / 16 and min(sizes.values()) > 0.5 * 40_000 / 16
    # the WHERE clauses and the condition say the same as the number
    clauses = ranges.range_predicates("k", cuts)
    hits = told.select("r", *[F.expr(c).cast("int").alias(f"c{i}") for i, c in enumerate(clauses)])
    assert hits.filter(sum(F.coalesce(f"c{i}", F.lit(0)) for i in range(len(clauses))) != 1).isEmpty()
    assert hits.filter(sum(F.when(F.coalesce(f"c{i}", F.lit(0)) == 1, i).otherwise(0) for i in range(len(clauses)))
                       != F.coalesce("r", F.lit(16))).isEmpty()
    for wanted in ([], [0], [15], [None, 3, 4, 9], [None]):
        got = told.filter(ranges.in_ranges(F.col("k"), cuts, wanted)).agg(F.collect_set(F.coalesce("r", F.lit(-1)))).first()[0]
        assert sorted(got) == sorted(-1 if x is None else x for x in wanted)


def test_few_keys_and_none(spark):
    few = spark.createDataFrame([(3,), (1,), (None,), (3,)], "k long")
    assert ranges.range_cuts(few, "k", 8) == [3]
    assert ranges.range_cuts(few.filter("k is null"), "k", 8) == []
    assert [r[0] for r in few.select(ranges.range_of(F.col("k"), [])).collect()] == [0, 0, None, 0]
