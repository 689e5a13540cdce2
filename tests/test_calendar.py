from datetime import date

import pytest
from pyspark.sql import functions as F

from runoff.config import (EclConfig, MobGrid, MobList, fiscal_quarter_first_day, fiscal_quarter_last_day,
                           SegmentRequest, DEFAULT, fiscal_year_of, segment_of)
from runoff.functions.calendar import (cohort_end, fiscal_quarter_label, max_mature_mob,
                                       whole_months)

CASES = [
    (date(1999, 3, 31), "FY99-Q4", date(1999, 3, 31)),
    (date(1999, 4, 1), "FY00-Q1", date(1999, 6, 30)),
    (date(1999, 12, 31), "FY00-Q3", date(1999, 12, 31)),
    (date(2000, 1, 1), "FY00-Q4", date(2000, 3, 31)),
    (date(2000, 2, 29), "FY00-Q4", date(2000, 3, 31)),
    (date(1999, 11, 3), "FY00-Q3", date(1999, 12, 31)),
    (date(2000, 7, 15), "FY01-Q2", date(2000, 9, 30)),
]


def test_fiscal_quarter_label_and_cohort_end(spark):
    df = spark.createDataFrame([(d,) for d, _, _ in CASES], "d date")
    got = df.select("d", fiscal_quarter_label("d").alias("l"), cohort_end("d").alias("e")).collect()
    exp = {d: (l, e) for d, l, e in CASES}
    for r in got:
        assert (r["l"], r["e"]) == exp[r["d"]]


def test_century_safe_ordering(spark):
    # FY00 sorts after FY99 because the key is the cohort end date, not the label
    df = spark.createDataFrame([(date(1999, 3, 1),), (date(1999, 5, 1),)], "d date")
    keys = [r[0] for r in df.select(cohort_end("d")).orderBy(cohort_end("d")).collect()]
    assert keys == sorted(keys) and keys[0].year == 1999 and keys[1] == date(1999, 6, 30)


def test_whole_months_ignores_day_and_max_mature(spark):
    g = MobGrid(3, 120, 3)
    df = spark.createDataFrame([(date(2006, 3, 1),), (date(2005, 12, 31),), (date(2006, 1, 31),),
                                (date(1995, 3, 31),)], "d date")
    m = whole_months("d", date(2006, 3, 31))
    r = df.select(m.alias("m"), max_mature_mob(m, g).alias("mm")).collect()
    assert [(x.m, x.mm) for x in r] == [(0, -1), (3, 3), (2, -1), (132, 120)]


def test_fiscal_bounds_and_argument_normalisation():
    assert fiscal_quarter_first_day(1997, 1) == date(1996, 4, 1)
    assert fiscal_quarter_last_day(2000, 4) == date(2000, 3, 31)
    assert fiscal_quarter_last_day(2000, 3) == date(1999, 12, 31)
    for x in (97, "97", "FY97", 1997, "FY1997", "FY97-Q1", " fy97 "):
        assert fiscal_year_of(x) == 1997
    assert fiscal_year_of("FY01") == 2001 and fiscal_year_of(49) == 2049 and fiscal_year_of(50) == 1950
    for x in ("FY", "199", "97-Q5", "FY97 Q1", "", None, 19970):
        with pytest.raises(ValueError):
            fiscal_year_of(x)
    for x in ("all", "ALL ", "*", None, "", "none"):
        assert segment_of(x) == "all"
    assert segment_of(3) == "3" == segment_of(" 3")
    for x in (9, "x", 0):
        with pytest.raises(ValueError):
            segment_of(x)


def test_segment_requests():
    r = SegmentRequest.read(DEFAULT, 3, "FY97", 2000, "84")
    assert (r.segment, r.window.fy_start, r.window.fy_end, r.window.anchor_mob) == ("3", 1997, 2000, 84)
    assert r.window.name == "FY97-FY00 @ 84M"
    for bad in (("3", 97, 2000, 60), ("3", 2000, 1997, 84), ("9", 97, 2000, 84), ("3", "x", 2000, 84)):
        with pytest.raises(ValueError):
            SegmentRequest.read(DEFAULT, *bad)


def test_months_at_unequal_steps(spark):
    grid = MobList((1, 2, 6, 12, 31))
    df = spark.createDataFrame([(m,) for m in (0, 1, 5, 6, 30, 31, 400, None)], "m int")
    got = [r[0] for r in df.select(max_mature_mob(F.col("m"), grid)).collect()]
    assert got == [-1, 1, 2, 6, 12, 31, 31, None]
    # on the same months, a list and a grid agree
    same, step = MobList(tuple(range(3, 121, 3))), MobGrid(3, 120, 3)
    ages = spark.range(-5, 140).withColumn("m", F.col("id").cast("int"))
    assert ages.filter(max_mature_mob(F.col("m"), same) != max_mature_mob(F.col("m"), step)).isEmpty()
    for wrong in ((), (3, 3), (6, 3), (-1, 3)):
        with pytest.raises(ValueError):
            MobList(wrong)


def test_months_that_a_run_cannot_do_without():
    years = tuple(range(12, 121, 12))
    EclConfig(extract_grid=MobList(years), triangle_grid=MobList(years))
    with pytest.raises(ValueError, match="not extracted"):
        EclConfig(triangle_grid=MobList((1, *years)))
    with pytest.raises(ValueError, match="denominator needs the months"):
        EclConfig(extract_grid=MobList(years), triangle_grid=MobList(years[1:]))
