"""Ranges of a key that hold alike many of its values, however these are
spread: cut points come from a sample of the keys, numbers or text.

The sample is the distinct keys whose hash falls into one class of so many
that some ``SAMPLE`` keys a range are left: its size follows the number of
ranges, not the table's, and the same keys give the same cuts.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sampled keys a range: a range's share is off by some 1 / sqrt(SAMPLE) of it.
SAMPLE = 100


def range_cuts(keys: DataFrame, key: str, ranges: int) -> list:
    """At most ``ranges - 1`` cut points, ascending.  Missing keys have no
    part; fewer keys than ranges give a cut at each but the first."""
    known = keys.select(F.col(key).alias("k")).filter(F.col("k").isNotNull())
    n = known.agg(F.approx_count_distinct("k")).first()[0]
    classes = max(1, n // (ranges * SAMPLE))
    sample = sorted(r["k"] for r in known.filter(F.pmod(F.xxhash64("k"), F.lit(classes)) == 0).distinct().collect())
    return sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)} - {sample[0]}) if sample else []


def range_of(key: Column, cuts: list) -> Column:
    """The number of the range that a key is in, from 0 (below the first cut);
    NULL for a missing key.  Halves the cuts at each comparison."""
    def among(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < F.lit(cuts[mid]), among(lo, mid)).otherwise(among(mid + 1, hi))
    return F.when(key.isNotNull(), among(0, len(cuts)))


def in_ranges(key: Column, cuts: list, wanted: list) -> Column:
    """Whether a key is in one of the ranges of these numbers (None: missing
    keys), as comparisons that reach a scan; neighbours are one."""
    spans: list[list[int]] = []
    for i in sorted(x for x in wanted if x is not None):
        if spans and spans[-1][1] == i - 1:
            spans[-1][1] = i
        else:
            spans.append([i, i])
    tests = [key.isNull()] if None in wanted else []
    for lo, hi in spans:
        ends = ([key >= F.lit(cuts[lo - 1])] if lo else []) + ([key < F.lit(cuts[hi])] if hi < len(cuts) else [])
        tests.append(reduce(Column.__and__, ends, key.isNotNull()))
    return reduce(Column.__or__, tests, F.lit(False))


def range_predicates(key: str, cuts: list) -> list[str]:
    """One WHERE clause a range, and one for the rows without a key: each row
    is in exactly one, if the database orders text as its bytes."""
    told = [str(c) if isinstance(c, int) else "'" + str(c).replace("'", "''") + "'" for c in sorted(cuts)]
    if not told:
        return ["1 = 1"]
    between = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(told[:-1], told[1:])]
    return [f"{key} < {told[0]}", *between, f"{key} >= {told[-1]}", f"{key} IS NULL"]
