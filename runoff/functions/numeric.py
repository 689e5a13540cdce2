"""Money and ratio helpers.

Amounts are summed as exact integers (minor units, then micro-crore) and only
turned into doubles at the end, so the result does not depend on the order in
which partitions are merged.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from runoff.config import MICRO_CRORE_MINOR_UNITS

# output rounding, identical in the DuckDB oracle
AMOUNT_DP = 6
RATE_DP = 8


def micro_crore(minor_units_col: str) -> Column:
    """Half-up rounding of a non-negative minor-unit sum (a named column) to
    1e-6 crore, as an exact long (integral ``div``, no floating point)."""
    half = MICRO_CRORE_MINOR_UNITS // 2
    return F.expr(f"(`{minor_units_col}` + {half}) div {MICRO_CRORE_MINOR_UNITS}")


def to_crore(micro) -> Column:
    c = F.col(micro) if isinstance(micro, str) else micro
    return c.cast("double") / F.lit(1e6)


def safe_ratio(num, den) -> Column:
    """``num/den`` with 0 for a zero/NULL denominator (the IFERROR rule)."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.when(d.isNull() | (d == 0), F.lit(0.0)).otherwise(n.cast("double") / d.cast("double"))
