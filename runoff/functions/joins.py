"""Small helpers around joins."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runoff.config import MobGrid, MobList


def side_by_side(*rows: DataFrame) -> DataFrame:
    """Combine single-row aggregates (distinct column names) into one row:
    a union of the rows and a max per column - no join."""
    u = rows[0]
    for r in rows[1:]:
        u = u.unionByName(r, allowMissingColumns=True)
    cols = [c for r in rows for c in r.columns]
    return u.agg(*[F.max(c).alias(c) for c in cols])


def with_loan(rows: DataFrame, loans: DataFrame, how: str = "inner") -> DataFrame:
    """Loan-level rows with their loan's columns: a task hashes its loans and
    passes the rows, many for each of them, along without sorting them."""
    return rows.join(loans.hint("shuffle_hash"), "loan_no", how)


def grid_column(grid: MobGrid | MobList, upto: Column | None = None) -> Column:
    """A config grid, or its months up to ``upto`` (not below its first), as a
    column to explode: a bounded, narrow fan-out."""
    if isinstance(grid, MobGrid):
        top = F.lit(grid.stop) if upto is None else F.least(F.lit(grid.stop), upto)
        return F.explode(F.sequence(F.lit(grid.start), top, F.lit(grid.step)))
    mobs = F.array(*[F.lit(m) for m in grid.mobs])
    return F.explode(mobs if upto is None else F.filter(mobs, lambda m: m <= upto))
