"""Fiscal calendar expressions (April start, year labelled by its ending year).

All functions return Columns; nothing leaves the JVM.
"""
from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from runoff.config import MobGrid, MobList


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fiscal_year(d) -> Column:
    """Ending calendar year of the fiscal year containing ``d``."""
    d = _c(d)
    return F.when(F.month(d) >= 4, F.year(d) + 1).otherwise(F.year(d))


def fiscal_quarter_no(d) -> Column:
    """Apr-Jun 1, Jul-Sep 2, Oct-Dec 3, Jan-Mar 4."""
    return ((F.month(_c(d)) + 8) % 12 / 3).cast("int") + 1


def fiscal_quarter_label(d) -> Column:
    """``FYyy-Qn`` display label; keys and sorting use :func:`cohort_end`."""
    return F.format_string("FY%02d-Q%d", fiscal_year(d) % 100, fiscal_quarter_no(d))


def cohort_end(d) -> Column:
    """Last day of the quarter containing ``d`` (fiscal and calendar quarter
    ends coincide for an April start)."""
    return F.last_day(F.add_months(F.trunc(_c(d), "quarter"), 2))


def whole_months(start, end: date) -> Column:
    """Whole-month distance ``(y2-y1)*12 + (m2-m1)``, ignoring the day."""
    s = _c(start)
    return (F.lit(end.year) - F.year(s)) * 12 + (F.lit(end.month) - F.month(s))


def max_mature_mob(months, grid: MobGrid | MobList) -> Column:
    """Largest grid MOB not above ``months``; -1 when none is."""
    m = _c(months)
    if isinstance(grid, MobList):
        reached = F.filter(F.array(*[F.lit(x) for x in grid.mobs]), lambda x: x <= m)
        return F.when(m.isNotNull(), F.coalesce(F.array_max(reached), F.lit(-1)))
    top = F.least(F.lit(grid.stop),
                  F.lit(grid.start) + F.floor((m - grid.start) / grid.step).cast("int") * grid.step)
    return F.when(m >= grid.start, top).otherwise(F.lit(-1))


def iso(d) -> Column:
    """Dates leave the engine as ISO text (stable across engines)."""
    return F.date_format(_c(d), "yyyy-MM-dd")
