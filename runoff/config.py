"""Run configuration: every knob of an ECL run lives in one frozen dataclass.

The as-of date is the single roll knob: the disbursal window end, the
maturity mask and the current-TPOS diagonal all derive from it.
"""
from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from datetime import date

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for the same results):
#   default rate per segment, in loans per thousand: 1 -> 20, 2 -> 35,
#   3 -> 55, 4 -> 80, 5 -> 120
#   extraction MOB grid 0..120 step 3, triangle grid 3..120 step 3
#   loss-rate anchors 72, 84, 120 months; yearly MOBs are multiples of 12
#   reconciliation tolerance 1e-4 crore; one crore = 1e7 rupees = 1e9 paise
#   published wide feed columns: fy_quarter, segment, lan_cnt, disbursal_amt, then
#   amt_90plus_settlement_<mob>mob and tpos_<mob>mob for every extraction MOB
#   extract columns: loans distinct_loan_no, customer_id, disbursal_date,
#   disbursal_amount, segment, tenure_months; performance distinct_loan_no, mob,
#   tpos, amt_90plus_settlement
#   spellings of the whole book: all, *, none, nothing at all
# ---------------------------------------------------------------------------
SEGMENT_DEFAULT_PER_MILLE = {1: 20, 2: 35, 3: 55, 4: 80, 5: 120}
SEGMENTS = (1, 2, 3, 4, 5)
MINOR_UNITS_PER_CRORE = 1_000_000_000  # cents/paise per crore
MICRO_CRORE_MINOR_UNITS = 1_000  # 1e-6 crore (the 6-dp feed unit) in cents
YEAR_MOB = 12

# Deterministic draws used to map the driver's orders table onto a loan book
# (see FIXTURES.md §3): hash multipliers and the default-month spread.
DEFAULT_HASH_MULT = 2654435761
DEFAULT_MOB_HASH_MULT = 40503
DEFAULT_MOB_SPREAD_LONG = 110
DEFAULT_MOB_SPREAD_REFERENCE_LIKE = 37


@dataclass(frozen=True)
class MobGrid:
    """A regular month-on-book grid ``start, start+step, .., stop``."""

    start: int
    stop: int
    step: int = 3

    @property
    def mobs(self) -> tuple[int, ...]:
        return tuple(range(self.start, self.stop + 1, self.step))

    @property
    def text(self) -> str:
        return f"{self.start}..{self.stop} step {self.step}"

    def __len__(self) -> int:
        return len(self.mobs)


@dataclass(frozen=True)
class MobList:
    """Any months on book, in ascending order; a triangle develops from each
    to the next, however many months lie between."""

    mobs: tuple[int, ...]

    def __post_init__(self):
        if not self.mobs or list(self.mobs) != sorted(set(self.mobs)) or self.mobs[0] < 0:
            raise ValueError(f"months must ascend from 0 or later, without repeats: {self.mobs}")

    @property
    def start(self) -> int:
        return self.mobs[0]

    @property
    def stop(self) -> int:
        return self.mobs[-1]

    @property
    def text(self) -> str:
        return ", ".join(map(str, self.mobs))

    def __len__(self) -> int:
        return len(self.mobs)


@dataclass(frozen=True)
class Window:
    """Inclusive cohort window ``FY<fy_start>-Q<q_start> .. FY<fy_end>-Q<q_end>``
    at a loss-rate anchor.  Fiscal years are four-digit, April start, labelled
    by their ending year (FY1997 = Apr 1996 .. Mar 1997)."""

    name: str
    fy_start: int
    fy_end: int
    anchor_mob: int
    q_start: int = 1
    q_end: int = 4

    @property
    def start_label(self) -> str:
        return f"FY{self.fy_start % 100:02d}-Q{self.q_start}"

    @property
    def end_label(self) -> str:
        return f"FY{self.fy_end % 100:02d}-Q{self.q_end}"

    @property
    def first_day(self) -> date:
        return fiscal_quarter_first_day(self.fy_start, self.q_start)

    @property
    def last_day(self) -> date:
        return fiscal_quarter_last_day(self.fy_end, self.q_end)


def fiscal_quarter_first_day(fy: int, q: int) -> date:
    """First calendar day of fiscal quarter ``q`` of fiscal year ``fy``."""
    if q not in (1, 2, 3, 4):
        raise ValueError(f"fiscal quarter must be 1..4, got {q}")
    month = (q * 3 + 1 - 1) % 12 + 1  # Q1 -> 4, Q2 -> 7, Q3 -> 10, Q4 -> 1
    year = fy - 1 if q < 4 else fy
    return date(year, month, 1)


def fiscal_quarter_last_day(fy: int, q: int) -> date:
    first = fiscal_quarter_first_day(fy, q)
    m = first.month + 2
    nxt = date(first.year + (m // 12), m % 12 + 1, 1)
    return date.fromordinal(nxt.toordinal() - 1)


DEFAULT_WINDOWS = (
    Window("FY97-FY00 @ 84M", 1997, 2000, 84),
    Window("FY97-FY00 @ 72M", 1997, 2000, 72),
    Window("FY95-FY01 @ 84M", 1995, 2001, 84),
    Window("FY95-FY01 @ 120M", 1995, 2001, 120),
)


@dataclass(frozen=True)
class EclConfig:
    as_of: date = date(2006, 3, 31)
    start: date = date(1995, 1, 1)
    extract_grid: MobGrid | MobList = MobGrid(0, 120, 3)
    triangle_grid: MobGrid | MobList = MobGrid(3, 120, 3)
    anchors: tuple[int, ...] = (72, 84, 120)
    windows: tuple[Window, ...] = DEFAULT_WINDOWS
    headline: str = "FY97-FY00 @ 84M"
    tol: float = 1e-4
    # driver-data mapping: "long" tenor (24..144 months) or "reference" (12..60)
    tenor: str = "long"
    freeze_tpos_at_default: bool = False
    # two-digit fiscal years resolve into [century_pivot, century_pivot + 99]
    century_pivot: int = 1950
    segments: tuple[int, ...] = field(default=SEGMENTS)

    def __post_init__(self):
        if self.headline not in {w.name for w in self.windows}:
            raise ValueError(f"headline window {self.headline!r} is not configured")
        for w in self.windows:
            if w.anchor_mob not in self.anchors:
                raise ValueError(f"window {w.name!r} anchor {w.anchor_mob} not in {self.anchors}")
        for a in self.anchors:
            if a % YEAR_MOB or a not in self.triangle_grid.mobs:
                raise ValueError(f"anchor {a} must be a yearly MOB on the triangle grid")
        needed = {*self.triangle_grid.mobs} - {*self.extract_grid.mobs}
        if needed:
            raise ValueError(f"the triangle's months {sorted(needed)} are not extracted")
        years = {*range(YEAR_MOB, max(self.anchors, default=0), YEAR_MOB)} - {*self.triangle_grid.mobs}
        if years:
            raise ValueError(f"the loss rate's denominator needs the months {sorted(years)} on the triangle grid")
        if self.tenor not in ("long", "reference"):
            raise ValueError("tenor must be 'long' or 'reference'")

    @property
    def end_disb(self) -> date:
        """Disbursal window end, derived from the as-of date."""
        return self.as_of

    @property
    def headline_window(self) -> Window:
        return next(w for w in self.windows if w.name == self.headline)

    def with_(self, **kw) -> "EclConfig":
        return replace(self, **kw)


DEFAULT = EclConfig()
YOUNG_BOOK = EclConfig(as_of=date(2001, 9, 30))


# Spellings: a fiscal year is its two- or four-digit ending year, with or
# without FY before it and a quarter after it; the whole book is a word, a
# star or nothing.
_FISCAL_YEAR = re.compile(r"\s*(?:FY)?(\d{2}|\d{4})(?:-Q[1-4])?\s*", re.IGNORECASE)
WHOLE_BOOK = "all"
WHOLE_BOOK_SPELLINGS = (WHOLE_BOOK, "*", "none", "")


def fiscal_year_of(spelling, century_pivot: int = 1950) -> int:
    """The four-digit ending year; two digits fall into the hundred years
    from ``century_pivot`` on."""
    found = _FISCAL_YEAR.fullmatch(str(spelling))
    if found is None:
        raise ValueError(f"{spelling!r} does not name a fiscal year (such as FY97 or 1997)")
    year = int(found[1])
    return century_pivot + (year - century_pivot) % 100 if year < 100 else year


def segment_of(spelling, segments=SEGMENTS) -> str:
    """A segment's key in the tables: its number as text, or the whole book."""
    keys = dict.fromkeys(WHOLE_BOOK_SPELLINGS, WHOLE_BOOK) | {str(s): str(s) for s in segments}
    text = "" if spelling is None else str(spelling).strip().lower()
    if text not in keys:
        raise ValueError(f"{spelling!r} is no segment of this book; it has {sorted(set(keys.values()))}")
    return keys[text]


@dataclass(frozen=True)
class SegmentRequest:
    """What a segment's ECL is asked for: segment key, window, anchor."""

    segment: str
    window: Window

    @classmethod
    def read(cls, cfg: "EclConfig", segment, fy_start, fy_end, anchor) -> "SegmentRequest":
        first, last = (fiscal_year_of(y, cfg.century_pivot) for y in (fy_start, fy_end))
        mob = int(anchor)
        problems = [text for wrong, text in (
            (mob not in cfg.anchors, f"month {mob} is no anchor; the anchors are {list(cfg.anchors)}"),
            (first > last, f"the window ends (FY{last}) before it begins (FY{first})")) if wrong]
        if problems:
            raise ValueError("; ".join(problems))
        name = f"FY{first % 100:02d}-FY{last % 100:02d} @ {mob}M"
        return cls(segment_of(segment, cfg.segments), Window(name, first, last, mob))
