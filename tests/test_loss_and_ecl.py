import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from runoff.config import EclConfig, MobGrid, Window
from runoff.operators import ecl, loss, triangle
from tests.conftest import make_cells

GRID = MobGrid(3, 24, 3)
CFG = EclConfig(as_of=date(2000, 3, 31), triangle_grid=GRID, anchors=(12, 24),
                windows=(Window("W12", 1996, 1997, 12), Window("EMPTY", 1990, 1990, 24)),
                headline="W12")
A, B = date(1996, 6, 30), date(1996, 9, 30)


def _tri(spark, rows):
    cells = make_cells(spark, list(GRID.mobs), rows)
    return triangle.fill(triangle.triangle_columns(cells))


def test_loss_rate_denominator_and_zero_rules(spark):
    mobs = list(GRID.mobs)
    tp = [100 - 4 * i for i in range(len(mobs))]
    d90 = [2 * i for i in range(len(mobs))]
    tri = _tri(spark, [(A, 1000, 24, d90, tp), (B, 0, 24, [0] * 8, [0] * 8)])
    l = {(r.cohort_end, r.anchor_mob): r for r in loss.loss_rates(tri, CFG).collect()}
    a12 = l[(A, 12)]
    # 12M: numerator 90+ at 12; denominator = disbursal only (no yearly MOB < 12)
    assert a12.denominator == pytest.approx(1000 / 1e6)
    assert a12.loss_rate == pytest.approx((2 * 3) / 1000)
    a24 = l[(A, 24)]
    assert a24.denominator == pytest.approx((1000 + tp[3]) / 1e6)    # + TPOS at 12
    assert a24.ninety_plus == pytest.approx(d90[7] / 1e6)
    assert l[(B, 24)].loss_rate == 0.0                                  # zero denominator


def test_weighted_rate_empty_window_and_headline_by_name(spark):
    mobs = list(GRID.mobs)
    tri = _tri(spark, [(A, 1000, 24, [1] * 8, [10] * 8), (B, 3000, 24, [3] * 8, [10] * 8)])
    lr = loss.loss_rates(tri, CFG)
    w = {r.window: r for r in ecl.weighted_loss_rate(lr, CFG).collect()}
    assert w["EMPTY"].n_quarters == 0 and w["EMPTY"].weighted_avg_lr == 0.0
    assert w["EMPTY"].simple_avg_lr is None and w["EMPTY"].total_disb == 0.0
    rates = {r.cohort_end: r.loss_rate for r in lr.filter("anchor_mob = 12").collect()}
    exp = (rates[A] * 1000 + rates[B] * 3000) / 4000
    assert w["W12"].weighted_avg_lr == pytest.approx(exp)
    assert w["W12"].simple_avg_lr == pytest.approx((rates[A] + rates[B]) / 2)
    h = ecl.headline(ecl.weighted_loss_rate(lr, CFG), CFG).collect()
    assert len(h) == 1 and h[0].window == "W12"


def test_flags_projected_and_implausible(spark):
    mobs = list(GRID.mobs)
    tri = _tri(spark, [(A, 10, 24, [50] * 8, [1] * 8), (B, 10, 9, [1, 2, 3], [9, 8, 7])])
    fl = {(r.cohort_end, r.anchor_mob): r.flag
          for r in loss.loss_rate_flags(loss.loss_rates(tri, CFG)).collect()}
    assert fl[(A, 12)] == "implausible"          # 50 / 10 > 100 %
    assert fl[(B, 12)] == "projected"            # B has not reached MOB 12


def test_current_tpos_diagonal(spark):
    tri = _tri(spark, [(A, 100, 12, [0] * 4, [90, 80, 70, 60]), (B, 100, -1, [], [])])
    cur = {r.cohort_end: r for r in loss.current_tpos(tri).collect()}
    assert cur[A].current_mob == 12 and cur[A].current_tpos == pytest.approx(60 / 1e6)
    assert cur[B].current_mob == -1 and cur[B].current_tpos == 0.0


def test_windows_from_a_table_equal_a_scan_of_each(spark):
    """Ten thousand windows, with gaps between cohorts, bounds inside quarters, empty and outside windows."""
    rng = random.Random(3)
    ends = [date(1999, 3, 31), date(1999, 6, 30), date(1999, 12, 31), date(2000, 3, 31), date(2001, 12, 31)]
    rows = [(s, e, a, rng.random(), rng.choice([0.0, round(rng.random(), 6)]), rng.random() < 0.5) for s in ("1", "all") for e in ends
            for a in (72, 84) if (s, a) != ("1", 84) or e != ends[0]]
    loss = spark.createDataFrame(rows, "segment string, cohort_end date, anchor_mob int, loss_rate double, disb_cr double, anchor_observed boolean")
    day = lambda: date(1998, 1, 1) + timedelta(days=rng.randrange(2000))
    asked = [(f"w{i}", rng.choice([72, 84]), *rng.choice([sorted, list])([day(), day()])) for i in range(10_000)]
    windows = spark.createDataFrame(asked, "window string, anchor_mob int, first_day date, last_day date")
    out = ecl.weighted_over_windows(loss, windows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = {(r.segment, r.window): r for r in out.collect()}
    assert len(got) == 2 * len(asked)
    for name, anchor, first, last in asked:
        for segment in ("1", "all"):
            own = [r for r in rows if r[0] == segment and r[2] == anchor and first <= r[1] <= last]
            r, disb = got[segment, name], sum(x[4] for x in own)
            assert (r.n_quarters, r.n_observed_at_anchor) == (len(own), sum(x[5] for x in own))
            assert r.total_disb == pytest.approx(disb, abs=1e-12)
            assert r.simple_avg_lr == (pytest.approx(sum(x[3] for x in own) / len(own)) if own else None)
            assert r.weighted_avg_lr == pytest.approx(sum(x[3] * x[4] for x in own) / disb if disb else 0.0, abs=1e-9)
