"""DuckDB oracle: for every registered query, an independent ANSI-SQL text
over the driver's parquet views (``orders`` is the only one used).

The SQL restates the same semantics from scratch (FIXTURES.md §3 mapping,
closed-form chain ladder of SURVEY §4.3) and applies the same output
conventions as ``queries.py``: amounts 6 dp, rates 8 dp, ISO dates,
BIGINT integers.  Text assembly here is plain string building, not a
planner: one CTE list per configuration plus one final SELECT per query.
"""
from __future__ import annotations

from runoff.config import (DEFAULT, DEFAULT_HASH_MULT, DEFAULT_MOB_HASH_MULT,
                           DEFAULT_MOB_SPREAD_LONG, DEFAULT_MOB_SPREAD_REFERENCE_LIKE,
                           SEGMENT_DEFAULT_PER_MILLE, YEAR_MOB, YOUNG_BOOK, EclConfig, MobGrid,
                           SegmentRequest)
from runoff.plans.queries import (DAMAGED, DEGENERATE_GROUPS, MATURE_BOOK, RESTATED, SEGMENT_ECL_ARGS,
                                  UNEQUAL_BOOK)


def LABEL(d: str) -> str:
    return (f"printf('FY%02d-Q%d', (CASE WHEN month({d}) >= 4 THEN year({d}) + 1 "
            f"ELSE year({d}) END) % 100, ((month({d}) + 8) % 12) // 3 + 1)")


def ISO(d: str) -> str:
    return f"strftime({d}, '%Y-%m-%d')"


def COHORT_END(d: str) -> str:
    return f"CAST(last_day(CAST(date_trunc('quarter', {d}) AS DATE) + INTERVAL 2 MONTH) AS DATE)"


def LBL(d: str = "cohort_end") -> str:
    return f"{LABEL(d)} AS fy_quarter, {ISO(d)} AS cohort_end"


def _ratio(n: str, d: str) -> str:
    return f"CASE WHEN ({d}) IS NULL OR ({d}) = 0 THEN 0.0::DOUBLE ELSE CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END"


def _date(d) -> str:
    return f"DATE '{d.isoformat()}'"


def ctes(cfg: EclConfig) -> list[str]:
    g, t = cfg.extract_grid, cfg.triangle_grid
    Y, M = cfg.as_of.year, cfg.as_of.month
    if cfg.tenor == "long":
        tenure, spread = "24 * (1 + o_orderkey % 6)", DEFAULT_MOB_SPREAD_LONG
    else:
        tenure, spread = "12 * (1 + o_orderkey % 5)", DEFAULT_MOB_SPREAD_REFERENCE_LIKE
    seg_case = ("CASE segment " + " ".join(f"WHEN {s} THEN {pm}" for s, pm in
                                           SEGMENT_DEFAULT_PER_MILLE.items()) + " ELSE 0 END")

    def amort(mob):
        return f"(amount_cents * (tenure_months - {mob}) * 2 + tenure_months) // (2 * tenure_months)"

    tpos = f"CASE WHEN mob >= tenure_months THEN 0 ELSE {amort('mob')} END"
    if cfg.freeze_tpos_at_default:
        tpos = f"CASE WHEN is_default AND mob >= default_mob THEN oad ELSE {tpos} END"
    months = f"({Y} - year(cohort_end)) * 12 + ({M} - month(cohort_end))"
    def series(grid):
        return (f"generate_series({grid.start}, {grid.stop}, {grid.step})" if isinstance(grid, MobGrid)
                else f"[{', '.join(map(str, grid.mobs))}]")

    maxmat = f"coalesce((SELECT max(x) FROM (SELECT unnest({series(t)}) AS x) WHERE x <= {months}), -1)"
    if isinstance(t, MobGrid):
        maxmat = (f"CASE WHEN {months} >= {t.start} THEN least({t.stop}, {t.start} + "
                  f"(({months} - {t.start}) // {t.step}) * {t.step}) ELSE -1 END")
    emobs = ", ".join(str(m) for m in g.mobs)
    anchors = ", ".join(str(a) for a in cfg.anchors)
    wins = ", ".join(
        f"('{w.name}', '{w.start_label}', '{w.end_label}', {w.anchor_mob}, {_date(w.first_day)}, "
        f"{_date(w.last_day)})" for w in cfg.windows)
    return [
        f"""loans AS (
  SELECT o_orderkey AS loan_no, o_custkey AS customer_id,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS segment,
         CAST(o_orderdate AS DATE) AS disbursal_date,
         CAST(round(o_totalprice * 100) AS BIGINT) AS amount_cents,
         CAST({tenure} AS INTEGER) AS tenure_months
  FROM orders)""",
        f"""loans_x AS (
  SELECT *, (loan_no * {DEFAULT_HASH_MULT}) % 1000 < {seg_case} AS is_default,
         CAST(least(3 + (loan_no * {DEFAULT_MOB_HASH_MULT}) % {spread}, tenure_months) AS INTEGER) AS default_mob
  FROM loans)""",
        f"""perf_base AS (
  SELECT loan_no, amount_cents, tenure_months, is_default, default_mob,
         CASE WHEN is_default AND default_mob < tenure_months THEN {amort('default_mob')} ELSE 0 END AS oad,
         ({Y} - year(disbursal_date)) * 12 + ({M} - month(disbursal_date)) AS age
  FROM loans_x)""",
        f"""performance AS (
  SELECT loan_no, CAST(mob AS INTEGER) AS mob, CAST({tpos} AS BIGINT) AS tpos_cents,
         CAST(CASE WHEN is_default AND mob >= default_mob THEN oad ELSE 0 END AS BIGINT) AS dpd90_cents
  FROM (SELECT *, unnest({series(g)}) AS mob FROM perf_base) WHERE mob <= age)""",
        f"""loans_w AS (
  SELECT loan_no, segment, amount_cents, disbursal_date, {COHORT_END('disbursal_date')} AS cohort_end
  FROM loans WHERE disbursal_date BETWEEN {_date(cfg.start)} AND {_date(cfg.end_disb)})""",
        f"""feed AS (
  SELECT l.cohort_end, l.segment, p.mob,
         CAST((SUM(p.dpd90_cents) + 500) // 1000 AS BIGINT) AS dpd90_uc,
         CAST((SUM(p.tpos_cents) + 500) // 1000 AS BIGINT) AS tpos_uc
  FROM performance p JOIN loans_w l ON p.loan_no = l.loan_no
  WHERE p.mob IN ({emobs})
  GROUP BY l.cohort_end, l.segment, p.mob)""",
        """disb AS (
  SELECT cohort_end, segment, COUNT(*) AS lan_cnt,
         CAST((SUM(amount_cents) + 500) // 1000 AS BIGINT) AS disb_uc
  FROM loans_w GROUP BY cohort_end, segment)""",
        """feed_g AS (
  SELECT cohort_end, CAST(segment AS VARCHAR) AS segment, mob, dpd90_uc, tpos_uc FROM feed
  UNION ALL
  SELECT cohort_end, 'all', mob, CAST(SUM(dpd90_uc) AS BIGINT), CAST(SUM(tpos_uc) AS BIGINT)
  FROM feed GROUP BY cohort_end, mob)""",
        """disb_g AS (
  SELECT cohort_end, CAST(segment AS VARCHAR) AS segment, lan_cnt, disb_uc FROM disb
  UNION ALL
  SELECT cohort_end, 'all', CAST(SUM(lan_cnt) AS BIGINT), CAST(SUM(disb_uc) AS BIGINT)
  FROM disb GROUP BY cohort_end)""",
        f"""cal AS (
  SELECT *, {months} AS months_on_book, {maxmat} AS max_mature_mob FROM disb_g)""",
        f"""tgrid AS (SELECT CAST(unnest({series(t)}) AS INTEGER) AS mob)""",
        """cells AS (
  SELECT c.segment, c.cohort_end, g.mob, c.lan_cnt, c.disb_uc, c.max_mature_mob,
         g.mob <= c.max_mature_mob AS is_observed,
         COALESCE(f.dpd90_uc, 0) AS dpd90_uc, COALESCE(f.tpos_uc, 0) AS tpos_uc
  FROM cal c CROSS JOIN tgrid g
  LEFT JOIN feed_g f ON f.segment = c.segment AND f.cohort_end = c.cohort_end AND f.mob = g.mob)""",
        """lagged AS (
  SELECT *, lag(dpd90_uc) OVER w AS prev_dpd90_uc, lag(tpos_uc) OVER w AS prev_tpos_uc
  FROM cells WINDOW w AS (PARTITION BY segment, cohort_end ORDER BY mob))""",
        """fac0 AS (
  SELECT segment, mob, CAST(count_if(is_observed) AS BIGINT) AS n_mature, CAST(count_if(NOT is_observed) AS BIGINT) AS n_projected,
         CAST(SUM(CASE WHEN is_observed THEN dpd90_uc END) AS BIGINT) AS num_dpd90,
         CAST(SUM(CASE WHEN is_observed THEN prev_dpd90_uc END) AS BIGINT) AS den_dpd90,
         SUM(CASE WHEN is_observed THEN CAST(tpos_uc AS HUGEINT) * CAST(disb_uc AS HUGEINT) END) AS num_tpos,
         SUM(CASE WHEN is_observed THEN CAST(prev_tpos_uc AS HUGEINT) * CAST(disb_uc AS HUGEINT) END) AS den_tpos
  FROM lagged GROUP BY segment, mob)""",
        f"""fac AS (
  SELECT *, {_ratio('num_dpd90', 'den_dpd90')} AS f_dpd90, {_ratio('num_tpos', 'den_tpos')} AS f_tpos,
         n_projected > 0 AND den_dpd90 IS NOT NULL AND den_dpd90 = 0 AND COALESCE(num_dpd90, 0) <> 0 AS degenerate_dpd90,
         n_projected > 0 AND den_tpos IS NOT NULL AND den_tpos = 0 AND COALESCE(num_tpos, 0) <> 0 AS degenerate_tpos
  FROM fac0)""",
        """filled AS (
  SELECT c.*,
    product(CASE WHEN c.is_observed THEN 1.0::DOUBLE ELSE f.f_dpd90 END) OVER r AS cp_dpd90,
    product(CASE WHEN c.is_observed THEN 1.0::DOUBLE ELSE f.f_tpos END) OVER r AS cp_tpos,
    max(CASE WHEN c.mob = c.max_mature_mob THEN c.dpd90_uc END) OVER rw AS base_dpd90,
    max(CASE WHEN c.mob = c.max_mature_mob THEN c.tpos_uc END) OVER rw AS base_tpos
  FROM cells c JOIN fac f ON f.segment = c.segment AND f.mob = c.mob
  WINDOW r AS (PARTITION BY c.segment, c.cohort_end ORDER BY c.mob
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         rw AS (PARTITION BY c.segment, c.cohort_end))""",
        """tri AS (
  SELECT segment, cohort_end, mob, lan_cnt, disb_uc, max_mature_mob, is_observed, dpd90_uc, tpos_uc,
    CASE WHEN is_observed THEN dpd90_uc / 1e6 ELSE COALESCE(base_dpd90 / 1e6 * cp_dpd90, 0.0) END AS dpd90_amt,
    CASE WHEN is_observed THEN tpos_uc / 1e6 ELSE COALESCE(base_tpos / 1e6 * cp_tpos, 0.0) END AS tpos_amt
  FROM filled)""",
        f"""anchors AS (SELECT CAST(unnest([{anchors}]) AS INTEGER) AS anchor_mob)""",
        f"""loss0 AS (
  SELECT t.segment, t.cohort_end, a.anchor_mob, max(t.disb_uc) AS disb_uc,
    max(CASE WHEN t.mob = a.anchor_mob THEN t.dpd90_amt END) AS ninety_plus,
    bool_or(CASE WHEN t.mob = a.anchor_mob THEN t.is_observed END) AS anchor_observed,
    SUM(CASE WHEN t.mob % {YEAR_MOB} = 0 AND t.mob < a.anchor_mob THEN t.tpos_amt END) AS tpos_sum
  FROM tri t CROSS JOIN anchors a
  WHERE t.mob = a.anchor_mob OR (t.mob % {YEAR_MOB} = 0 AND t.mob < a.anchor_mob)
  GROUP BY t.segment, t.cohort_end, a.anchor_mob)""",
        """loss AS (
  SELECT segment, cohort_end, anchor_mob, disb_uc / 1e6 AS disb_cr,
    COALESCE(ninety_plus, 0.0) AS ninety_plus, COALESCE(tpos_sum, 0.0) AS tpos_sum,
    disb_uc / 1e6 + COALESCE(tpos_sum, 0.0) AS denominator,
    CASE WHEN disb_uc / 1e6 + COALESCE(tpos_sum, 0.0) = 0 THEN 0.0::DOUBLE
         ELSE ninety_plus / (disb_uc / 1e6 + COALESCE(tpos_sum, 0.0)) END AS loss_rate,
    COALESCE(anchor_observed, false) AS anchor_observed
  FROM loss0)""",
        f"""windows AS (SELECT * FROM (VALUES {wins})
  t(window_name, fy_start, fy_end, anchor_mob, first_day, last_day))""",
        """wavg AS (
  SELECT g.segment, w.window_name, w.fy_start, w.fy_end, w.anchor_mob,
    COUNT(l.cohort_end) AS n_quarters, CAST(count_if(l.anchor_observed) AS BIGINT) AS n_observed_at_anchor,
    COALESCE(SUM(l.disb_cr), 0.0) AS total_disb,
    AVG(l.loss_rate) AS simple_avg_lr,
    CASE WHEN SUM(l.disb_cr) IS NULL OR SUM(l.disb_cr) = 0 THEN 0.0::DOUBLE
         ELSE SUM(l.loss_rate * l.disb_cr) / SUM(l.disb_cr) END AS weighted_avg_lr
  FROM (SELECT DISTINCT segment FROM loss) g CROSS JOIN windows w
  LEFT JOIN loss l ON l.segment = g.segment AND l.anchor_mob = w.anchor_mob
                  AND l.cohort_end BETWEEN w.first_day AND w.last_day
  GROUP BY g.segment, w.window_name, w.fy_start, w.fy_end, w.anchor_mob)""",
        """cur AS (
  SELECT c.segment, c.cohort_end, c.max_mature_mob AS current_mob, c.disb_uc / 1e6 AS disb_cr,
         COALESCE(t.tpos_amt, 0.0) AS current_tpos
  FROM cal c LEFT JOIN tri t ON t.segment = c.segment AND t.cohort_end = c.cohort_end
                            AND t.mob = c.max_mature_mob)""",
    ]


def _with(cfg: EclConfig, select: str, extra: list[str] | None = None) -> str:
    return "WITH " + ",\n".join(ctes(cfg) + (extra or [])) + "\n" + select


def _wide_cols(mobs, expr, name, cast="BIGINT"):
    return ",\n  ".join(f"CAST({expr(m)} AS {cast}) AS {name(m)}" for m in mobs)


ALL = "segment = 'all'"


def _rate(n: str, disb_uc: str = "disb_uc") -> str:
    return f"CASE WHEN {disb_uc} / 1e6 = 0 THEN 0.0::DOUBLE ELSE {n} / ({disb_uc} / 1e6) END"


def _wavg_cols(with_segment: bool = False) -> str:
    s = "segment, " if with_segment else ""
    return (f"{s}window_name, fy_start, fy_end, CAST(anchor_mob AS BIGINT) AS anchor_mob, n_quarters, "
            "n_observed_at_anchor, "
            "round(total_disb, 6) AS total_disb, round(simple_avg_lr, 8) AS simple_avg_lr, "
            "round(weighted_avg_lr, 8) AS weighted_avg_lr, round(weighted_avg_lr, 8) AS ecl_pct")


def _verdicts(rows: str, cfg: EclConfig) -> str:
    """check_id, measure, bound, verdict of SQL rows (check_id, measure)."""
    t = cfg.tol
    limits = [("feed.loan_count", 0.0, "FAIL"), ("feed.disbursal", t, "FAIL"), ("feed.overdue", t, "FAIL"),
              ("feed.outstanding", t, "FAIL"), *[(f"loss_rate.{a}m", t, "FAIL") for a in cfg.anchors],
              ("window.weighted_rate", t, "FAIL"), ("window.rate_above_one", 0.0, "WARN"),
              ("triangle.recurrence", 1e-9, "FAIL"), ("book.whole_run", t, "FAIL"),
              ("sink.summary_rate", t, "FAIL"), ("sink.rows", 0.0, "FAIL")]
    values = ", ".join(f"('{k}', {b!r}::DOUBLE, '{v}')" for k, b, v in limits)
    return (f"SELECT m.check_id, m.measure, l.bound, CASE WHEN m.measure <= l.bound THEN 'PASS' ELSE l.beyond END AS verdict "
            f"FROM ({rows}) m JOIN (VALUES {values}) l(kind, bound, beyond) ON l.kind = split_part(m.check_id, ':', 1)")


def _overall(verdicts: str) -> str:
    return f"""SELECT * FROM ({verdicts}) UNION ALL
SELECT 'overall', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
  CASE WHEN bool_or(verdict = 'FAIL') THEN 'FAIL' WHEN bool_or(verdict = 'WARN') THEN 'WARN' ELSE 'PASS' END
FROM ({verdicts})"""


def _measure(check_id: str, value: str, src: str = "") -> str:
    return f"SELECT '{check_id}' AS check_id, CAST({value} AS DOUBLE) AS measure {src}"


def _reconcile_feed_parts(cfg: EclConfig) -> tuple[list[str], str]:
    mobs = ", ".join(str(m) for m in cfg.extract_grid.mobs)
    extra = [
        f"""per_loan AS (SELECT loan_no, mob, SUM(dpd90_cents) AS d, SUM(tpos_cents) AS t
  FROM performance WHERE mob IN ({mobs}) GROUP BY loan_no, mob)""",
        """exp AS (SELECT cohort_end, segment, COUNT(*) AS exp_cnt, SUM(amount_cents) AS exp_amt
  FROM loans_w GROUP BY cohort_end, segment)""",
        """exp_long AS (SELECT l.cohort_end, l.segment, p.mob, SUM(p.d) AS exp_d, SUM(p.t) AS exp_t
  FROM loans_w l JOIN per_loan p ON p.loan_no = l.loan_no GROUP BY l.cohort_end, l.segment, p.mob)""",
        """hd AS (SELECT
  max(abs(COALESCE(d.lan_cnt, 0) - COALESCE(e.exp_cnt, 0))) AS d_cnt,
  max(abs(COALESCE(d.disb_uc * 1000, 0) - COALESCE(e.exp_amt, 0))) AS d_amt
  FROM disb d FULL OUTER JOIN exp e ON d.cohort_end = e.cohort_end AND d.segment = e.segment)""",
        """md AS (SELECT
  max(abs(COALESCE(f.dpd90_uc * 1000, 0) - COALESCE(e.exp_d, 0))) AS d_d,
  max(abs(COALESCE(f.tpos_uc * 1000, 0) - COALESCE(e.exp_t, 0))) AS d_t
  FROM feed f FULL OUTER JOIN exp_long e ON f.cohort_end = e.cohort_end AND f.segment = e.segment
                                        AND f.mob = e.mob)""",
    ]
    return extra, "\nUNION ALL ".join([
        _measure("feed.loan_count", "d_cnt", "FROM hd"),
        _measure("feed.disbursal", "CAST(d_amt AS DOUBLE) / 1e9", "FROM hd"),
        _measure("feed.overdue", "CAST(d_d AS DOUBLE) / 1e9", "FROM md"),
        _measure("feed.outstanding", "CAST(d_t AS DOUBLE) / 1e9", "FROM md")])


def _reconcile_loss_parts(cfg: EclConfig) -> tuple[list[str], str]:
    ymobs = [m for m in cfg.triangle_grid.mobs if m % YEAR_MOB == 0]
    cols = ",\n  ".join([f"max(CASE WHEN mob = {m} THEN dpd90_amt END) AS d{m}" for m in ymobs]
                        + [f"max(CASE WHEN mob = {m} THEN tpos_amt END) AS t{m}" for m in ymobs])
    extra = [f"wt AS (SELECT segment, cohort_end, disb_uc,\n  {cols}\n  FROM tri WHERE mob % {YEAR_MOB} = 0 "
             "GROUP BY segment, cohort_end, disb_uc)"]
    parts = []
    for a in cfg.anchors:
        den = " + ".join(["disb_uc / 1e6"] + [f"t{m}" for m in range(YEAR_MOB, a, YEAR_MOB)])
        extra.append(f"re{a} AS (SELECT segment, cohort_end, {_ratio(f'd{a}', den)} AS lr_re FROM wt)")
        extra.append(
            f"""dl{a} AS (SELECT round(max(abs(COALESCE(r.lr_re, 0.0) - COALESCE(l.loss_rate, 0.0))), 10) AS d
  FROM re{a} r FULL OUTER JOIN (SELECT * FROM loss WHERE anchor_mob = {a}) l
    ON r.segment = l.segment AND r.cohort_end = l.cohort_end)""")
        parts.append(_measure(f"loss_rate.{a}m", "d", f"FROM dl{a}"))
    return extra, "\nUNION ALL ".join(parts)


def _reconcile_weighted_parts(cfg: EclConfig) -> tuple[list[str], str]:
    sel = []
    for w in cfg.windows:
        sel.append(
            f"""SELECT abs(COALESCE(r.re, 0.0) - COALESCE(v.weighted_avg_lr, 0.0)) AS d FROM
  (SELECT segment, {_ratio('SUM(loss_rate * disb_cr)', 'SUM(disb_cr)')} AS re FROM loss
   WHERE anchor_mob = {w.anchor_mob} AND cohort_end BETWEEN {_date(w.first_day)} AND {_date(w.last_day)}
   GROUP BY segment) r
  FULL OUTER JOIN (SELECT segment, weighted_avg_lr FROM wavg WHERE window_name = '{w.name}') v
  ON r.segment = v.segment""")
    extra = ["rw AS (SELECT round(max(d), 10) AS d FROM (" + "\n  UNION ALL ".join(sel) + "))"]
    return extra, _measure("window.weighted_rate", "d", "FROM rw")


def _chain_parts(cfg: EclConfig) -> list[str]:
    first = cfg.triangle_grid.start
    return [
        """rc AS (
  SELECT *, COALESCE(sum(wv) OVER above, 0.0) AS s, count(*) OVER above > 0 AS has_above
  FROM (SELECT segment, cohort_end, mob, is_observed, 'dpd90' AS metric, dpd90_amt AS v, dpd90_amt AS wv FROM tri
        UNION ALL
        SELECT segment, cohort_end, mob, is_observed, 'tpos', tpos_amt, tpos_amt * (disb_uc / 1e6) FROM tri)
  WINDOW above AS (PARTITION BY metric, segment, mob ORDER BY cohort_end
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
        """rc2 AS (SELECT *, lag(s) OVER rr AS s_prev, lag(v) OVER rr AS v_prev FROM rc
  WINDOW rr AS (PARTITION BY metric, segment, cohort_end ORDER BY mob))""",
        f"""rc3 AS (SELECT *, CASE WHEN mob = {first} OR NOT has_above THEN 0.0::DOUBLE
                        WHEN s_prev = 0 THEN 0.0::DOUBLE ELSE v_prev * s / s_prev END AS expected
  FROM rc2)""",
        """rcl AS (SELECT segment, metric, CAST(count_if(NOT is_observed) AS BIGINT) AS n_projected,
  round(COALESCE(max(CASE WHEN NOT is_observed THEN abs(v - expected) / greatest(1.0::DOUBLE, abs(expected)) END),
                 0.0), 10) AS max_rel_diff
  FROM rc3 GROUP BY segment, metric)""",
    ]


def oracle_sql(cfg: EclConfig = DEFAULT) -> dict[str, str]:
    q: dict[str, str] = {}
    W = lambda sel, extra=None: _with(cfg, sel, extra)
    g = cfg.extract_grid
    tmobs = cfg.triangle_grid.mobs

    # ---- sources
    q["scan_loans"] = W(f"""SELECT loan_no, customer_id, CAST(segment AS BIGINT) AS segment,
  {ISO('disbursal_date')} AS disbursal_date, amount_cents, CAST(tenure_months AS BIGINT) AS tenure_months
FROM loans""")
    q["scan_performance"] = W("SELECT loan_no, CAST(mob AS BIGINT) AS mob, tpos_cents, dpd90_cents FROM performance")
    q["amortisation_schedule"] = W(f"""SELECT CAST(l.tenure_months AS BIGINT) AS tenure_months,
  CAST(p.mob AS BIGINT) AS mob, COUNT(*) AS n_rows, CAST(SUM(p.tpos_cents) AS BIGINT) AS tpos_cents,
  CAST(SUM(l.amount_cents) AS BIGINT) AS amount_cents,
  round({_ratio('SUM(p.tpos_cents)', 'SUM(l.amount_cents)')}, 8) AS tpos_share
FROM performance p JOIN loans l ON p.loan_no = l.loan_no GROUP BY l.tenure_months, p.mob""")
    q["default_exposure"] = W("""SELECT loan_no, CAST(segment AS BIGINT) AS segment,
  CAST(tenure_months AS BIGINT) AS tenure_months, CAST(default_mob AS BIGINT) AS default_mob,
  CAST(CASE WHEN default_mob < tenure_months THEN
    (amount_cents * (tenure_months - default_mob) * 2 + tenure_months) // (2 * tenure_months)
    ELSE 0 END AS BIGINT) AS oad_cents
FROM loans_x WHERE is_default""")
    seg_mob = lambda col, flag: f"""SELECT CAST(l.segment AS BIGINT) AS segment, CAST(p.mob AS BIGINT) AS mob,
  CAST(count_if(p.{col} > 0) AS BIGINT) AS {flag}, CAST(SUM(p.{col}) AS BIGINT) AS {col}
FROM performance p JOIN loans l ON p.loan_no = l.loan_no GROUP BY l.segment, p.mob"""
    q["default_carry_forward"] = W(seg_mob("dpd90_cents", "n_in_default"))
    q["tpos_frozen"] = _with(cfg.with_(freeze_tpos_at_default=True), seg_mob("tpos_cents", "n_outstanding"))
    q["dq_key_violations"] = W("""SELECT
  (SELECT COUNT(*) FROM loans) AS n_loans,
  (SELECT COUNT(*) FROM (SELECT loan_no FROM loans GROUP BY loan_no HAVING COUNT(*) > 1)) AS dup_loan_keys,
  (SELECT CAST(count_if(loan_no IS NULL OR customer_id IS NULL OR segment IS NULL OR disbursal_date IS NULL
                   OR amount_cents IS NULL OR tenure_months IS NULL) AS BIGINT) FROM loans) AS null_loan_fields,
  (SELECT COUNT(*) FROM performance) AS n_perf_rows,
  (SELECT COUNT(*) FROM (SELECT loan_no, mob FROM performance GROUP BY loan_no, mob HAVING COUNT(*) > 1)) AS dup_perf_keys,
  (SELECT CAST(count_if(loan_no IS NULL OR mob IS NULL OR tpos_cents IS NULL OR dpd90_cents IS NULL) AS BIGINT)
     FROM performance) AS null_perf_fields,
  (SELECT COUNT(*) FROM performance p WHERE NOT EXISTS
     (SELECT 1 FROM loans l WHERE l.loan_no = p.loan_no)) AS orphan_perf_rows,
  (SELECT COUNT(*) FROM loans l WHERE NOT EXISTS
     (SELECT 1 FROM performance p WHERE p.loan_no = l.loan_no)) AS loans_without_perf""")

    # ---- calendar
    q["fiscal_quarter"] = W(f"""SELECT {ISO('d')} AS disbursal_date, {LABEL('d')} AS fy_quarter,
  CAST(CASE WHEN month(d) >= 4 THEN year(d) + 1 ELSE year(d) END AS BIGINT) AS fiscal_year,
  CAST(((month(d) + 8) % 12) // 3 + 1 AS BIGINT) AS fiscal_quarter,
  {ISO(COHORT_END('d'))} AS cohort_end
FROM (SELECT DISTINCT disbursal_date AS d FROM loans)""")
    q["cohort_calendar"] = W(f"""SELECT segment, {LBL()}, CAST(months_on_book AS BIGINT) AS months_on_book,
  CAST(max_mature_mob AS BIGINT) AS max_mature_mob, CAST(max_mature_mob AS BIGINT) AS current_mob FROM cal""")
    q["maturity_mask"] = W(f"""SELECT {LBL()}, CAST(mob AS BIGINT) AS mob,
  CAST(max_mature_mob AS BIGINT) AS max_mature_mob, is_observed FROM cells WHERE {ALL}""")
    hw = cfg.headline_window
    q["disbursal_window"] = W(f"""SELECT {LBL()}, COUNT(*) AS n_loans, CAST(SUM(amount_cents) AS BIGINT) AS amount_cents,
  {ISO('min(disbursal_date)')} AS first_disbursal, {ISO('max(disbursal_date)')} AS last_disbursal
FROM (SELECT *, {COHORT_END('disbursal_date')} AS cohort_end FROM loans
      WHERE disbursal_date BETWEEN {_date(hw.first_day)} AND {_date(hw.last_day)})
GROUP BY cohort_end""")
    q["segment_feed"] = W(f"""SELECT {LBL()}, CAST(mob AS BIGINT) AS mob, round(dpd90_uc / 1e6, 6) AS dpd90_cr,
  round(tpos_uc / 1e6, 6) AS tpos_cr FROM feed WHERE segment = 3""")
    tri_in = ", ".join(str(m) for m in tmobs)
    n_anchor = " + ".join(f"(CASE WHEN mob < {a} THEN 1 ELSE 0 END)" for a in cfg.anchors)
    q["mob_grid"] = W(f"""SELECT CAST(mob AS BIGINT) AS mob, COUNT(*) AS n_rows, mob IN ({tri_in}) AS in_triangle,
  mob % {YEAR_MOB} = 0 AS is_yearly,
  CAST(CASE WHEN mob % {YEAR_MOB} = 0 AND mob > 0 THEN {n_anchor} ELSE 0 END AS BIGINT) AS n_anchor_denominators
FROM performance GROUP BY mob""")

    # ---- feed
    q["feed_long"] = W(f"""SELECT {LBL()}, CAST(segment AS BIGINT) AS segment, CAST(mob AS BIGINT) AS mob,
  round(dpd90_uc / 1e6, 6) AS dpd90_cr, round(tpos_uc / 1e6, 6) AS tpos_cr FROM feed""")
    q["feed_disbursal"] = W(f"""SELECT {LBL()}, CAST(segment AS BIGINT) AS segment, lan_cnt,
  round(disb_uc / 1e6, 6) AS disbursal_cr FROM disb""")
    q["loan_mob_wide"] = W("SELECT loan_no,\n  "
                           + _wide_cols(g.mobs, lambda m: f"SUM(CASE WHEN mob = {m} THEN dpd90_cents END)",
                                        lambda m: f"overdue_at_{m}", "DOUBLE") + ",\n  "
                           + _wide_cols(g.mobs, lambda m: f"SUM(CASE WHEN mob = {m} THEN tpos_cents END)",
                                        lambda m: f"outstanding_at_{m}", "DOUBLE")
                           + "\nFROM performance GROUP BY loan_no")
    fw_cols = ",\n  ".join(
        [f"round(max(CASE WHEN f.mob = {m} THEN f.dpd90_uc END) / 1e6, 6) AS amt_90plus_settlement_{m}mob"
         for m in g.mobs]
        + [f"round(max(CASE WHEN f.mob = {m} THEN f.tpos_uc END) / 1e6, 6) AS tpos_{m}mob" for m in g.mobs])
    feed_wide_sel = f"""SELECT {LABEL('d.cohort_end')} AS fy_quarter, CAST(d.segment AS BIGINT) AS segment,
  d.lan_cnt, round(d.disb_uc / 1e6, 6) AS disbursal_amt,
  {fw_cols}
FROM disb d LEFT JOIN feed f ON f.cohort_end = d.cohort_end AND f.segment = d.segment
GROUP BY d.cohort_end, d.segment, d.lan_cnt, d.disb_uc"""
    q["feed_wide"] = W(feed_wide_sel)
    q["feed_by_quarter"] = W(f"""SELECT {LBL('d.cohort_end')}, CAST(x.mob AS BIGINT) AS mob, d.lan_cnt,
  round(d.disb_uc / 1e6, 6) AS disbursal_cr,
  round(COALESCE(f.dpd90_uc, 0) / 1e6, 6) AS dpd90_cr, round(COALESCE(f.tpos_uc, 0) / 1e6, 6) AS tpos_cr
FROM disb_g d CROSS JOIN (SELECT CAST(unnest(generate_series({g.start}, {g.stop}, {g.step})) AS INTEGER) AS mob) x
LEFT JOIN feed_g f ON f.segment = d.segment AND f.cohort_end = d.cohort_end AND f.mob = x.mob
WHERE d.segment = 'all'""")
    vcols = ", ".join([f"amt_90plus_settlement_{m}mob" for m in g.mobs] + [f"tpos_{m}mob" for m in g.mobs])
    q["unpivot_feed"] = W(f"""SELECT fy_quarter, segment,
  CASE WHEN col_name LIKE 'tpos_%' THEN 'tpos' ELSE 'dpd90' END AS metric,
  CAST(regexp_extract(col_name, '_(\\d+)mob$', 1) AS BIGINT) AS mob, amount_cr
FROM (UNPIVOT fw ON {vcols} INTO NAME col_name VALUE amount_cr)
WHERE amount_cr IS NOT NULL""", [f"fw AS ({feed_wide_sel})"])

    # ---- profile
    q["book_profile"] = W(f"""SELECT
  (SELECT COUNT(*) FROM loans) AS n_loans,
  (SELECT COUNT(*) FROM performance) AS n_perf_rows,
  (SELECT round(CAST((SUM(amount_cents) + 500) // 1000 AS BIGINT) / 1e6, 6) FROM loans) AS disbursal_cr,
  (SELECT COUNT(DISTINCT customer_id) FROM loans) AS n_customers,
  (SELECT {ISO('min(disbursal_date)')} FROM loans) AS first_disbursal,
  (SELECT {ISO('max(disbursal_date)')} FROM loans) AS last_disbursal,
  round(CAST((SELECT COUNT(*) FROM performance) AS DOUBLE)
        / CAST((SELECT COUNT(*) FROM loans) AS DOUBLE), 8) AS avg_observed_mobs,
  (SELECT max(c) FROM (SELECT COUNT(*) AS c FROM loans GROUP BY customer_id)) AS max_loans_per_customer""")
    q["observed_mob_spread"] = W("""SELECT CAST(min(m) AS BIGINT) AS min_max_mob,
  CAST(quantile_cont(m, 0.5) AS DOUBLE) AS median_max_mob, CAST(max(m) AS BIGINT) AS max_max_mob
FROM (SELECT loan_no, max(mob) AS m FROM performance GROUP BY loan_no)""")
    q["default_rate_by_segment"] = W(f"""SELECT CAST(l.segment AS BIGINT) AS segment, COUNT(*) AS n_loans,
  CAST(count_if(p.d) AS BIGINT) AS n_defaulted, round({_ratio('CAST(count_if(p.d) AS BIGINT)', 'COUNT(*)')}, 8) AS default_rate
FROM (SELECT loan_no, max(dpd90_cents) > 0 AS d FROM performance GROUP BY loan_no) p
JOIN loans l ON l.loan_no = p.loan_no GROUP BY l.segment""")

    # ---- triangles
    q["triangle_observed"] = W(f"""SELECT {LBL()}, CAST(mob AS BIGINT) AS mob, is_observed,
  round(CASE WHEN is_observed THEN dpd90_uc / 1e6 END, 6) AS dpd90_cr,
  round(CASE WHEN is_observed THEN tpos_uc / 1e6 END, 6) AS tpos_cr FROM cells WHERE {ALL}""")
    q["dev_factor_90plus"] = W(f"""SELECT CAST(mob AS BIGINT) AS mob, n_mature, round(num_dpd90 / 1e6, 6) AS num_cr,
  round(den_dpd90 / 1e6, 6) AS den_cr, round(f_dpd90, 8) AS factor, degenerate_dpd90 AS degenerate
FROM fac WHERE {ALL}""")
    q["dev_factor_tpos"] = W(f"""SELECT CAST(mob AS BIGINT) AS mob, n_mature,
  CAST(num_tpos AS DOUBLE) AS num_amt_x_disb, CAST(den_tpos AS DOUBLE) AS den_amt_x_disb,
  round(f_tpos, 8) AS factor, degenerate_tpos AS degenerate FROM fac WHERE {ALL}""")
    for m, name in (("dpd90", "chain_ladder_90plus"), ("tpos", "chain_ladder_tpos")):
        q[name] = W(f"""SELECT {LBL()}, CAST(mob AS BIGINT) AS mob, is_observed, round({m}_amt, 6) AS amount_cr,
  round({_rate(f'{m}_amt')}, 8) AS rate FROM tri WHERE {ALL}""")
    q["chain_ladder_young_book"] = _with(YOUNG_BOOK if cfg == DEFAULT else cfg.with_(
        as_of=YOUNG_BOOK.as_of), f"""SELECT {LBL()}, CAST(mob AS BIGINT) AS mob, is_observed,
  round(dpd90_amt, 6) AS dpd90_amt, round(tpos_amt, 6) AS tpos_amt FROM tri WHERE {ALL}""")
    q["triangle_rate"] = W(f"""SELECT {LBL()}, CAST(mob AS BIGINT) AS mob, is_observed,
  round({_rate('dpd90_amt')}, 8) AS dpd90_rate, round({_rate('tpos_amt')}, 8) AS tpos_rate
FROM tri WHERE {ALL}""")
    q["triangle_amount"] = W(f"""SELECT {LBL()}, CAST(mob AS BIGINT) AS mob, is_observed,
  round(dpd90_amt, 6) AS dpd90_amt, round(tpos_amt, 6) AS tpos_amt FROM tri WHERE {ALL}""")
    q["chain_ladder_by_segment"] = W(f"""SELECT segment, {LBL()}, CAST(mob AS BIGINT) AS mob, is_observed,
  round(dpd90_amt, 6) AS dpd90_amt, round(tpos_amt, 6) AS tpos_amt FROM tri""")
    q["chain_ladder_sequential"] = W(f"""SELECT segment, metric, {LBL()}, CAST(mob AS BIGINT) AS mob,
  round(amount, 6) AS amount_cr
FROM (SELECT segment, 'dpd90' AS metric, cohort_end, mob, dpd90_amt AS amount FROM tri
      UNION ALL SELECT segment, 'tpos', cohort_end, mob, tpos_amt FROM tri)""")
    q["triangle_cell_counts"] = W("""SELECT segment, COUNT(DISTINCT cohort_end) AS n_cohorts, COUNT(*) AS n_cells,
  CAST(count_if(is_observed) AS BIGINT) AS n_observed, CAST(count_if(NOT is_observed) AS BIGINT) AS n_projected FROM cells GROUP BY segment""")
    q["triangle_sanity"] = W(f"""SELECT segment, COUNT(*) AS n_cells,
  CAST(count_if(dpd90_amt IS NULL OR tpos_amt IS NULL) AS BIGINT) AS n_null, CAST(count_if(r < prev - 1e-9) AS BIGINT) AS n_decreasing
FROM (SELECT *, lag(r) OVER (PARTITION BY segment, cohort_end ORDER BY mob) AS prev
      FROM (SELECT *, {_rate('dpd90_amt')} AS r FROM tri))
GROUP BY segment""")
    q["reconcile_chain_ladder"] = W("""SELECT segment, metric, n_projected, max_rel_diff,
  CASE WHEN max_rel_diff <= 1e-9 THEN 'PASS' ELSE 'FAIL' END AS result FROM rcl""", _chain_parts(cfg))

    # ---- movements / loss
    for col, name, dp, expr in (
            ("tpos_amt", "movement_tpos_amt", 6, "tpos_amt"),
            ("tpos_pct", "movement_tpos_pct", 8, _rate("tpos_amt")),
            ("dpd90_amt", "movement_90plus_amt", 6, "dpd90_amt"),
            ("dpd90_pct", "movement_90plus_pct", 8, _rate("dpd90_amt"))):
        q[name] = W(f"""SELECT {LBL()}, CAST(mob AS BIGINT) AS mob, is_observed, round({expr}, {dp}) AS {col}
FROM tri WHERE {ALL} AND mob % {YEAR_MOB} = 0""")
    q["loss_rate_denominator"] = W(f"""SELECT {LBL()}, CAST(anchor_mob AS BIGINT) AS anchor_mob,
  round(disb_cr, 6) AS disb_cr, round(tpos_sum, 6) AS tpos_sum, round(denominator, 6) AS denominator
FROM loss WHERE {ALL}""")
    q["loss_rate"] = W(f"""SELECT {LBL()}, CAST(anchor_mob AS BIGINT) AS anchor_mob,
  round(ninety_plus, 6) AS ninety_plus, round(denominator, 6) AS denominator,
  round(loss_rate, 8) AS loss_rate, anchor_observed FROM loss WHERE {ALL}""")
    q["loss_rate_flags"] = W(f"""SELECT segment, {LBL()}, CAST(anchor_mob AS BIGINT) AS anchor_mob,
  round(loss_rate, 8) AS loss_rate,
  CASE WHEN NOT anchor_observed THEN 'projected' WHEN loss_rate > 1 THEN 'implausible'
       ELSE 'observed' END AS flag FROM loss""")
    q["loss_rate_stats"] = W("""SELECT segment, CAST(anchor_mob AS BIGINT) AS anchor_mob, COUNT(*) AS n_cohorts,
  round(min(loss_rate), 8) AS min_lr, round(quantile_cont(loss_rate, 0.5), 8) AS median_lr,
  round(max(loss_rate), 8) AS max_lr, CAST(count_if(loss_rate > 1) AS BIGINT) AS n_above_100pct
FROM loss GROUP BY segment, anchor_mob""")
    q["current_tpos"] = W(f"""SELECT {LBL()}, CAST(current_mob AS BIGINT) AS current_mob,
  round(current_tpos, 6) AS current_tpos FROM cur WHERE {ALL}""")
    q["portfolio_tpos"] = W("""SELECT segment, COUNT(*) AS n_cohorts, round(SUM(current_tpos), 6) AS portfolio_tpos
FROM cur GROUP BY segment""")

    # ---- ECL
    q["weighted_loss_rate"] = W(f"SELECT {_wavg_cols()} FROM wavg WHERE {ALL}")
    q["headline_ecl"] = W(f"SELECT {_wavg_cols()} FROM wavg WHERE {ALL} AND window_name = '{cfg.headline}'")
    seg, y1, y2, anc = SEGMENT_ECL_ARGS
    sw = SegmentRequest.read(cfg, seg, y1, y2, anc).window
    q["segment_ecl"] = W(f"""SELECT {_wavg_cols(True)} FROM (
  SELECT '{seg}' AS segment, '{sw.name}' AS window_name, '{sw.start_label}' AS fy_start,
    '{sw.end_label}' AS fy_end, {sw.anchor_mob} AS anchor_mob,
    COUNT(cohort_end) AS n_quarters, CAST(count_if(anchor_observed) AS BIGINT) AS n_observed_at_anchor,
    COALESCE(SUM(disb_cr), 0.0) AS total_disb,
    AVG(loss_rate) AS simple_avg_lr, {_ratio('SUM(loss_rate * disb_cr)', 'SUM(disb_cr)')} AS weighted_avg_lr
  FROM loss WHERE segment = '{seg}' AND anchor_mob = {sw.anchor_mob}
    AND cohort_end BETWEEN {_date(sw.first_day)} AND {_date(sw.last_day)})""")
    q["segment_ecl_detail"] = W(f"""SELECT {LBL()}, round(disb_cr, 6) AS disb_cr, round(ninety_plus, 6) AS ninety_plus,
  round(denominator, 6) AS denominator, round(loss_rate, 8) AS loss_rate, anchor_observed
FROM loss WHERE segment = '{seg}' AND anchor_mob = {sw.anchor_mob}
  AND cohort_end BETWEEN {_date(sw.first_day)} AND {_date(sw.last_day)}""")
    q["weighted_over_windows"] = W(f"""SELECT g.segment, strftime(f.first_day, '%Y-%m-%d') || '..' || strftime(f.last_day, '%Y-%m-%d') AS window_name,
  CAST(g.anchor_mob AS BIGINT) AS anchor_mob, COUNT(l.loss_rate) AS n_quarters,
  CAST(count_if(l.anchor_observed) AS BIGINT) AS n_observed_at_anchor, round(COALESCE(SUM(l.disb_cr), 0), 6) AS total_disb,
  round(AVG(l.loss_rate), 7) AS simple_avg_lr,
  round(CASE WHEN COALESCE(SUM(l.disb_cr), 0) = 0 THEN 0 ELSE SUM(l.loss_rate * l.disb_cr) / SUM(l.disb_cr) END, 7) AS weighted_avg_lr
FROM (SELECT DISTINCT segment, anchor_mob FROM loss) g
CROSS JOIN (SELECT first_day, {COHORT_END('q')} AS last_day FROM (
  SELECT first_day, unnest(generate_series(first_day::TIMESTAMP, {_date(cfg.as_of)}::TIMESTAMP, INTERVAL 3 MONTH)) AS q
  FROM (SELECT DISTINCT CAST(date_trunc('month', cohort_end) - INTERVAL 2 MONTH AS DATE) AS first_day FROM disb_g WHERE {ALL}))) f
LEFT JOIN loss l ON l.segment = g.segment AND l.anchor_mob = g.anchor_mob AND l.cohort_end BETWEEN f.first_day AND f.last_day
GROUP BY g.segment, g.anchor_mob, f.first_day, f.last_day""")
    q["cohort_calendar_unequal"] = _with(UNEQUAL_BOOK, f"""SELECT segment, {LBL()}, CAST(months_on_book AS BIGINT) AS months_on_book,
  CAST(max_mature_mob AS BIGINT) AS max_mature_mob FROM cal""")
    q["chain_ladder_unequal"] = _with(UNEQUAL_BOOK, f"""SELECT segment, {LBL()}, CAST(mob AS BIGINT) AS mob, is_observed,
  round(dpd90_amt, 6) AS dpd90_amt, round(tpos_amt, 6) AS tpos_amt, round({_rate('dpd90_amt')}, 8) AS dpd90_rate FROM tri""")
    q["segment_ecl_unequal"] = _with(UNEQUAL_BOOK, f"SELECT {_wavg_cols(True)} FROM wavg")

    # ---- requests: each kind's arguments as they are meant, not parsed
    fy = "CASE WHEN month(cohort_end) >= 4 THEN year(cohort_end) + 1 ELSE year(cohort_end) END"
    kinds = [("segment", "fy", "2001", "84", "''"), ("segment", "year(cohort_end)", "fy", "72", "''"),
             ("CASE WHEN segment = 'all' THEN 'all' END", "fy", "fy", "120", "CASE WHEN segment <> 'all' THEN 'no such segment' ELSE '' END"),
             ("segment", "2001", "fy", "month(cohort_end) * 12",
              f"CASE WHEN month(cohort_end) * 12 IN ({', '.join(map(str, cfg.anchors))}) THEN '' ELSE 'no anchor' END"),
             ("NULL", "NULL", "NULL", "NULL", "'no such segment; no first fiscal year; no last fiscal year; no anchor'"),
             ("segment", "fy + 40", "fy + 41", "84", "''")]
    asked = "\n  UNION ALL ".join(
        f"SELECT cohort_end, segment AS of, {i} AS kind, {k} AS key, {a} AS y1, {z} AS y2, {m} AS anchor, {wrong} AS wrong "
        f"FROM (SELECT *, {fy} AS fy FROM disb_g)" for i, (k, a, z, m, wrong) in enumerate(kinds))
    q["segment_requests"] = W(f"""SELECT {LABEL('cohort_end')} AS cohort, of, CAST(kind AS BIGINT) AS kind, key,
  CASE WHEN problem = '' THEN n ELSE 0 END AS n_quarters, CASE WHEN problem = '' THEN round(rate, 7) END AS weighted_avg_lr,
  nullif(problem, '') AS problem
FROM (SELECT *, CASE WHEN wrong <> '' OR y1 > y2 THEN concat_ws('; ', nullif(wrong, ''), CASE WHEN y1 > y2 THEN 'ends before it begins' END)
                     WHEN n = 0 THEN 'covers no cohorts' ELSE '' END AS problem
      FROM (SELECT a.cohort_end, a.of, a.kind, a.key, a.y1, a.y2, a.wrong, COUNT(l.loss_rate) AS n,
              CASE WHEN COALESCE(SUM(l.disb_cr), 0) = 0 THEN 0 ELSE SUM(l.loss_rate * l.disb_cr) / SUM(l.disb_cr) END AS rate
            FROM asked a LEFT JOIN loss l ON l.segment = a.key AND l.anchor_mob = a.anchor
              AND l.cohort_end > make_date(CAST(a.y1 - 1 AS BIGINT), 3, 31) AND l.cohort_end <= make_date(CAST(a.y2 AS BIGINT), 3, 31)
            GROUP BY ALL))""", [f"asked AS ({asked})"])

    # ---- R9: one MOB of the feed, of the sources, and of a second copy of performance
    r = RESTATED
    spot = [f"""restated AS (
  SELECT loan_no, mob, tpos_cents, dpd90_cents + CASE WHEN (loan_no % {r['amount']} = 0 AND mob = {YEAR_MOB}) OR (loan_no % {r['later']} = 0
    AND mob = {2 * YEAR_MOB}) THEN 100000000 ELSE 0 END AS dpd90_cents
  FROM (SELECT *, unnest(CASE WHEN mob <> {YEAR_MOB} THEN [1] WHEN loan_no % {r['gone']} = 0 THEN [] WHEN loan_no % {r['twice']} = 0
    THEN [1, 1] ELSE [1] END) FROM performance))"""]

    def at_one_mob(source: str) -> str:
        return f"""(SELECT l.cohort_end, l.segment, f.lan_cnt AS feed_loans, l.n AS source_loans, f.disb_uc * 1000 AS feed_disbursal,
    CAST(l.amt AS BIGINT) AS source_disbursal, COALESCE(m.dpd90_uc, 0) * 1000 AS feed_dpd90, CAST(COALESCE(p.d, 0) AS BIGINT) AS source_dpd90,
    COALESCE(m.tpos_uc, 0) * 1000 AS feed_tpos, CAST(COALESCE(p.t, 0) AS BIGINT) AS source_tpos
  FROM (SELECT cohort_end, segment, COUNT(*) AS n, SUM(amount_cents) AS amt FROM loans_w GROUP BY 1, 2) l
  JOIN disb f USING (cohort_end, segment)
  LEFT JOIN (SELECT * FROM feed WHERE mob = {YEAR_MOB}) m USING (cohort_end, segment)
  LEFT JOIN (SELECT w.cohort_end, w.segment, SUM(dpd90_cents) AS d, SUM(tpos_cents) AS t FROM {source} s JOIN loans_w w USING (loan_no)
             WHERE s.mob = {YEAR_MOB} GROUP BY 1, 2) p USING (cohort_end, segment))"""

    off = ("greatest(abs(feed_disbursal - source_disbursal), abs(feed_dpd90 - source_dpd90), abs(feed_tpos - source_tpos))")
    sides = ", ".join(f"feed_{x}, source_{x}" for x in ("loans", "disbursal", "dpd90", "tpos"))
    q["spot_check"] = W(f"""SELECT {LBL()}, CAST(segment AS BIGINT) AS segment, {sides}, {off} AS off_cents,
  CASE WHEN feed_loans = source_loans AND {off} <= {cfg.tol} * 1e9 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM {at_one_mob('performance')}""")
    q["spot_check_restated"] = W(f"""SELECT {LBL()}, CAST(segment AS BIGINT) AS segment, feed_dpd90, source_dpd90, feed_tpos, source_tpos,
  {off} AS off_cents FROM {at_one_mob('restated')} WHERE {off} > {cfg.tol} * 1e9""", spot)
    q["spot_loans"] = W(f"""SELECT loan_no, r1 AS rows_1, COALESCE(r2, 0) AS rows_2, d1 AS dpd90_cents_1, t1 AS tpos_cents_1,
  COALESCE(d2, 0) AS dpd90_cents_2, COALESCE(t2, 0) AS tpos_cents_2, CASE WHEN r2 IS NULL THEN 'missing' WHEN r1 <> r2 THEN 'rows' ELSE 'amounts' END AS reason
FROM (SELECT loan_no, COUNT(*) AS r1, CAST(SUM(dpd90_cents) AS BIGINT) AS d1, CAST(SUM(tpos_cents) AS BIGINT) AS t1
      FROM performance WHERE mob = {YEAR_MOB} GROUP BY 1)
LEFT JOIN (SELECT loan_no, COUNT(*) AS r2, CAST(SUM(dpd90_cents) AS BIGINT) AS d2, CAST(SUM(tpos_cents) AS BIGINT) AS t2
           FROM restated WHERE mob = {YEAR_MOB} GROUP BY 1) USING (loan_no)
WHERE (r1, d1, t1) IS DISTINCT FROM (r2, d2, t2)""", spot)
    q["segment_ecl_matrix"] = W(f"SELECT {_wavg_cols(True)} FROM wavg")
    q["cohort_edges"] = W(f"""SELECT {LBL()}, CAST(max_mature_mob AS BIGINT) AS max_mature_mob,
  CASE WHEN u <= 3 THEN 'first' ELSE 'last' END AS edge,
  CAST(CASE WHEN u <= 3 THEN u ELSE d END AS BIGINT) AS edge_rank
FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY cohort_end) AS u,
             row_number() OVER (PARTITION BY segment ORDER BY cohort_end DESC) AS d
      FROM cal WHERE {ALL})
WHERE u <= 3 OR d <= 3""")

    # ---- checks
    def validation(c: EclConfig) -> tuple[list[str], str]:
        fx, fbody = _reconcile_feed_parts(c)
        lx, lbody = _reconcile_loss_parts(c)
        wx, wbody = _reconcile_weighted_parts(c)
        chain = _measure("triangle.recurrence", "d", "FROM (SELECT max(max_rel_diff) AS d FROM rcl)")
        above = _measure("window.rate_above_one", "d", "FROM (SELECT round(max(greatest(0.0, weighted_avg_lr - 1)), 10) AS d "
                         f"FROM wavg WHERE {ALL})")
        return (fx + lx + wx + _chain_parts(c), "\nUNION ALL ".join([fbody, lbody, wbody, chain, above]))

    for name, parts in (("reconcile_feed", _reconcile_feed_parts(cfg)), ("reconcile_loss_rate", _reconcile_loss_parts(cfg)),
                        ("reconcile_weighted", _reconcile_weighted_parts(cfg))):
        q[name] = W(_verdicts(parts[1], cfg), parts[0])
    vx, vbody = validation(cfg)
    q["validation_checks"] = W(_overall(_verdicts(vbody, cfg)), vx)
    mx, mbody = validation(MATURE_BOOK)
    q["validation_checks_mature"] = _with(MATURE_BOOK, _overall(_verdicts(mbody, MATURE_BOOK)), mx)
    hw = cfg.headline_window
    inside = f"anchor_mob = {hw.anchor_mob} AND cohort_end BETWEEN {_date(hw.first_day)} AND {_date(hw.last_day)}"
    # The matrix row against the rate summed from the loss table
    whole_rate = f"SELECT {_ratio('SUM(loss_rate * disb_cr)', 'SUM(disb_cr)')} AS w FROM loss WHERE {ALL} AND {inside}"
    seg_rate = f"SELECT weighted_avg_lr AS w FROM wavg WHERE {ALL} AND window_name = '{cfg.headline}'"
    whole_run = _measure("book.whole_run", "d", f"FROM (SELECT round(abs(a.w - b.w), 10) AS d FROM ({seg_rate}) a, ({whole_rate}) b)")
    q["reconcile_all_segment"] = W(_verdicts(whole_run, cfg))
    # The summary's rate (rounded as published) and the loss table's
    told = _measure("sink.summary_rate", "d", f"""FROM (SELECT round(abs(round(a.w, 8) - round(b.w, 8)), 10) AS d
  FROM ({seg_rate}) a, ({whole_rate}) b)""")
    q["reconcile_summary"] = W(_verdicts(told, cfg))

    # ---- sinks
    sizes = {
        "feed_state": "(SELECT mob FROM feed UNION ALL SELECT NULL FROM disb)", "feed": "feed", "feed_disbursal": "disb", "feed_wide": "disb", "triangles": "tri",
        "movements": f"tri WHERE mob % {YEAR_MOB} = 0", "loss": "loss",
        "by_quarter": f"(SELECT DISTINCT cohort_end FROM loss WHERE {ALL})", "weighted": "wavg",
        "summary": "(SELECT unnest(range(9)))"}
    q["sink_round_trip"] = W("\nUNION ALL ".join(
        f"SELECT '{k}' AS table_name, COUNT(*) AS rows_written, COUNT(*) AS rows_read FROM {src}" for k, src in sizes.items()))
    sunk = "\nUNION ALL ".join(_measure(f"sink.rows:{k}", "0.0") for k in sizes)
    q["published_checks"] = W(_overall(_verdicts("\nUNION ALL ".join([vbody, whole_run, told, sunk]), cfg)), vx)
    q["headline_from_extract"] = q["headline_ecl"]
    q["roll_forward_feed"] = q["feed_long"]
    q["resume_from_published"] = q["segment_ecl_matrix"]
    rate = f"(SELECT round(weighted_avg_lr, 8) FROM wavg WHERE {ALL} AND window_name = '{hw.name}')"
    q["accepted_quarter"] = W(f"""SELECT CAST(1 AS BIGINT) AS run, 'accepted' AS verdict, '' AS failed, {rate} AS ecl_pct,
  true AS is_the_quarter
UNION ALL SELECT 2, 'rejected', 'feed.loan_count', {rate}, false""")

    # ---- a damaged extract: what is left of both tables, and what is not
    d = DAMAGED
    bad_loan = f"(loan_no % {d['date']} = 0 OR loan_no % {d['amount']} = 0)"
    bad_perf = f"(loan_no % {d['tpos']} = 0 AND mob = {YEAR_MOB})"
    rejected = [("loans", "disbursal_date", "2020-13-45", "not a date", f"loan_no % {d['date']} = 0"),
                ("loans", "disbursal_amount", "12,5", "not an amount", f"loan_no % {d['amount']} = 0"),
                ("performance", "tpos", "n/a", "not an amount", bad_perf)]
    q["rejected_rows"] = W("\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{f}' AS field, '{raw}' AS raw, '{why}' AS reason, COUNT(*) AS n_rows, "
        f"COUNT(DISTINCT loan_no) AS n_loans FROM {t} WHERE {cond} HAVING COUNT(*) > 0" for t, f, raw, why, cond in rejected))
    left = [x.replace("  FROM orders)", "  FROM orders), loans AS (SELECT * FROM all_loans WHERE NOT " + bad_loan + ")")
            .replace("loans AS (\n", "all_loans AS (\n", 1) if x.startswith("loans AS") else
            x.replace("FROM loans)", "FROM all_loans)") if x.startswith("loans_x AS") else
            x.replace("performance AS (\n", "all_performance AS (\n")
            + f",\nperformance AS (SELECT * FROM all_performance WHERE NOT {bad_perf})" if x.startswith("performance AS") else x
            for x in ctes(cfg)]
    q["headline_from_damaged_extract"] = "WITH " + ",\n".join(left) + "\n" + (
        f"SELECT {_wavg_cols()} FROM wavg WHERE {ALL} AND window_name = '{cfg.headline}'")
    q["dq_damaged_extract"] = "WITH " + ",\n".join(left) + "\n" + q["dq_key_violations"][
        q["dq_key_violations"].index("SELECT\n  (SELECT COUNT(*) FROM loans) AS n_loans"):] + f""",
  (SELECT COUNT(*) FROM all_loans WHERE {bad_loan}) AS rejected_loans_rows,
  (SELECT COUNT(*) FROM all_performance WHERE {bad_perf}) AS rejected_performance_rows"""

    # ---- C6 by the recurrence itself, a cell at a time in column order, for all groups at once
    first, stop, step = cfg.triangle_grid.start, cfg.triangle_grid.stop, cfg.triangle_grid.step
    n_cols = (stop - first) // step + 1
    fine = [x.replace("CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS segment,",
                      f"CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 100 + CAST(o_orderkey % {DEGENERATE_GROUPS} AS INTEGER) AS segment,")
            .replace("CASE segment WHEN", "CASE segment // 100 WHEN") for x in ctes(YOUNG_BOOK)]
    fine = fine[:next(i for i, x in enumerate(fine) if x.startswith("lagged AS"))]
    q["chain_ladder_degenerate"] = "WITH RECURSIVE " + ",\n".join(fine) + f""",
ordered AS (
  SELECT segment, mob, list(CASE WHEN is_observed THEN dpd90_uc / 1e6 END ORDER BY cohort_end) AS seen,
         list(cohort_end ORDER BY cohort_end) AS cohorts
  FROM cells WHERE segment <> 'all' GROUP BY segment, mob),
columns AS (SELECT segment, any_value(cohorts) AS cohorts, list(seen ORDER BY mob) AS seen FROM ordered GROUP BY segment),
sweep AS (
  SELECT segment, 1 AS j, 1 AS i, CAST([] AS DOUBLE[]) AS before, CAST([] AS DOUBLE[]) AS done, cohorts, seen FROM columns
  UNION ALL
  SELECT segment, CASE WHEN i = len(cohorts) THEN j + 1 ELSE j END, CASE WHEN i = len(cohorts) THEN 1 ELSE i + 1 END,
    CASE WHEN i = len(cohorts) THEN list_append(done, v) ELSE before END,
    CASE WHEN i = len(cohorts) THEN CAST([] AS DOUBLE[]) ELSE list_append(done, v) END, cohorts, seen
  FROM (SELECT *, CASE WHEN seen[j][i] IS NOT NULL THEN seen[j][i]
                       WHEN i = 1 OR j = 1 OR list_sum(before[1:i - 1]) = 0 THEN 0.0::DOUBLE
                       ELSE before[i] * list_sum(done) / list_sum(before[1:i - 1]) END AS v
        FROM sweep WHERE j <= {n_cols})),
filled_columns AS (SELECT segment, j - 1 AS j, before, cohorts, seen FROM sweep WHERE i = 1 AND j > 1),
cells_out AS (
  SELECT segment, {first} + (j - 1) * {step} AS mob, unnest(cohorts) AS cohort_end, unnest(before) AS v, unnest(seen[j]) AS o
  FROM filled_columns)
SELECT segment, {LBL()}, CAST(mob AS BIGINT) AS mob, round(v, 6) AS amount_cr FROM cells_out WHERE o IS NULL"""

    # ---- report tables
    for m, name in (("dpd90", "raw_pivot_90plus"), ("tpos", "raw_pivot_tpos")):
        cols = ",\n  ".join(f"round(SUM(CASE WHEN is_observed AND mob = {x} THEN {m}_uc END) / 1e6, 6) AS m{x}"
                            for x in tmobs)
        q[name] = W(f"""SELECT {LBL()}, round(disb_uc / 1e6, 6) AS disb_cr,
  {cols}
FROM cells WHERE {ALL} GROUP BY cohort_end, disb_uc
UNION ALL
SELECT 'Grand Total', CAST(NULL AS VARCHAR),
  (SELECT round(SUM(disb_uc) / 1e6, 6) FROM cal WHERE {ALL}),
  {cols}
FROM cells WHERE {ALL}""")
    rate_cols = ",\n  ".join(f"max(CASE WHEN mob = {x} THEN round({_rate('dpd90_amt')}, 8) END) AS m{x}"
                             for x in tmobs)
    amt_cols = ",\n  ".join(f"max(CASE WHEN mob = {x} THEN round(tpos_amt, 6) END) AS m{x}" for x in tmobs)
    q["triangle_wide"] = W(f"""SELECT {LBL()}, 'dpd90_rate' AS metric, round(disb_uc / 1e6, 6) AS disb_cr,
  {rate_cols}
FROM tri WHERE {ALL} GROUP BY cohort_end, disb_uc
UNION ALL
SELECT {LBL()}, 'tpos_amt', round(disb_uc / 1e6, 6),
  {amt_cols}
FROM tri WHERE {ALL} GROUP BY cohort_end, disb_uc""")
    lr_cols = ",\n  ".join(f"round(max(CASE WHEN l.anchor_mob = {a} THEN l.loss_rate END), 8) AS lr_{a}m"
                           for a in cfg.anchors)
    q["loss_rate_report"] = W(f"""SELECT {LBL('l.cohort_end')}, round(l.disb_cr, 6) AS disb_cr,
  {lr_cols},
  CAST(max(c.current_mob) AS BIGINT) AS current_mob, round(max(c.current_tpos), 6) AS current_tpos
FROM loss l LEFT JOIN cur c ON c.segment = l.segment AND c.cohort_end = l.cohort_end
WHERE l.segment = 'all' GROUP BY l.cohort_end, l.disb_cr""")
    tg = cfg.triangle_grid
    anchors_txt = ", ".join(f"{a}M" for a in cfg.anchors)
    hsel = f"FROM wavg WHERE {ALL} AND window_name = '{cfg.headline}'"
    q["summary"] = W(f"""SELECT 'as_of' AS key, CAST(NULL AS DOUBLE) AS value_num, '{cfg.as_of.isoformat()}' AS value_text
UNION ALL SELECT 'n_cohorts', CAST(COUNT(*) AS DOUBLE), NULL FROM cur WHERE {ALL}
UNION ALL SELECT 'mob_grid', NULL, '{tg.start}..{tg.stop} step {tg.step}'
UNION ALL SELECT 'anchors', NULL, '{anchors_txt}'
UNION ALL SELECT 'headline_window', NULL, '{cfg.headline}'
UNION ALL SELECT 'weighted_avg_lr', round(weighted_avg_lr, 8), NULL {hsel}
UNION ALL SELECT 'window_disb', round(total_disb, 6), NULL {hsel}
UNION ALL SELECT 'ecl_pct', round(weighted_avg_lr, 8), NULL {hsel}
UNION ALL SELECT 'portfolio_tpos', round(SUM(current_tpos), 6), NULL FROM cur WHERE {ALL}""")
    return q
