"""Registered decision, back-test, metric, fold and data-quality queries.

The Spark side uses the one-pass operators (histogram sweeps, single wide
aggregations); the SQL oracles are brute force - every strategy and every
threshold evaluated on its own - so they check the fast plans.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import decision as D
from ..operators import backtest as B
from ..operators import folds as FO
from ..operators import metrics as E
from ..operators import series as S
from . import inputs as I
from .queries import (ADVISORY_TIGHT, DY, H, IV, SCORING_PRICE, SCORING_TIGHT, _ivr, _r,
                      daily_features, q)

OVERRIDE_T = 0.3
LABELS = ["Normal", "Scarcity", "Surplus", "Tight"]


def _iv(spark, sf):
    return _ivr(spark, sf)


def _sql_override(t=OVERRIDE_T):
    return f"CASE WHEN p_scarcity >= {t} THEN 'Scarcity' ELSE pred_regime END"


# ===========================================================================
# B1-B3 dispatch rules
# ===========================================================================

_ACTION_SQL = f"""
CASE WHEN coalesce(pred_prc < 3000, false) THEN '{D.ACTION_CURTAIL}'
     WHEN coalesce(pred_prc < {SCORING_TIGHT}, false) AND coalesce(pred_price > {SCORING_PRICE}, false)
       THEN '{D.ACTION_REDUCE_BOTH}'
     WHEN coalesce(pred_prc < {SCORING_TIGHT}, false) THEN '{D.ACTION_REDUCE_PRC}'
     WHEN coalesce(pred_price > {SCORING_PRICE}, false) THEN '{D.ACTION_REDUCE_PRICE}'
     ELSE '{D.ACTION_OPERATE}' END"""


@q("dispatch_action", IV(f"SELECT event_id, {_ACTION_SQL} AS action FROM iv"))
def dispatch_action(spark, sf):
    iv = I.intervals(spark, sf)
    return iv.select("event_id", D.dispatch_action("pred_prc", "pred_price", SCORING_TIGHT,
                                                   SCORING_PRICE).alias("action"))


@q("advisory_24h", IV(f"""
SELECT event_id, CASE WHEN r = '' THEN '{D.ADVISORY_LOW}'
  ELSE '{D.ADVISORY_ELEVATED_PREFIX}' || r || '{D.ADVISORY_ELEVATED_SUFFIX}' END AS advisory
FROM (SELECT event_id, concat_ws(', ',
  CASE WHEN pred_prc < 3000 THEN '{D.RISK_SCARCITY}' WHEN pred_prc < {ADVISORY_TIGHT} THEN '{D.RISK_TIGHT}' END,
  CASE WHEN dam > 100 THEN 'DAM high ($' || printf('%.0f', dam) || ')' END,
  CASE WHEN pred_price > 100 THEN 'RT may exceed $' || printf('%.0f', pred_price) END) AS r FROM iv)"""))
def advisory_24h(spark, sf):
    iv = I.intervals(spark, sf)
    return iv.select("event_id", D.advisory_24h("pred_prc", "pred_price", "dam",
                                                ADVISORY_TIGHT).alias("advisory"))


@q("risk_alert_filter", DY("""
SELECT ts, round(p_peak, 9) AS p_peak, round(load_total, 6) AS load_total FROM dailys
WHERE is_4cp_season = 1 AND p_peak > 0.01 ORDER BY ts DESC LIMIT 20"""))
def risk_alert_filter(spark, sf):
    d = daily_features(spark, sf)
    return (d.where((F.col("is_4cp_season") == 1) & (F.col("p_peak") > 0.01))
             .orderBy(F.col("ts").desc()).limit(20)
             .select("ts", _r("p_peak", 9), _r("load_total")))


# ===========================================================================
# B4-B5 row back-tests
# ===========================================================================

@q("mining_backtest", IV("""
SELECT round(sum(a), 2) AS total_always_on, round(sum(g), 2) AS total_guided,
       round(sum(a) - sum(g), 2) AS savings, count(*) FILTER (WHERE g = 0) AS hours_curtailed,
       count(*) AS n_rows
FROM (SELECT (rt - 40) * 200 AS a,
             CASE WHEN coalesce(pred_prc < 3000, false) OR coalesce(pred_prc >= 3000 AND pred_prc < 5000, false)
                  THEN 0.0 ELSE (rt - 40) * 200 END AS g FROM iv)"""))
def mining_backtest(spark, sf):
    c = B.mining_costs(I.intervals(spark, sf), "pred_prc", "rt", 5000.0)
    s = B.backtest_summary(c)
    return s.select(*[F.round(x, 2).alias(x) for x in ("total_always_on", "total_guided", "savings")],
                    "hours_curtailed", "n_rows")


@q("datacenter_backtest", IV("""
SELECT round(sum(rt * 200), 2) AS total_always_on, round(sum(rt * l + 50 * (200 - l)), 2) AS total_guided,
       round(sum(rt * 200) - sum(rt * l + 50 * (200 - l)), 2) AS savings,
       count(*) FILTER (WHERE rt * l + 50 * (200 - l) = 0) AS hours_curtailed,
       count(*) FILTER (WHERE l < 200) AS hours_reduced, count(*) AS n_rows
FROM (SELECT rt, CASE WHEN coalesce(pred_prc < 3000, false) THEN 130.0
                      WHEN coalesce(pred_prc >= 3000 AND pred_prc < 5000, false) THEN 165.0
                      ELSE 200.0 END AS l FROM iv)"""))
def datacenter_backtest(spark, sf):
    c = B.datacenter_costs(I.intervals(spark, sf), "pred_prc", "rt")
    s = B.backtest_summary(c)
    return s.select(*[F.round(x, 2).alias(x) for x in ("total_always_on", "total_guided", "savings")],
                    "hours_curtailed", "hours_reduced", "n_rows")


# ===========================================================================
# B6-B8, B16 sweeps (Spark: histogram; SQL: brute force per candidate)
# ===========================================================================

def _pairs_sql():
    vals = ", ".join(f"({s}, {t})" for s in B.PRC_SCARCITY_GRID for t in B.PRC_TIGHT_GRID if t > s)
    return f"pairs AS (SELECT CAST(s AS INTEGER) AS s, CAST(t AS INTEGER) AS t FROM (VALUES {vals}) v(s, t))"


def _b6_sql(use_case):
    if use_case == "mining":
        benefit = """CASE WHEN coalesce(pred_prc < s, false) OR coalesce(pred_prc >= s AND pred_prc < t, false)
                      THEN (rt - 40) * 200 ELSE 0 END"""
    else:
        benefit = """rt * 200 - CASE WHEN coalesce(pred_prc < s, false) THEN rt * 130 + 50 * 70
                       WHEN coalesce(pred_prc >= s AND pred_prc < t, false) THEN rt * 165 + 50 * 35
                       ELSE rt * 200 END"""
    return IV(f"""
SELECT s AS scarcity_threshold, t AS tight_threshold, sv AS savings,
       CAST(row_number() OVER (ORDER BY sv DESC, s, t) = 1 AND sv > 0 AS INTEGER) AS is_best
FROM (SELECT s, t, round(sum({benefit}), 2) AS sv FROM pairs, iv GROUP BY s, t)""", _pairs_sql())


@q("optimize_prc_thresholds", _b6_sql("mining"))
def optimize_prc_thresholds(spark, sf):
    return B.optimize_prc_thresholds(I.intervals(spark, sf), "pred_prc", "rt", "mining")


@q("optimize_prc_thresholds_datacenter", _b6_sql("datacenter"))
def optimize_prc_thresholds_dc(spark, sf):
    return B.optimize_prc_thresholds(I.intervals(spark, sf), "pred_prc", "rt", "datacenter")


_PRICE_GRID_SQL = "grid AS (SELECT CAST(x AS DOUBLE) AS threshold FROM range(30, 125, 5) r(x))"


@q("optimize_price_mining", IV("""
SELECT threshold, hc AS hours_curtailed, tp AS true_positives, fp AS false_positives,
       round(av, 2) AS avoided_cost, round(lo, 2) AS lost_revenue, round(av - lo, 2) AS net_savings,
       CAST(row_number() OVER (ORDER BY round(av - lo, 2) DESC, threshold) = 1 AS INTEGER) AS is_best
FROM (SELECT threshold, count(*) FILTER (WHERE pred_price > threshold) AS hc,
        count(*) FILTER (WHERE pred_price > threshold AND rt > 40) AS tp,
        count(*) FILTER (WHERE pred_price > threshold AND rt <= 40) AS fp,
        coalesce(sum((rt - 40) * 200) FILTER (WHERE pred_price > threshold AND rt > 40), 0) AS av,
        coalesce(sum((40 - rt) * 200) FILTER (WHERE pred_price > threshold AND rt <= 40), 0) AS lo
      FROM grid, iv GROUP BY threshold)""", _PRICE_GRID_SQL))
def optimize_price_mining(spark, sf):
    return B.optimize_price_mining(I.intervals(spark, sf), "pred_price", "rt")


@q("optimize_price_datacenter", IV("""
SELECT threshold, hc AS hours_curtailed, good AS beneficial_hours, bad AS harmful_hours,
       round(net, 2) AS net_savings,
       CAST(row_number() OVER (ORDER BY round(net, 2) DESC, threshold) = 1 AS INTEGER) AS is_best
FROM (SELECT threshold, count(*) FILTER (WHERE pred_price > threshold) AS hc,
        count(*) FILTER (WHERE pred_price > threshold AND rt > 50) AS good,
        count(*) FILTER (WHERE pred_price > threshold AND rt <= 50) AS bad,
        coalesce(sum((rt - 50) * 35.0) FILTER (WHERE pred_price > threshold), 0) AS net
      FROM grid, iv GROUP BY threshold)""", _PRICE_GRID_SQL))
def optimize_price_datacenter(spark, sf):
    return B.optimize_price_datacenter(I.intervals(spark, sf), "pred_price", "rt")


@q("peak_threshold_sweep", DY("""
SELECT threshold, count(*) FILTER (WHERE p_peak > threshold) AS curtail_hours,
       count(*) FILTER (WHERE p_peak > threshold AND is_peak = 1) AS peaks_caught,
       count(*) FILTER (WHERE is_peak = 1) - count(*) FILTER (WHERE p_peak > threshold AND is_peak = 1)
         AS peaks_missed
FROM (SELECT unnest([0.01, 0.05, 0.10, 0.20, 0.30, 0.50]::DOUBLE[]) AS threshold), dailys
WHERE month IN (6, 7, 8, 9) GROUP BY threshold"""))
def peak_threshold_sweep(spark, sf):
    d = daily_features(spark, sf).where(F.col("month").isin(6, 7, 8, 9))
    return B.peak_threshold_sweep(d, "p_peak", "is_peak")


# ===========================================================================
# B9-B15, B17, B18 strategy comparisons
# ===========================================================================

def _mining_masks_sql(price_t, baselines):
    m = [(f"DAM-only @${t}", f"coalesce(dam > {t}, false)") for t in baselines]
    m += [(f"RT lag-react @${t}", f"coalesce(pred_price, 0) > {t}") for t in baselines]
    prc = "coalesce(pred_prc < 5000, false)"
    price = f"coalesce(pred_price > {price_t}, false)"
    m += [("PRC model", prc), (f"Price model @${price_t}", price),
          (f"Combined system @${price_t}", f"({prc} OR {price})")]
    return m


def _compare_mining_sql():
    masks = _mining_masks_sql(40, B.MINING_BASELINE_THRESHOLDS)
    parts = ["SELECT 0 AS ord, 'Always-on' AS strategy, 0.0::DOUBLE AS sv, 0::BIGINT AS hc, 0::BIGINT AS fp, "
             "0.0::DOUBLE AS fc FROM (SELECT 1)"]
    for i, (name, m) in enumerate(masks):
        parts.append(f"SELECT {i + 1}, '{name}', coalesce(sum(net) FILTER (WHERE {m}), 0), "
                     f"count(*) FILTER (WHERE {m}), count(*) FILTER (WHERE {m} AND rt <= 40), "
                     f"coalesce(sum((40 - rt) * 200) FILTER (WHERE {m} AND rt <= 40), 0) FROM b")
    parts.append(f"SELECT {len(masks) + 1}, 'Oracle', sum(greatest(net, 0)), count(*) FILTER (WHERE rt > 40), "
                 "0, 0.0 FROM b")
    return IV(f"""
SELECT CAST(ord AS INTEGER) AS ord, strategy, round(sv, 2) AS savings, hc AS hours_curtailed,
       CAST(fp AS BIGINT) AS false_positives, round(fc, 2) AS fp_cost,
       round(CASE WHEN ord = {len(masks) + 1} THEN 100.0 WHEN ord = 0 THEN 0.0
                  WHEN o > 0 THEN sv / o * 100 ELSE 0.0 END, 4) AS pct_oracle
FROM ({' UNION ALL '.join(parts)}) x, (SELECT sum(greatest(net, 0)) AS o FROM b) y""",
              "b AS (SELECT *, (rt - 40) * 200 AS net FROM iv)")


@q("compare_mining", _compare_mining_sql())
def compare_mining(spark, sf):
    return B.compare_mining(I.intervals(spark, sf), lag_rt="pred_price")


def _compare_dc_sql():
    masks = _mining_masks_sql(60, B.DATACENTER_BASELINE_THRESHOLDS)
    half = "(rt * 200 - (rt * 165.0 + 1750.0))"
    parts = ["SELECT 0 AS ord, 'Always-on' AS strategy, 0.0::DOUBLE AS sv, 0::BIGINT AS hc FROM (SELECT 1)"]
    for i, (name, m) in enumerate(masks):
        parts.append(f"SELECT {i + 1}, '{name}', coalesce(sum({half}) FILTER (WHERE {m}), 0), "
                     f"count(*) FILTER (WHERE {m}) FROM iv")
    n = len(masks) + 1
    ocost = "(rt * 200 - (rt * 130.0 + 3500.0))"
    parts.append(f"SELECT {n}, 'Oracle @>$143', coalesce(sum({ocost}) FILTER (WHERE rt > 50 / 0.35), 0), "
                 f"count(*) FILTER (WHERE rt > 50 / 0.35) FROM iv")
    return IV(f"""
SELECT CAST(ord AS INTEGER) AS ord, strategy, round(sv, 2) AS savings, hc AS hours_curtailed,
       round(CASE WHEN ord = {n} THEN 100.0 WHEN ord = 0 THEN 0.0 WHEN o > 0 THEN sv / o * 100 ELSE 0.0 END, 4)
         AS pct_oracle
FROM ({' UNION ALL '.join(parts)}) x,
     (SELECT coalesce(sum({ocost}) FILTER (WHERE rt > 50 / 0.35), 0) AS o FROM iv) y""")


@q("compare_datacenter", _compare_dc_sql())
def compare_datacenter(spark, sf):
    return B.compare_datacenter(I.intervals(spark, sf), lag_rt="pred_price")


@q("incremental_value")  # oracle attached at the end of the module
def incremental_value(spark, sf):
    cmp = B.compare_mining(I.intervals(spark, sf), lag_rt="pred_price")
    return B.incremental_value(cmp)


def _incremental_sql():
    base = _compare_mining_sql()
    return f"""
WITH cmp AS ({base})
SELECT c.strategy AS baseline, round(k.savings - c.savings, 2) AS increment
FROM cmp c, (SELECT savings FROM cmp WHERE strategy LIKE 'Combined%') k
WHERE c.strategy IN ('DAM-only @$40', 'DAM-only @$60', 'RT lag-react @$40')"""


def _five_mining_sql():
    rows = [("A: Always-on", "-", None), ("B: PRC-only", "-", "b")]
    for t in B.FIVE_STRATEGY_THRESHOLDS:
        rows += [("C: Price-only", f"${t}", f"c{t}"), ("D: Combined", f"${t}", f"(b OR c{t})")]
    parts = []
    for i, (s, p, m) in enumerate(rows):
        if m is None:
            parts.append(f"SELECT {i} AS ord, '{s}' AS strategy, '{p}' AS price_threshold, sum(net) AS tc, "
                         f"0::BIGINT AS hc FROM m")
        else:
            parts.append(f"SELECT {i}, '{s}', '{p}', coalesce(sum(net) FILTER (WHERE NOT {m}), 0), "
                         f"count(*) FILTER (WHERE {m}) FROM m")
    parts.append(f"SELECT {len(rows)}, 'E: Oracle', '-', sum(least(net, 0)), count(*) FILTER (WHERE rt > 40) FROM m")
    cs = ", ".join(f"coalesce(pred_price > {t}, false) AS c{t}" for t in B.FIVE_STRATEGY_THRESHOLDS)
    return IV(f"""
SELECT CAST(ord AS INTEGER) AS ord, strategy, price_threshold, round(tc, 2) AS total_cost, hc AS hours_curtailed,
       round(tot - tc, 2) AS savings_vs_A, round((tot - tc) / (tot - oc) * 100, 1) AS pct_of_oracle
FROM ({' UNION ALL '.join(parts)}) x, (SELECT sum(net) AS tot, sum(least(net, 0)) AS oc FROM m) y""",
              f"m AS (SELECT rt, (rt - 40) * 200 AS net, coalesce(pred_prc < 5000, false) AS b, {cs} FROM iv)")


@q("five_strategy_mining", _five_mining_sql())
def five_strategy_mining(spark, sf):
    return B.five_strategy_mining(I.intervals(spark, sf))


def _five_dc_sql():
    full, alls, half = "rt * 200", "(rt * 130.0 + 3500.0)", "(rt * 165.0 + 1750.0)"
    rows = [("A: Always-on", "-", full, "false"),
            ("B: PRC-only", "-", f"CASE WHEN sc THEN {alls} WHEN tg THEN {half} ELSE {full} END", "(sc OR tg)")]
    for t in B.FIVE_STRATEGY_THRESHOLDS:
        rows.append(("C: Price-only", f"${t}", f"CASE WHEN c{t} THEN {half} ELSE {full} END", f"c{t}"))
        rows.append(("D: Combined", f"${t}",
                     f"CASE WHEN sc THEN {alls} WHEN tg OR c{t} THEN {half} ELSE {full} END", f"(sc OR tg OR c{t})"))
    rows.append(("E: Oracle", ">$143", f"CASE WHEN rt > 50 / 0.35 THEN {alls} ELSE {full} END", "rt > 50 / 0.35"))
    parts = [f"SELECT {i} AS ord, '{s}' AS strategy, '{p}' AS price_threshold, sum({cost}) AS tc, "
             f"count(*) FILTER (WHERE {m}) AS hc FROM m" for i, (s, p, cost, m) in enumerate(rows)]
    last = len(rows) - 1
    cs = ", ".join(f"coalesce(pred_price > {t}, false) AS c{t}" for t in B.FIVE_STRATEGY_THRESHOLDS)
    return IV(f"""
SELECT CAST(ord AS INTEGER) AS ord, strategy, price_threshold, round(tc, 2) AS total_cost, hc AS hours_reduced,
       round(tot - tc, 2) AS savings_vs_A,
       CASE WHEN os > 0 THEN round((tot - tc) / os * 100, 1) ELSE 0.0 END AS pct_of_oracle
FROM x, (SELECT sum(rt * 200) AS tot FROM m) y, (SELECT (SELECT sum(rt * 200) FROM m) - tc AS os FROM x WHERE ord = {last}) z""",
              f"""m AS (SELECT rt, coalesce(pred_prc < 3000, false) AS sc,
                       coalesce(pred_prc >= 3000 AND pred_prc < 5000, false) AS tg, {cs} FROM iv)""",
              f"x AS ({' UNION ALL '.join(parts)})")


@q("five_strategy_datacenter", _five_dc_sql())
def five_strategy_datacenter(spark, sf):
    return B.five_strategy_datacenter(I.intervals(spark, sf))


def _fp_sql():
    parts = []
    for t in B.FIVE_STRATEGY_THRESHOLDS:
        d = f"(coalesce(pred_prc < 5000, false) OR coalesce(pred_price > {t}, false))"
        parts.append(f"""SELECT {t} AS price_threshold, count(*) FILTER (WHERE {d}) AS hours_curtailed,
  count(*) FILTER (WHERE {d} AND rt > 40) AS tp_hours,
  round(coalesce(sum((rt - 40) * 200) FILTER (WHERE {d} AND rt > 40), 0), 2) AS avoided_cost,
  count(*) FILTER (WHERE {d} AND rt <= 40) AS fp_hours,
  round(coalesce(sum((40 - rt) * 200) FILTER (WHERE {d} AND rt <= 40), 0), 2) AS lost_revenue,
  round(coalesce(sum((rt - 40) * 200) FILTER (WHERE {d} AND rt > 40), 0)
        - coalesce(sum((40 - rt) * 200) FILTER (WHERE {d} AND rt <= 40), 0), 2) AS net_benefit FROM iv""")
    return IV("SELECT CAST(price_threshold AS INTEGER) AS price_threshold, hours_curtailed, tp_hours, "
              "avoided_cost, fp_hours, lost_revenue, net_benefit FROM (" + " UNION ALL ".join(parts) + ")")


@q("fp_analysis", _fp_sql())
def fp_analysis(spark, sf):
    return B.fp_analysis(I.intervals(spark, sf))


@q("exposure_hours", IV("""
SELECT count(*) FILTER (WHERE regime IN ('Normal', 'Surplus') AND rt > 100) AS exposure_hours,
       round(coalesce(sum(rt * 200) FILTER (WHERE regime IN ('Normal', 'Surplus') AND rt > 100), 0), 2)
         AS exposure_cost, count(*) AS n_rows FROM ivr"""))
def exposure_hours(spark, sf):
    return B.exposure_hours(I.with_regimes(I.intervals(spark, sf)))


def _peak_sql():
    ths = B.PEAK_MODEL_THRESHOLDS
    cur = ", ".join(f"count(*) FILTER (WHERE p_peak > {t}) AS c{i}, "
                    f"count(*) FILTER (WHERE p_peak > {t} AND is_peak = 1) AS d{i}" for i, t in enumerate(ths))
    rows = ["SELECT 0 AS ord, 'No 4CP management' AS strategy, 0::BIGINT AS h, 0::BIGINT AS pd, lab AS pt, "
            "9000000.0 AS tr, 0.0 AS pl, 9000000.0 AS nc FROM st",
            "SELECT 1, 'Conservative (all afternoons)', CAST(floor(aft / ny) AS BIGINT), 4, 4, 0.0, "
            "floor(aft / ny) * 8000.0, floor(aft / ny) * 8000.0 FROM st"]
    for i, t in enumerate(ths):
        tr = f"((pk - d{i}) / ny / 4 * 200.0 * 45000.0)"
        pl = f"(c{i} / ny * 8000.0)"
        rows.append(f"SELECT {2 + i}, 'Model @{t:.2f}', CAST(floor(c{i} / ny) AS BIGINT), d{i}, pk, {tr}, {pl}, "
                    f"{tr} + {pl} FROM st")
    n = 2 + len(ths)
    rows.append(f"SELECT {n}, 'Oracle (peak hours only)', CAST(floor(pk / ny) AS BIGINT), pk, pk, 0.0, "
                "floor(pk / ny) * 8000.0, floor(pk / ny) * 8000.0 FROM st")
    return DY(f"""
SELECT CAST(ord AS INTEGER) AS ord, strategy, h AS hours_curtailed_per_summer, CAST(pd AS BIGINT) AS peaks_dodged,
       CAST(pt AS BIGINT) AS peaks_total, round(tr, 2) AS transmission_per_year,
       round(pl, 2) AS production_lost_per_summer, round(nc, 2) AS net_cost_per_year
FROM ({' UNION ALL '.join(rows)})""", f"""st AS (
  SELECT CAST(count(DISTINCT year) AS DOUBLE) AS ny, count(*) FILTER (WHERE is_4cp_season = 1) AS aft,
         CAST(coalesce(sum(is_peak), 0) AS BIGINT) AS pk, {cur},
         (SELECT count(*) FROM peaks) AS lab
  FROM dailys WHERE month IN (6, 7, 8, 9))""")


@q("compare_peak_strategies", _peak_sql())
def compare_peak_strategies(spark, sf):
    d = daily_features(spark, sf)
    labels = d.where(F.col("is_peak") == 1).select("year")
    return B.compare_peak_strategies(d, "p_peak", "is_peak", "is_4cp_season", labels)


def _calibrated_sql():
    benefit = """CASE WHEN coalesce(pred_prc < s, false) OR coalesce(pred_prc >= s AND pred_prc < t, false)
                 THEN (rt - 40) * 200 ELSE 0 END"""
    return IV(f"""
SELECT best.s AS scarcity_threshold, best.t AS tight_threshold, best.sv AS tune_savings,
       round(sum(CASE WHEN coalesce(g.pred_prc < best.s, false)
                       OR coalesce(g.pred_prc >= best.s AND g.pred_prc < best.t, false)
                      THEN (g.rt - 40) * 200 ELSE 0 END), 2) AS test_savings,
       count(*) AS test_rows
FROM gp g, (SELECT s, t, sv FROM (SELECT s, t, sv, row_number() OVER (ORDER BY sv DESC, s, t) AS rk
            FROM (SELECT s, t, round(sum({benefit}), 2) AS sv FROM pairs, gp
                  WHERE gpos < (SELECT count(*) FROM gp) // 2 GROUP BY s, t)) WHERE rk = 1 AND sv > 0) best
WHERE g.gpos >= (SELECT count(*) FROM gp) // 2
GROUP BY best.s, best.t, best.sv""", _pairs_sql(),
              "gp AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS gpos FROM iv)")


@q("calibrated_fold_backtest", _calibrated_sql())
def calibrated_fold_backtest(spark, sf):
    iv = I.intervals(spark, sf).drop("pos")
    order = ["ts", "event_id"]
    edge, _ = FO.boundary_keys(I.events(spark, sf), order, lambda n: [n // 2])       # the same rows
    return B.calibrated_fold_backtest(iv.withColumn("half", FO.part_of(iv, order, edge)), "half", 2, "pred_prc", "rt", "mining")


# ===========================================================================
# E metrics
# ===========================================================================

@q("mae_rmse", IV("""
SELECT count(*) AS n, round(avg(abs(rt - pred_price)), 6) AS mae,
       round(sqrt(avg((rt - pred_price) * (rt - pred_price))), 6) AS rmse
FROM iv WHERE rt IS NOT NULL AND pred_price IS NOT NULL"""))
def mae_rmse(spark, sf):
    m = E.mae_rmse(I.intervals(spark, sf), "rt", "pred_price")
    return m.select("n", _r("mae"), _r("rmse"))


@q("mae_by_tier", IV("""
SELECT CASE WHEN rt < 0 THEN 'negative' WHEN rt >= 0 AND rt <= 40 THEN 'low'
  WHEN rt > 40 AND rt <= 100 THEN 'medium' WHEN rt > 100 THEN 'high' END AS tier,
  count(*) AS n, round(avg(abs(rt - pred_price)), 6) AS mae
FROM iv WHERE rt IS NOT NULL AND pred_price IS NOT NULL GROUP BY 1"""))
def mae_by_tier(spark, sf):
    return E.mae_by_tier(I.intervals(spark, sf), "rt", "pred_price").select("tier", "n", _r("mae"))


def _rp_sql(a, p, ths, src="iv", where="rt IS NOT NULL AND pred_price IS NOT NULL"):
    parts = [f"""SELECT {float(t)}::DOUBLE AS threshold, count(*) FILTER (WHERE {a} > {t}) AS n_actual,
      count(*) FILTER (WHERE {p} > {t}) AS n_pred, count(*) FILTER (WHERE {a} > {t} AND {p} > {t}) AS tp
      FROM {src} WHERE {where}""" for t in ths]
    return IV(f"""
SELECT threshold, n_actual, n_pred, tp,
       round(CASE WHEN n_actual > 0 THEN tp / n_actual ELSE 0.0 END, 6) AS recall,
       round(CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END, 6) AS precision
FROM ({' UNION ALL '.join(parts)})""")


@q("recall_precision_at", _rp_sql("rt", "pred_price", E.SPIKE_THRESHOLDS))
def recall_precision_at(spark, sf):
    r = E.recall_precision_at(I.intervals(spark, sf), "rt", "pred_price", E.SPIKE_THRESHOLDS)
    return r.select("threshold", "n_actual", "n_pred", "tp", _r("recall"), _r("precision"))


@q("recall_precision_spread", _rp_sql("(rt - dam)", "(pred_price - dam)", E.SPREAD_THRESHOLDS,
                                      where="rt - dam IS NOT NULL AND pred_price - dam IS NOT NULL"))
def recall_precision_spread(spark, sf):
    iv = I.intervals(spark, sf).withColumn("spread", F.col("rt") - F.col("dam")) \
        .withColumn("pred_spread", F.col("pred_price") - F.col("dam"))
    r = E.recall_precision_at(iv, "spread", "pred_spread", E.SPREAD_THRESHOLDS)
    return r.select("threshold", "n_actual", "n_pred", "tp", _r("recall"), _r("precision"))


def _report_sql(src, actual, pred, by=None, where="TRUE"):
    """sklearn-style report over labels present in actual or predicted."""
    b = f"{by}, " if by else ""
    bj = f" USING ({by}, label)" if by else " USING (label)"
    g = f"GROUP BY {by}" if by else ""
    return f"""
cm AS (SELECT {b}{actual} AS actual, {pred} AS pred, count(*) AS n FROM {src}
       WHERE {actual} IS NOT NULL AND {pred} IS NOT NULL AND {where} GROUP BY ALL),
sup AS (SELECT {b}actual AS label, sum(n) AS support FROM cm GROUP BY ALL),
prd AS (SELECT {b}pred AS label, sum(n) AS np FROM cm GROUP BY ALL),
tpt AS (SELECT {b}actual AS label, sum(n) AS tp FROM cm WHERE actual = pred GROUP BY ALL),
per0 AS (SELECT {b}label, coalesce(support, 0) AS support, coalesce(np, 0) AS np, coalesce(tp, 0) AS tp
         FROM sup FULL JOIN prd{bj} LEFT JOIN tpt{bj}),
per AS (SELECT {b}label, CASE WHEN np > 0 THEN tp / np ELSE 0.0 END AS precision,
               CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support, tp FROM per0),
per1 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                   ELSE 0.0 END AS f1 FROM per),
tot AS (SELECT {b}sum(support) AS t, sum(tp) AS ttp, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
               sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1 * support) AS wf
        FROM per1 {g}),
rep AS (
  SELECT {b}label, precision, recall, f1, CAST(support AS BIGINT) AS support FROM per1
  UNION ALL SELECT {b}'macro avg', mp, mr, mf, CAST(t AS BIGINT) FROM tot
  UNION ALL SELECT {b}'weighted avg', CASE WHEN t > 0 THEN wp / t ELSE 0.0 END,
                   CASE WHEN t > 0 THEN wr / t ELSE 0.0 END, CASE WHEN t > 0 THEN wf / t ELSE 0.0 END,
                   CAST(t AS BIGINT) FROM tot
  UNION ALL SELECT {b}'accuracy', CASE WHEN t > 0 THEN ttp / t ELSE 0.0 END,
                   CASE WHEN t > 0 THEN ttp / t ELSE 0.0 END, CASE WHEN t > 0 THEN ttp / t ELSE 0.0 END,
                   CAST(t AS BIGINT) FROM tot)"""


@q("classification_report", IV("""
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support
FROM rep""", _report_sql("ivr", "regime", "pred_regime")))
def classification_report(spark, sf):
    r = E.classification_report(_iv(spark, sf), "regime", "pred_regime")
    return r.select("label", _r("precision"), _r("recall"), _r("f1"), "support")


@q("confusion_matrix", IV("""
SELECT regime AS actual, """ + ", ".join(
    f"count(*) FILTER (WHERE pred_regime = '{lab}') AS \"{lab}\"" for lab in LABELS) + """
FROM ivr WHERE regime IS NOT NULL AND pred_regime IS NOT NULL GROUP BY 1"""))
def confusion_matrix(spark, sf):
    return E.confusion_matrix(_iv(spark, sf), "regime", "pred_regime", LABELS)


@q("f1_weighted", IV("""
SELECT split, round(f1, 6) AS f1_weighted FROM rep WHERE label = 'weighted avg'""",
                     "sp AS (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 'train' ELSE 'test' END AS split "
                     "FROM ivr)", _report_sql("sp", "regime", "pred_regime", by="split")))
def f1_weighted(spark, sf):
    iv = _iv(spark, sf).withColumn(
        "split", F.when(F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-15")), "train").otherwise("test"))
    return E.f1_weighted_by_split(iv, "regime", "pred_regime", "split").select("split", _r("f1_weighted"))


def _folded(spark, sf):
    g, _ = FO.time_folds(_iv(spark, sf).drop("pos"), ["ts", "event_id"], 4, keys=I.events(spark, sf))       # the same rows
    return g.where(F.col("fold") > 0)


_FOLD_SQL = ("fd AS (SELECT *, CAST(floor((gpos - (n - 4 * (n // 5))) / (n // 5)) + 1 AS INTEGER) AS fold "
             "FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS gpos, count(*) OVER () AS n "
             "FROM ivr) WHERE gpos >= n - 4 * (n // 5))")


def _fold_report_sql(pred):
    return IV("""
SELECT f.fold, coalesce(CAST(s.support AS BIGINT), 0) AS n_target,
       round(coalesce(s.recall, 0.0), 6) AS target_recall, round(coalesce(m.recall, 0.0), 6) AS macro_recall
FROM (SELECT DISTINCT fold FROM fd) f
LEFT JOIN (SELECT fold, recall, support FROM rep WHERE label = 'Scarcity') s ON f.fold = s.fold
LEFT JOIN (SELECT fold, recall FROM rep WHERE label = 'macro avg') m ON f.fold = m.fold""",
              _FOLD_SQL, _report_sql("fd", "regime", pred, by="fold"))


@q("cv_recall", _fold_report_sql("pred_regime"))
def cv_recall(spark, sf):
    r = E.recall_by_fold(_folded(spark, sf), "regime", "pred_regime", "fold")
    return r.select("fold", "n_target", _r("target_recall"), _r("macro_recall"))


@q("per_fold_report", _fold_report_sql(_sql_override()))
def per_fold_report(spark, sf):
    d = _folded(spark, sf).withColumn("pred", D.threshold_override("p_scarcity", "pred_regime", OVERRIDE_T))
    r = E.recall_by_fold(d, "regime", "pred", "fold")
    return r.select("fold", "n_target", _r("target_recall"), _r("macro_recall"))


def _e8_sql():
    over = "CASE WHEN p_scarcity >= t THEN 'Scarcity' ELSE pred_regime END"
    return IV(f"""
SELECT threshold, recall, precision, macro_recall,
  CAST(CASE WHEN (SELECT max(CAST(recall >= 0.65 AS INTEGER)) FROM sw) = 1
            THEN threshold = (SELECT max(threshold) FROM sw WHERE recall >= 0.65)
            ELSE threshold = (SELECT min(threshold) FROM sw WHERE recall = (SELECT max(recall) FROM sw)) END
       AS INTEGER) AS is_chosen
FROM sw""",
              "grid AS (SELECT CAST(round(x * 0.01, 2) AS DOUBLE) AS t FROM range(1, 50) r(x))",
              f"x AS (SELECT t, regime, {over} AS pred FROM grid, ivr "
              f"WHERE regime IS NOT NULL AND pred_regime IS NOT NULL)",
              _report_sql("x", "regime", "pred", by="t"),
              """sw AS (SELECT g.t AS threshold, round(coalesce(s.recall, 0.0), 3) AS recall,
                  round(coalesce(s.precision, 0.0), 3) AS precision, round(coalesce(m.recall, 0.0), 3) AS macro_recall
                FROM grid g LEFT JOIN (SELECT * FROM rep WHERE label = 'Scarcity') s ON g.t = s.t
                LEFT JOIN (SELECT * FROM rep WHERE label = 'macro avg') m ON g.t = m.t)""")


@q("threshold_for_recall", _e8_sql())
def threshold_for_recall(spark, sf):
    return E.threshold_for_recall(_iv(spark, sf), "regime", "pred_regime", "p_scarcity")


@q("false_positive_audit", IV(f"""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE pred = 'Scarcity') AS n_flagged,
  round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE pred = 'Scarcity') * 100.0 / count(*) ELSE 0.0 END, 2)
    AS pct,
  CAST(round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE pred = 'Scarcity') * 100.0 / count(*)
                  ELSE 0.0 END, 2) < 2.0 AS INTEGER) AS passed
FROM (SELECT {_sql_override()} AS pred FROM ivr WHERE regime IS NOT NULL AND regime <> 'Scarcity')"""))
def false_positive_audit(spark, sf):
    d = _iv(spark, sf).where(F.col("regime").isNotNull() & (F.col("regime") != "Scarcity"))
    d = d.withColumn("pred", D.threshold_override("p_scarcity", "pred_regime", OVERRIDE_T))
    return E.false_positive_audit(d, "pred")


@q("error_slices", IV(f"""
SELECT CASE WHEN regime = 'Scarcity' AND pred = 'Scarcity' THEN 'caught'
            WHEN regime = 'Scarcity' THEN 'missed' ELSE 'false_alarm' END AS slice,
       CASE WHEN regime = 'Scarcity' THEN pred ELSE regime END AS other_class, count(*) AS n
FROM (SELECT regime, {_sql_override()} AS pred FROM ivr) WHERE regime IS NOT NULL AND pred IS NOT NULL
  AND (regime = 'Scarcity' OR pred = 'Scarcity') GROUP BY 1, 2"""))
def error_slices(spark, sf):
    d = _iv(spark, sf).withColumn("pred", D.threshold_override("p_scarcity", "pred_regime", OVERRIDE_T))
    return E.error_slices(d, "regime", "pred")


@q("topk_hit_by_period", DY("""
SELECT year, month, ts AS peak_ts, round(p_peak, 9) AS peak_score, rk AS peak_rank,
       CAST(rk = 1 AS INTEGER) AS top1, CAST(rk <= 3 AS INTEGER) AS top3
FROM (SELECT *, row_number() OVER (PARTITION BY year, month ORDER BY p_peak DESC, ts) AS rk FROM dailys)
WHERE is_peak = 1"""))
def topk_hit_by_period(spark, sf):
    r = E.topk_hit_by_period(daily_features(spark, sf), "p_peak", "is_peak", ["year", "month"])
    return r.select("year", "month", "peak_ts", F.round("peak_score", 9).alias("peak_score"),
                    F.col("peak_rank").cast("long").alias("peak_rank"), "top1", "top3")


# ===========================================================================
# M8, M11, M16
# ===========================================================================

@q("ts_folds", """
WITH g AS (SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS gpos FROM events),
nn AS (SELECT count(*) AS n FROM events),
b AS (SELECT CAST(f AS INTEGER) AS fold, n - (4 - f + 1) * (n // 5) AS lo, n - (4 - f) * (n // 5) AS hi
      FROM nn, range(1, 5) r(f))
SELECT fold, role, count(*) AS n_rows, min(gpos) AS min_pos, max(gpos) AS max_pos FROM (
  SELECT fold, CASE WHEN gpos < lo THEN 'train' WHEN gpos < hi THEN 'test' END AS role, gpos FROM g, b)
WHERE role IS NOT NULL GROUP BY 1, 2""")
def ts_folds(spark, sf):
    ev = I.events(spark, sf).select("ts", "event_id")
    g, n = S.with_position(ev, ["ts", "event_id"], None, "gpos", with_count=True)
    f = FO.assign_folds(g, "gpos", n, 4)
    return f.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("n_rows"), F.min("gpos").alias("min_pos"),
                                         F.max("gpos").alias("max_pos"))


@q("class_weights", IV("""
SELECT regime, CAST(CASE regime WHEN 'Scarcity' THEN 40 WHEN 'Surplus' THEN 5 ELSE 1 END AS DOUBLE) AS weight,
       count(*) AS n FROM ivr WHERE regime IS NOT NULL GROUP BY 1"""))
def class_weights(spark, sf):
    from ..operators.models import class_weight_expr
    d = _iv(spark, sf).where(F.col("regime").isNotNull())
    return d.groupBy("regime").agg(F.count(F.lit(1)).alias("n")) \
            .select("regime", class_weight_expr("regime").alias("weight"), "n")


@q("prob_threshold_override", IV(f"SELECT event_id, {_sql_override()} AS pred_class FROM ivr"))
def prob_threshold_override(spark, sf):
    d = _iv(spark, sf)
    return d.select("event_id", D.threshold_override("p_scarcity", "pred_regime", OVERRIDE_T).alias("pred_class"))


# ===========================================================================
# K5, K6 data quality and drift
# ===========================================================================

@q("dq_checks", H("""
SELECT count(*) AS n_rows, count(DISTINCT ts) AS n_distinct_ts, count(*) - count(DISTINCT ts) AS n_duplicate_ts,
       count(*) FILTER (WHERE rt IS NULL) AS null_rt, count(*) FILTER (WHERE dam IS NULL) AS null_dam,
       count(*) FILTER (WHERE prc IS NULL) AS null_prc,
       count(*) FILTER (WHERE rt < 0 OR prc < 0) AS out_of_range,
       count(*) FILTER (WHERE n_events IS NULL) AS gap_hours, min(ts) AS min_ts, max(ts) AS max_ts
FROM hourly"""))
def dq_checks(spark, sf):
    from ..operators.quality import dq_checks as dq
    return dq(I.hourly(spark, sf), "ts", ["rt", "dam", "prc"], ["rt", "prc"], "n_events")


@q("drift_check", IV("""
SELECT date_trunc('week', ts) AS period, count(*) AS n, round(avg(abs(rt - pred_price)), 6) AS mae,
       count(*) FILTER (WHERE rt > 100) AS n_actual, count(*) FILTER (WHERE rt > 100 AND pred_price > 100) AS tp,
       round(CASE WHEN count(*) FILTER (WHERE rt > 100) > 0
             THEN count(*) FILTER (WHERE rt > 100 AND pred_price > 100) / count(*) FILTER (WHERE rt > 100)
             ELSE 0.0 END, 6) AS recall_100
FROM iv WHERE rt IS NOT NULL AND pred_price IS NOT NULL GROUP BY 1"""))
def drift_check(spark, sf):
    from ..operators.quality import drift_check as dc
    return dc(I.intervals(spark, sf), "ts", "rt", "pred_price", 100.0)


# ===========================================================================
# flagship
# ===========================================================================

@q("flagship_dispatch_summary", H(f"""
SELECT action, count(*) AS n_hours, round(avg(rt), 6) AS avg_rt, round(avg(prc), 6) AS avg_prc
FROM (SELECT *, {_ACTION_SQL.replace('pred_prc', 'prc_1h_lag').replace('pred_price', 'rt_1h_lag')} AS action
      FROM (SELECT ts, rt, prc, lag(prc) OVER (ORDER BY ts) AS prc_1h_lag, lag(rt) OVER (ORDER BY ts) AS rt_1h_lag
            FROM f2))
GROUP BY action""", """f AS (SELECT ts, last_value(rt IGNORE NULLS) OVER w AS rt_f, last_value(prc IGNORE NULLS) OVER w AS prc_f,
            first_value(rt IGNORE NULLS) OVER w2 AS rt_b, first_value(prc IGNORE NULLS) OVER w2 AS prc_b
       FROM hourly WINDOW w AS (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                          w2 AS (ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
    "f2 AS (SELECT ts, coalesce(rt_f, rt_b) AS rt, coalesce(prc_f, prc_b) AS prc FROM f)"))
def flagship_dispatch_summary(spark, sf):
    from .flagship import dispatch_summary
    return dispatch_summary(spark, sf)


# the incremental-value oracle needs the comparison SQL defined above
from .queries import QUERIES as _Q  # noqa: E402

_Q["incremental_value"] = (incremental_value, _incremental_sql())


# ===========================================================================
# J6: "every row x every candidate threshold" - computed by the histogram
# sweep (no cross join); the SQL oracle is the literal cross join
# ===========================================================================

def _j6_sql():
    return IV("""
SELECT threshold, count(*) FILTER (WHERE pred_price > threshold) AS n_pred_above,
       count(*) FILTER (WHERE rt > threshold) AS n_actual_above,
       round(coalesce(sum(rt) FILTER (WHERE pred_price > threshold), 0), 6) AS sum_rt_pred_above
FROM grid CROSS JOIN iv GROUP BY threshold""", _PRICE_GRID_SQL)


def threshold_cross_join(spark, sf):
    """One pass over the rows: a 2-D histogram of (predicted-price interval,
    actual-price interval), at most (K+2)^2 rows, from which every threshold's
    counts are suffix sums."""
    from ..operators.sweep import interval_index
    iv = I.intervals(spark, sf)
    ts = sorted(B.PRICE_GRID)
    k = len(ts)
    jp = F.when(F.col("pred_price").isNull(), F.lit(0)).otherwise(interval_index(F.col("pred_price"), ts, "gt"))
    ja = F.when(F.col("rt").isNull(), F.lit(0)).otherwise(interval_index(F.col("rt"), ts, "gt"))
    hist = iv.groupBy(jp.alias("jp"), ja.alias("ja")).agg(F.count(F.lit(1)).alias("n"),
                                                          F.sum("rt").alias("s"))
    spread = hist.select(F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_i"), "jp", "ja", "n", "s")
    per = spread.groupBy("_i").agg(
        F.sum(F.when(F.col("_i") < F.col("jp"), F.col("n")).otherwise(0)).alias("n_pred_above"),
        F.sum(F.when(F.col("_i") < F.col("ja"), F.col("n")).otherwise(0)).alias("n_actual_above"),
        F.sum(F.when(F.col("_i") < F.col("jp"), F.col("s")).otherwise(0.0)).alias("sum_rt_pred_above"))
    grid = spark.createDataFrame([(i, float(t)) for i, t in enumerate(ts)], "_i int, threshold double")
    return grid.join(per, "_i", "left").select(
        "threshold", F.coalesce("n_pred_above", F.lit(0)).cast("long").alias("n_pred_above"),
        F.coalesce("n_actual_above", F.lit(0)).cast("long").alias("n_actual_above"),
        F.round(F.coalesce("sum_rt_pred_above", F.lit(0.0)), 6).alias("sum_rt_pred_above"))


_Q["threshold_cross_join"] = (threshold_cross_join, _j6_sql())
