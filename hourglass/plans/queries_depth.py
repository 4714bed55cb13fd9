"""Queries of operators in depth: leaks, wide least squares, event-free audits, fold means."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import decision as D
from ..operators import folds as FO
from ..operators import gramian as G
from ..operators import metrics as E
from ..operators import series as S
from ..session import stored
from . import inputs as I
from .queries import H, IV, _r, q
from .queries_decision import OVERRIDE_T, _FOLD_SQL, _folded, _report_sql
from .queries_models import TRAIN_END, _before, _model_ready_sql

# ---------------------------------------------------------------------------
# Features whose exact combination is the target
# ---------------------------------------------------------------------------

#: the lag and the ramp of the target, and the spread and the day-ahead price, give the target exactly
LEAK_CANDIDATES = ["rt_1h_lag", "rt_ramp", "spread", "dam", "load_total", "hub_load", "wind", "load_total_ramp", "wind_ramp", "hour", "day_of_week"]


def _leak_sql():
    cols = ", ".join(LEAK_CANDIDATES)
    whole = " AND ".join(f"{c} IS NOT NULL" for c in [*LEAK_CANDIDATES, "rt"])
    return f"""
WITH m AS ({_model_ready_sql()}),
w AS (SELECT row_number() OVER () AS i, rt AS y, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in LEAK_CANDIDATES)} FROM m WHERE {whole}),
u AS (UNPIVOT w ON {cols} INTO NAME f VALUE v),
s AS (SELECT a.f AS f1, b.f AS f2, var_pop(a.v) AS s11, var_pop(b.v) AS s22, covar_pop(a.v, b.v) AS s12, covar_pop(a.v, a.y) AS s1y, covar_pop(b.v, a.y) AS s2y, var_pop(a.y) AS syy
      FROM u a JOIN u b ON a.i = b.i AND a.f < b.f GROUP BY 1, 2),
r AS (SELECT *, s11 * s22 - s12 * s12 AS det FROM s),
e AS (SELECT f1, f2, ((s22 * s1y - s12 * s2y) / det * s1y + (s11 * s2y - s12 * s1y) / det * s2y) / syy AS r2 FROM r WHERE det > 1e-9 * s11 * s22)
SELECT 2 AS n_features, f1 || ' + ' || f2 AS features FROM e WHERE r2 > 1 - 1e-7"""


@q("feature_leaks", _leak_sql())
def feature_leaks(spark, sf):
    from .model_ready import model_ready
    d = model_ready(I.hourly(spark, sf))
    return G.feature_leaks(d, LEAK_CANDIDATES, "rt").select("n_features", "features")


# ---------------------------------------------------------------------------
# M1 / M8 at the full width
# ---------------------------------------------------------------------------

WIDE_LAGS = 20
WIDE = [f"{c}_lag{k}" for c in ("rt", "prc") for k in range(1, WIDE_LAGS + 1)] + ["hour", "day_of_week", "twice_hour"]


def _wide_sql():
    lags = ", ".join(f"lag({c}, {k}) OVER o AS {c}_lag{k}" for c in ("rt", "prc") for k in range(1, WIDE_LAGS + 1))
    whole = " AND ".join(f"{c}_lag{k} IS NOT NULL" for c in ("rt", "prc") for k in range(1, WIDE_LAGS + 1))
    return IV(f"""
SELECT CAST(f AS INTEGER) AS fold, (SELECT count(*) FROM w WHERE gpos < n - (4 - f + 1) * (n // 5)) AS n_rows, {len(WIDE) - 1} AS rank, true AS normal_equations_hold
FROM (SELECT count(*) AS n FROM w) nn, range(1, 5) r(f)""",
              f"l AS (SELECT *, {lags} FROM (SELECT event_id, ts, rt, prc FROM iv) WINDOW o AS (ORDER BY ts, event_id))",
              f"w AS (SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS gpos FROM l WHERE prc IS NOT NULL AND {whole})")


@q("wide_fold_ols", _wide_sql())
def wide_fold_ols(spark, sf):
    """43 features, one of them twice another: least squares of every fold from one pass, with its rank and
    the largest remaining correlation of a feature with the residuals (0 at the least squares)."""
    ev = stored(I.intervals(spark, sf).select("event_id", "ts", "rt", "prc"))   # positions read it more than once
    specs = [S.Lag(c, k, f"{c}_lag{k}") for c in ("rt", "prc") for k in range(1, WIDE_LAGS + 1)]
    wide = S.add_series_features(ev, specs, ["ts", "event_id"], keep_pos=False)
    wide = wide.withColumn("hour", F.hour("ts").cast("double")).withColumn("day_of_week", F.weekday("ts").cast("double"))
    wide = wide.withColumn("twice_hour", F.col("hour") * 2).na.drop(subset=[*WIDE, "prc"])
    g = FO.time_folds(stored(wide), ["ts", "event_id"], 4)[0]                # prepared once for the bounds and all passes
    mean, dev = G.scales(g, [*WIDE, "prc"])
    fits = G.expanding_ols(g, F.col("fold"), 4, WIDE, "prc", (mean, dev))
    # the residuals of all folds against all features, in one more pass over the rows
    left = []
    for f, _, _, beta in fits:
        fitted = F.lit(float(beta[0]))
        for c, b in zip(WIDE, beta[1:]):
            fitted = fitted + F.col(c) * float(b)
        left.append((F.col("prc") - fitted).alias(f"left{f}"))
    names = [f"left{f}" for f, *_ in fits]
    held = G.gramians(g.select("fold", *WIDE, *left), F.col("fold"), [*WIDE, *names], np.r_[mean[:-1], np.zeros(len(names))], np.r_[dev[:-1], np.full(len(names), dev[-1])])
    rows = []
    for i, (f, n, rank, _) in enumerate(fits):
        total = sum(v for r, v in held.items() if r < f)
        rows.append((f, n, rank, bool(np.abs(total[: len(WIDE) + 1, len(WIDE) + 1 + i]).max() / max(n, 1) < 1e-6)))
    return spark.createDataFrame(rows, "fold int, n_rows long, rank int, normal_equations_hold boolean")


# ---------------------------------------------------------------------------
# E10, E7, E6
# ---------------------------------------------------------------------------

_HOURS_SQL = """h AS (SELECT ts, prc, CASE WHEN pred IS NOT NULL THEN greatest(0.0, least(1.0, 1.0 - pred / 6000.0)) END AS p,
         CASE WHEN pred <= 0 THEN NULL WHEN pred <= 3000 THEN 'Scarcity' WHEN pred <= 5000 THEN 'Tight' WHEN pred <= 10000 THEN 'Normal' ELSE 'Surplus' END AS pred_regime,
         coalesce(prc > 0 AND prc <= 3000 OR rt > 60, false) AS event
       FROM (SELECT *, lag(prc) OVER (ORDER BY ts) AS pred FROM hourly))"""


@q("event_free_audit", H(f"""
SELECT min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n_rows, count(*) FILTER (WHERE pred = 'Scarcity') AS n_flagged,
       round(count(*) FILTER (WHERE pred = 'Scarcity') * 100.0 / count(*), 2) AS pct,
       CAST(round(count(*) FILTER (WHERE pred = 'Scarcity') * 100.0 / count(*), 2) < 2.0 AS INTEGER) AS passed
FROM (SELECT *, CASE WHEN p >= {OVERRIDE_T} THEN 'Scarcity' ELSE pred_regime END AS pred FROM i
      WHERE island = (SELECT island FROM i GROUP BY island ORDER BY count(*) DESC, min(ts) LIMIT 1))""",
                         _HOURS_SQL, "i AS (SELECT * FROM (SELECT *, count(*) FILTER (WHERE event) OVER (ORDER BY ts) AS island FROM h) WHERE NOT event)"))
def event_free_audit(spark, sf):
    """False alarms in the longest run of hours without an event (a scarcity or a price above 60)."""
    h = S.add_series_features(I.hourly(spark, sf), [S.Lag("prc", 1, "pred_prc")], ["ts"])
    h = I.with_regimes(h)
    p = F.when(F.col("pred_prc").isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - F.col("pred_prc") / F.lit(6000.0))))
    event = F.coalesce((F.col("regime") == "Scarcity") | (F.col("rt") > 60), F.lit(False))
    h = h.withColumn("p_scarcity", p).withColumn("pred", D.threshold_override("p_scarcity", "pred_regime", OVERRIDE_T))
    return E.event_free_audit(h, event, "pred", "ts", "pos")


@q("cv_mean_recall", IV("""
SELECT round(coalesce(avg(recall), 0.0), 6) AS mean_recall, count(*) AS folds_with_target
FROM rep WHERE label = 'Scarcity' AND support > 0""", _FOLD_SQL, _report_sql("fd", "regime", "pred_regime", by="fold")))
def cv_mean_recall(spark, sf):
    """The mean over the folds that have an event."""
    m = E.cv_mean_recall(E.recall_by_fold(_folded(spark, sf), "regime", "pred_regime", "fold"))
    return m.select(_r("mean_recall"), "folds_with_target")


@q("mae_ratio", IV(f"""
SELECT round(avg(abs(rt - pred_price)) FILTER (WHERE ts < TIMESTAMP '{TRAIN_END}'), 6) AS train_mae,
       round(avg(abs(rt - pred_price)) FILTER (WHERE ts >= TIMESTAMP '{TRAIN_END}'), 6) AS test_mae,
       round(avg(abs(rt - pred_price)) FILTER (WHERE ts >= TIMESTAMP '{TRAIN_END}') / avg(abs(rt - pred_price)) FILTER (WHERE ts < TIMESTAMP '{TRAIN_END}'), 6) AS ratio
FROM iv"""))
def mae_ratio(spark, sf):
    """Test error against training error."""
    r = E.mae_ratio(I.intervals(spark, sf), "rt", "pred_price", _before("ts", TRAIN_END))
    return r.select(_r("train_mae"), _r("test_mae"), _r("ratio"))
