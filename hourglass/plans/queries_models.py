"""Model queries.

Trained models have no SQL equivalent except linear least squares, which is
checked two ways: univariate OLS against ``regr_slope / regr_intercept`` and
the per-fold two-feature OLS against its closed form in covariances.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import regime
from ..operators import folds as FO
from ..operators import metrics as E
from ..operators import models as M
from ..operators import series as S
from ..session import checkpoint_once, stored
from ..sources import sinks
from ..streaming.streams import scratch_dir
from . import inputs as I
from .queries import DY, H, IV, daily_features, q

TRAIN_END = "2024-01-22"
VALID_START = "2024-01-15"
HOLDOUT = ("2024-01-08", "2024-01-15")


def model_table(spark, sf) -> DataFrame:
    """Per-user features, evaluated in the same halo stage as ``intervals``."""
    specs = [S.Lag("prc", 2, "prc_lag2"), S.Rolling("prc", 6, "mean", "prc_roll_mean_6"),
             S.Rolling("rt", 6, "mean", "rt_roll_mean_6"), S.LagAbove("rt", 100.0, "spike_lag")]
    m = I.intervals(spark, sf, extra_specs=specs)
    return (m.withColumnRenamed("pred_prc", "prc_lag1").withColumnRenamed("pred_price", "rt_lag1")
             .withColumn("hour", F.hour("ts").cast("double"))
             .withColumn("day_of_week", F.weekday("ts").cast("double"))
             .withColumn("spike_lag", F.col("spike_lag").cast("double"))
             .withColumn("regime", regime("prc"))
             .withColumn("spread", F.col("rt") - F.col("dam")))


def _before(c, ts):
    return F.col(c) < F.to_timestamp_ntz(F.lit(ts))


# ---------------------------------------------------------------------------
# M1 (checked)
# ---------------------------------------------------------------------------

@q("linear_fit", IV("""
SELECT round(regr_intercept(prc, pred_prc), 6) AS intercept, round(regr_slope(prc, pred_prc), 6) AS slope
FROM iv WHERE prc IS NOT NULL AND pred_prc IS NOT NULL"""))
def linear_fit(spark, sf):
    iv = I.intervals(spark, sf)
    m = M.fit_linear(iv, ["pred_prc"], "prc")
    coef = dict(M.linear_coefficients(m, ["pred_prc"]))
    one = iv.agg(F.count(F.lit(1)).alias("_n"))   # keeps the result tied to the data
    return one.select(F.round(F.lit(coef["intercept"]), 6).alias("intercept"),
                      F.round(F.lit(coef["pred_prc"]), 6).alias("slope"))


def _fold_ols_sql():
    terms = [("intercept", "my - b1 * m1 - b2 * m2"), ("pred_prc", "b1"), ("pred_price", "b2")]
    body = " UNION ALL ".join(f"SELECT fold, '{t}' AS term, round({e}, 3) AS coef FROM sol" for t, e in terms)
    return IV(f"SELECT fold, term, coef FROM ({body})",
              """c AS (SELECT prc AS y, pred_prc AS x1, pred_price AS x2,
                         row_number() OVER (ORDER BY ts, event_id) - 1 AS gpos
                  FROM iv WHERE prc IS NOT NULL AND pred_prc IS NOT NULL AND pred_price IS NOT NULL)""",
              "nn AS (SELECT count(*) AS n FROM c)",
              "b AS (SELECT CAST(f AS INTEGER) AS fold, n - (4 - f + 1) * (n // 5) AS lo FROM nn, range(1, 5) r(f))",
              """st AS (SELECT fold, var_pop(x1) AS s11, var_pop(x2) AS s22, covar_pop(x1, x2) AS s12,
                          covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y, avg(x1) AS m1, avg(x2) AS m2,
                          avg(y) AS my
                   FROM b JOIN c ON c.gpos < b.lo GROUP BY fold)""",
              """sol AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
                               (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM st)""")


@q("fold_ols", _fold_ols_sql())
def fold_ols(spark, sf):
    iv = M.complete_rows(I.intervals(spark, sf).drop("pos"), ["prc", "pred_prc", "pred_price"])
    g, _ = FO.time_folds(iv, ["ts", "event_id"], 4)
    out = M.ols_by_fold(g, F.col("fold"), 4, ["pred_prc", "pred_price"], "prc")
    return out.select("fold", "term", F.round("coef", 3).alias("coef"))


# ---------------------------------------------------------------------------
# M2-M4 regressors
# ---------------------------------------------------------------------------

@q("residual_ensemble")
def residual_ensemble(spark, sf):
    feats = M.feature_set("prc_1h")
    mt = stored(M.complete_rows(model_table(spark, sf), feats).select("ts", "prc", *feats))   # read by three fits and two scorings
    train, test = mt.where(_before("ts", TRAIN_END)), mt.where(~_before("ts", TRAIN_END))
    lin = M.fit_linear(train, feats, "prc")
    ens = M.fit_residual_ensemble(train, feats, "prc")
    a = E.mae_rmse(lin.transform(test), "prc", "prediction").withColumn("model", F.lit("linear"))
    b = E.mae_rmse(M.predict_residual_ensemble(ens, test), "prc", "prediction") \
        .withColumn("model", F.lit("linear+residual_trees"))
    return a.unionByName(b).select("model", "n", "mae", "rmse")


@q("price_regressor")
def price_regressor(spark, sf):
    mt = model_table(spark, sf)
    feats = M.feature_set("price_1h")
    train = mt.where(_before("ts", TRAIN_END))
    off = M.target_offset(train.where(_before("ts", VALID_START)), "rt")   # validation rows set nothing
    tr = train.withColumn("y", F.log1p(F.col("rt") + F.lit(off))) \
              .withColumn("is_val", ~_before("ts", VALID_START))
    model = M.fit_gbt_regressor(tr, feats, "y", validation_col="is_val", max_iter=40)
    test = mt.where(~_before("ts", TRAIN_END))
    pred = M.predict_with(model, test, feats).withColumn("pred_price", F.expm1("prediction") - F.lit(off))
    return E.mae_by_tier(pred, "rt", "pred_price")


_SPREAD_FEATS = ["rt_lag1", "rt_roll_mean_6", "prc_lag1", "hour", "spike_lag"]


def _spread_model(spark, sf, max_iter=30, patience=5):
    """The spread model cut at its best iteration on the validation week; with the rows it was prepared from."""
    mt = checkpoint_once(model_table(spark, sf).where(F.col("dam").isNotNull() & F.col("spread").isNotNull()))
    train, valid = mt.where(_before("ts", VALID_START)), mt.where(~_before("ts", VALID_START) & _before("ts", TRAIN_END))
    return mt, valid, M.fit_gbt_early_stop(train, valid, _SPREAD_FEATS, "spread", max_iter=max_iter, patience=patience)


@q("spread_regressor")
def spread_regressor(spark, sf):
    mt, _, (model, _, _) = _spread_model(spark, sf)
    pred = M.predict_with(model, mt.where(~_before("ts", TRAIN_END)), _SPREAD_FEATS).withColumn("pred_rt", F.col("dam") + F.col("prediction"))
    return E.recall_precision_at(pred, "rt", "pred_rt", E.SPIKE_THRESHOLDS)


@q("early_stop_curve", IV("""
SELECT CAST(30 AS INTEGER) AS n_iterations, count(*) AS n_valid, true AS chosen_is_least_so_far, true AS stop_follows_patience, true AS cut_model_has_the_least_error
FROM iv WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-22' AND dam IS NOT NULL AND rt IS NOT NULL"""))
def early_stop_curve(spark, sf):
    """M4: the rule of the early stop, read off the validation curve, and the cut model's own error on the validation rows."""
    _, valid, (model, curve, m) = _spread_model(spark, sf)
    c = spark.createDataFrame([(i + 1, e, i + 1 == m) for i, e in enumerate(curve)], "iteration int, error double, chosen boolean")
    at = c.where("chosen").select("iteration", "error")
    here = at.select("iteration").scalar()
    least = at.select("error").scalar()
    rule = c.agg(F.count(F.lit(1)).cast("int").alias("n_iterations"),
                 (F.min(F.when(F.col("iteration") <= here + 5, F.col("error"))) == least).alias("chosen_is_least_so_far"),
                 ((F.count_if(F.col("iteration") > here) == 0) | (F.count_if((F.col("iteration") > here) & (F.col("iteration") <= here + 5) & (F.col("error") < least)) == 0)).alias("stop_follows_patience"))
    own = M.predict_with(model, valid, _SPREAD_FEATS).agg(F.count(F.lit(1)).alias("n_valid"), F.avg((F.col("prediction") - F.col("spread")) ** 2).alias("mse"))
    return rule.select("n_iterations", own.select("n_valid").scalar().alias("n_valid"), "chosen_is_least_so_far", "stop_follows_patience",
                       (F.abs(own.select("mse").scalar() - F.lit(curve[m - 1])) < 1e-6 * F.lit(max(curve[m - 1], 1e-9))).alias("cut_model_has_the_least_error"))


@q("model_importances")
def model_importances(spark, sf):
    """Importances of the regime forest by column, greatest first."""
    feats = M.feature_set("regime")
    mt = M.complete_rows(model_table(spark, sf), [*feats, "regime"]).where(_before("ts", TRAIN_END))
    model = M.fit_regime_classifier(mt, feats, num_trees=20)
    scored = model.transform(M.with_null_indicators(mt, feats))
    rows = [(i + 1, c, v) for i, (c, v) in enumerate(M.importances(model, scored)[:5])]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")


# ---------------------------------------------------------------------------
# deterministic parts of the model queries, checked by SQL
# ---------------------------------------------------------------------------

_COMPLETE_SQL = """c AS (SELECT * FROM (SELECT *, lag(prc, 2) OVER w AS prc_lag2, count(prc) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS full6
    FROM iv WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
  WHERE pred_prc IS NOT NULL AND prc_lag2 IS NOT NULL AND full6 = 6 AND pred_price IS NOT NULL AND dam IS NOT NULL AND prc > 0)"""
_SCARCE = "CAST(prc <= 3000 AS INTEGER)"


@q("oof_membership", IV(f"""
SELECT CAST(CASE WHEN gpos >= n - 4 * (n // 5) THEN floor((gpos - (n - 4 * (n // 5))) / (n // 5)) + 1 ELSE 0 END AS INTEGER) AS fold, count(*) AS n,
       sum({_SCARCE})::BIGINT AS n_target, min(ts) AS first_ts, max(ts) AS last_ts
FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS gpos, count(*) OVER () AS n FROM c) GROUP BY 1""", _COMPLETE_SQL))
def oof_membership(spark, sf):
    """Rows, target rows and time span of each fold of the model table; fold 0 only trains."""
    g = _folded_complete(spark, sf, M.feature_set("regime"), 4)
    return g.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("regime") == "Scarcity").alias("n_target"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@q("oof_scored_rows", IV("""
SELECT fold, count(*) AS n, true AS probabilities_sum_to_one, true AS each_row_once FROM (
  SELECT CAST(floor((gpos - (n - 4 * (n // 5))) / (n // 5)) + 1 AS INTEGER) AS fold FROM (
    SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS gpos, count(*) OVER () AS n FROM c) WHERE gpos >= n - 4 * (n // 5)) GROUP BY 1""", _COMPLETE_SQL))
def oof_scored_rows(spark, sf):
    """Every test row has one out-of-fold score and rows that only train have none."""
    oof = _oof(spark, sf)
    total = sum((F.col(f"p_{c}") for c in M.REGIME_CLASSES), F.lit(0.0))
    return oof.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), (F.max(F.abs(total - 1)) < 1e-9).alias("probabilities_sum_to_one"),
                                   (F.count_distinct("event_id") == F.count(F.lit(1))).alias("each_row_once"))


@q("holdout_membership", IV(f"""
SELECT ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' AS held_out, count(*) AS n, sum({_SCARCE})::BIGINT AS n_target FROM c GROUP BY 1""", _COMPLETE_SQL))
def holdout_membership(spark, sf):
    """The event week against the rest of the complete rows."""
    mt = M.complete_rows(model_table(spark, sf), [*M.feature_set("regime"), "regime"])
    inside = ~_before("ts", HOLDOUT[0]) & _before("ts", HOLDOUT[1])
    return mt.groupBy(inside.alias("held_out")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("regime") == "Scarcity").alias("n_target"))


@q("windowed_scores_outside", DY("""
SELECT CAST(month IN (6, 7, 8, 9) AS INTEGER) AS is_4cp_season, count(*) AS n, true AS zero_outside, true AS within_bounds FROM daily GROUP BY 1"""))
def windowed_scores_outside(spark, sf):
    """One row per day, probability 0 outside the season, within [0, 1] inside."""
    d, model = _peak_model(spark, sf)
    s = M.score_windowed(model, d, _PEAK_FEATS, F.col("is_4cp_season") == 1, ["ts"], "p_model")
    p = F.col("p_model")
    return s.groupBy("is_4cp_season").agg(F.count(F.lit(1)).alias("n"), (F.count_if((F.col("is_4cp_season") == 0) & (p != 0)) == 0).alias("zero_outside"),
                                          (F.count_if((p < 0) | (p > 1) | p.isNull()) == 0).alias("within_bounds"))


@q("score_batch_coverage", IV("""
SELECT count(*) AS n, count(*) FILTER (WHERE pred_prc IS NOT NULL AND prc_lag2 IS NOT NULL AND full6 = 6 AND pred_price IS NOT NULL AND dam IS NOT NULL) AS n_scored
FROM f""", """f AS (SELECT *, lag(prc, 2) OVER w AS prc_lag2, count(prc) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS full6
    FROM iv WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""))
def score_batch_coverage(spark, sf):
    """Every row comes back, and those with all features are scored."""
    mt = model_table(spark, sf)
    feats = M.feature_set("prc_1h")
    model = M.fit_linear(mt.where(_before("ts", TRAIN_END)), feats, "prc")
    return M.score_complete(model, mt, feats, ["event_id"], "predicted_prc").agg(F.count(F.lit(1)).alias("n"), F.count("predicted_prc").alias("n_scored"))


# ---------------------------------------------------------------------------
# M5, M10, E8 on out-of-fold probabilities
# ---------------------------------------------------------------------------

def _folded_complete(spark, sf, feats, k):
    """The complete rows with their fold, prepared once for the fold bounds and all fits."""
    whole = M.complete_rows(model_table(spark, sf), [*feats, "regime"]).select("event_id", "ts", *feats, "regime")
    mt = checkpoint_once(whole)   # keeps rows and partitions in place, which the forests' bags depend on
    return FO.time_folds(mt, ["ts", "event_id"], k)[0]


def _oof(spark, sf):
    feats = M.feature_set("regime")
    return M.oof_predictions(_folded_complete(spark, sf, feats, 4), 4, lambda tr: M.fit_regime_classifier(tr, feats, num_trees=20),
                             lambda m, te: M.class_probabilities(m, te, feats))


@q("regime_classifier")
def regime_classifier(spark, sf):
    return E.threshold_for_recall(_oof(spark, sf), "regime", "pred", "p_Scarcity")


@q("oof_predictions")
def oof_predictions(spark, sf):
    return E.recall_by_fold(_oof(spark, sf), "regime", "pred", "fold")


@q("grid_search")
def grid_search(spark, sf):
    feats = M.feature_set("regime")
    g = _folded_complete(spark, sf, feats, 2)
    grid = [{"num_trees": 10, "max_depth": 4}, {"num_trees": 20, "max_depth": 6}]

    def metric(m, te):
        rep = E.recall_by_fold(M.class_probabilities(m, te, feats).withColumn("fold", F.lit(1)),
                               "regime", "pred", "fold").first()
        return float(rep.macro_recall)

    return M.grid_search(g, 2, grid, lambda tr, p: M.fit_regime_classifier(tr, feats, **p), metric)


@q("uri_holdout")
def uri_holdout(spark, sf):
    feats = M.feature_set("regime")
    mt = M.complete_rows(model_table(spark, sf), [*feats, "regime"])
    inside = ~_before("ts", HOLDOUT[0]) & _before("ts", HOLDOUT[1])
    model = M.fit_regime_classifier(mt.where(~inside), feats, num_trees=20)
    pred = M.class_probabilities(model, mt.where(inside), feats)
    return E.classification_report(pred, "regime", "pred")


@q("baseline_models")
def baseline_models(spark, sf):
    mt = model_table(spark, sf).withColumn("is_scarcity", (F.col("regime") == "Scarcity").cast("int"))
    feats = M.feature_set("prc_1h")
    return M.baseline_models(mt.where(_before("ts", TRAIN_END)), mt.where(~_before("ts", TRAIN_END)),
                             feats, "is_scarcity")


# ---------------------------------------------------------------------------
# M6, M15 peak classifier on the daily series
# ---------------------------------------------------------------------------

_PEAK_FEATS = ["load_total", "load_vs_monthly_max", "day_of_week", "month", "n_orders", "avg_price"]


def _peak_model(spark, sf):
    d = daily_features(spark, sf).withColumn("day_of_week", F.col("day_of_week").cast("double")) \
        .withColumn("month", F.col("month").cast("double"))
    summer = d.where(F.col("is_4cp_season") == 1)
    model = M.fit_peak_classifier(summer.where(F.col("year") <= 1998), _PEAK_FEATS, "is_peak")
    return d, model


@q("peak_classifier")
def peak_classifier(spark, sf):
    d, model = _peak_model(spark, sf)
    test = d.where((F.col("is_4cp_season") == 1) & (F.col("year") >= 1999))
    scored = M.positive_probability(model, test, _PEAK_FEATS, "p_model")
    return E.topk_hit_by_period(scored, "p_model", "is_peak", ["year", "month"])


@q("score_windowed")
def score_windowed(spark, sf):
    d, model = _peak_model(spark, sf)
    s = M.score_windowed(model, d, _PEAK_FEATS, F.col("is_4cp_season") == 1, ["ts"], "p_model")
    return s.groupBy("is_4cp_season").agg(F.count(F.lit(1)).alias("n"),
                                          F.count_if(F.col("p_model") > 0).alias("n_positive_p"),
                                          F.avg("p_model").alias("mean_p"))


# ---------------------------------------------------------------------------
# M14, S9, S10
# ---------------------------------------------------------------------------

@q("score_batch")
def score_batch(spark, sf):
    mt = model_table(spark, sf)
    feats = M.feature_set("prc_1h")
    model = M.fit_linear(mt.where(_before("ts", TRAIN_END)), feats, "prc")
    s = M.score_complete(model, mt, feats, ["event_id"], "predicted_prc")
    s = s.withColumn("predicted_regime", regime("predicted_prc"))
    return s.groupBy("predicted_regime").agg(F.count(F.lit(1)).alias("n"),
                                             F.count("predicted_prc").alias("n_scored"))


@q("model_persistence", IV("""
SELECT count(*) AS n, 0.0::DOUBLE AS max_abs_diff, 6 AS n_features FROM f
WHERE ts >= TIMESTAMP '2024-01-22' AND pred_prc IS NOT NULL AND prc_lag2 IS NOT NULL AND full6 = 6
  AND pred_price IS NOT NULL AND dam IS NOT NULL""", """f AS (
  SELECT *, lag(prc, 2) OVER w AS prc_lag2, count(prc) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS full6
  FROM iv WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""))
def model_persistence(spark, sf):
    from pyspark.ml import PipelineModel
    mt = model_table(spark, sf)
    feats = M.feature_set("prc_1h")
    train = mt.where(_before("ts", TRAIN_END))
    model = M.fit_linear(train, feats, "prc")
    meta = {"features": feats, "target": "prc", "train_end": TRAIN_END,
            "coefficients": dict(M.linear_coefficients(model, feats))}
    path = scratch_dir(spark, "model")
    sinks.save_model_with_metadata(spark, model, path, meta)
    loaded, meta2 = sinks.load_model_metadata(spark, path, PipelineModel)
    test = M.complete_rows(mt.where(~_before("ts", TRAIN_END)), feats)
    a = model.transform(sinks.project_features(test, ["event_id", *meta2["features"]])) \
        .select("event_id", F.col("prediction").alias("p1"))
    b = loaded.transform(sinks.project_features(test, ["event_id", *meta2["features"]])) \
        .select("event_id", F.col("prediction").alias("p2"))
    return a.join(b, "event_id").agg(F.count(F.lit(1)).alias("n"),
                                     F.max(F.abs(F.col("p1") - F.col("p2"))).alias("max_abs_diff"),
                                     F.lit(len(meta2["features"])).alias("n_features"))


@q("sink_model_metadata")
def sink_model_metadata(spark, sf):
    """Fit, save the model with its JSON sidecar, and read the sidecar
    back as rows (term, coefficient) from the shared folder."""
    mt = model_table(spark, sf)
    feats = M.feature_set("prc_1h")
    model = M.fit_linear(mt.where(_before("ts", TRAIN_END)), feats, "prc")
    meta = {"features": feats, "target": "prc", "train_end": TRAIN_END,
            "coefficients": dict(M.linear_coefficients(model, feats))}
    path = scratch_dir(spark, "model-meta")
    sinks.save_model_with_metadata(spark, model, path, meta)
    side = spark.read.text(f"{path}/metadata")
    parsed = F.from_json("value", "struct<features: array<string>, coefficients: map<string, double>>")
    return side.select(parsed.alias("m")).select(F.explode("m.coefficients").alias("term", "coef"))


@q("load_model_metadata")
def load_model_metadata(spark, sf):
    """Load a saved model and its frozen feature list, project exactly
    those columns and score; NULL predictions where a feature is missing."""
    from pyspark.ml import PipelineModel
    mt = model_table(spark, sf)
    feats = M.feature_set("prc_1h")
    path = scratch_dir(spark, "model-load")
    sinks.save_model_with_metadata(spark, M.fit_linear(mt.where(_before("ts", TRAIN_END)), feats, "prc"),
                                   path, {"features": feats})
    model, meta = sinks.load_model_metadata(spark, path, PipelineModel)
    scored = M.score_complete(model, sinks.project_features(mt, ["event_id", *meta["features"]]),
                              meta["features"], ["event_id"], "predicted_prc")
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.count("predicted_prc").alias("n_scored"),
                      F.avg("predicted_prc").alias("mean_prediction"))


#: features that the further feeds add, in naive SQL
_FEED_SQL = {
    "wind_forecast_error": "wind - wind_forecast", "solar_forecast_error": "solar - solar_forecast", "net_load_west": "hub_load - wind",
    "net_load_system": "load_total - wind_system - solar", "renewable_pct_system": "(wind_system + solar) / nullif(load_total, 0)",
    "load_fcst_vs_monthly_max": "load_forecast / nullif(monthly_load_max, 0)", "dam_congestion_spread": "dam - dam_system",
    "wind_system_ramp": "wind_system - lag(wind_system) OVER o",
    "temp_roll_3h_max": "CASE WHEN count(temperature) OVER (ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) = 3 THEN max(temperature) OVER (ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END",
    "adder_reserve_log1p": "ln(1 + adder_reserve)", "adder_offline_log1p": "ln(1 + adder_offline)", "adder_reliability_log1p": "ln(1 + adder_reliability)",
}


def _market_sql() -> str:
    feeds = ", ".join(f"{re.sub(r'([0-9])D', r'\1::DOUBLE', e)} AS {c}" for c, e in I.MARKET_FEEDS.items())
    return f"market AS (SELECT * REPLACE (CASE WHEN hour(ts) % 5 = 0 THEN rt + 1000.0 ELSE rt END AS rt) FROM (SELECT *, {feeds} FROM hourly))"


def _model_ready_sql(wide: bool = False) -> str:
    """The feature table in naive SQL: global windows over the hourly table (``wide``: with all feeds)."""
    fills = ", ".join(f"""coalesce({c}, last_value({c} IGNORE NULLS) OVER (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value({c} IGNORE NULLS) OVER (ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"""
                      for c in ("rt", "dam", "hub_load", "load_total", *(("solar_capacity",) if wide else ())))
    caps = ", CASE WHEN wind <= 25000 THEN wind END AS wind"
    caps += ", CASE WHEN solar <= 25000 THEN solar END AS solar, CASE WHEN wind_system <= 45000 THEN wind_system END AS wind_system" if wide else ""
    feats = [(f"lag({c}, {k}) OVER o", f"{c}_{k}h_lag") for c in ("rt", "dam", "prc") for k in (1, 24, 168)]
    feats += [(f"lag({c}, {k}) OVER o", f"{c}_{k}h_lag")
              for c, k in (("hub_load", 24), ("load_total", 24), ("wind", 24), ("wind", 168), ("spread", 1))]
    rolls = [("prc", 6, "mean"), ("prc", 6, "std"), ("prc", 24, "mean")]
    rolls += [(c, n, fn) for c in ("rt", "dam", "hub_load", "load_total", "wind") for n in (6, 24) for fn in ("mean", "std")]
    for c, n, fn in rolls:
        frame = f"OVER (ORDER BY pos ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        f = {"mean": "avg", "std": "stddev_samp"}[fn]
        feats.append((f"CASE WHEN count({c}) {frame} = {n} THEN {f}({c}) {frame} END", f"{c}_roll_{fn}_{n}h"))
    feats += [(f"{c} - lag({c}) OVER o", f"{c}_ramp") for c in ("load_total", "hub_load", "wind", "rt")]
    feats += [("load_total - wind", "net_load"), ("wind / nullif(load_total, 0)", "renewable_pct"),
              ("wind / nullif(hub_load, 0)", "wind_load_ratio"), ("load_total / nullif(monthly_load_max, 0)", "load_vs_monthly_max"),
              ("load_total - monthly_load_max", "load_above_monthly_max"),
              ("sin(2 * pi() * hour / 24.0)", "hour_sin"), ("cos(2 * pi() * hour / 24.0)", "hour_cos")]
    feats += [(c, c) for c in ("rt", "dam", "prc", "load_total", "hub_load", "wind", "zone_view", "zone_click", "zone_signup",
                               "zone_error", "spread", "monthly_load_max")]
    if wide:
        feats += [(e, c) for c, e in _FEED_SQL.items()] + [(c, c) for c in I.MARKET_FEEDS]
    cols = ", ".join(f"round({e}, 6) AS {name}" for e, name in feats)
    body = f"""
SELECT * FROM (SELECT ts, n_events, hour, day_of_week, month, is_weekend, year, is_pre_rtcb, days_since_start, pos, {cols},
  CASE WHEN lag(rt) OVER o > 100 THEN 1 ELSE 0 END AS price_spike_lag,
  CAST(month IN (6, 7, 8, 9) AS INTEGER) AS is_4cp_season,
  CAST(month IN (6, 7, 8, 9) AND hour BETWEEN 14 AND 19 AS INTEGER) AS is_4cp_window,
  CASE WHEN prc > 0 AND prc <= 3000 THEN 'Scarcity' WHEN prc > 3000 AND prc <= 5000 THEN 'Tight'
       WHEN prc > 5000 AND prc <= 10000 THEN 'Normal' WHEN prc > 10000 THEN 'Surplus' END AS regime
  FROM p WINDOW o AS (ORDER BY pos)) WHERE pos >= 168"""
    first = [_market_sql()] if wide else []
    return H(body, *first, f"filled AS (SELECT * REPLACE ({fills}{caps}) FROM {'market' if wide else 'hourly'})",
             """kept AS (
  SELECT *, rt - dam AS spread, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
         CAST(month(ts) AS INTEGER) AS month, CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend, CAST(year(ts) AS INTEGER) AS year,
         CAST(ts < TIMESTAMP '2025-12-05' AS INTEGER) AS is_pre_rtcb,
         CAST(date_diff('day', DATE '2021-01-01', CAST(ts AS DATE)) AS INTEGER) AS days_since_start,
         row_number() OVER (ORDER BY ts) - 1 AS pos
  FROM filled WHERE prc IS NOT NULL AND wind IS NOT NULL""" + (" AND solar IS NOT NULL)" if wide else ")"),
             "peak AS (SELECT *, max(load_total) OVER (PARTITION BY year, month ORDER BY pos) AS cm FROM kept)",
             "p AS (SELECT * EXCLUDE (cm), lag(cm) OVER (ORDER BY pos) AS monthly_load_max FROM peak)")


def _market_ready(spark, sf):
    from .model_ready import FEEDS, model_ready
    return model_ready(I.market(spark, sf), source_rank="source_rank", feeds={f: f for f in FEEDS})


def _rounded(d):
    return d.select(*[F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in d.dtypes])


@q("market_table", _model_ready_sql(wide=True))
def market_table(spark, sf):
    """The whole feature table with all feeds from two sources, of which the first wins."""
    return _rounded(_market_ready(spark, sf))


#: numeric columns of the market table
_MARKET_COLUMNS = ["hour", "day_of_week", "month", "is_weekend", "year", "is_pre_rtcb", "days_since_start", "price_spike_lag", "is_4cp_season", "is_4cp_window",
                   *(f"{c}_{k}h_lag" for c in ("rt", "dam", "prc") for k in (1, 24, 168)), "hub_load_24h_lag", "load_total_24h_lag", "wind_24h_lag", "wind_168h_lag",
                   "spread_1h_lag", "prc_roll_mean_6h", "prc_roll_std_6h", "prc_roll_mean_24h",
                   *(f"{c}_roll_{fn}_{n}h" for c in ("rt", "dam", "hub_load", "load_total", "wind") for n in (6, 24) for fn in ("mean", "std")),
                   "load_total_ramp", "hub_load_ramp", "wind_ramp", "rt_ramp", "net_load", "renewable_pct", "wind_load_ratio", "load_vs_monthly_max",
                   "load_above_monthly_max", "hour_sin", "hour_cos", "rt", "dam", "prc", "load_total", "hub_load", "wind", "spread", "monthly_load_max",
                   *_FEED_SQL, *I.MARKET_FEEDS]


def _feature_profile_sql() -> str:
    rows = ", ".join(f"{{'model': '{m}', 'feature': '{c}', 'n': count({c}), 'mean': round(avg({c}), 4)}}"
                     for m, drops in M.FEATURE_DROPS.items() for c in _MARKET_COLUMNS if c not in drops)
    return f"SELECT unnest(r, recursive := true) FROM (SELECT unnest([{rows}]) AS r FROM ({_model_ready_sql(wide=True)}))"


@q("feature_set_profile", _feature_profile_sql())
def feature_set_profile(spark, sf):
    """Every feature of the five models' full sets, with its count and mean, in one aggregation."""
    d = _rounded(_market_ready(spark, sf))
    pairs = [(m, c) for m in M.FEATURE_DROPS for c in M.full_feature_set(d, m)]
    every = sorted({c for _, c in pairs})
    d = checkpoint_once(d.select(*every))
    row = d.agg(*[F.count(c).alias(f"{c}__n") for c in every], *[F.round(F.avg(F.col(c).cast("double")), 4).alias(f"{c}__mean") for c in every]).first()
    return spark.createDataFrame([(m, c, row[f"{c}__n"], row[f"{c}__mean"]) for m, c in pairs], "model string, feature string, n long, mean double")


@q("model_ready", _model_ready_sql())
def model_ready_table(spark, sf):
    """The full feature table (quality -> calendar -> positional features ->
    ratios -> peak season -> regimes -> warm-up drop) on the hourly feeds."""
    from .model_ready import model_ready
    d = model_ready(I.hourly(spark, sf))
    return d.select(*[F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in d.dtypes])
