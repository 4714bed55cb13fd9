"""Modelling on Spark ML.

Every fit is a distributed Spark ML fit; loops run over folds or parameter
sets (k small) on the driver, never over rows.  The expanding-window OLS
uses per-region Gramians (``gramian.py``).

Spark trees are not LightGBM: no native missing values (impute first, with
indicator columns), depth-wise growth, and GBT is binary.  Results are
compared on quality, not bit-for-bit.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Sequence

import numpy as np
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import regime
from .folds import test_fold
from .gramian import expanding_ols

# --- fixed values that must equal the reference's --------------------------
CLASS_WEIGHTS = {"Scarcity": 40.0, "Tight": 1.0, "Normal": 1.0, "Surplus": 5.0}
REGIME_CLASSES = ("Normal", "Scarcity", "Surplus", "Tight")   # alphabetical, fixed order
# ---------------------------------------------------------------------------

SEED = 42


def class_weight_expr(label_col: str, weights: dict = CLASS_WEIGHTS, default: float = 1.0) -> Column:
    """Label -> weight, unknown labels weigh ``default``."""
    m = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(m[F.col(label_col)], F.lit(default))


# ---------------------------------------------------------------------------
# features
# ---------------------------------------------------------------------------

def with_null_indicators(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``<c>_isnull`` flags so trees can still split on missingness
    after imputation."""
    return df.select("*", *[F.col(c).isNull().cast("double").alias(f"{c}_isnull") for c in cols])


def imputer(cols: Sequence[str], strategy: str = "mean") -> Imputer:
    return Imputer(inputCols=list(cols), outputCols=[f"{c}_imp" for c in cols], strategy=strategy)


FEATURE_SETS: dict[str, dict] = {
    # Named sets by horizon availability (declarative; the contract is
    # the frozen list, not "all numeric columns")
    "prc_1h": {"features": ["prc_lag1", "prc_lag2", "prc_roll_mean_6", "rt_lag1", "dam", "hour"]},
    "prc_24h": {"features": ["prc_lag2", "prc_roll_mean_6", "dam", "hour", "day_of_week"]},
    "price_1h": {"features": ["rt_lag1", "rt_roll_mean_6", "dam", "prc_lag1", "hour", "spike_lag"]},
    "regime": {"features": ["prc_lag1", "prc_lag2", "prc_roll_mean_6", "rt_lag1", "dam", "hour"]},
}


# --- fixed values that must equal the reference's: columns that a model may not see -------------
_TARGETS = ("ts", "prc", "regime", "rt", "dam", "spread", "adder_reserve", "adder_offline", "adder_reliability")
_PRC_ROLLS = ("prc_roll_mean_6h", "prc_roll_std_6h", "prc_roll_mean_24h")
_NOT_A_DAY_AHEAD = (
    "hub_load", "load_total", "wind", "wind_system", "solar", "net_load_system", "net_load_west",
    "renewable_pct_system", "renewable_pct_west", "wind_forecast_error", "solar_forecast_error",
    "rt_1h_lag", "dam_1h_lag",
    "rt_roll_mean_6h", "rt_roll_std_6h", "dam_roll_mean_6h", "dam_roll_std_6h", "hub_load_roll_mean_6h", "hub_load_roll_std_6h",
    "load_total_roll_mean_6h", "load_total_roll_std_6h", "wind_roll_mean_6h", "wind_roll_std_6h",
    "load_total_ramp", "hub_load_ramp", "wind_ramp", "wind_system_ramp", "rt_ramp",
    "adder_reserve_log1p", "adder_offline_log1p", "adder_reliability_log1p",
)
FEATURE_DROPS = {
    "prc_1h": _TARGETS + _PRC_ROLLS,
    "prc_24h": _TARGETS + _NOT_A_DAY_AHEAD,
    "price_1h": ("ts", "regime", "rt", "dam", "spread", "adder_reserve", "adder_offline", "adder_reliability"),
    "spread_24h": ("ts", "regime", "rt", "spread", "adder_reserve", "adder_offline", "adder_reliability") + _NOT_A_DAY_AHEAD
    + ("wind_load_ratio", "prc_1h_lag", "spread_1h_lag", "price_spike_lag", "prc_roll_mean_6h", "prc_roll_std_6h"),
    "peak": _TARGETS + (
        "adder_reserve_log1p", "adder_offline_log1p", "adder_reliability_log1p", "rt_1h_lag", "rt_24h_lag", "rt_168h_lag", "spread_1h_lag",
        "price_spike_lag", "rt_roll_mean_6h", "rt_roll_std_6h", "rt_roll_mean_24h", "rt_roll_std_24h", "rt_ramp",
        "dam_roll_mean_6h", "dam_roll_std_6h", "dam_roll_mean_24h", "dam_roll_std_24h", "is_4cp_peak", "year"),
}
# -------------------------------------------------------------------------------------------------
#: columns of the table that are no features of any model
HELPERS = ("pos", "n_events", "zone_view", "zone_click", "zone_signup", "zone_error")


def full_feature_set(df: DataFrame, name: str) -> list[str]:
    """All numeric columns but those that the named model may not see."""
    return numeric_columns(df, drop=[*FEATURE_DROPS[name], *HELPERS])


def feature_set(name: str) -> list[str]:
    return list(FEATURE_SETS[name]["features"])


def numeric_columns(df: DataFrame, drop: Sequence[str] = ()) -> list[str]:
    """P22 / build_X: every numeric column except ``drop``."""
    num = ("double", "float", "integer", "long", "short")
    return [f.name for f in df.schema.fields if f.name not in drop and f.dataType.typeName() in num]


def complete_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where every column is present."""
    return df.na.drop(subset=list(cols))


# ---------------------------------------------------------------------------
# M1, M2, M3, M4: regressors
# ---------------------------------------------------------------------------

def fit_linear(train: DataFrame, features: Sequence[str], label: str,
               prediction: str = "prediction") -> PipelineModel:
    """M1: ordinary least squares (normal equations) on complete rows."""
    asm = VectorAssembler(inputCols=list(features), outputCol="_f")
    lr = LinearRegression(featuresCol="_f", labelCol=label, predictionCol=prediction,
                          solver="normal", regParam=0.0, standardization=False)
    return Pipeline(stages=[asm, lr]).fit(complete_rows(train, [*features, label]))


def linear_coefficients(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    lr = model.stages[-1]
    return [("intercept", float(lr.intercept))] + [(f, float(c)) for f, c in zip(features, lr.coefficients)]


def fit_residual_ensemble(train: DataFrame, features: Sequence[str], label: str, max_iter: int = 30,
                          max_depth: int = 5, step: float = 0.1):
    """M2: OLS, then boosted trees on its residuals; prediction = sum."""
    base = complete_rows(train, [*features, label])
    lin = fit_linear(base, features, label, "_lin")
    res = lin.transform(base).withColumn("_resid", F.col(label) - F.col("_lin"))
    asm = VectorAssembler(inputCols=list(features), outputCol="_f2")
    gbt = GBTRegressor(featuresCol="_f2", labelCol="_resid", predictionCol="_res_pred", maxIter=max_iter,
                       maxDepth=max_depth, stepSize=step, seed=SEED)
    trees = Pipeline(stages=[asm, gbt]).fit(res.drop("_f"))
    return lin, trees


def predict_residual_ensemble(models, df: DataFrame, prediction: str = "prediction") -> DataFrame:
    lin, trees = models
    out = trees.transform(lin.transform(df).drop("_f"))
    return out.withColumn(prediction, F.col("_lin") + F.col("_res_pred")).drop("_lin", "_res_pred", "_f2")


def _gbt_features(train: DataFrame, features: Sequence[str], label: str, fit_on: Column | None = None):
    """Imputer (fitted on the rows of ``fit_on`` alone) and assembler, and the prepared rows."""
    d = with_null_indicators(train.where(F.col(label).isNotNull()), features)
    imp = imputer(features).fit(d if fit_on is None else d.where(fit_on))
    asm = VectorAssembler(inputCols=[f"{c}_imp" for c in features] + [f"{c}_isnull" for c in features], outputCol="_f")
    return [imp, asm], asm.transform(imp.transform(d))


def fit_gbt_regressor(train: DataFrame, features: Sequence[str], label: str,
                      validation_col: str | None = None, max_iter: int = 50, max_depth: int = 5,
                      step: float = 0.1) -> PipelineModel:
    """M3 / M4: boosted trees; imputation + indicators replace native missing
    handling; optional validation rows drive early stopping, and set nothing else."""
    kw = dict(featuresCol="_f", labelCol=label, maxIter=max_iter, maxDepth=max_depth, stepSize=step, seed=SEED)
    if validation_col:
        kw.update(validationIndicatorCol=validation_col, validationTol=0.001)
    stages, rows = _gbt_features(train, features, label, ~F.col(validation_col) if validation_col else None)
    return PipelineModel([*stages, GBTRegressor(**kw).fit(rows)])


def best_iteration(curve: Sequence[float], patience: int) -> int:
    """The number of trees at the least validation error before ``patience`` iterations bring no better one."""
    best = 0
    for i, e in enumerate(curve):
        if e < curve[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def first_trees(model, m: int):
    """The boosted model cut to its first ``m`` trees."""
    from pyspark.ml.regression import GBTRegressionModel
    java = model._java_obj
    gateway = SparkContext._active_spark_context._gateway
    jvm = gateway.jvm
    kind = jvm.org.apache.spark.ml.regression
    trees, weights = java.trees(), java.treeWeights()
    some, share = gateway.new_array(kind.DecisionTreeRegressionModel, m), gateway.new_array(jvm.double, m)
    for i in range(m):
        some[i], share[i] = trees[i], weights[i]
    cut = GBTRegressionModel(kind.GBTRegressionModel(f"{model.uid}_{m}", some, share, model.numFeatures))
    return cut.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


def fit_gbt_early_stop(train: DataFrame, valid: DataFrame, features: Sequence[str], label: str, max_iter: int = 50,
                       max_depth: int = 5, step: float = 0.1, patience: int = 10) -> tuple[PipelineModel, list[float], int]:
    """M4: (model, validation curve, chosen number of trees).

    All ``max_iter`` trees are fitted on the training rows; the curve is the
    mean squared error on the validation rows after each tree, and the
    ensemble is cut where :func:`best_iteration` says."""
    stages, rows = _gbt_features(train, features, label)
    gbt = GBTRegressor(featuresCol="_f", labelCol=label, maxIter=max_iter, maxDepth=max_depth, stepSize=step, seed=SEED).fit(rows)
    held = with_null_indicators(valid.where(F.col(label).isNotNull()), features)
    for s in stages:
        held = s.transform(held)
    curve = [float(e) for e in gbt.evaluateEachIteration(held, "squared")]
    m = best_iteration(curve, patience)
    return PipelineModel([*stages, first_trees(gbt, m)]), curve, m


def importances(model: PipelineModel, scored: DataFrame, base_of: Callable[[str], str] | None = None, features_col: str = "_f") -> list[tuple[str, float]]:
    """[(column, importance)] of a fitted tree ensemble, greatest first; they sum to 1.

    Slots of the feature vector get their names from the ML attributes of
    ``scored`` (rows with the assembled vector); the slots of one column (its
    imputed value and its null flag) are added up."""
    attrs = scored.schema[features_col].metadata["ml_attr"]["attrs"]
    name = {a["idx"]: a["name"] for kind in attrs.values() for a in kind}
    base_of = base_of or (lambda n: n.removesuffix("_imp").removesuffix("_isnull"))
    total: dict[str, float] = {}
    for i, v in enumerate(model.stages[-1].featureImportances.toArray()):
        total[base_of(name[i])] = total.get(base_of(name[i]), 0.0) + float(v)
    return sorted(total.items(), key=lambda x: (-x[1], x[0]))


def predict_with(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    out = model.transform(with_null_indicators(df, features))
    return out.drop(*[f"{c}_isnull" for c in features], *[f"{c}_imp" for c in features], "_f")


def target_offset(train: DataFrame, target: str) -> float:
    """``abs(min(train target)) + 1`` so that log1p is defined."""
    return float(abs(train.agg(F.min(target)).first()[0]) + 1.0)


# ---------------------------------------------------------------------------
# M5, M6, M7: classifiers
# ---------------------------------------------------------------------------

def fit_regime_classifier(train: DataFrame, features: Sequence[str], label: str = "regime",
                          num_trees: int = 30, max_depth: int = 6, weights: dict = CLASS_WEIGHTS) -> PipelineModel:
    """M5: weighted random forest over the four regimes (Spark GBT is binary)."""
    d = with_null_indicators(train.where(F.col(label).isNotNull()), features) \
        .withColumn("_w", class_weight_expr(label, weights))
    idx = StringIndexer(inputCol=label, outputCol="_y", stringOrderType="alphabetAsc", handleInvalid="keep")
    imp = imputer(features)
    asm = VectorAssembler(inputCols=[f"{c}_imp" for c in features] + [f"{c}_isnull" for c in features],
                          outputCol="_f")
    rf = RandomForestClassifier(featuresCol="_f", labelCol="_y", weightCol="_w", numTrees=num_trees,
                                maxDepth=max_depth, seed=SEED)
    return Pipeline(stages=[idx, imp, asm, rf]).fit(d)


def class_probabilities(model: PipelineModel, df: DataFrame, features: Sequence[str],
                        classes: Sequence[str] = REGIME_CLASSES, prefix: str = "p_") -> DataFrame:
    """M10 helper: probability vector -> one column per global class; classes
    the fold model never saw get probability 0; ``pred`` is the argmax."""
    labels = list(model.stages[0].labels)
    out = predict_with(model, df, features)
    arr = vector_to_array(F.col("probability"))
    cols = []
    for c in classes:
        cols.append((arr[labels.index(c)] if c in labels else F.lit(0.0)).alias(f"{prefix}{c}"))
    out = out.select(*[c for c in df.columns], *cols)
    best = F.greatest(*[F.col(f"{prefix}{c}") for c in classes])
    argmax = None
    for c in classes:   # first class wins ties, like numpy argmax
        hit = F.col(f"{prefix}{c}") == best
        argmax = F.when(hit, F.lit(c)) if argmax is None else argmax.when(hit, F.lit(c))
    return out.withColumn("pred", argmax)


def fit_peak_classifier(train: DataFrame, features: Sequence[str], label: str, max_iter: int = 30,
                        max_depth: int = 4) -> PipelineModel:
    """M6: rare-positive binary trees; positives weigh n / positives."""
    n, pos = train.agg(F.count(F.lit(1)), F.sum(label)).first()
    scale = float(int(n / max(pos or 0, 1)))
    d = with_null_indicators(train, features).withColumn(
        "_w", F.when(F.col(label) == 1, F.lit(scale)).otherwise(F.lit(1.0)))
    imp = imputer(features)
    asm = VectorAssembler(inputCols=[f"{c}_imp" for c in features] + [f"{c}_isnull" for c in features],
                          outputCol="_f")
    gbt = GBTClassifier(featuresCol="_f", labelCol=label, weightCol="_w", maxIter=max_iter,
                        maxDepth=max_depth, seed=SEED, subsamplingRate=0.8)
    return Pipeline(stages=[imp, asm, gbt]).fit(d.withColumn(label, F.col(label).cast("double")))


def positive_probability(model: PipelineModel, df: DataFrame, features: Sequence[str], out: str = "p") -> DataFrame:
    p = predict_with(model, df, features)
    return p.select(*df.columns, vector_to_array(F.col("probability"))[1].alias(out))


def baseline_models(train: DataFrame, test: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """M7: logistic regression, random forest and boosted trees on the same
    binary target; precision / recall / F1 of the positive class on test."""
    spark = train.sparkSession
    models = {
        "logistic": LogisticRegression(featuresCol="_f", labelCol=label, maxIter=50),
        "random_forest": RandomForestClassifier(featuresCol="_f", labelCol=label, numTrees=30, seed=SEED),
        "gbt": GBTClassifier(featuresCol="_f", labelCol=label, maxIter=20, seed=SEED),
    }
    tr = complete_rows(train, [*features, label]).withColumn(label, F.col(label).cast("double"))
    te = complete_rows(test, [*features, label]).withColumn(label, F.col(label).cast("double"))
    rows = []
    for name, est in models.items():
        m = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="_f"), est]).fit(tr)
        s = m.transform(te).agg(
            F.count_if((F.col("prediction") == 1) & (F.col(label) == 1)).alias("tp"),
            F.count_if(F.col("prediction") == 1).alias("np"),
            F.count_if(F.col(label) == 1).alias("na")).first()
        prec = s.tp / s.np if s.np else 0.0
        rec = s.tp / s.na if s.na else 0.0
        f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
        rows.append((name, float(prec), float(rec), float(f1), int(s.na)))
    return spark.createDataFrame(rows, "model string, precision double, recall double, f1 double, support long")


# ---------------------------------------------------------------------------
# M8 + M1 (fold Gramians), M10 (out-of-fold), M9 (grid search)
# ---------------------------------------------------------------------------

def ols_by_fold(df: DataFrame, fold: Column, k: int, features: Sequence[str], label: str) -> DataFrame:
    """Expanding-window OLS (``gramian.expanding_ols``): fold, term, coef."""
    out = [(f, t, float(b)) for f, _, _, beta in expanding_ols(df, fold, k, features, label) for t, b in zip(["intercept", *features], beta)]
    return df.sparkSession.createDataFrame(out, "fold int, term string, coef double")


def fold_ols(df: DataFrame, pos_col: str, n: int, k: int, features: Sequence[str], label: str) -> DataFrame:
    """:func:`ols_by_fold` for rows that have positions."""
    return ols_by_fold(df, F.coalesce(test_fold(pos_col, n, k), F.lit(0)), k, features, label)


#: fits that run at a time; Spark shares the executors among their jobs
CONCURRENT_FITS = 4


def concurrently(jobs: Sequence[Callable[[], object]], at_a_time: int = CONCURRENT_FITS) -> list:
    """The results of the jobs in their order; the first error is raised."""
    with ThreadPoolExecutor(max_workers=max(1, min(at_a_time, len(jobs)))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(j)) for j in jobs]]


def oof_predictions(df: DataFrame, k: int, fit: Callable[[DataFrame], PipelineModel],
                    score: Callable[[PipelineModel, DataFrame], DataFrame], fold: str = "fold", at_a_time: int = CONCURRENT_FITS) -> DataFrame:
    """Union of each fold's test-block predictions from a model fitted
    on that fold's training rows only (all earlier folds); rows of fold 0
    always train and get no score.  The folds are fitted concurrently."""
    col = F.col(fold)
    models = concurrently([lambda f=f: fit(df.where(col < f)) for f in range(1, k + 1)], at_a_time)
    out = None
    for f, model in enumerate(models, 1):
        s = score(model, df.where(col == f)).withColumn(fold, F.lit(f))
        out = s if out is None else out.unionByName(s)
    return out


def grid_search(df: DataFrame, k: int, grid: Sequence[dict], fit: Callable[[DataFrame, dict], PipelineModel],
                metric: Callable[[PipelineModel, DataFrame], float], fold: str = "fold", at_a_time: int = CONCURRENT_FITS) -> DataFrame:
    """M9: every parameter set evaluated on every expanding-window fold, as
    concurrent fits over one prepared table; mean metric per set
    (CrossValidator cannot express expanding windows)."""
    col = F.col(fold)
    cells = [(g, f) for g in range(len(grid)) for f in range(1, k + 1)]
    found = concurrently([lambda g=g, f=f: metric(fit(df.where(col < f), grid[g]), df.where(col == f)) for g, f in cells], at_a_time)
    vals = {c: v for c, v in zip(cells, found)}
    rows = []
    for g, params in enumerate(grid):
        own = [vals[g, f] for f in range(1, k + 1)]
        rows.append((g, str(sorted(params.items())), float(np.mean(own)), float(np.min(own))))
    return df.sparkSession.createDataFrame(rows, "grid_id int, params string, mean_metric double, min_metric double")


# ---------------------------------------------------------------------------
# scoring
# ---------------------------------------------------------------------------

def score_complete(model: PipelineModel, df: DataFrame, features: Sequence[str], key_cols: Sequence[str],
                   prediction: str = "prediction") -> DataFrame:
    """Score rows whose features are all present; others keep a NULL
    prediction (left join back on the key)."""
    ok = complete_rows(df, features)
    scored = model.transform(ok).select(*key_cols, F.col("prediction").alias(prediction))
    return df.join(scored, list(key_cols), "left")


def score_windowed(model: PipelineModel, df: DataFrame, features: Sequence[str], mask: Column,
                   key_cols: Sequence[str], out: str = "p") -> DataFrame:
    """Probability only inside the window (e.g. summer afternoons), 0
    elsewhere."""
    inside = positive_probability(model, df.where(mask), features, out).select(*key_cols, out)
    return df.join(inside, list(key_cols), "left").withColumn(out, F.coalesce(F.col(out), F.lit(0.0)))


def predicted_regime(col: str) -> Column:
    return regime(col)
