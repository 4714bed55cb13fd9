"""Metrics (zero denominators, absent classes) and expanding-window folds."""

import pytest
from pyspark.sql import functions as F

from hourglass.operators import folds as FO
from hourglass.operators import metrics as E


def test_fold_bounds_n11_k4():
    assert FO.fold_bounds(11, 4) == [(1, 3, 5), (2, 5, 7), (3, 7, 9), (4, 9, 11)]


def test_assign_folds_roles(spark):
    df = spark.range(11).withColumnRenamed("id", "pos")
    out = FO.assign_folds(df, "pos", 11, 4).groupBy("fold", "role").agg(F.count("*").alias("n")).toPandas()
    got = {(r.fold, r.role): r.n for r in out.itertuples()}
    assert got == {(1, "train"): 3, (1, "test"): 2, (2, "train"): 5, (2, "test"): 2,
                   (3, "train"): 7, (3, "test"): 2, (4, "train"): 9, (4, "test"): 2}


def test_zero_denominator_gives_zero(spark):
    df = spark.createDataFrame([(10.0, 20.0), (30.0, 5.0)], "a double, p double")
    r = E.recall_precision_at(df, "a", "p", [100.0]).first()
    assert (r.n_actual, r.n_pred, r.recall, r.precision) == (0, 0, 0.0, 0.0)


def test_report_absent_class_and_macro_over_union(spark):
    rows = [("A", "A"), ("A", "B"), ("B", "B"), ("C", "B")]
    df = spark.createDataFrame(rows, "y string, p string")
    rep = {r.label: r for r in E.classification_report(df, "y", "p").collect()}
    assert rep["C"].recall == 0.0 and rep["C"].precision == 0.0
    assert rep["A"].recall == 0.5 and rep["B"].precision == pytest.approx(1 / 3)
    assert rep["macro avg"].recall == pytest.approx((0.5 + 1.0 + 0.0) / 3)
    assert rep["accuracy"].f1 == 0.5


def test_threshold_for_recall_chooses_highest_viable(spark):
    rows = [("Scarcity", "Tight", 0.40), ("Scarcity", "Tight", 0.20), ("Tight", "Tight", 0.30),
            ("Normal", "Normal", 0.05)]
    df = spark.createDataFrame(rows, "y string, base string, p double")
    out = E.threshold_for_recall(df, "y", "base", "p", thresholds=[0.1, 0.2, 0.3, 0.4, 0.45],
                                 target_recall=0.5).toPandas()
    assert out[out.is_chosen == 1].threshold.tolist() == [0.4]
    unreachable = E.threshold_for_recall(df, "y", "base", "p", thresholds=[0.1, 0.2, 0.3],
                                         target_recall=1.5).toPandas()
    assert unreachable[unreachable.is_chosen == 1].threshold.tolist() == [0.1]


def test_topk_hit_by_period(spark):
    rows = [(1, 1, 0.9, 0), (1, 2, 0.5, 1), (1, 3, 0.1, 0), (2, 1, 0.2, 1), (2, 2, 0.1, 0)]
    df = spark.createDataFrame(rows, "m int, ts int, p double, peak int")
    got = {r.m: (r.peak_rank, r.top1, r.top3) for r in E.topk_hit_by_period(df, "p", "peak", ["m"]).collect()}
    assert got == {1: (2, 0, 1), 2: (1, 1, 1)}


def test_exact_quantiles_match_pandas(spark):
    import numpy as np
    from hourglass.operators.aggregate import exact_quantiles
    vals = [float(x) for x in np.random.default_rng(1).normal(50, 20, 997)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "v double")
    got = exact_quantiles(df, "v", [0.0, 0.1, 0.5, 0.99, 1.0]).orderBy("q").toPandas()
    import pandas as pd
    exp = pd.Series(vals).quantile([0.0, 0.1, 0.5, 0.99, 1.0]).tolist()
    np.testing.assert_allclose(got.value, exp, rtol=1e-12)


def test_fold_ols_matches_numpy(spark):
    import numpy as np
    from hourglass.operators.models import fold_ols
    rng = np.random.default_rng(3)
    x1, x2 = rng.normal(size=200), rng.normal(size=200)
    y = 2 + 3 * x1 - x2 + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([(int(i), float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x1, x2, y))],
                               "pos long, x1 double, x2 double, y double")
    got = fold_ols(df, "pos", 200, 4, ["x1", "x2"], "y").toPandas()
    for f, lo, _ in FO.fold_bounds(200, 4):
        X = np.c_[np.ones(lo), x1[:lo], x2[:lo]]
        beta = np.linalg.lstsq(X, y[:lo], rcond=None)[0]
        np.testing.assert_allclose(got[got.fold == f].coef.to_numpy(), beta, rtol=1e-8)
