"""Wide least squares, leaks, early stop, importances, folds without positions."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.operators import folds as FO
from hourglass.operators import gramian as G
from hourglass.operators import models as M
from hourglass.operators import series as S


def _wide(seed, n, p):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, p)) * 10.0 ** r.integers(-3, 4, p) + 10.0 ** r.integers(0, 5, p)
    y = x @ r.standard_normal(p) + r.standard_normal(n)
    return x, y


def _frame(spark, x, y, **more):
    cols = [f"c{i}" for i in range(x.shape[1])]
    rows = [(*map(float, row), float(v), *(m[i] for m in more.values())) for i, (row, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, [*cols, "y", *more]), cols


def test_wide_ols_equals_least_squares_and_takes_the_least_norm(spark):
    n, p = 900, 71
    x, y = _wide(1, n, p)
    x[:, 70] = 3 * x[:, 0] - x[:, 1]                                  # a dependent column
    x[:, 69] = 4.0                                                    # a constant one
    df, cols = _frame(spark, x, y, fold=[0 if i < 100 else 1 + (i - 100) // 200 for i in range(n)])
    got = G.expanding_ols(df.repartition(7), F.col("fold"), 4, cols, "y")
    for f, rows, rank, beta in got:
        m = 100 + 200 * (f - 1)
        assert rows == m and rank == min(69, m - 1)
        mean, dev = x.mean(axis=0), np.where(x.std(axis=0) > 0, x.std(axis=0), 1)
        z = (x[:m] - mean) / dev
        zc = z - z.mean(axis=0)
        want = np.linalg.pinv(zc, rcond=1e-7) @ (y[:m] - y[:m].mean())
        np.testing.assert_allclose(beta[1:] * dev, want, rtol=1e-4, atol=1e-5 * np.abs(want).max())
        fitted = x[:m] @ beta[1:] + beta[0]
        best = zc @ want + y[:m].mean()
        np.testing.assert_allclose(fitted, best, atol=1e-4 * np.abs(y).max())


def test_leaks_are_found_and_nothing_else(spark):
    n = 400
    x, _ = _wide(2, n, 8)
    y = x[:, 0] / 3 - 2 * x[:, 4]
    x[:, 6] = y - x[:, 1]                                             # y = c6 + c1
    df, cols = _frame(spark, x, y)
    found = {r.features for r in G.feature_leaks(df, cols, "y").collect()}
    assert found == {"c0 + c4", "c1 + c6"}
    noisy = df.withColumn("y", F.col("y") + F.rand(3) * 0.01 * F.abs(F.col("y")))
    assert G.feature_leaks(noisy, cols, "y").count() == 0
    assert G.feature_leaks(df.limit(6), cols, "y").count() == 0       # too few rows to tell
    assert G.feature_leaks(df.where("c0 IS NULL"), cols, "y").count() == 0


@pytest.mark.parametrize("limit", [100_000, 50])
def test_folds_without_positions(spark, monkeypatch, limit):
    monkeypatch.setattr(S, "SERIES_ROWS", limit)
    monkeypatch.setattr(S, "BLOCK_ROWS", 7)
    r = random.Random(3)
    t0 = dt.datetime(2024, 3, 9)
    rows = [(t0 + dt.timedelta(minutes=r.randrange(5000)) if r.random() < 0.95 else None, i, r.choice([0.1, 1 / 3, -7.0])) for i in range(1003)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, id long, v double")
    got, n = FO.time_folds(df, ["ts", "v", "id"], 4)
    assert n == len(rows)
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or t0, x[2], x[1]))
    size = n // 5
    want = {x[1]: max(0, (p - (n - 4 * size)) // size + 1) if p >= n - 4 * size else 0 for p, x in enumerate(order)}
    assert {x.id: x.fold for x in got.collect()} == want


def test_best_iteration():
    assert M.best_iteration([5, 4, 3, 3.5, 3.4, 2.0], 2) == 3
    assert M.best_iteration([5, 4, 3, 3.5, 3.4, 2.0], 3) == 6
    assert M.best_iteration([1.0], 1) == 1


def test_early_stop_cuts_the_ensemble(spark):
    r = np.random.default_rng(5)
    x = r.standard_normal((600, 3))
    y = x[:, 0] + r.standard_normal(600) * 2                          # mostly noise: more trees overfit
    df, cols = _frame(spark, x, y, i=list(range(600)))
    train, valid = df.where("i < 300"), df.where("i >= 300")
    model, curve, m = M.fit_gbt_early_stop(train, valid, cols, "y", max_iter=25, max_depth=4, step=0.3, patience=4)
    assert len(curve) == 25 and m == M.best_iteration(curve, 4) < 25
    assert model.stages[-1].getNumTrees == m
    mse = M.predict_with(model, valid, cols).agg(F.avg((F.col("prediction") - F.col("y")) ** 2)).first()[0]
    assert abs(mse - curve[m - 1]) < 1e-9


def test_imputer_sees_training_rows_only(spark):
    rows = [(float(i % 5), float(i), False) for i in range(50)] + [(1000.0, 1.0, True)] * 5 + [(None, 2.0, False)]
    df = spark.createDataFrame(rows, "a double, y double, is_val boolean")
    model = M.fit_gbt_regressor(df, ["a"], "y", validation_col="is_val", max_iter=2)
    assert model.stages[0].surrogateDF.first()[0] == 2.0


def test_importances_by_column(spark):
    r = random.Random(6)
    rows = [(v, r.random() if r.random() < 0.8 else None, r.random(), "Scarcity" if v < 0.3 else "Normal") for v in (r.random() for _ in range(400))]
    df = spark.createDataFrame(rows, "a double, b double, c double, regime string")
    feats = ["a", "b", "c"]
    model = M.fit_regime_classifier(df, feats, num_trees=5)
    got = M.importances(model, model.transform(M.with_null_indicators(df, feats)))
    assert {c for c, _ in got} == set(feats) and abs(sum(v for _, v in got) - 1) < 1e-9
    assert got[0][0] == "a" and [v for _, v in got] == sorted((v for _, v in got), reverse=True)


def test_concurrent_fits_give_what_a_loop_gives(spark):
    r = random.Random(7)
    rows = [(i, r.random(), r.choice(["Scarcity", "Normal"]), i // 60) for i in range(300)]
    df = spark.createDataFrame(rows, "i long, a double, regime string, fold int")

    def fit(tr, p):
        return M.fit_regime_classifier(tr, ["a"], **p)

    def metric(m, te):
        return float(M.class_probabilities(m, te, ["a"]).where("pred = regime").count())

    grid = [{"num_trees": 3}, {"num_trees": 5, "max_depth": 2}]
    a, b = (M.grid_search(df, 4, grid, fit, metric, at_a_time=k).collect() for k in (1, 4))
    assert a == b
    with pytest.raises(ValueError, match="stop"):
        M.concurrently([lambda: 1, lambda: (_ for _ in ()).throw(ValueError("stop"))])
