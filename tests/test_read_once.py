"""Tables that several passes read are computed once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourglass.operators import gramian as G
from hourglass.plans import inputs as I
from hourglass.plans import queries_depth as QD
from hourglass.plans import queries_models as QM


def _events(spark, path, n=900):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=47 * i), i % 3, "view", float(i * 37 % 101), f'{{"k": {i * 13 % 89 + 1}}}') for i in range(n)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .write.mode("overwrite").parquet(f"{path}/events.parquet")
    return path


def _counted(spark, df):
    """The rows of ``df``, and a counter of how many were computed."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(run, df.schema), seen


@pytest.mark.parametrize("name", ["oof_scored_rows", "grid_search", "residual_ensemble"])
def test_model_table_is_computed_once(spark, tmpdir_path, monkeypatch, name):
    mt = QM.model_table(spark, _events(spark, tmpdir_path))
    n = mt.count()
    counted, seen = _counted(spark, mt)
    monkeypatch.setattr(QM, "model_table", lambda *_: counted)
    assert QM.__dict__[name](spark, tmpdir_path).count() > 0
    assert seen.value == n


def test_wide_least_squares_reads_the_intervals_once(spark, tmpdir_path, monkeypatch):
    iv = I.intervals(spark, _events(spark, tmpdir_path))
    n = iv.count()
    counted, seen = _counted(spark, iv)
    monkeypatch.setattr(I, "intervals", lambda *_: counted)
    got = QD.wide_fold_ols(spark, tmpdir_path).collect()
    assert [r.fold for r in got] == [1, 2, 3, 4] and all(r.normal_equations_hold for r in got)
    assert seen.value == n


def test_scales_with_nulls_and_a_large_mean(spark):
    rows = [(1e7 + i % 5 * 1e-2, None if i % 3 else float(i), 4.0, None) for i in range(600)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    mean, dev = G.scales(df, ["a", "b", "c", "d"])
    want = df.agg(F.avg("b"), F.stddev_pop("b"), F.stddev_pop("a")).first()
    assert abs(mean[0] - 1e7 - 0.02) < 1e-6 and abs(dev[0] / want[2] - 1) < 1e-5
    assert abs(mean[1] - want[0]) < 1e-9 and abs(dev[1] - want[1]) < 1e-9
    assert list(mean[2:]) == [4.0, 0.0] and list(dev[2:]) == [1.0, 1.0]
    assert list(G.scales(df.where("a < 0"), ["a"])[1]) == [1.0]
