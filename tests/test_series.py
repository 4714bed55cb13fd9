"""Positional series operators: micro-fixtures for pandas semantics and
halo / carry equivalence with global windows (the skew-safe plans must
equal the naive single-partition answer)."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hourglass.operators import series as S


def _df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_positions_dense_per_series_with_hot_key(spark):
    # one series holds most rows; positions must still be 0..n-1 per series
    rows = [(1 if i % 10 else 2, i, float(i)) for i in range(3000)]
    rows += [(None, i, 1.0) for i in range(5)]   # NULL series key
    df = _df(spark, rows, "s long, t long, v double")
    out = S.with_position(df, ["t"], ["s"], num_blocks=16).toPandas()
    for key, g in out.groupby(out.s.fillna(-1)):
        g = g.sort_values("t")
        assert list(g.pos) == list(range(len(g))), key


def test_position_global_many_blocks(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("t"))
    out = S.with_position(df, ["t"], None, num_blocks=37).toPandas().sort_values("t")
    assert list(out.pos) == list(range(5000))


def test_numeric_blocks_follow_the_order_beyond_the_sketch(spark, monkeypatch):
    # few quantiles, many even cuts between them; nulls come first, NaN last
    monkeypatch.setattr(S, "SKETCH_BOUNDS", 5)
    rng = random.Random(3)
    vals = [rng.lognormvariate(0, 4) * rng.choice((-1, 1)) for _ in range(2000)] + [0.0] * 900
    rows = [(v, i) for i, v in enumerate([*vals, None, float("nan"), float("inf"), float("-inf")])]
    df = _df(spark, rows, "v double, i long")
    got = S.order_blocks(df, "v", 64).toPandas().sort_values("i")
    by = got.loc[[i for _, i in sorted((v, i) for i, v in enumerate(vals))], "_hg_blk"]
    assert by.is_monotonic_increasing and by.nunique() > 20
    pos = S.with_position(df, ["v", "i"], None, num_blocks=64).orderBy("pos").toPandas()
    assert list(pos.pos) == list(range(len(rows)))
    assert list(pos.i) == [r.i for r in df.orderBy("v", "i").collect()]


def test_time_blocks_with_two_level_offsets(spark):
    import datetime as dt
    t0 = dt.datetime(1969, 12, 30)      # blocks below and above zero, many spans of 1024
    rows = [(t0 + dt.timedelta(seconds=(i * 7919) % 4000 * 3600), i) for i in range(3000)] + [(None, -1)]
    df = _df(spark, rows, "ts timestamp_ntz, i long")
    pos = S.with_position(df, ["ts", "i"], None).orderBy("pos").toPandas()
    assert list(pos.pos) == list(range(len(rows)))
    assert list(pos.i) == [r.i for r in df.orderBy("ts", "i").collect()]


@pytest.mark.parametrize("series", [[], ["s"]])
def test_a_long_hourly_series_gives_a_small_table_of_blocks(spark, series):
    n = 200_000
    df = spark.range(n).select(F.expr("TIMESTAMP_NTZ '1990-01-01 00:00:00' + make_dt_interval(0, cast(id as int))").alias("ts"),
                               F.when(F.col("id") % 1000 == 1, None).otherwise(F.lit("hot")).alias("s"), "id")
    keyed, skey = S.series_keys(df, series)
    blocked, total, cut = S.series_blocks(keyed, "ts", skey)
    assert cut and total == n
    blocks = blocked.where("_hg_blk IS NOT NULL").groupBy(*skey, "_hg_blk").count()
    sizes = [r["count"] for r in blocks.collect()]
    assert len(sizes) <= 64 and max(sizes) <= S.SERIES_ROWS          # 16 blocks are aimed at; one row per hour before
    assert blocked.where("_hg_blk IS NULL").count() == (200 if series else 0)      # the short series stays whole
    out = S.with_position(df, ["ts"], series, "pos")
    want = F.when(F.col("id") % 1000 == 1, F.expr("id div 1000")).otherwise(F.expr("id - (id + 998) div 1000")) if series else F.col("id")
    assert out.count() == n and out.where(F.col("pos") != want).count() == 0


def test_uneven_series_are_cut_by_their_own_quantiles(spark, monkeypatch):
    monkeypatch.setattr(S, "SERIES_ROWS", 400)
    monkeypatch.setattr(S, "BLOCK_ROWS", 50)
    rng = random.Random(4)
    rows = [(s, rng.lognormvariate(0, 3) if s else rng.uniform(0, 1), i) for i, s in enumerate(rng.choices((0, 1, 2, None), (50, 40, 1, 9), k=6000))]
    df = _df(spark, rows, "s int, v double, i long")
    keyed, skey = S.series_keys(df, ["s"])
    blocked, _, cut = S.series_blocks(keyed, "v", skey)
    sizes = blocked.where("_hg_blk IS NOT NULL").groupBy("s", "_hg_blk").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert cut and sizes[0] <= 400 and sizes[1] <= 2 * 6000 / 50 + 4 * S.SERIES_BOUNDS
    want = {}
    for s in (0, 1, 2, None):
        for p, (_, i) in enumerate(sorted((v, i) for s_, v, i in rows if s_ == s)):
            want[i] = p
    assert {r.i: r.pos for r in S.with_position(df, ["v", "i"], ["s"], "pos").collect()} == want


def test_scans_of_two_levels(spark, monkeypatch):
    monkeypatch.setattr(S, "SPAN", 3)
    monkeypatch.setattr(S, "SERIES_ROWS", 20)
    monkeypatch.setattr(S, "BLOCK_ROWS", 2)
    rng = random.Random(8)
    rows = [(s, i, rng.uniform(0, 9) if rng.random() < 0.2 else None) for s in ("a", None) for i in range(150)]
    df = _df(spark, rows, "s string, t long, v double")
    p = S.with_position(df, ["t"], ["s"], "pos")
    assert all(r.pos == r.t for r in p.collect())
    out = S.fill_forward_backward(p, ["v"], ["s"], "pos", bucket_size=4).toPandas()
    lin = S.interpolate_linear(p, ["v"], ["s"], "pos", bucket_size=4).toPandas()
    for key in ("a", None):
        own = pd.Series([v for s, _, v in rows if s == key], dtype=float)
        pick = lambda d: (d[d.s == key] if key else d[d.s.isna()]).sort_values("t").v.astype(float).tolist()
        assert pick(out) == own.ffill().bfill().tolist()
        np.testing.assert_allclose(pick(lin), own.interpolate())
    from hourglass.operators import joins as J
    left = _df(spark, [(s, 10 * i, i) for s in ("a", None) for i in range(60)], "s string, t long, lid long")
    right = _df(spark, [(s, rng.randrange(600), i, float(i)) for s in ("a", None) for i in range(50)], "s string, t long, rid long, x double")
    got = {(r.s, r.t): r.x for r in J.asof_backward(left, right, "t", ["s"], ["x"], "lid", "rid").collect()}
    for (s, t), x in got.items():
        best = max(((r.t, r.rid, r.x) for r in right.collect() if r.s == s and r.t <= t), default=(None, None, None))
        assert x == best[2]


def test_quantiles_of_many_columns_at_once(spark, monkeypatch):
    from hourglass.operators import quantiles as Q
    rng = random.Random(2)
    n = 3000
    cols = {"uniform": [rng.random() for _ in range(n)], "heavy": [math.exp(rng.uniform(-600, 600)) for _ in range(n)],
            "ties": [float(rng.choice((0, 0, 0, 1, 7))) for _ in range(n)], "one": [5.0] * n, "none": [None] * n,
            "few": [float(i) if i < 3 else None for i in range(n)], "edges": [float("inf") if i < 5 else float("-inf") if i < 9 else -0.5 * i for i in range(n)],
            "ints": [rng.randrange(-5, 40) for _ in range(n)]}
    names = list(cols)
    df = _df(spark, list(zip(*cols.values())), ", ".join(f"{c} {'long' if c == 'ints' else 'double'}" for c in names))
    probs = [0.0, 0.01, 0.25, 0.5, 0.77, 0.999, 1.0]
    for accuracy, few in ((Q.ACCURACY, Q.FEW), (40, 5)):              # rough sketches need more passes
        monkeypatch.setattr(Q, "ACCURACY", accuracy)
        monkeypatch.setattr(Q, "FEW", few)
        got = Q.column_quantiles(df, names, probs)
        for c, v in cols.items():
            v = [x for x in v if x is not None]
            assert got[c]["count"] == len(v)
            if not v:
                assert got[c]["q"] == [None] * len(probs)
                continue
            s = sorted(v)
            want = [s[int((len(s) - 1) * p)] + ((s[min(int((len(s) - 1) * p) + 1, len(s) - 1)] - s[int((len(s) - 1) * p)]) * ((len(s) - 1) * p - int((len(s) - 1) * p))
                                                if s[min(int((len(s) - 1) * p) + 1, len(s) - 1)] != s[int((len(s) - 1) * p)] else 0) for p in probs]
            np.testing.assert_allclose(got[c]["q"], want, rtol=1e-12)


def test_quantiles_with_one_frequent_value(spark):
    from hourglass.operators.aggregate import exact_quantiles
    vals = [0.0] * 4000 + [float(i) ** 1.5 for i in range(1, 1001)]
    df = _df(spark, [(v,) for v in vals] + [(None,)], "v double")
    probs = [0.0, 0.25, 0.79, 0.8, 0.81, 0.999, 1.0]
    got = {r.q: r.value for r in exact_quantiles(df, "v", probs).collect()}
    np.testing.assert_allclose([got[q] for q in probs], np.quantile(vals, probs), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("bucket", [1, 3, 7, 50, 100000])
def test_halo_equals_global_windows(spark, bucket):
    rng = random.Random(7)
    rows = []
    for s in range(4):
        for t in range(60 if s else 400):   # series 0 is hot
            v = None if rng.random() < 0.15 else rng.uniform(-5, 150)
            rows.append((s, t, v))
    df = _df(spark, rows, "s long, t long, v double")
    specs = [S.Lag("v", 1, "l1"), S.Lag("v", 24, "l24"), S.Rolling("v", 6, "mean", "m6"),
             S.Rolling("v", 6, "std", "s6"), S.Rolling("v", 3, "max", "x3"), S.Diff("v", "d1"),
             S.LagAbove("v", 100.0, "sp"), S.TrailingMean("v", 3, "tm3")]
    out = S.add_series_features(df, specs, ["t"], ["s"], bucket_size=bucket).toPandas()
    pdf = pd.DataFrame(rows, columns=["s", "t", "v"]).sort_values(["s", "t"])
    g = pdf.groupby("s")["v"]
    exp = pdf.assign(l1=g.shift(1), l24=g.shift(24),
                     m6=g.transform(lambda x: x.shift(1).rolling(6).mean()),
                     s6=g.transform(lambda x: x.shift(1).rolling(6).std()),
                     x3=g.transform(lambda x: x.shift(1).rolling(3).max()),
                     d1=g.diff(), sp=g.transform(lambda x: (x.shift(1) > 100).astype(int)),
                     tm3=g.transform(lambda x: x.shift(1).rolling(3, min_periods=1).mean()))
    got = out.sort_values(["s", "t"]).reset_index(drop=True)
    exp = exp.reset_index(drop=True)
    for c in ["l1", "l24", "m6", "s6", "x3", "d1", "sp", "tm3"]:
        np.testing.assert_allclose(got[c].astype(float).fillna(-1e9), exp[c].astype(float).fillna(-1e9),
                                   rtol=1e-9, atol=1e-9, err_msg=c)


def test_roll_guard_null_in_frame(spark):
    vals = [1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]
    df = _df(spark, [(i, v) for i, v in enumerate(vals)], "t long, v double")
    out = S.add_series_features(df, [S.Rolling("v", 3, "mean", "m")], ["t"]).orderBy("t").toPandas()
    exp = pd.Series(vals).shift(1).rolling(3).mean()
    assert out.m.isna().tolist() == exp.isna().tolist()
    np.testing.assert_allclose(out.m.dropna(), exp.dropna())


def test_positional_gap_shift_skips_dropped_row(spark):
    df = _df(spark, [(0, 1.0), (1, 2.0), (2, None), (3, 4.0), (4, 5.0)], "t long, v double")
    kept = df.na.drop(subset=["v"])
    out = S.add_series_features(kept, [S.Lag("v", 1, "l")], ["t"]).orderBy("t").toPandas()
    assert out.l.tolist()[1:] == [1.0, 2.0, 4.0]


def test_spike_flag_first_row_is_zero(spark):
    df = _df(spark, [(0, 500.0), (1, 50.0), (2, 10.0)], "t long, v double")
    out = S.add_series_features(df, [S.LagAbove("v", 100.0, "f")], ["t"]).orderBy("t").toPandas()
    assert out.f.tolist() == [0, 1, 0]


def test_month_turn_running_max_sees_previous_month(spark):
    rows = [(0, 2024, 1, 5.0), (1, 2024, 1, 9.0), (2, 2024, 1, 7.0), (3, 2024, 2, 1.0), (4, 2024, 2, 3.0),
            (5, 2024, 2, None), (6, 2024, 2, 2.0)]
    df = _df(spark, rows, "t long, y int, m int, v double")
    for bucket in (2, 100):
        p = S.with_position(df, ["t"], None, "pos")
        out = S.running_period_max(p, "v", ["y", "m"], "rm", None, "pos", bucket_size=bucket) \
            .orderBy("t").toPandas()
        pdf = pd.DataFrame(rows, columns=["t", "y", "m", "v"])
        exp = pdf.groupby(["y", "m"])["v"].cummax().shift(1)
        assert out.rm.fillna(-1).tolist() == exp.fillna(-1).tolist()


@pytest.mark.parametrize("bucket", [2, 3, 1000])
def test_fill_across_buckets(spark, bucket):
    vals = [None, None, 3.0, None, None, None, None, 8.0, None, None]
    df = _df(spark, [(i, v) for i, v in enumerate(vals)], "t long, v double")
    p = S.with_position(df, ["t"], None, "pos")
    ff = S.fill_forward_backward(p, ["v"], None, "pos", bucket_size=bucket).orderBy("t").toPandas()
    assert ff.v.tolist() == pd.Series(vals).ffill().bfill().tolist()
    f_only = S.fill_forward_backward(p, ["v"], None, "pos", backward=False, bucket_size=bucket) \
        .orderBy("t").toPandas()
    assert f_only.v.fillna(-1).tolist() == pd.Series(vals).ffill().fillna(-1).tolist()


@pytest.mark.parametrize("bucket", [2, 1000])
def test_interpolate_linear(spark, bucket):
    vals = [None, 2.0, None, None, -4.0, None, 10.0, None, None]
    df = _df(spark, [(i, v) for i, v in enumerate(vals)], "t long, v double")
    p = S.with_position(df, ["t"], None, "pos")
    out = S.interpolate_linear(p, ["v"], None, "pos", bucket_size=bucket).orderBy("t").toPandas()
    exp = pd.Series(vals).interpolate()
    assert math.isnan(out.v[0]) and math.isnan(exp[0])
    np.testing.assert_allclose(out.v[1:], exp[1:])


def test_row_order_and_partitioning_invariance(spark):
    rows = [(i % 3, i, float((i * 37) % 101)) for i in range(600)]
    df = _df(spark, rows, "s long, t long, v double")
    specs = [S.Lag("v", 5, "l5"), S.Rolling("v", 4, "mean", "m4")]
    a = S.add_series_features(df, specs, ["t"], ["s"], bucket_size=11).toPandas().sort_values(["s", "t"])
    shuffled = df.orderBy(F.rand(3)).repartition(13)
    b = S.add_series_features(shuffled, specs, ["t"], ["s"], bucket_size=29).toPandas().sort_values(["s", "t"])
    pd.testing.assert_frame_equal(a.reset_index(drop=True), b.reset_index(drop=True))


def test_positions_and_truncation_ignore_session_time_zone(spark):
    import datetime as dt
    from hourglass.functions.time import floor_hour
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        rows = [(dt.datetime(2024, 3, 10, 0, 0) + dt.timedelta(minutes=10 * i),) for i in range(60)]
        df = spark.createDataFrame(rows, "ts timestamp_ntz")
        out = S.with_position(df, ["ts"], None, num_blocks=16).orderBy("ts").toPandas()
        assert list(out.pos) == list(range(60))       # across the 02:00-03:00 spring-forward gap
        hrs = [r[0] for r in df.select(floor_hour("ts")).orderBy("ts").collect()]
        assert hrs[15] == dt.datetime(2024, 3, 10, 2, 0)   # 02:30 wall clock stays in hour 02
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_time_lags_follow_the_clock_not_rows(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", t0, 1.0), ("a", t0 + dt.timedelta(hours=1), 2.0), ("a", t0 + dt.timedelta(hours=3), 4.0),
            ("b", t0 + dt.timedelta(hours=2), 9.0)]
    df = spark.createDataFrame(rows, "s string, ts timestamp_ntz, v double")
    got = {(r.s, r.ts.hour): r.v_1h_ago for r in S.time_lags(df, "ts", [("v", 1)], ["s"]).collect()}
    assert got == {("a", 0): None, ("a", 1): 1.0, ("a", 3): None, ("b", 2): None}


def test_model_ready_table(spark):
    from hourglass.plans import inputs as I
    from hourglass.plans.model_ready import model_ready
    h = I.hourly(spark, "/root/testdata/sf0.01")
    out = model_ready(h).toPandas().sort_values("ts")
    kept = h.na.drop(subset=["prc", "wind"]).count()
    assert len(out) == kept - 168                          # warm-up rows dropped after the row drops
    assert out.pos.min() == 168 and out.rt_168h_lag.notna().all()
    assert out.rt.notna().all()                            # prices were filled
    assert set(out.regime.dropna()) <= {"Scarcity", "Tight", "Normal", "Surplus"}
    assert len(out.columns) > 70
