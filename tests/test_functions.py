"""Literal micro-fixtures for clocks, numeric rules and dispatch text."""

import datetime as dt
import math

from pyspark.sql import functions as F

from hourglass.functions import decision as D
from hourglass.functions import numeric as N
from hourglass.functions import time as T


def test_hour_ending_rollover_and_trim(spark):
    df = spark.createDataFrame([("2024-03-09", "24:00"), ("2024-03-09", "01:00"), ("2024-03-09", " 7:00")],
                               "d string, he string")
    got = [r[0] for r in df.select(T.hour_ending_to_ts("d", "he")).collect()]
    assert got == [dt.datetime(2024, 3, 10, 0), dt.datetime(2024, 3, 9, 1), dt.datetime(2024, 3, 9, 7)]


def test_interval_to_ts(spark):
    df = spark.createDataFrame([("2024-01-01", 1, 1), ("2024-01-01", 1, 4), ("2024-01-01", 24, 4)],
                               "d string, h int, i int")
    got = [r[0] for r in df.select(T.interval_to_ts("d", "h", "i")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 45), dt.datetime(2024, 1, 1, 23, 45)]


def test_dst_fall_back_maps_two_utc_hours_to_one_wall_hour(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 11, 3, 6, 30),), (dt.datetime(2024, 11, 3, 7, 30),)],
                               "ts timestamp_ntz")
    got = {r[0] for r in df.select(T.utc_to_market_local("ts")).collect()}
    assert got == {dt.datetime(2024, 11, 3, 1, 30)}


def test_strip_offset_keeps_wall_clock(spark):
    df = spark.createDataFrame([("2025-12-05 00:00:00-06:00",)], "s string")
    assert df.select(T.strip_tz_keep_wall("s")).first()[0] == dt.datetime(2025, 12, 5, 0, 0)
    for text, wall in (("2025-12-05 07:08:09.250125-06:00", dt.datetime(2025, 12, 5, 7, 8, 9, 250125)), ("2025-12-05T07:08:09.5Z", dt.datetime(2025, 12, 5, 7, 8, 9, 500000)), ("2025-12-05", dt.datetime(2025, 12, 5))):
        assert df.select(T.strip_tz_keep_wall(F.lit(text))).first()[0] == wall


def test_calendar_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 15),), (dt.datetime(2024, 1, 7, 3),)], "ts timestamp_ntz")
    cal = T.calendar_columns("ts")
    rows = df.select(cal["day_of_week"], cal["is_weekend"], cal["hour"]).collect()
    assert [tuple(r) for r in rows] == [(0, 0, 15), (6, 1, 3)]


def test_caps_strict_and_null(spark):
    df = spark.createDataFrame([(45000.0,), (45000.1,), (25000.1,), (None,)], "v double")
    got = [r[0] for r in df.select(N.cap_to_null("v", N.CAP_WIND_SYSTEM)).collect()]
    assert got == [45000.0, None, 25000.1, None]


def test_nan_normalised_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (150.0,)], "v double")
    d = df.select(N.nan_to_null("v").alias("v"))
    assert d.where(F.col("v") > 100).count() == 1
    assert d.agg(F.avg("v")).first()[0] == 150.0


def test_regime_right_closed_edges(spark):
    vals = [0.0, -1.0, 3000.0, 3000.01, 5000.0, 10000.0, 10000.01, None]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    got = [r[0] for r in df.select(N.regime("p")).collect()]
    assert got == [None, None, "Scarcity", "Tight", "Tight", "Normal", "Surplus", None]


def test_price_tier(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (40.0,), (40.5,), (100.0,), (100.01,)], "p double")
    got = [r[0] for r in df.select(N.price_tier("p")).collect()]
    assert got == ["negative", "low", "low", "medium", "medium", "high"]


def test_zero_load_ratio_is_null(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(N.safe_ratio("a", "b")).collect()] == [None, 2.5]


def test_coalesce_total_needs_every_zone(spark):
    df = spark.createDataFrame([(1.0, None, 2.0, 3.0, 99.0), (1.0, 2.0, 3.0, 4.0, 99.0), (None, None, None, None, 7.0)],
                               "a double, b double, c double, d double, t double")
    got = [r[0] for r in df.select(N.coalesce_total(["a", "b", "c", "d"], "t")).collect()]
    assert got == [99.0, 10.0, 7.0]


def test_dispatch_edges(spark):
    rows = [(2999.0, None), (3000.0, None), (6749.0, 10.0), (6750.0, 40.0), (6750.0, 40.01), (5000.0, 41.0),
            (None, None)]
    df = spark.createDataFrame(rows, "p double, price double")
    got = [r[0] for r in df.select(D.dispatch_action("p", "price", 6750.0, 40.0)).collect()]
    assert got == [D.ACTION_CURTAIL, D.ACTION_REDUCE_PRC, D.ACTION_REDUCE_PRC, D.ACTION_OPERATE,
                   D.ACTION_REDUCE_PRICE, D.ACTION_REDUCE_BOTH, D.ACTION_OPERATE]


def test_advisory_text(spark):
    rows = [(2000.0, 150.5, 101.5), (9000.0, 50.0, 100.0), (6000.0, 100.5, 120.0)]
    df = spark.createDataFrame(rows, "p double, rt double, dam double")
    got = [r[0] for r in df.select(D.advisory_24h("p", "rt", "dam", 6500.0)).collect()]
    assert got[0] == ("ELEVATED RISK — PRC scarcity expected, DAM high ($102), RT may exceed $150. "
                      "Pre-position flexible load.")
    assert got[1] == "LOW RISK — standard scheduling"
    assert got[2] == "ELEVATED RISK — PRC tight expected, DAM high ($120), RT may exceed $100. Pre-position flexible load."


def test_log1p_offset_roundtrip(spark):
    df = spark.createDataFrame([(-5.0,), (0.0,), (1000.0,)], "x double")
    off = 6.0
    got = [r[0] for r in df.select(N.expm1_offset(N.log1p_offset("x", off), off)).collect()]
    assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(got, [-5.0, 0.0, 1000.0]))
