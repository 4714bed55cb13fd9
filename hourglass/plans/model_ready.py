"""The model-ready feature table in one call (the reference's feature step),
composed from the series / function operators and generalised to any number
of series.

Order matters and is kept: quality fixes and row drops happen first, so every
lag counts surviving rows; all positional features share one halo stage; the
warm-up rows are dropped last.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import time as T
from ..operators import dedup as DD
from ..operators import series as S

WARMUP_ROWS = 168


def model_ready(df: DataFrame, ts: str = "ts", series_cols: Sequence[str] = (), price: str = "rt",
                dam: str = "dam", prc: str = "prc", load: str = "load_total", hub_load: str = "hub_load",
                wind: str = "wind", wind_cap: float = N.CAP_WIND_WEST, era_cutoff: str = "2025-12-05",
                start: str = "2021-01-01", warmup: int = WARMUP_ROWS, source_rank: str | None = None,
                feeds: dict[str, str] | None = None) -> DataFrame:
    """The feature table.

    ``source_rank`` names a column: of the rows of one (series, ts) the one with
    the least rank stays (the first source wins) and the column is dropped.
    ``feeds`` names the columns of further feeds (:data:`FEEDS`); the features
    of each one that is given are added.
    """
    series = list(series_cols)
    feed = dict(feeds or {})
    if unknown := set(feed) - set(FEEDS):
        raise ValueError(f"unknown feeds: {sorted(unknown)}")
    # quality: one row per (series, ts), capped outliers, filled prices/loads,
    # rows without PRC or wind dropped, spread recomputed
    # duplicates are told apart by all other columns, so reruns keep the same row
    rest = [c for c, kind in df.dtypes if c not in (*series, ts, source_rank) and not kind.startswith("map")]
    order = [source_rank, *rest] if source_rank else rest
    d = DD.keep_first(df, [*series, ts], order or [ts])
    d = d.drop(source_rank) if source_rank else d
    d = d.withColumn(wind, N.cap_to_null(wind, wind_cap))
    for name, cap in (("solar", N.CAP_SOLAR_SYSTEM), ("wind_system", N.CAP_WIND_SYSTEM)):
        if name in feed:
            d = d.withColumn(feed[name], N.cap_to_null(feed[name], cap))
    d = S.with_position(d, [ts], series, "_p0")
    filled = [price, dam, hub_load, load] + [feed[x] for x in ("solar_capacity",) if x in feed]
    d = S.fill_forward_backward(d, filled, series, "_p0").drop("_p0")
    d = d.na.drop(subset=[prc, wind] + [feed[x] for x in ("solar",) if x in feed]).withColumn("spread", F.col(price) - F.col(dam))
    if "dam_system" in feed:
        d = d.withColumn("dam_congestion_spread", F.col(dam) - F.col(feed["dam_system"]))
    # calendar
    cal = T.calendar_columns(ts)
    cyc = T.cyclic_hour(F.hour(ts))
    d = d.select("*", *[cal[k].alias(k) for k in ("hour", "day_of_week", "month", "is_weekend", "year")],
                 cyc["hour_sin"].alias("hour_sin"), cyc["hour_cos"].alias("hour_cos"),
                 T.era_flag(ts, era_cutoff).alias("is_pre_rtcb"), T.days_since(ts, start).alias("days_since_start"))
    # positions after the drops; running monthly peak (shifted over the series)
    d = S.with_position(d, [ts], series, "pos")
    d = S.running_period_max(d, load, ["year", "month"], "monthly_load_max", series, "pos")
    # every positional feature in one halo stage
    specs = [S.Lag(price, k, f"{price}_{k}h_lag") for k in (1, 24, 168)]
    specs += [S.Lag(dam, k, f"{dam}_{k}h_lag") for k in (1, 24, 168)]
    specs += [S.Lag(prc, k, f"{prc}_{k}h_lag") for k in (1, 24, 168)]
    specs += [S.Lag(hub_load, 24, f"{hub_load}_24h_lag"), S.Lag(load, 24, f"{load}_24h_lag"),
              S.Lag(wind, 24, f"{wind}_24h_lag"), S.Lag(wind, 168, f"{wind}_168h_lag"),
              S.Lag("spread", 1, "spread_1h_lag"), S.LagAbove(price, 100.0, "price_spike_lag"),
              S.Rolling(prc, 6, "mean", f"{prc}_roll_mean_6h"), S.Rolling(prc, 6, "std", f"{prc}_roll_std_6h"),
              S.Rolling(prc, 24, "mean", f"{prc}_roll_mean_24h")]
    for c in (price, dam, hub_load, load, wind):
        for n in (6, 24):
            specs += [S.Rolling(c, n, "mean", f"{c}_roll_mean_{n}h"), S.Rolling(c, n, "std", f"{c}_roll_std_{n}h")]
    specs += [S.Diff(c, f"{c}_ramp") for c in (load, hub_load, wind, price)]
    if "wind_system" in feed:
        specs.append(S.Diff(feed["wind_system"], "wind_system_ramp"))
    if "temperature" in feed:
        specs.append(S.Rolling(feed["temperature"], 3, "max", "temp_roll_3h_max"))
    d = S.halo_windows(d, specs, series, "pos")
    # engineered ratios and peak-season features
    d = d.select("*",
                 (F.col(load) - F.col(wind)).alias("net_load"),
                 N.safe_ratio(wind, load).alias("renewable_pct"),
                 N.safe_ratio(wind, hub_load).alias("wind_load_ratio"),
                 T.in_season("month").alias("is_4cp_season"),
                 (T.in_season("month") * T.in_hour_window("hour")).alias("is_4cp_window"),
                 N.safe_ratio(load, "monthly_load_max").alias("load_vs_monthly_max"),
                 (F.col(load) - F.col("monthly_load_max")).alias("load_above_monthly_max"),
                 N.regime(prc).alias("regime"), *_feed_features(feed, hub_load, load, wind))
    return S.position_filter(d, warmup, "pos")


#: what ``feeds`` may name
FEEDS = ("wind_forecast", "wind_system", "solar", "solar_forecast", "solar_capacity", "load_forecast", "dam_system", "temperature",
         "adder_reserve", "adder_offline", "adder_reliability")


def _feed_features(feed: dict[str, str], hub_load: str, load: str, wind: str) -> list:
    """Forecast errors, net loads, renewable shares, compressed adders and the forecast against the running peak."""
    has = lambda *names: all(n in feed for n in names)
    col = lambda name: F.col(feed[name])
    out = [(F.col(hub_load) - F.col(wind)).alias("net_load_west")] if feed else []
    if has("wind_forecast"):
        out.append((F.col(wind) - col("wind_forecast")).alias("wind_forecast_error"))
    if has("solar", "solar_forecast"):
        out.append((col("solar") - col("solar_forecast")).alias("solar_forecast_error"))
    if has("wind_system", "solar"):
        out.append((F.col(load) - col("wind_system") - col("solar")).alias("net_load_system"))
        out.append(N.safe_ratio(col("wind_system") + col("solar"), load).alias("renewable_pct_system"))
    if has("load_forecast"):
        out.append(N.safe_ratio(feed["load_forecast"], "monthly_load_max").alias("load_fcst_vs_monthly_max"))
    out += [F.log1p(col(a)).alias(f"{a}_log1p") for a in ("adder_reserve", "adder_offline", "adder_reliability") if has(a)]
    return out
