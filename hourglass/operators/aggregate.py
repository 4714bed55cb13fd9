"""Resampling and profiling aggregates.

All are single-pass declarative aggregates (partial + final) except the
exact quantiles, which take a few (``quantiles.py``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import time as T
from .quantiles import column_quantiles
from .series import Diff, _cols, halo_windows, running_period_max, with_position


def resample(df: DataFrame, ts_col: str, value_cols: Sequence[str], how: str = "mean",
             series_cols=None, unit: str = "hour", out_ts: str = "ts") -> DataFrame:
    """A1 / A2: sub-hourly -> hourly (``mean`` or ``min``); partial
    aggregation also fixes files that split an hour."""
    fn = {"mean": F.avg, "min": F.min, "max": F.max, "sum": F.sum}[how]
    g = T.trunc_ntz(ts_col, unit).alias(out_ts)
    return df.groupBy(*_cols(series_cols), g).agg(*[fn(c).alias(c) for c in value_cols])


def group_profile(df: DataFrame, key: Column, value: str, alias: str = "mean_value",
                  exclude: Column | None = None) -> DataFrame:
    """A3: mean of ``value`` per calendar key, optionally excluding rows."""
    d = df if exclude is None else df.where(~exclude)
    return d.groupBy(key).agg(F.avg(value).alias(alias), F.count(value).alias("n"))


def event_count_by_day(df: DataFrame, ts_col: str, mask: Column) -> DataFrame:
    """A4: hours matching ``mask`` per calendar day."""
    return (df.where(mask).groupBy(F.to_date(ts_col).alias("date"))
              .agg(F.count(F.lit(1)).alias("n_hours")))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A5: class distribution (NULL is a class of its own here)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles (pandas / ``quantile_cont``), exact,
    by a few aggregations that narrow the bounds of each rank."""
    found = column_quantiles(df, [col], probs)[col]["q"]
    return df.sparkSession.createDataFrame([(float(p), v) for p, v in zip(probs, found)], "q double, value double")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count / mean / std / min / 25% / 50% / 75% / max per column (long),
    all columns in the same passes."""
    found = column_quantiles(df, cols, [0.25, 0.5, 0.75])
    rows = [(c, v["count"], v["mean"], v["std"], v["min"], *v["q"], v["max"]) for c, v in found.items()]
    return df.sparkSession.createDataFrame(rows, "column string, count long, mean double, std double, min double, "
                                                 "q25 double, q50 double, q75 double, max double")


def null_profile(df: DataFrame, cols: Sequence[str], ts_col: str) -> DataFrame:
    """NULL count and first / last timestamp of NULLs per column, one pass."""
    aggs = []
    for c in cols:
        isn = F.col(c).isNull()
        aggs += [F.count_if(isn).alias(f"{c}__n"),
                 F.min(F.when(isn, F.col(ts_col))).alias(f"{c}__first"),
                 F.max(F.when(isn, F.col(ts_col))).alias(f"{c}__last")]
    wide = df.agg(*aggs)
    rows = ", ".join(f"'{c}', `{c}__n`, `{c}__first`, `{c}__last`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {rows}) AS (column, n_null, first_null, last_null)")


def histogram(df: DataFrame, col: str, bins: int = 100) -> DataFrame:
    """Equal-width bins over [min, max]; the top edge is closed."""
    mn, mx = df.agg(F.min(col), F.max(col)).first()
    if mn is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, n long")
    width = (mx - mn) / bins if mx > mn else 1.0
    x = F.col(col)
    b = (F.least(F.floor((x - F.lit(mn)) * F.lit(float(bins)) / F.lit(float(mx - mn) or 1.0)),
                 F.lit(bins - 1))).cast("int")
    return (df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
              .select("bin", (F.lit(mn) + F.col("bin") * F.lit(width)).alias("lower"),
                      (F.lit(mn) + (F.col("bin") + 1) * F.lit(width)).alias("upper"), "n"))


def correlation(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """A10: Pearson correlation of every column with ``target`` in one agg."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target)).alias(c) for c in cols])
    rows = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {rows}) AS (feature, corr)")


def mask_counts(df: DataFrame, masks: dict[str, Column], value: str | None = None,
                by: Sequence[str] = ()) -> DataFrame:
    """Counts (and optional sums of ``value``) under several masks."""
    aggs = []
    for name, m in masks.items():
        aggs.append(F.count_if(F.coalesce(m, F.lit(False))).alias(f"n_{name}"))
        if value:
            aggs.append(F.sum(F.when(m, F.col(value))).alias(f"sum_{name}"))
    return (df.groupBy(*by) if by else df.groupBy()).agg(*aggs)


def daily_rollup(hourly: DataFrame, ts_col: str = "ts", load: str = "load_total",
                 price: str = "rt", gen: Sequence[str] = ("wind",), temp: str = "hub_load",
                 window_hours=(14, 19)) -> DataFrame:
    """Day-level features - afternoon max / mean / std of load, temperature
    stand-in max / mean and its day-over-day change, generation means, price
    max, and the running monthly maximum of the daily peak (previous day)."""
    lo, hi = window_hours
    hr = F.hour(ts_col)
    aft = hr.between(lo, hi)
    d = (hourly.groupBy(F.to_date(ts_col).alias("date"))
               .agg(F.max(F.when(aft, F.col(load))).alias("aft_load_max"),
                    F.avg(F.when(aft, F.col(load))).alias("aft_load_mean"),
                    F.stddev_samp(F.when(aft, F.col(load))).alias("aft_load_std"),
                    F.max(temp).alias("temp_max"), F.avg(temp).alias("temp_mean"),
                    *[F.avg(g).alias(f"{g}_mean") for g in gen],
                    F.max(price).alias("price_max"),
                    F.max(load).alias("load_max")))
    d = d.withColumn("year", F.year("date")).withColumn("month", F.month("date"))
    d = with_position(d, ["date"], None, "pos")
    d = running_period_max(d, "load_max", ["year", "month"], "monthly_peak_prev", None, "pos")
    d = halo_windows(d, [Diff("temp_max", "temp_change")], None, "pos")
    return d.drop("pos")
