"""Data-quality assertions and drift checks (K5, K6), one pass each."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dq_checks(df: DataFrame, ts_col: str, not_null: Sequence[str], non_negative: Sequence[str],
              presence_col: str) -> DataFrame:
    """K5: uniqueness of the time key, NULL counts, range violations and gap
    hours (spine rows with no source rows) in one aggregation.  Distinct
    count is exact (the key is the grain of the table)."""
    rng = None
    for c in non_negative:
        x = F.col(c) < 0
        rng = x if rng is None else (rng | x)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(ts_col).alias("n_distinct_ts"),
        (F.count(F.lit(1)) - F.countDistinct(ts_col)).alias("n_duplicate_ts"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null],
        F.count_if(F.coalesce(rng, F.lit(False))).alias("out_of_range"),
        F.count_if(F.col(presence_col).isNull()).alias("gap_hours"),
        F.min(ts_col).alias("min_ts"), F.max(ts_col).alias("max_ts"))


def drift_check(df: DataFrame, ts_col: str, actual: str, pred: str, spike: float,
                unit: str = "week") -> DataFrame:
    """K6: error and spike recall per period, to compare a later window with
    the test window."""
    d = df.where(F.col(actual).isNotNull() & F.col(pred).isNotNull())
    a, p = F.col(actual), F.col(pred)
    n_act = F.count_if(a > spike)
    tp = F.count_if((a > spike) & (p > spike))
    from ..functions.time import trunc_ntz
    return d.groupBy(trunc_ntz(ts_col, unit).alias("period")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(F.abs(a - p)), 6).alias("mae"),
        n_act.alias("n_actual"), tp.alias("tp"),
        F.round(F.when(n_act > 0, tp / n_act).otherwise(F.lit(0.0)), 6).alias("recall_100"))
