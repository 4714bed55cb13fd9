"""One-pass threshold sweeps.

The reference re-scans the data once per candidate threshold.  Here every
row is assigned, once, the index of the threshold interval its score falls
in; one aggregation per interval (partial + final, K+1 groups) and a prefix
or suffix sum over at most K+1 rows then give the totals for every
threshold.  Work is O(N + K) instead of O(N * K), nothing data-sized is
broadcast and no cross join is planned.

Interval closure follows the test:
    ``gt``  score >  t   (price, peak probability)
    ``ge``  score >= t   (class-probability override)
    ``lt``  score <  t   (PRC)
    ``le``  score <= t
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNB_PREC, UNB_FOLL = Window.unboundedPreceding, Window.unboundedFollowing


def interval_index(score: Column, thresholds: Sequence[float], closed: str) -> Column:
    """Number of sorted thresholds below the score (strictly or not)."""
    arr = F.array(*[F.lit(float(t)) for t in thresholds])
    if closed in ("gt", "le"):   # passes t when t < s  (gt) / fails t when t < s (le)
        return F.size(F.filter(arr, lambda t: t < score))
    return F.size(F.filter(arr, lambda t: t <= score))     # ge / lt


def threshold_sums(df: DataFrame, score: str | Column, thresholds: Sequence[float], closed: str,
                   sums: dict[str, Column], threshold_col: str = "threshold") -> DataFrame:
    """For every threshold ``t``: ``sum(expr)`` over the rows whose score
    passes ``t`` (per ``closed``), plus ``<name>_total`` over all rows.

    Rows with a NULL score never pass (NULL comparisons are false).
    """
    ts = sorted(float(t) for t in thresholds)
    k = len(ts)
    s = F.col(score) if isinstance(score, str) else score
    j = F.when(s.isNull(), F.lit(-1)).otherwise(interval_index(s, ts, closed))
    hist = df.groupBy(j.alias("_j")).agg(*[F.sum(e).alias(n) for n, e in sums.items()])
    spark = df.sparkSession
    grid = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], f"_i int, {threshold_col} double")
    bins = spark.range(-1, k + 1).select(F.col("id").cast("int").alias("_j"))
    h = bins.join(hist, "_j", "left").na.fill(0, list(sums))
    w_all = Window.orderBy("_j").rowsBetween(UNB_PREC, UNB_FOLL)
    if closed in ("gt", "ge"):
        # passes threshold i iff j > i  ->  suffix sum from j = i + 1
        frame = Window.orderBy("_j").rowsBetween(0, UNB_FOLL)
        h = h.select("_j", *[F.sum(n).over(frame).alias(n) for n in sums],
                     *[F.sum(n).over(w_all).alias(f"{n}_total") for n in sums])
        h = h.withColumn("_i", F.col("_j") - 1)
    else:
        # passes threshold i iff 0 <= j <= i  ->  prefix sum from j = 0 (NULLs sit at -1)
        frame = Window.orderBy("_j").rowsBetween(UNB_PREC, 0)
        h = h.select("_j", *[(F.sum(n).over(frame) - F.sum(F.when(F.col("_j") < 0, F.col(n)))
                              .over(w_all)).alias(n) for n in sums],
                     *[F.sum(n).over(w_all).alias(f"{n}_total") for n in sums])
        h = h.withColumn("_i", F.col("_j"))
    return grid.join(h.drop("_j"), "_i").drop("_i")


def first_best(df: DataFrame, value: str, order_cols: Sequence[str], flag: str = "is_best",
               require_positive: bool = True, decimals: int = 2) -> DataFrame:
    """Mark the argmax of ``value`` with first-wins ties in ``order_cols``
    order (the reference's strict ``>`` scan).  With ``require_positive`` no
    row is marked unless the value is > 0 (best starts at 0)."""
    v = F.round(F.col(value), decimals)
    w = Window.orderBy(v.desc(), *[F.col(c).asc() for c in order_cols])
    ok = (v > 0) if require_positive else F.lit(True)
    return (df.withColumn("_rk", F.row_number().over(w))
              .withColumn(flag, ((F.col("_rk") == 1) & ok).cast("int")).drop("_rk"))
