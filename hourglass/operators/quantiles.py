"""Exact quantiles of many columns by interval refinement.

A pass is one aggregation over all columns.  The first takes approximate
quantiles around each wanted rank, which bound it within a few thousandths
of the rows.  Each further pass counts, for every open rank, the rows below
and on both bounds, and either finds it (a bound has that rank), or collects
the values strictly between the bounds if these are few, or takes a sketch of
them, which bounds the rank a hundred times more closely.  Bounds that count
too many or too few rows are moved out again, so the result is exact, ties and
skew included.  The number of passes follows the logarithm of the row count,
not the number of columns; rows are never shuffled.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: accuracy of the sketches (rank error 1 / ACCURACY), and values collected per rank at most
ACCURACY, FEW = 10_000, 2_000
#: quantiles that a refining sketch returns
GRID = 100


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, dict]:
    """``{column: {"count", "mean", "std", "min", "max", "q": [value per prob]}}``, NULLs left out.

    Quantiles are linear between neighbouring ranks (pandas, ``quantile_cont``).
    """
    spark = df.sparkSession
    cells = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("x")) for i, c in enumerate(cols)])
    long = df.select(F.explode(cells).alias("v")).select("v.c", "v.x").where(F.col("x").isNotNull())
    d = 3 / ACCURACY
    near = sorted({min(max(p + s, 0.0), 1.0) for p in probs for s in (-d, d)})
    first = {r.c: r for r in long.groupBy("c").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("lo"), F.max("x").alias("hi"),
        F.percentile_approx("x", near, ACCURACY).alias("q")).collect()}      # a row per column
    found: dict[tuple[int, int], float] = {}
    open_: dict[tuple[int, int], list[float]] = {}
    for c, r in first.items():
        for p in probs:
            at = (r.n - 1) * float(p)
            lo = r.q[near.index(min(max(p - d, 0.0), 1.0))] if p > d else r.lo
            hi = r.q[near.index(min(max(p + d, 0.0), 1.0))] if p < 1 - d else r.hi
            for rank in {math.floor(at), min(math.floor(at) + 1, r.n - 1)}:
                open_[c, rank] = [lo, hi]
    while open_:
        want = spark.createDataFrame([(c, rank, *map(float, b)) for (c, rank), b in open_.items()], "c int, rank long, lo double, hi double")
        x, inside = F.col("x"), (F.col("x") > F.col("lo")) & (F.col("x") < F.col("hi"))
        counts = {(r.c, r.rank): r for r in long.join(F.broadcast(want), "c").groupBy("c", "rank").agg(   # columns x probabilities rows
            F.count_if(x < F.col("lo")).alias("lt_lo"), F.count_if(x <= F.col("lo")).alias("le_lo"), F.count_if(x < F.col("hi")).alias("lt_hi"),
            F.count_if(x <= F.col("hi")).alias("le_hi"), F.percentile_approx(F.when(inside, x), [i / GRID for i in range(GRID + 1)], ACCURACY).alias("q")).collect()}
        few = {}
        for key, (lo, hi) in list(open_.items()):
            r, rank, ends = counts[key], key[1], first[key[0]]
            if r.lt_lo <= rank < r.le_lo:
                found[key] = lo
            elif r.lt_hi <= rank < r.le_hi:
                found[key] = hi
            elif rank < r.lt_lo:
                open_[key] = [ends.lo, lo]
            elif rank >= r.le_hi:
                open_[key] = [hi, ends.hi]
            elif r.lt_hi - r.le_lo <= FEW:
                few[key] = (lo, hi, rank - r.le_lo)
            else:
                share = (rank - r.le_lo) / (r.lt_hi - r.le_lo) * GRID
                open_[key] = [r.q[max(0, math.floor(share) - 1)], r.q[min(GRID, math.ceil(share) + 1)]]
        if few:
            want = spark.createDataFrame([(c, rank, float(lo), float(hi)) for (c, rank), (lo, hi, _) in few.items()], "c int, rank long, lo double, hi double")
            for r in long.join(F.broadcast(want), "c").where(inside).groupBy("c", "rank").agg(F.array_sort(F.collect_list("x")).alias("x")).collect():
                found[r.c, r.rank] = r.x[few[r.c, r.rank][2]]      # at most FEW values
        open_ = {k: b for k, b in open_.items() if k not in found}
    out = {}
    for i, name in enumerate(cols):
        r = first.get(i)
        q = []
        for p in probs:
            if r is None:
                q.append(None)
                continue
            at = (r.n - 1) * float(p)
            lo = math.floor(at)
            a, b = found[i, lo], found[i, min(lo + 1, r.n - 1)]
            q.append(a + (b - a) * (at - lo) if a != b else a)
        out[name] = {"count": r.n if r else 0, "mean": r and r.mean, "std": r and r.std, "min": r and r.lo, "max": r and r.hi, "q": q}
    return out
