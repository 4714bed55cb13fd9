"""Wide least squares and leak tests from Gramians.

One pass over the rows gives X'X, X'y and the sums of any number of columns,
by region of the rows: a task multiplies its batches as matrices and returns
one matrix a region, and the cells are summed in an aggregation.  The driver
gets ``regions x columns^2`` numbers, whatever the rows.  Columns are centred
and scaled by a first aggregation, so that one tolerance tells dependent
columns from independent ones.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: eigenvalues below this share of the largest count as zero
TOLERANCE = 1e-9


def scales(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the columns over the given rows; a constant column has deviation 1.

    Tasks give count, mean and squared deviations of each column's values;
    these are merged around the common mean, a row a task and column."""
    def run(batches):
        n, mean, m2 = np.zeros((3, len(cols)))
        for batch in batches:
            for i in range(len(cols)):
                x = batch.column(i).drop_null().to_numpy()
                if len(x):
                    own, total = x.mean(), n[i] + len(x)
                    m2[i] += ((x - own) ** 2).sum() + (own - mean[i]) ** 2 * n[i] * len(x) / total
                    mean[i] += (own - mean[i]) * len(x) / total
                    n[i] = total
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), *(pa.array(v[held]) for v in (n, mean, m2))], names=["at", "n", "mean", "m2"])

    parts = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]).mapInArrow(run, "at int, n double, mean double, m2 double")
    one = Window.partitionBy("at")
    parts = parts.withColumn("total", F.sum("n").over(one)).withColumn("level", F.sum(F.col("n") * F.col("mean")).over(one) / F.col("total"))
    square = F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("level")) ** 2) / F.first("total")
    mean, dev = np.zeros((2, len(cols)))
    for r in parts.groupBy("at").agg(F.first("level").alias("level"), F.sqrt(square).alias("dev")).collect():   # a row a column
        mean[r.at], dev[r.at] = np.nan_to_num(r.level), np.nan_to_num(r.dev)
    return mean, np.where(dev > 0, dev, 1.0)


def gramians(df: DataFrame, region: Column, cols: Sequence[str], mean: np.ndarray, dev: np.ndarray) -> dict[int, np.ndarray]:
    """{region: Z'Z} of the complete rows, with a column of ones first and the columns centred and scaled."""
    p = len(cols) + 1

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            z = np.ones((batch.num_rows, p))
            for i in range(len(cols)):
                z[:, i + 1] = (batch.column(i + 1).to_numpy(zero_copy_only=False) - mean[i]) / dev[i]
            at = batch.column(0).to_numpy()
            whole = np.isfinite(z).all(axis=1)
            for r in np.unique(at[whole]):
                part = z[whole & (at == r)]
                held[int(r)] = held.get(int(r), 0) + part.T @ part
        for r, g in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([g.ravel().tolist()], pa.list_(pa.float64()))], names=["region", "cells"])

    rows = df.select(region.cast("int").alias("region"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    rows = rows.where(F.col("region").isNotNull())
    cells = rows.mapInArrow(run, "region int, cells array<double>").select("region", F.posexplode("cells").alias("at", "v"))
    out: dict[int, np.ndarray] = {}
    for r in cells.groupBy("region", "at").agg(F.sum("v").alias("v")).collect():   # regions x columns^2 numbers
        out.setdefault(r.region, np.zeros(p * p))[r.at] = r.v
    return {r: v.reshape(p, p) for r, v in sorted(out.items())}


def centred(g: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(rows, means, covariances) of the columns behind the ones."""
    n = g[0, 0]
    m = g[0, 1:] / n
    return n, m, g[1:, 1:] / n - np.outer(m, m)


def solve(c: np.ndarray, b: np.ndarray, tolerance: float = TOLERANCE) -> tuple[np.ndarray, int]:
    """The least of the vectors that solve ``c x = b`` best, and the rank of ``c`` (symmetric, not negative)."""
    w, v = np.linalg.eigh(c)
    keep = w > tolerance * max(w.max(initial=0.0), 1e-300)
    return v[:, keep] @ ((v[:, keep].T @ b) / w[keep]), int(keep.sum())


def expanding_ols(df: DataFrame, fold: Column, k: int, features: Sequence[str], label: str,
                  scale: tuple[np.ndarray, np.ndarray] | None = None) -> list[tuple[int, int, int, np.ndarray]]:
    """[(fold, training rows, rank, intercept and coefficients)] for folds 1..k.

    ``fold`` is 0 for rows that only train and f for the test rows of fold f;
    fold f trains on the complete rows of all earlier folds, by prefix sums of
    the Gramians.  Of equally good coefficients a fold takes those of the
    least norm (in scaled columns); a fold without rows has none.  ``scale`` may
    give the :func:`scales` of features and label over the complete rows.
    """
    cols = [*features, label]
    mean, dev = scale or scales(df.na.drop(subset=cols), cols)
    held = gramians(df, fold, cols, mean, dev)
    total = np.zeros((len(cols) + 1,) * 2)
    out = []
    for f in range(1, k + 1):
        total = total + held.get(f - 1, 0)
        if total[0, 0] < 1:
            out.append((f, 0, 0, np.full(len(cols), np.nan)))
            continue
        n, m, c = centred(total)
        beta, rank = solve(c[:-1, :-1], c[:-1, -1])
        raw = beta * dev[-1] / dev[:-1]
        level = mean[-1] + dev[-1] * (m[-1] - beta @ m[:-1])
        out.append((f, int(round(n)), rank, np.r_[level - raw @ mean[:-1], raw]))
    return out


def find_leaks(c: np.ndarray, b: np.ndarray, own: float, names: Sequence[str], tolerance: float = TOLERANCE) -> list[list[str]]:
    """Least sets of features that give the target exactly.

    ``c``, ``b``, ``own``: covariances of the features, with the target, and of
    the target.  While all features left explain the target but for
    ``tolerance``, features are dropped as long as the others still do, those
    with the smallest coefficients first; what remains is a leak.  One of its
    features is then left out and the rest searched again.
    """
    def explains(s: list[int]) -> bool:
        x, _ = solve(c[np.ix_(s, s)], b[s])
        return bool(s) and own - b[s] @ x < tolerance * own

    found, pool = [], list(range(len(names)))
    while own > 0 and explains(pool):
        s = list(pool)
        x, _ = solve(c[np.ix_(s, s)], b[s])
        for f in sorted(pool, key=lambda f: abs(x[pool.index(f)])):
            rest = [i for i in s if i != f]
            if rest and explains(rest):
                s = rest
        found.append(sorted(names[i] for i in s))
        x, _ = solve(c[np.ix_(s, s)], b[s])
        pool.remove(s[int(np.argmin(np.abs(x)))])
    return found


def feature_leaks(df: DataFrame, features: Sequence[str], target: str, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per leak (leak, n_features, features): features whose exact linear combination is the target.

    Two aggregations over the complete rows.  With no more rows than features
    every target is an exact combination, so none is reported then.
    """
    cols = [*features, target]
    rows = df.na.drop(subset=cols)
    mean, dev = scales(rows, cols)
    g = gramians(rows, F.lit(0), cols, mean, dev).get(0)
    leaks = []
    if g is not None and g[0, 0] > len(cols) + 1:
        _, _, c = centred(g)
        leaks = find_leaks(c[:-1, :-1], c[:-1, -1], c[-1, -1], features, tolerance)
    return df.sparkSession.createDataFrame([(i + 1, len(s), " + ".join(s)) for i, s in enumerate(leaks)], "leak int, n_features int, features string")
