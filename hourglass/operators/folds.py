"""Expanding-window time-series folds (M8).

Test size is ``n // (k + 1)``; fold ``f`` tests rows
``[n - (k - f) * size, n - (k - f - 1) * size)`` and trains on every earlier
row.  Rows before the first test block are always training rows and never
receive out-of-fold scores.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .series import block_offsets, series_blocks


def fold_bounds(n: int, k: int) -> list[tuple[int, int, int]]:
    """[(fold, test_start, test_end)] with 1-based fold numbers."""
    size = n // (k + 1)
    if size == 0:
        raise ValueError(f"{n} rows cannot make {k} folds")
    first = n - k * size
    return [(f + 1, first + f * size, first + (f + 1) * size) for f in range(k)]


def test_fold(pos_col: str, n: int, k: int):
    """Fold number of a row's test block, NULL for always-train rows."""
    size = n // (k + 1)
    first = n - k * size
    p = F.col(pos_col)
    return F.when(p >= first, (F.floor((p - F.lit(first)) / F.lit(size)) + 1).cast("int"))


def assign_folds(df: DataFrame, pos_col: str, n: int, k: int) -> DataFrame:
    """M8: one row per (row, fold, role) with role ``train`` or ``test``.

    A row trains every later fold, so it appears up to ``k`` times; the
    expansion is a per-row ``explode`` (no join, no shuffle).
    """
    parts = []
    p = F.col(pos_col)
    for fold, lo, hi in fold_bounds(n, k):
        role = F.when(p < lo, F.lit("train")).when((p >= lo) & (p < hi), F.lit("test"))
        parts.append(F.when(role.isNotNull(), F.struct(F.lit(fold).alias("fold"), role.alias("role"))))
    arr = F.filter(F.array(*parts), lambda x: x.isNotNull())
    return df.withColumn("_hg_f", F.explode(arr)).select("*", "_hg_f.fold", "_hg_f.role").drop("_hg_f")


def boundary_keys(df: DataFrame, order_cols: Sequence[str], at: Callable[[int], Sequence[int]]) -> tuple[list[list[str | None]], int]:
    """The order columns (as text) of the rows at the positions ``at(row count)``, and the count.

    Rows are counted by block of the order range; only the blocks that hold a
    wanted position are numbered, so no table is positioned, moved or stored.
    ``order_cols`` must be a total order.
    """
    keys = df.select(*order_cols)
    blocked, n, cut = series_blocks(keys, order_cols[0], [])
    want = sorted({p for p in at(n) if 0 <= p < n})
    if not want:
        return [], n
    if cut:
        hit = F.exists(F.lit(want), lambda p: (p >= F.col("_hg_off")) & (p < F.col("_hg_off") + F.col("_hg_n")))
        counts = blocked.groupBy("_hg_blk").agg(F.count(F.lit(1)).alias("_hg_n"))
        held = [(r["_hg_blk"], r["_hg_off"]) for r in block_offsets(counts, []).where(hit).collect()]   # a block per position
        first = F.create_map(*[F.lit(x) for pair in held for x in pair])
        blocked = blocked.where(F.col("_hg_blk").isin([b for b, _ in held]))
        place = first[F.col("_hg_blk")] + F.row_number().over(Window.partitionBy("_hg_blk").orderBy(*order_cols)) - 1
    else:
        place = F.row_number().over(Window.orderBy(*order_cols)) - 1       # at most SERIES_ROWS rows
    found = blocked.withColumn("_hg_place", place).where(F.col("_hg_place").isin(want)).orderBy("_hg_place")
    return [list(r) for r in found.select(*[F.col(c).cast("string") for c in order_cols]).collect()], n


def part_of(df: DataFrame, order_cols: Sequence[str], bounds: Sequence[Sequence[str | None]]) -> Column:
    """How many of the boundary rows a row is not before: 0 to ``len(bounds)``."""
    row = F.struct(*order_cols)
    out = F.lit(0)
    for b in bounds:
        edge = F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order_cols, b)])
        out = out + (row >= edge).cast("int")
    return out


def time_folds(df: DataFrame, order_cols: Sequence[str], k: int, keys: DataFrame | None = None) -> tuple[DataFrame, int]:
    """M8 without positions: ``fold`` is f for the test rows of fold f and 0 for rows that only train.

    ``keys`` may give the same rows' order columns more cheaply.  Returns the
    frame and the row count."""
    bounds, n = boundary_keys(df if keys is None else keys, order_cols, lambda n: [lo for _, lo, _ in fold_bounds(n, k)])
    return df.withColumn("fold", part_of(df, order_cols, bounds)), n
