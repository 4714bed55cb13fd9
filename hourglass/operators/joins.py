"""Joins (J1-J5): time spine, spine left joins, backward as-of join,
label membership and score alignment.

There is no cross join anywhere: the threshold sweeps that the reference
runs as loops over every candidate are histogram scans (``sweep.py``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .series import UNB_PREC, _cols, carried, series_blocks, series_keys


def time_spine(df: DataFrame, ts_col: str = "ts", series_cols=None, step: str = "1 hour",
               start: str | None = None, end: str | None = None) -> DataFrame:
    """A regular timestamp sequence from ``start`` (or the data minimum) to
    ``end`` (or the data maximum), per series when ``series_cols`` are given.
    The spine size is bounded by the time range, not the data volume."""
    series = _cols(series_cols)
    lo = F.to_timestamp_ntz(F.lit(start)) if start else F.min(ts_col)
    hi = F.to_timestamp_ntz(F.lit(end)) if end else F.max(ts_col)
    bounds = (df.groupBy(*series) if series else df.groupBy()).agg(
        lo.alias("_lo"), hi.alias("_hi"))
    return bounds.select(*series, F.explode(F.sequence(
        F.col("_lo").cast("timestamp_ntz"), F.col("_hi").cast("timestamp_ntz"),
        F.expr(f"INTERVAL {step}"))).alias(ts_col))


def spine_left_join(spine: DataFrame, feeds: Sequence[DataFrame], on: Sequence[str],
                    shift_hours: Sequence[int] | None = None, ts_col: str = "ts") -> DataFrame:
    """Left-join pre-deduplicated feeds onto the spine.  ``shift_hours``
    re-aligns hour-ending feeds (e.g. -1) before the join."""
    out = spine
    for i, f in enumerate(feeds):
        if shift_hours and shift_hours[i]:
            f = f.withColumn(ts_col, F.col(ts_col) + F.make_dt_interval(hours=F.lit(shift_hours[i])))
        out = out.join(f, list(on), "left")
    return out


def asof_backward(left: DataFrame, right: DataFrame, ts_col: str, by_cols: Sequence[str],
                  right_cols: Sequence[str], left_id: str, right_id: str,
                  matched_ts_col: str | None = None, num_blocks: int | None = None) -> DataFrame:
    """For every left row, the latest right row of the same ``by`` key with
    ``right.ts <= left.ts`` (exact matches allowed; among equal timestamps the
    highest ``right_id`` wins).

    Both sides are unioned and forward-filled in ``(ts, side, id)`` order.
    Keys of at most ``series.SERIES_ROWS`` rows are filled whole.  Longer ones
    are cut into blocks of their time range, with the last match of earlier
    blocks carried in from a table of one row per block (a scan of two
    levels), so a hot key never lands in one task and no nested-loop join is
    planned.  ``num_blocks`` cuts every key into about so many blocks.
    """
    by = list(by_cols)
    match_fields = [F.col(c).alias(c) for c in right_cols]
    if matched_ts_col:
        match_fields.append(F.col(ts_col).alias(matched_ts_col))
    r = right.select(*by, ts_col, F.lit(0).alias("_hg_side"), F.col(right_id).alias("_hg_id"),
                     F.struct(*match_fields).alias("_hg_m"))
    lcols = [c for c in left.columns if c not in by and c != ts_col]
    l = left.select(*by, ts_col, F.lit(1).alias("_hg_side"), F.col(left_id).alias("_hg_id"),
                    F.lit(None).cast(r.schema["_hg_m"].dataType).alias("_hg_m"),
                    F.struct(*[F.col(c) for c in lcols]).alias("_hg_l"))
    u = l.unionByName(r, allowMissingColumns=True)
    u, skey = series_keys(u, by)
    u, _, cut = series_blocks(u, ts_col, skey, num_blocks)
    u = u.withColumn("_hg_blk", F.coalesce("_hg_blk", F.lit(-1))) if cut else u.drop("_hg_blk")
    keys = [*skey, "_hg_blk"] if cut else skey
    wl = Window.partitionBy(*keys).orderBy(ts_col, "_hg_side", "_hg_id").rowsBetween(UNB_PREC, 0)
    m = F.last("_hg_m", True).over(wl)
    j = u
    if cut:
        okey = F.struct(F.col(ts_col), F.col("_hg_side"), F.col("_hg_id"))
        last = F.when(F.col("_hg_m").isNotNull(), F.struct(okey.alias("k"), F.col("_hg_m").alias("m")))
        blocks = u.where("_hg_blk >= 0").groupBy(*keys).agg(F.max(last).alias("_hg_prev"))
        # the join and the window have the same keys: one exchange of the rows
        j = u.join(carried(blocks, skey, "_hg_blk", ["_hg_prev"]), keys, "left")
        m = F.coalesce(m, F.col("_hg_prev").getField("m"))
    out = j.withColumn("_hg_match", m).where(F.col("_hg_side") == 1)
    sel = [*by, ts_col, *[F.col(f"_hg_l.{c}").alias(c) for c in lcols],
           *[F.col(f"_hg_match.{c}").alias(c) for c in right_cols]]
    if matched_ts_col:
        sel.append(F.col(f"_hg_match.{matched_ts_col}").alias(matched_ts_col))
    return out.select(*sel)


def flag_membership(df: DataFrame, labels: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """``flag = 1`` when the row's key is in ``labels`` (exact match).
    Whether the labels are broadcast is left to AQE, which knows their bytes."""
    keys = labels.select(*on).distinct().withColumn(flag, F.lit(1))
    return df.join(keys, list(on), "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))


def align_scored(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keep only rows scored by both models (index intersection)."""
    return a.join(b, list(on), "inner")
