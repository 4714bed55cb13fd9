"""De-duplication and upsert.

``min_by`` / ``max_by`` over a struct are declarative aggregates with a
partial (map-side) phase, so a key holding a third of the table is reduced
on every mapper before the shuffle - unlike ``row_number() == 1`` over a
key window, which would sort the whole hot key in one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str], latest: bool) -> DataFrame:
    cols = df.columns
    rec = F.struct(*[F.col(c) for c in cols])
    order = F.struct(*[F.col(c) for c in order_cols])
    agg = (F.max_by if latest else F.min_by)(rec, order).alias("_hg_rec")
    return df.groupBy(*key_cols).agg(agg).select(*[F.col(f"_hg_rec.{c}").alias(c) for c in cols])


def keep_first(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key, the smallest ``order_cols`` wins (source rank,
    file, row - a total order, unlike an unstable sort)."""
    return _pick(df, key_cols, order_cols, latest=False)


def keep_latest(df: DataFrame, key_cols: Sequence[str], seq_cols: Sequence[str]) -> DataFrame:
    """One row per key, the latest vintage (largest ``seq_cols``) wins."""
    return _pick(df, key_cols, seq_cols, latest=True)


def scd1_upsert(current: DataFrame, changes: DataFrame, key_cols: Sequence[str],
                seq_cols: Sequence[str]) -> DataFrame:
    """D3: SCD type 1 - apply ``changes`` to ``current``; per key the highest
    sequence wins, so late revisions supersede and replays are no-ops."""
    return keep_latest(current.unionByName(changes, allowMissingColumns=True), key_cols, seq_cols)


def priority_union(frames: Sequence[DataFrame], key_cols: Sequence[str],
                   order_cols: Sequence[str] = (), rank_col: str = "source_rank",
                   keep_rank: bool = False) -> DataFrame:
    """Concatenate sources in priority order; per key the first source
    (then ``order_cols``) wins."""
    tagged = None
    for i, f in enumerate(frames):
        t = f.withColumn(rank_col, F.lit(i))
        tagged = t if tagged is None else tagged.unionByName(t, allowMissingColumns=True)
    out = keep_first(tagged, key_cols, [rank_col, *order_cols])
    return out if keep_rank else out.drop(rank_col)
