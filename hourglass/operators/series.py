"""Positional series operators that never put a whole series in one task.

Every operator here works on "positional" semantics: row ``i`` of a series
is the i-th row in ``order_cols`` order after any earlier filtering, so
``lag(x, 24)`` means 24 surviving rows back (not 24 hours back).

Three building blocks carry the scale:

* :func:`with_position` - dense 0-based position per series.  One map-side
  count tells the series with more than ``SERIES_ROWS`` rows; the others are
  numbered whole.  A longer series is cut into blocks of about ``BLOCK_ROWS``
  rows of its own order range (quantiles of a sketch, cut evenly between), its
  rows are numbered inside ``(series, block)``, and a table with one row per
  block of the long series gives every block its offset, by a scan of two
  levels.  Block assignment is a function of the row and the checkpointed
  cuts, so retries are deterministic (physical partition ids are never used).
* :func:`halo_windows` - ``bucket = pos div B``; the last ``H`` rows of a
  bucket are copied into the next bucket, windows run per
  ``(series, bucket)`` and the copies are dropped.  Each task sees at most
  ``B + H`` rows of any series.
* carry operators (:func:`fill_forward_backward`, :func:`interpolate_linear`,
  :func:`running_period_max`) - per-bucket summaries are scanned over buckets
  (a table of ``N / B`` rows, in two levels: no task sees more than ``SPAN``
  buckets or ``N / (B * SPAN)`` spans), joined back, and combined with an
  in-bucket window on the same keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET = 100_000
# rows of a series that are numbered in one piece
SERIES_ROWS = 100_000
# rows of a block of a longer series; an order range eight times as dense as
# its surroundings still makes blocks of at most SERIES_ROWS
BLOCK_ROWS = SERIES_ROWS // 8
# quantiles of a long series that guide its cuts
SERIES_BOUNDS = 32
# long series whose cuts may be broadcast (about 300 bytes each)
BROADCAST_SERIES = 20_000
# blocks or buckets that one task scans at the lower of two levels
SPAN = 1024
# quantiles fetched to cut a numeric column; finer blocks are even cuts
# between them
SKETCH_BOUNDS = 1_000
UNB_PREC = Window.unboundedPreceding
UNB_FOLL = Window.unboundedFollowing

_BUCKET, _HALO = "_hg_bucket", "_hg_halo"


def _cols(xs: Iterable[str] | str | None) -> list[str]:
    if xs is None:
        return []
    if isinstance(xs, str):
        return [xs]
    return list(xs)


def series_keys(df: DataFrame, series: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The frame with the series columns as one struct, and the name of that key.

    A struct is never null and its null fields are equal, so a plain equality
    is null-safe, and a window and a join on it share one exchange."""
    return (df.withColumn("_hg_s", F.struct(*series)), ["_hg_s"]) if series else (df, [])


# ---------------------------------------------------------------------------
# position
# ---------------------------------------------------------------------------

def _order_key_double(df: DataFrame, name: str) -> Column:
    """The first order column as a double that sorts the same way (seconds if temporal)."""
    dt = df.schema[name].dataType.typeName()
    c = F.col(name)
    if dt == "timestamp_ntz":
        # wall-clock seconds from the parts: independent of the session time
        # zone (a cast to timestamp is not monotonic across a DST gap)
        return (F.unix_date(F.to_date(c)).cast("double") * 86400.0 + F.hour(c) * 3600.0
                + F.minute(c) * 60.0 + F.date_part(F.lit("SECOND"), c).cast("double"))
    elif dt == "timestamp":
        return F.unix_micros(c).cast("double") / 1e6
    elif dt == "date":
        return F.unix_date(c).cast("double") * 86400.0
    elif dt not in ("double", "float", "integer", "long", "short", "byte", "decimal"):
        raise TypeError(f"first order column {name} must be numeric or temporal, not {dt}")
    return c.cast("double")


def order_blocks(df: DataFrame, order_col: str, num_blocks: int, block_col: str = "_hg_blk",
                 with_count: bool = False):
    """Assign every row a block (long) of the global range of a numeric column.

    At most ``SKETCH_BOUNDS`` approximate quantiles are fetched (a sketch of
    fixed size, whatever the input), and each range between two of them is cut
    evenly until there are about ``num_blocks`` blocks.  Later keys never get an
    earlier block, and equal keys share one.  Returns the frame, or
    ``(frame, row_count)`` with ``with_count``.
    """
    d = df.withColumn("_hg_okey", F.coalesce(_order_key_double(df, order_col), F.lit(float("-inf"))))
    k = max(2, min(num_blocks, SKETCH_BOUNDS))
    row = d.agg(F.count(F.lit(1)).alias("n"), F.min("_hg_okey").alias("lo"), F.max("_hg_okey").alias("hi"),
                F.percentile_approx("_hg_okey", [i / k for i in range(1, k)], 4 * k).alias("q")).first()
    bounds = sorted({q for q in [row["lo"], *(row["q"] or []), row["hi"]]
                     if q is not None and q == q and q not in (float("inf"), float("-inf"))})
    if not bounds:
        out = d.withColumn(block_col, F.lit(0).cast("long")).drop("_hg_okey")
    else:
        from pyspark.ml.feature import Bucketizer
        cuts = -(-num_blocks // len(bounds))
        ranged = Bucketizer(splits=[float("-inf")] + bounds + [float("inf")], inputCol="_hg_okey",
                            outputCol="_hg_range", handleInvalid="keep").transform(d)
        # range r holds [bounds[r - 1], bounds[r]); the open ranges at both ends aren't cut
        r = F.col("_hg_range").cast("int")
        lo, hi = F.get(F.lit(bounds), r - 1), F.get(F.lit(bounds), r)
        part = (F.col("_hg_okey") - lo) / (hi - lo)
        sub = F.when((part >= 0) & (part < 1), F.floor(part * F.lit(float(cuts)))).otherwise(0)
        out = ranged.withColumn(block_col, r.cast("long") * cuts + sub.cast("long")).drop("_hg_okey", "_hg_range")
    return (out, int(row["n"])) if with_count else out


def series_blocks(df: DataFrame, order_col: str, skey: Sequence[str], num_blocks: int | None = None):
    """Cut the series with more than ``SERIES_ROWS`` rows into blocks of about ``BLOCK_ROWS``.

    Returns ``(frame, row count, whether any series is cut)``; the frame has
    ``_hg_blk``, which is null for the rows of series that stay whole.
    ``num_blocks`` cuts every series into about so many blocks instead.

    Sizes come from one partial aggregation.  Only the rows of long series are
    sketched, and their cuts are checkpointed, since a sketch may differ when
    it is taken again.  The cuts are broadcast if counted to be few.
    """
    from ..session import checkpoint_once
    limit = 0 if num_blocks else SERIES_ROWS
    sizes = df.groupBy(*skey).agg(F.count(F.lit(1)).alias("_hg_rows"))
    total, longest, n_long = sizes.agg(F.sum("_hg_rows"), F.max("_hg_rows"), F.count_if(F.col("_hg_rows") > limit)).first()
    if not n_long:
        return df.withColumn("_hg_blk", F.lit(None).cast("long")), total or 0, False
    keyed = df.withColumn("_hg_okey", F.coalesce(_order_key_double(df, order_col), F.lit(float("-inf"))))
    few = (lambda d: F.broadcast(d)) if n_long <= BROADCAST_SERIES else (lambda d: d)
    probe = keyed.select(*skey, "_hg_okey")
    if skey:
        probe = probe.join(few(sizes.where(F.col("_hg_rows") > limit).select(*skey)), list(skey), "left_semi")
    k = SERIES_BOUNDS
    sketch = probe.groupBy(*skey).agg(F.count(F.lit(1)).alias("_hg_n"), F.min("_hg_okey").alias("lo"), F.max("_hg_okey").alias("hi"),
                                      F.percentile_approx("_hg_okey", [i / k for i in range(1, k)], 10 * k).alias("q"))
    bounds = F.array_sort(F.array_distinct(F.concat(F.array("lo"), F.coalesce("q", F.array().cast("array<double>")), F.array("hi"))))
    blocks = F.lit(num_blocks) if num_blocks else F.ceil(F.col("_hg_n") / BLOCK_ROWS)
    cuts = checkpoint_once(sketch.select(*skey, bounds.alias("_hg_bounds"), F.greatest(F.ceil(blocks / k), F.lit(1)).cast("long").alias("_hg_cuts")))
    if skey:
        joined = keyed.join(few(cuts), list(skey), "left")
    else:
        one = cuts.first()
        joined = keyed.withColumn("_hg_bounds", F.lit(one["_hg_bounds"])).withColumn("_hg_cuts", F.lit(one["_hg_cuts"]))
    # range r holds the keys from bound r on, up to bound r + 1 (counted from 1); the lambdas
    # name values, so that each is evaluated once a row wherever the expression ends up
    def named(value: Column, body) -> Column:
        return F.get(F.transform(F.array(value), body), 0)

    def cut(r: Column, part: Column) -> Column:
        sub = F.when((part >= 0) & (part < 1), F.floor(part * F.col("_hg_cuts"))).otherwise(0)
        return r.cast("long") * F.col("_hg_cuts") + sub.cast("long")

    def inside(key: Column, r: Column) -> Column:
        return named(F.get("_hg_bounds", r - 1), lambda lo: F.try_divide(key - lo, F.get("_hg_bounds", r) - lo))

    out = joined.withColumn("_hg_blk", named(F.col("_hg_okey"), lambda key: named(
        F.size(F.filter("_hg_bounds", lambda b: b <= key)), lambda r: named(inside(key, r), lambda part: cut(r, part)))))
    return out.drop("_hg_okey", "_hg_bounds", "_hg_cuts"), total, True


def block_offsets(counts: DataFrame, series: Sequence[str], n_col: str = "_hg_n") -> DataFrame:
    """``_hg_off``: rows of the series in earlier blocks, for each row of ``counts``.

    The sum has two levels, over spans of ``SPAN`` blocks and inside each span,
    so that no window sees all blocks of a series."""
    spanned = counts.withColumn("_hg_span", F.floor(F.col("_hg_blk") / F.lit(SPAN)))
    w = Window.partitionBy(*series).orderBy("_hg_span").rowsBetween(UNB_PREC, -1)
    before = spanned.groupBy(*series, "_hg_span").agg(F.sum(n_col).alias("_hg_t")).select(
        *series, "_hg_span", F.coalesce(F.sum("_hg_t").over(w), F.lit(0)).alias("_hg_before"))
    w = Window.partitionBy(*series, "_hg_span").orderBy("_hg_blk").rowsBetween(UNB_PREC, -1)
    inside = spanned.withColumn("_hg_off", F.coalesce(F.sum(n_col).over(w), F.lit(0)))
    out = inside.join(before, [*series, "_hg_span"]).withColumn("_hg_off", F.col("_hg_off") + F.col("_hg_before"))
    return out.drop("_hg_span", "_hg_before")


def with_position(df: DataFrame, order_cols: Sequence[str] | str,
                  series_cols: Sequence[str] | str | None = None,
                  pos_col: str = "pos", num_blocks: int | None = None, with_count: bool = False):
    """Add a dense 0-based position per series in ``order_cols`` order.

    Series of at most ``SERIES_ROWS`` rows are numbered whole, with one
    exchange and no join.  Longer ones are cut into blocks
    (:func:`series_blocks`), numbered inside ``(series, block)`` and shifted by
    the rows in their earlier blocks, so a series that holds a third of the
    table is spread over all its blocks.  The numbering window and the join
    with the offsets share one exchange of the rows.  Rows of a series with
    equal values of the first order column share a block.

    ``order_cols`` must be a total order inside a series (add an id column
    to break ties).  With ``with_count`` returns ``(frame, total_rows)``.
    """
    series = _cols(series_cols)
    order = _cols(order_cols)
    keyed, skey = series_keys(df, series)
    blocked, n_rows, cut = series_blocks(keyed, order[0], skey, num_blocks)
    if not cut:
        number = F.row_number().over(Window.partitionBy(*skey).orderBy(*order)) - 1
        out = keyed.withColumn("_hg_pos", number.cast("long")).select(*df.columns, F.col("_hg_pos").alias(pos_col))
        return (out, n_rows) if with_count else out
    blocked = blocked.withColumn("_hg_blk", F.coalesce("_hg_blk", F.lit(-1)))
    keys = [*skey, "_hg_blk"]
    d = blocked.withColumn("_hg_loc", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    # block sizes by map-side partial aggregation: the shuffle carries one
    # row per block of a long series per mapper, and reads only the keys
    counts = blocked.where("_hg_blk >= 0").groupBy(*keys).agg(F.count(F.lit(1)).alias("_hg_n"))
    out = d.join(block_offsets(counts, skey).drop("_hg_n"), keys, "left")
    out = out.select(*df.columns, (F.coalesce("_hg_off", F.lit(0)) + F.col("_hg_loc")).cast("long").alias(pos_col))
    return (out, n_rows) if with_count else out


def positioned_for_reuse(df: DataFrame, order_cols, series_cols=None, pos_col: str = "pos",
                         num_blocks: int | None = None):
    """Position the rows and cut the lineage with a reliable checkpoint (in
    the shared checkpoint folder) when several actions will read the result
    (fold splits, repeated model fits); returns ``(frame, total_rows)``."""
    from ..session import checkpoint_once
    out, n = with_position(df, order_cols, series_cols, pos_col, num_blocks, with_count=True)
    return checkpoint_once(out), n


# ---------------------------------------------------------------------------
# halo windows
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Lag:
    col: str
    k: int
    name: str

    halo = property(lambda self: self.k)

    def expr(self, w):
        return F.lag(F.col(self.col), self.k).over(w)


@dataclass(frozen=True)
class Rolling:
    """``x.shift(shift).rolling(n).<fn>()`` with pandas' full-window rule:
    the result is NULL unless all ``n`` values in the frame are non-null."""
    col: str
    n: int
    fn: str  # mean | std | max | min | sum
    name: str
    shift: int = 1

    @property
    def halo(self):
        return self.n + self.shift - 1

    def expr(self, w):
        frame = w.rowsBetween(-(self.n + self.shift - 1), -self.shift)
        c = F.col(self.col)
        agg = {"mean": F.avg, "std": F.stddev_samp, "max": F.max,
               "min": F.min, "sum": F.sum}[self.fn](c)
        return F.when(F.count(c).over(frame) == self.n, agg.over(frame))


@dataclass(frozen=True)
class Diff:
    col: str
    name: str
    k: int = 1

    halo = property(lambda self: self.k)

    def expr(self, w):
        return F.col(self.col) - F.lag(F.col(self.col), self.k).over(w)


@dataclass(frozen=True)
class LagAbove:
    """``(x.shift(1) > threshold).astype(int)``: a missing lag counts as 0."""
    col: str
    threshold: float
    name: str

    halo = 1

    def expr(self, w):
        return F.coalesce((F.lag(F.col(self.col), 1).over(w) > F.lit(self.threshold)).cast("int"),
                          F.lit(0))


@dataclass(frozen=True)
class TrailingMean:
    """Mean of the previous ``n`` rows that exist (no full-window rule)."""
    col: str
    n: int
    name: str

    halo = property(lambda self: self.n)

    def expr(self, w):
        return F.avg(F.col(self.col)).over(w.rowsBetween(-self.n, -1))


def halo_windows(df: DataFrame, specs: Sequence, series_cols=None, pos_col: str = "pos",
                 bucket_size: int | None = None) -> DataFrame:
    """Evaluate positional window ``specs`` per series with halo buckets."""
    series = _cols(series_cols)
    halo = max([s.halo for s in specs] + [0])
    B = max(bucket_size or DEFAULT_BUCKET, halo, 1)
    pos = F.col(pos_col)
    copies = (F.when((pos % B) >= B - halo, F.array(F.lit(0), F.lit(1)))
               .otherwise(F.array(F.lit(0))) if halo > 0 else F.array(F.lit(0)))
    framed = (df.withColumn(_HALO, F.explode(copies))
                .withColumn(_BUCKET, F.expr(f"{pos_col} div {B}") + F.col(_HALO)))
    w = Window.partitionBy(*series, _BUCKET).orderBy(pos_col)
    out = framed.select("*", *[s.expr(w).alias(s.name) for s in specs])
    return out.where(F.col(_HALO) == 0).drop(_HALO, _BUCKET)


def add_series_features(df: DataFrame, specs: Sequence, order_cols, series_cols=None,
                        pos_col: str = "pos", keep_pos: bool = True,
                        bucket_size: int | None = None) -> DataFrame:
    """Position the rows (if needed) and evaluate the window specs."""
    if pos_col not in df.columns:
        df = with_position(df, order_cols, series_cols, pos_col)
    out = halo_windows(df, specs, series_cols, pos_col, bucket_size)
    return out if keep_pos else out.drop(pos_col)


# ---------------------------------------------------------------------------
# carry operators
# ---------------------------------------------------------------------------

def _bucketed(df: DataFrame, pos_col: str, B: int) -> DataFrame:
    return df.withColumn(_BUCKET, F.expr(f"{pos_col} div {B}"))


def carried(stats: DataFrame, skey: Sequence[str], order_col: str, last: Sequence[str] = (),
            first: Sequence[str] = ()) -> DataFrame:
    """For each row of ``stats``, the greatest of each ``last`` column in earlier rows of the
    series, and the least of each ``first`` column in later rows.

    A scan of two levels: within spans of ``SPAN`` rows, and over the spans."""
    s = stats.withColumn("_hg_span", F.floor(F.col(order_col) / F.lit(SPAN)))
    spans = s.groupBy(*skey, "_hg_span").agg(*[F.max(c).alias(c) for c in last], *[F.min(c).alias(c) for c in first])
    w = Window.partitionBy(*skey).orderBy("_hg_span")
    far = spans.select(*skey, "_hg_span", *[F.max(c).over(w.rowsBetween(UNB_PREC, -1)).alias(f"{c}_far") for c in last],
                       *[F.min(c).over(w.rowsBetween(1, UNB_FOLL)).alias(f"{c}_far") for c in first])
    w = Window.partitionBy(*skey, "_hg_span").orderBy(order_col)
    near = s.select(*skey, "_hg_span", order_col, *[F.max(c).over(w.rowsBetween(UNB_PREC, -1)).alias(c) for c in last],
                    *[F.min(c).over(w.rowsBetween(1, UNB_FOLL)).alias(c) for c in first])
    return near.join(far, [*skey, "_hg_span"]).select(*skey, order_col, *[F.greatest(c, f"{c}_far").alias(c) for c in last],
                                                      *[F.least(c, f"{c}_far").alias(c) for c in first])


def _with_neighbours(df: DataFrame, cols: Sequence[str], series: Sequence[str], pos_col: str, B: int):
    """The rows with ``_l<i>`` / ``_f<i>``: the last (position, value) of column i in earlier buckets
    of the series, the first in later ones; and the window of a bucket."""
    d, skey = series_keys(_bucketed(df, pos_col, B), series)
    aggs = []
    for i, c in enumerate(cols):
        pv = F.when(F.col(c).isNotNull(), F.struct(F.col(pos_col).alias("p"), F.col(c).alias("v")))
        aggs += [F.max(pv).alias(f"_l{i}"), F.min(pv).alias(f"_f{i}")]
    keys = [*skey, _BUCKET]
    carry = carried(d.groupBy(*keys).agg(*aggs), skey, _BUCKET, [f"_l{i}" for i, _ in enumerate(cols)], [f"_f{i}" for i, _ in enumerate(cols)])
    return d.join(carry, keys), Window.partitionBy(*keys).orderBy(pos_col)


def fill_forward_backward(df: DataFrame, cols: Sequence[str], series_cols=None,
                          pos_col: str = "pos", backward: bool = True,
                          bucket_size: int | None = None) -> DataFrame:
    """``ffill()`` then (optionally) ``bfill()`` per series, by position."""
    j, wb = _with_neighbours(df, cols, _cols(series_cols), pos_col, bucket_size or DEFAULT_BUCKET)
    outs = {}
    for i, c in enumerate(cols):
        filled = F.coalesce(F.col(c), F.last(F.col(c), True).over(wb.rowsBetween(UNB_PREC, 0)), F.col(f"_l{i}").getField("v"))
        if backward:
            filled = F.coalesce(filled, F.first(F.col(c), True).over(wb.rowsBetween(0, UNB_FOLL)), F.col(f"_f{i}").getField("v"))
        outs[c] = filled.alias(c)
    return j.select(*[outs.get(c, F.col(c)) for c in df.columns])


def interpolate_linear(df: DataFrame, cols: Sequence[str], series_cols=None,
                       pos_col: str = "pos", bucket_size: int | None = None) -> DataFrame:
    """Linear interpolation by row position; trailing gaps take the last value,
    leading gaps stay NULL (pandas ``interpolate()`` defaults)."""
    j, wb = _with_neighbours(df, cols, _cols(series_cols), pos_col, bucket_size or DEFAULT_BUCKET)
    pos = F.col(pos_col)
    outs = {}
    for i, c in enumerate(cols):
        pv = F.when(F.col(c).isNotNull(), F.struct(pos.alias("p"), F.col(c).alias("v")))
        prev = F.coalesce(F.last(pv, True).over(wb.rowsBetween(UNB_PREC, 0)), F.col(f"_l{i}"))
        nxt = F.coalesce(F.first(pv, True).over(wb.rowsBetween(0, UNB_FOLL)), F.col(f"_f{i}"))
        slope = (nxt.getField("v") - prev.getField("v")) / (nxt.getField("p") - prev.getField("p"))
        val = (F.when(F.col(c).isNotNull(), F.col(c))
                .when(prev.isNotNull() & nxt.isNotNull(),
                      slope * (pos - prev.getField("p")) + prev.getField("v"))
                .when(prev.isNotNull(), prev.getField("v")))
        outs[c] = val.alias(c)
    return j.select(*[outs.get(c, F.col(c)) for c in df.columns])


def running_period_max(df: DataFrame, col: str, period_cols: Sequence[str], name: str,
                       series_cols=None, pos_col: str = "pos", shift: int = 1,
                       bucket_size: int | None = None) -> DataFrame:
    """``groupby(period)[col].cummax().shift(shift)`` where the shift runs over
    the whole series (so the first row of a period sees the previous period's
    maximum).  A NULL input row has a NULL running max, as in pandas."""
    series = _cols(series_cols)
    B = bucket_size or DEFAULT_BUCKET
    d, skey = series_keys(_bucketed(df, pos_col, B), [*series, *_cols(period_cols)])
    keys = [*skey, _BUCKET]
    carry = carried(d.groupBy(*keys).agg(F.max(col).alias("_cm")), skey, _BUCKET, ["_cm"])
    wl = Window.partitionBy(*keys).orderBy(pos_col).rowsBetween(UNB_PREC, 0)
    cm = F.when(F.col(col).isNotNull(), F.greatest(F.max(col).over(wl), F.col("_cm")))
    staged = d.join(carry, keys).withColumn("_hg_cummax", cm).select(*df.columns, "_hg_cummax")
    if shift == 0:
        return staged.withColumnRenamed("_hg_cummax", name)
    out = halo_windows(staged, [Lag("_hg_cummax", shift, name)], series, pos_col, B)
    return out.drop("_hg_cummax")


def position_filter(df: DataFrame, min_pos: int, pos_col: str = "pos") -> DataFrame:
    """Drop the first ``min_pos`` rows of every series (lag warm-up)."""
    return df.where(F.col(pos_col) >= min_pos)




def time_lags(df: DataFrame, ts_col: str, cols_hours: Sequence[tuple[str, int]], series_cols=None,
              suffix: str = "h_ago") -> DataFrame:
    """Temporal lags (``mode='time'``): the value at exactly ``ts - k hours``
    of the same series, NULL when that hour is absent - as opposed to the
    positional default, which counts surviving rows.

    One equi-join per distinct offset on ``(series, ts)``; the hash exchange
    on both keys spreads a hot series over many tasks.
    """
    series = _cols(series_cols)
    out = df
    by_k: dict[int, list[str]] = {}
    for c, k in cols_hours:
        by_k.setdefault(k, []).append(c)
    for k, cols in sorted(by_k.items()):
        shifted = df.select(*series, (F.col(ts_col) + F.make_dt_interval(hours=F.lit(k))).alias(ts_col),
                            *[F.col(c).alias(f"{c}_{k}{suffix}") for c in cols])
        out = out.join(shifted, [*series, ts_col], "left")
    return out
