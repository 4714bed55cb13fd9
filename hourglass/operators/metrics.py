"""Evaluation metrics.

Every metric reduces the scored rows with one partial+final aggregation to a
table bounded by classes x classes (or thresholds x classes); the rest is
arithmetic on that small table.  Zero denominators give 0, as in the
reference (``zero_division=0``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import price_tier
from ..session import materialize_small
from .series import fill_forward_backward
from .sweep import interval_index

# --- fixed values that must equal the reference's --------------------------
SPIKE_THRESHOLDS = (40, 100, 200)
SPREAD_THRESHOLDS = (20, 50, 100)
RECALL_SWEEP = tuple(round(0.01 * i, 2) for i in range(1, 50))   # 0.01 .. 0.49
TARGET_RECALL = 0.65
FP_PASS_PCT = 2.0
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _div0(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def mae_rmse(df: DataFrame, actual: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE and RMSE over rows where both values exist."""
    d = df.where(F.col(actual).isNotNull() & F.col(pred).isNotNull())
    e = F.col(actual) - F.col(pred)
    return (d.groupBy(*by) if by else d.groupBy()).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"))


def mae_by_tier(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """MAE and row count per price tier of the actual value."""
    d = df.where(F.col(actual).isNotNull() & F.col(pred).isNotNull())
    return d.groupBy(price_tier(actual).alias("tier")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col(actual) - F.col(pred))).alias("mae"))


def recall_precision_at(df: DataFrame, actual: str, pred: str,
                        thresholds: Sequence[float] = SPIKE_THRESHOLDS) -> DataFrame:
    """Actual / predicted exceedances, TP, recall and precision at each
    threshold (``value > t``)."""
    d = df.where(F.col(actual).isNotNull() & F.col(pred).isNotNull())
    a, p = F.col(actual), F.col(pred)
    aggs = []
    for i, t in enumerate(thresholds):
        aggs += [F.count_if(a > t).alias(f"a{i}"), F.count_if(p > t).alias(f"p{i}"),
                 F.count_if((a > t) & (p > t)).alias(f"tp{i}")]
    wide = d.agg(*aggs)
    rows = ", ".join(f"{float(t)}D, a{i}, p{i}, tp{i}" for i, t in enumerate(thresholds))
    long = wide.selectExpr(f"stack({len(thresholds)}, {rows}) AS (threshold, n_actual, n_pred, tp)")
    return long.select("threshold", "n_actual", "n_pred", "tp",
                       _div0(F.col("tp"), F.col("n_actual")).alias("recall"),
                       _div0(F.col("tp"), F.col("n_pred")).alias("precision"))


def confusion_counts(df: DataFrame, actual: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., actual, pred) -> n; rows with a NULL actual or prediction are
    not classified."""
    d = df.where(F.col(actual).isNotNull() & F.col(pred).isNotNull())
    return d.groupBy(*by, F.col(actual).alias("actual"), F.col(pred).alias("pred")) \
            .agg(F.count(F.lit(1)).alias("n"))


def report_from_counts(cm: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """E4 from a confusion table: per-class precision / recall / F1 / support
    over the classes present in actual or predicted, plus ``macro avg``,
    ``weighted avg`` and ``accuracy`` rows.

    One aggregation (every confusion cell contributes its count to the
    actual label's support and the predicted label's prediction count) and
    one window over ``by``; the summary rows are emitted by the first label
    of each group, so no joins or unions are planned.
    """
    by = list(by)
    hit = F.when(F.col("actual") == F.col("pred"), F.col("n")).otherwise(F.lit(0))
    contrib = cm.select(*by, F.explode(F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("s"), F.lit(0).cast("long").alias("p"),
                 hit.cast("long").alias("t")),
        F.struct(F.col("pred").alias("label"), F.lit(0).cast("long").alias("s"), F.col("n").alias("p"),
                 F.lit(0).cast("long").alias("t")))).alias("c")).select(*by, "c.*")
    per = contrib.groupBy(*by, "label").agg(F.sum("s").alias("support"), F.sum("p").alias("n_pred"),
                                            F.sum("t").alias("tp"))
    prec = _div0(F.col("tp"), F.col("n_pred"))
    rec = _div0(F.col("tp"), F.col("support"))
    per = per.select(*by, "label", prec.alias("precision"), rec.alias("recall"), "support", "tp")
    per = per.withColumn("f1", _div0(2 * F.col("precision") * F.col("recall"),
                                     F.col("precision") + F.col("recall")))
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    wall = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.select("*", F.sum("support").over(wall).alias("_tot"), F.sum("tp").over(wall).alias("_ttp"),
                     F.avg("precision").over(wall).alias("_mp"), F.avg("recall").over(wall).alias("_mr"),
                     F.avg("f1").over(wall).alias("_mf"),
                     F.sum(F.col("precision") * F.col("support")).over(wall).alias("_wp"),
                     F.sum(F.col("recall") * F.col("support")).over(wall).alias("_wr"),
                     F.sum(F.col("f1") * F.col("support")).over(wall).alias("_wf"),
                     (F.row_number().over(w.orderBy("label")) == 1).alias("_first"))
    tot = F.col("_tot")

    def row(label, p, r, f, sup):
        return F.struct((F.lit(label) if isinstance(label, str) else label).alias("label"),
                        p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        sup.cast("long").alias("support"))

    own = row(F.col("label"), F.col("precision"), F.col("recall"), F.col("f1"), F.col("support"))
    macro = row("macro avg", F.col("_mp"), F.col("_mr"), F.col("_mf"), tot)
    weighted = row("weighted avg", _div0(F.col("_wp"), tot), _div0(F.col("_wr"), tot),
                   _div0(F.col("_wf"), tot), tot)
    acc = _div0(F.col("_ttp"), tot)
    accuracy = row("accuracy", acc, acc, acc, tot)
    rows = F.when(F.col("_first"), F.array(own, macro, weighted, accuracy)).otherwise(F.array(own))
    return per.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")


def classification_report(df: DataFrame, actual: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """E4."""
    return report_from_counts(confusion_counts(df, actual, pred, by), by)


def confusion_matrix(df: DataFrame, actual: str, pred: str, labels: Sequence[str]) -> DataFrame:
    """E5: actual x predicted counts, one column per predicted label."""
    cm = confusion_counts(df, actual, pred)
    return cm.groupBy("actual").pivot("pred", list(labels)).agg(F.sum("n")).na.fill(0)


def f1_weighted_by_split(df: DataFrame, actual: str, pred: str, split_col: str) -> DataFrame:
    """Weighted F1 per split (train vs test overfit check)."""
    rep = classification_report(df, actual, pred, [split_col])
    return rep.where(F.col("label") == "weighted avg").select(split_col, F.col("f1").alias("f1_weighted"))


def recall_by_fold(df: DataFrame, actual: str, pred: str, fold_col: str = "fold",
                   target: str = "Scarcity") -> DataFrame:
    """Per-fold recall of ``target`` and macro recall; folds without
    a ``target`` row are flagged (excluded from the mean by :func:`cv_mean_recall`)."""
    rep = classification_report(df, actual, pred, [fold_col])
    sc = rep.where(F.col("label") == target).select(fold_col, F.col("recall").alias("target_recall"),
                                                    F.col("support").alias("n_target"))
    mac = rep.where(F.col("label") == "macro avg").select(fold_col, F.col("recall").alias("macro_recall"))
    folds = df.select(fold_col).distinct()
    return (folds.join(sc, fold_col, "left").join(mac, fold_col, "left")
                 .select(fold_col, F.coalesce("n_target", F.lit(0)).cast("long").alias("n_target"),
                         F.coalesce("target_recall", F.lit(0.0)).alias("target_recall"),
                         F.coalesce("macro_recall", F.lit(0.0)).alias("macro_recall")))


def cv_mean_recall(per_fold: DataFrame) -> DataFrame:
    """Mean target recall over the folds that contain the target class."""
    return per_fold.where(F.col("n_target") > 0).agg(
        F.coalesce(F.avg("target_recall"), F.lit(0.0)).alias("mean_recall"),
        F.count(F.lit(1)).alias("folds_with_target"))


def threshold_for_recall(df: DataFrame, actual: str, base_pred: str, p_target: str,
                         thresholds: Sequence[float] = RECALL_SWEEP, target_recall: float = TARGET_RECALL,
                         target: str = "Scarcity") -> DataFrame:
    """Sweep the override threshold (``p >= t`` -> ``target``) in one pass.

    Each row gets the index of the first threshold it fails; counts per
    (index, actual, base prediction) - a table bounded by thresholds x
    classes^2 - give the full confusion table at every threshold.  Chosen:
    the highest threshold whose rounded recall reaches ``target_recall``,
    else the first threshold with the maximum recall.
    """
    ts = sorted(float(t) for t in thresholds)
    k = len(ts)
    d = df.where(F.col(actual).isNotNull() & F.col(base_pred).isNotNull())
    s = F.col(p_target)
    j = F.when(s.isNull(), F.lit(0)).otherwise(interval_index(s, ts, "ge"))
    hist = d.groupBy(j.alias("_j"), F.col(actual).alias("actual"), F.col(base_pred).alias("base")) \
            .agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    grid = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "_i int, threshold double")
    # a row overrides at threshold i iff i < j: every histogram row (at most
    # k x classes^2 of them) is spread over the k threshold indices
    spread = hist.select(F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_i"), "_j", "actual",
                         "base", "n")
    pred = F.when(F.col("_i") < F.col("_j"), F.lit(target)).otherwise(F.col("base"))
    cm = (spread.groupBy("_i", "actual", pred.alias("pred")).agg(F.sum("n").alias("n"))
                .join(grid, "_i").drop("_i"))
    rep = report_from_counts(cm, ["threshold"])
    is_t, is_m = F.col("label") == target, F.col("label") == "macro avg"
    per_t = rep.groupBy("threshold").agg(
        F.round(F.max(F.when(is_t, F.col("recall"))), 3).alias("recall"),
        F.round(F.max(F.when(is_t, F.col("precision"))), 3).alias("precision"),
        F.round(F.max(F.when(is_m, F.col("recall"))), 3).alias("macro_recall"))
    out = (grid.select("threshold").join(per_t, "threshold", "left")
               .na.fill(0.0, ["recall", "precision", "macro_recall"]))
    viable = F.col("recall") >= target_recall
    w_v = Window.orderBy(F.col("_v").desc(), F.col("threshold").desc())
    w_m = Window.orderBy(F.col("recall").desc(), F.col("threshold").asc())
    out = (out.withColumn("_v", viable.cast("int"))
              .withColumn("_rv", F.row_number().over(w_v))
              .withColumn("_rm", F.row_number().over(w_m))
              .withColumn("_any", F.max("_v").over(Window.orderBy(F.lit(1)).rowsBetween(
                  Window.unboundedPreceding, Window.unboundedFollowing))))
    chosen = F.when(F.col("_any") == 1, F.col("_rv") == 1).otherwise(F.col("_rm") == 1)
    return out.select("threshold", "recall", "precision", "macro_recall",
                      chosen.cast("int").alias("is_chosen"))


def false_positive_audit(df: DataFrame, pred: str, target: str = "Scarcity",
                         pass_pct: float = FP_PASS_PCT) -> DataFrame:
    """Share of rows predicted ``target`` in an event-free window."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(F.col(pred) == target).alias("n_flagged")) \
             .withColumn("pct", F.round(_div0(F.col("n_flagged") * 100.0, F.col("n_rows")), 2)) \
             .withColumn("passed", (F.col("pct") < pass_pct).cast("int"))


def event_free_audit(df: DataFrame, event: Column, pred: str, ts_col: str, pos_col: str, target: str = "Scarcity",
                     pass_pct: float = FP_PASS_PCT, start=None, end=None) -> DataFrame:
    """False alarms of ``pred`` in the longest run of rows without an event (ties: the
    earliest), or in the rows from ``start`` to ``end``.

    ``df`` is a gap-free spine with positions.  A run is named by the position
    of the event before it, which is carried forward over buckets, so no
    window sees the whole series."""
    marked = df.withColumn("_hg_event", event)
    if start is None:
        named = fill_forward_backward(marked.withColumn("_hg_run", F.when(F.col("_hg_event"), F.col(pos_col))), ["_hg_run"], None, pos_col, backward=False)
        free = named.where(~F.col("_hg_event")).withColumn("_hg_run", F.coalesce("_hg_run", F.lit(-1)))
        runs = free.groupBy("_hg_run").agg(F.min(ts_col).alias("s"), F.max(ts_col).alias("e"), F.count(F.lit(1)).alias("n"))
        best = materialize_small(runs.agg(F.min_by(F.struct("s", "e"), F.struct(-F.col("n"), F.col("s"))).alias("b")).select("b.s", "b.e"))
        inside = F.col(ts_col).between(best.select("s").scalar(), best.select("e").scalar())
    else:
        inside = F.col(ts_col).between(start, end)
    rows = marked.where(inside)
    out = rows.agg(F.min(ts_col).alias("start_ts"), F.max(ts_col).alias("end_ts"), F.count(F.lit(1)).alias("n_rows"),
                   F.count_if(F.col(pred) == target).alias("n_flagged"))
    return out.withColumn("pct", F.round(_div0(F.col("n_flagged") * 100.0, F.col("n_rows")), 2)) \
              .withColumn("passed", (F.col("pct") < pass_pct).cast("int"))


def mae_ratio(df: DataFrame, actual: str, pred: str, training: Column) -> DataFrame:
    """Mean absolute error on training and test rows, and test over training."""
    e = F.abs(F.col(actual) - F.col(pred))
    return df.agg(F.avg(F.when(training, e)).alias("train_mae"), F.avg(F.when(~training, e)).alias("test_mae")) \
             .withColumn("ratio", F.try_divide("test_mae", "train_mae"))


def error_slices(df: DataFrame, actual: str, pred: str, target: str = "Scarcity") -> DataFrame:
    """Caught / missed / false alarms of ``target`` with the class on the
    other side of the error."""
    a, p = F.col(actual), F.col(pred)
    sl = (F.when((a == target) & (p == target), "caught")
           .when((a == target) & (p != target), "missed")
           .when((a != target) & (p == target), "false_alarm"))
    other = F.when(a == target, p).otherwise(a)
    return (df.where(a.isNotNull() & p.isNotNull()).where(sl.isNotNull())
              .groupBy(sl.alias("slice"), other.alias("other_class")).agg(F.count(F.lit(1)).alias("n")))


def topk_hit_by_period(df: DataFrame, score: str, is_peak: str, period_cols: Sequence[str],
                       ts_col: str = "ts") -> DataFrame:
    """W13 + E12: rank rows per period by score (ties: earlier first); for
    each period that has a labelled peak, the peak's rank and top-1 / top-3
    hits.  Periods are calendar months, so a group is bounded by the time
    grain, not by data volume."""
    w = Window.partitionBy(*period_cols).orderBy(F.col(score).desc_nulls_last(), F.col(ts_col))
    ranked = df.withColumn("rank", F.row_number().over(w))
    peaks = ranked.where(F.col(is_peak) == 1).groupBy(*period_cols).agg(
        F.min_by(F.struct("rank", ts_col, score), F.col(ts_col)).alias("_p"))
    return peaks.select(*period_cols, F.col(f"_p.{ts_col}").alias("peak_ts"),
                        F.col(f"_p.{score}").alias("peak_score"), F.col("_p.rank").alias("peak_rank"),
                        (F.col("_p.rank") == 1).cast("int").alias("top1"),
                        (F.col("_p.rank") <= 3).cast("int").alias("top3"))
