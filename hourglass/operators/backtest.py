"""Curtailment back-tests in money.

Every comparison is ONE aggregation: each strategy is a boolean mask and its
totals are conditional sums in a single wide ``agg`` (all in whole-stage
codegen, partial aggregation before the shuffle), followed by an unpivot of
that one row.  Threshold searches use the histogram sweep in ``sweep.py``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize_small
from .sweep import first_best, threshold_sums

# --- fixed values that must equal the reference's --------------------------
CAPACITY_MW = 200.0
MINING_REVENUE = 40.0
CRITICAL_PCT = 0.65
CURTAIL_PENALTY = 50.0
PRC_SCARCITY = 3000.0
PRC_TIGHT = 5000.0
TRANSMISSION_RATE = 45000.0
PRC_SCARCITY_GRID = tuple(range(2000, 4500, 250))
PRC_TIGHT_GRID = tuple(range(4000, 9000, 250))
PRICE_GRID = tuple(float(x) for x in range(30, 125, 5))
MINING_BASELINE_THRESHOLDS = (40, 60, 80)
DATACENTER_BASELINE_THRESHOLDS = (50, 60, 80)
FIVE_STRATEGY_THRESHOLDS = (40, 60, 80, 100)
PEAK_MODEL_THRESHOLDS = (0.01, 0.05, 0.10, 0.20, 0.50)
PEAK_SWEEP_THRESHOLDS = (0.01, 0.05, 0.10, 0.20, 0.30, 0.50)
INCREMENT_BASELINES = ("DAM-only @$40", "DAM-only @$60", "RT lag-react @$40")
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _true(m: Column) -> Column:
    return F.coalesce(m, F.lit(False))


def _unpivot(wide: DataFrame, names: Sequence[str], fields: Sequence[str], label: str = "strategy",
             order_col: str = "ord") -> DataFrame:
    """One-row frame with ``{i}__{field}`` columns -> one row per strategy."""
    parts = []
    for i, n in enumerate(names):
        parts.append(f"{i}, '{n.replace(chr(39), chr(39) * 2)}', " +
                     ", ".join(f"`{i}__{f}`" for f in fields))
    spec = ", ".join(parts)
    cols = ", ".join([order_col, label, *fields])
    return wide.selectExpr(f"stack({len(names)}, {spec}) AS ({cols})")


# ---------------------------------------------------------------------------
# row-level back-tests (B4, B5) and their summaries
# ---------------------------------------------------------------------------

def mining_costs(df: DataFrame, pred_prc: str, rt: str, tight: float,
                 scarcity: float = PRC_SCARCITY, capacity_mw: float = CAPACITY_MW,
                 revenue: float = MINING_REVENUE) -> DataFrame:
    """B4 rows: always-on cost ``(RT - revenue) * MW``; guided cost 0 when the
    predicted PRC is below the tight threshold (both branches curtail)."""
    p = _c(pred_prc)
    always = (_c(rt) - F.lit(revenue)) * F.lit(capacity_mw)
    curtail = _true(p < F.lit(scarcity)) | _true((p >= F.lit(scarcity)) & (p < F.lit(tight)))
    return df.withColumn("always_on_cost", always) \
             .withColumn("guided_cost", F.when(curtail, F.lit(0.0)).otherwise(always))


def datacenter_costs(df: DataFrame, pred_prc: str, rt: str, tight: float = PRC_TIGHT,
                     scarcity: float = PRC_SCARCITY, critical_pct: float = CRITICAL_PCT,
                     capacity_mw: float = CAPACITY_MW, penalty: float = CURTAIL_PENALTY) -> DataFrame:
    """B5 rows: full load; all flexible shed below scarcity; half shed in the
    tight band; penalty on every shed MW."""
    p = _c(pred_prc)
    flex = 1.0 - critical_pct
    load = (F.when(_true(p < F.lit(scarcity)), F.lit(capacity_mw * critical_pct))
             .when(_true((p >= F.lit(scarcity)) & (p < F.lit(tight))),
                   F.lit(capacity_mw * (critical_pct + flex * 0.5)))
             .otherwise(F.lit(capacity_mw)))
    return (df.withColumn("always_on_cost", _c(rt) * F.lit(capacity_mw))
              .withColumn("guided_load", load)
              .withColumn("guided_cost", _c(rt) * F.col("guided_load") +
                          F.lit(penalty) * (F.lit(capacity_mw) - F.col("guided_load"))))


def backtest_summary(costs: DataFrame, capacity_mw: float = CAPACITY_MW) -> DataFrame:
    """Totals of a B4/B5 row frame: always-on, guided, savings, hours
    curtailed (guided cost exactly 0, as in the reference) and hours at
    reduced load."""
    aggs = [F.sum("always_on_cost").alias("total_always_on"),
            F.sum("guided_cost").alias("total_guided"),
            (F.sum("always_on_cost") - F.sum("guided_cost")).alias("savings"),
            F.count_if(F.col("guided_cost") == 0).alias("hours_curtailed")]
    if "guided_load" in costs.columns:
        aggs.append(F.count_if(F.col("guided_load") < capacity_mw).alias("hours_reduced"))
    return costs.agg(*aggs, F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------------------
# threshold searches
# ---------------------------------------------------------------------------

def optimize_prc_thresholds(df: DataFrame, pred_prc: str, rt: str, use_case: str = "mining",
                            scarcity_grid: Sequence[int] = PRC_SCARCITY_GRID,
                            tight_grid: Sequence[int] = PRC_TIGHT_GRID,
                            capacity_mw: float = CAPACITY_MW, revenue: float = MINING_REVENUE,
                            critical_pct: float = CRITICAL_PCT,
                            penalty: float = CURTAIL_PENALTY) -> DataFrame:
    """Savings for every (scarcity, tight) pair with tight > scarcity.

    savings(s, t) = F(s) + G(t) - G(s), where F(x) sums the "shed all"
    benefit and G(x) the "shed half" benefit over rows with pred < x.  One
    histogram pass over the union grid gives F and G at every grid value;
    the 197 pairs are a fixed parameter table joined on grid values.
    First-wins argmax (scarcity, then tight ascending); nothing is marked
    when no pair saves money.
    """
    r = _c(rt)
    if use_case == "mining":
        full = half = (r - F.lit(revenue)) * F.lit(capacity_mw)
    else:
        flex = 1.0 - critical_pct
        always = r * F.lit(capacity_mw)
        l_full = capacity_mw * critical_pct
        l_half = capacity_mw * (critical_pct + flex * 0.5)
        full = always - (r * F.lit(l_full) + F.lit(penalty) * F.lit(capacity_mw - l_full))
        half = always - (r * F.lit(l_half) + F.lit(penalty) * F.lit(capacity_mw - l_half))
    grid = sorted({float(x) for x in (*scarcity_grid, *tight_grid)})
    sums = materialize_small(threshold_sums(df, pred_prc, grid, "lt", {"F": full, "G": half}, "x"))
    spark = df.sparkSession
    pairs = spark.createDataFrame(
        [(int(s), int(t)) for s in scarcity_grid for t in tight_grid if t > s],
        "scarcity_threshold int, tight_threshold int")
    fs = sums.select(F.col("x").alias("_s"), F.col("F").alias("_Fs"), F.col("G").alias("_Gs"))
    gt = sums.select(F.col("x").alias("_t"), F.col("G").alias("_Gt"))
    out = (pairs.join(fs, pairs.scarcity_threshold.cast("double") == fs._s)
                .join(gt, pairs.tight_threshold.cast("double") == gt._t)
                .select("scarcity_threshold", "tight_threshold",
                        F.round(F.coalesce(F.col("_Fs"), F.lit(0.0)) + F.coalesce(F.col("_Gt"), F.lit(0.0))
                                - F.coalesce(F.col("_Gs"), F.lit(0.0)), 2).alias("savings")))
    return first_best(out, "savings", ["scarcity_threshold", "tight_threshold"])


def optimize_price_mining(df: DataFrame, pred_price: str, rt: str,
                          thresholds: Sequence[float] = PRICE_GRID,
                          capacity_mw: float = CAPACITY_MW, revenue: float = MINING_REVENUE) -> DataFrame:
    """Per threshold - hours curtailed, true / false positives, avoided
    cost, lost revenue, net; first-wins argmax of net (may be negative)."""
    r = _c(rt)
    tp = _true(r > F.lit(revenue))
    fp = _true(r <= F.lit(revenue))
    sums = threshold_sums(df, pred_price, thresholds, "gt", {
        "hours_curtailed": F.lit(1),
        "true_positives": tp.cast("int"),
        "false_positives": fp.cast("int"),
        "avoided_cost": F.when(tp, (r - F.lit(revenue)) * F.lit(capacity_mw)).otherwise(0.0),
        "lost_revenue": F.when(fp, (F.lit(revenue) - r) * F.lit(capacity_mw)).otherwise(0.0),
    })
    out = sums.select("threshold",
                      F.col("hours_curtailed").cast("long").alias("hours_curtailed"),
                      F.col("true_positives").cast("long").alias("true_positives"),
                      F.col("false_positives").cast("long").alias("false_positives"),
                      F.round("avoided_cost", 2).alias("avoided_cost"),
                      F.round("lost_revenue", 2).alias("lost_revenue"),
                      F.round(F.col("avoided_cost") - F.col("lost_revenue"), 2).alias("net_savings"))
    return first_best(out, "net_savings", ["threshold"], require_positive=False)


def optimize_price_datacenter(df: DataFrame, pred_price: str, rt: str,
                              thresholds: Sequence[float] = PRICE_GRID,
                              capacity_mw: float = CAPACITY_MW, critical_pct: float = CRITICAL_PCT,
                              penalty: float = CURTAIL_PENALTY) -> DataFrame:
    """Shed half the flexible load when the predicted price exceeds the
    threshold; benefit (RT - penalty) * shed MW per curtailed hour."""
    r = _c(rt)
    shed = capacity_mw * (1.0 - critical_pct) * 0.5
    sums = threshold_sums(df, pred_price, thresholds, "gt", {
        "hours_curtailed": F.lit(1),
        "beneficial_hours": _true(r > F.lit(penalty)).cast("int"),
        "harmful_hours": _true(r <= F.lit(penalty)).cast("int"),
        "net": F.coalesce((r - F.lit(penalty)) * F.lit(shed), F.lit(0.0)),
    })
    out = sums.select("threshold",
                      *[F.col(c).cast("long").alias(c) for c in
                        ("hours_curtailed", "beneficial_hours", "harmful_hours")],
                      F.round("net", 2).alias("net_savings"))
    return first_best(out, "net_savings", ["threshold"], require_positive=False)


def peak_threshold_sweep(df: DataFrame, p: str, is_peak: str,
                         thresholds: Sequence[float] = PEAK_SWEEP_THRESHOLDS) -> DataFrame:
    """Curtailed rows, peaks caught and missed at each probability
    threshold (``p > t``)."""
    sums = threshold_sums(df, p, thresholds, "gt", {
        "curtail_hours": F.lit(1), "caught": (F.col(is_peak) == 1).cast("int"),
        "peaks": (F.col(is_peak) == 1).cast("int")})
    return sums.select("threshold", F.col("curtail_hours").cast("long").alias("curtail_hours"),
                       F.col("caught").cast("long").alias("peaks_caught"),
                       (F.col("peaks_total") - F.col("caught")).cast("long").alias("peaks_missed"))


# ---------------------------------------------------------------------------
# strategy comparisons
# ---------------------------------------------------------------------------

def _mining_masks(rt, dam, lag_rt, pred_price, pred_prc, price_threshold, prc_tight,
                  baselines) -> list[tuple[str, Column]]:
    m = []
    for t in baselines:
        m.append((f"DAM-only @${t}", _true(_c(dam) > F.lit(float(t)))))
    for t in baselines:
        m.append((f"RT lag-react @${t}", F.coalesce(_c(lag_rt), F.lit(0.0)) > F.lit(float(t))))
    prc_mask = _true(_c(pred_prc) < F.lit(float(prc_tight)))
    price_mask = _true(_c(pred_price) > F.lit(float(price_threshold)))
    m.append(("PRC model", prc_mask))
    m.append((f"Price model @${price_threshold}", price_mask))
    m.append((f"Combined system @${price_threshold}", prc_mask | price_mask))
    return m


def compare_mining(df: DataFrame, rt: str = "rt", dam: str = "dam", lag_rt: str = "lag_rt",
                   pred_price: str = "pred_price", pred_prc: str = "pred_prc",
                   price_threshold: int = 40, prc_tight: float = PRC_TIGHT,
                   capacity_mw: float = CAPACITY_MW, revenue: float = MINING_REVENUE) -> DataFrame:
    """Always-on, DAM-only, RT lag-react, PRC, price, combined and oracle
    strategies for a binary miner; savings, hours, false positives, their
    cost and % of oracle."""
    r = _c(rt)
    net = (r - F.lit(revenue)) * F.lit(capacity_mw)
    fp_row = _true(r <= F.lit(revenue))
    masks = _mining_masks(rt, dam, lag_rt, pred_price, pred_prc, price_threshold, prc_tight,
                          MINING_BASELINE_THRESHOLDS)
    aggs = [F.sum(F.greatest(net, F.lit(0.0))).alias("_oracle"),
            F.count_if(_true(r > F.lit(revenue))).alias("_oracle_hours")]
    for i, (_, m) in enumerate(masks):
        aggs += [F.coalesce(F.sum(F.when(m, net)), F.lit(0.0)).alias(f"{i}__savings"),
                 F.count_if(m).alias(f"{i}__hours_curtailed"),
                 F.count_if(m & fp_row).alias(f"{i}__false_positives"),
                 F.coalesce(F.sum(F.when(m & fp_row, (F.lit(revenue) - r) * F.lit(capacity_mw))),
                            F.lit(0.0)).alias(f"{i}__fp_cost")]
    wide = materialize_small(df.agg(*aggs))   # one row, read by several branches
    names = [n for n, _ in masks]
    body = _unpivot(wide, names, ["savings", "hours_curtailed", "false_positives", "fp_cost"])
    body = _with_scalar(body, wide, ["_oracle", "_oracle_hours"])
    body = body.select((F.col("ord") + 1).alias("ord"), "strategy", "savings", "hours_curtailed",
                       "false_positives", "fp_cost",
                       F.when(F.col("_oracle") > 0, F.col("savings") / F.col("_oracle") * 100)
                       .otherwise(F.lit(0.0)).alias("pct_oracle"), "_oracle", "_oracle_hours")
    spark = df.sparkSession
    always = spark.createDataFrame([(0, "Always-on", 0.0, 0, 0, 0.0, 0.0)],
                                   "ord int, strategy string, savings double, hours_curtailed long, "
                                   "false_positives long, fp_cost double, pct_oracle double")
    oracle = _with_scalar(spark.createDataFrame([(len(names) + 1, "Oracle")], "ord int, strategy string"),
                          wide, ["_oracle", "_oracle_hours"]).select(
        "ord", "strategy", F.col("_oracle").alias("savings"),
        F.col("_oracle_hours").alias("hours_curtailed"), F.lit(0).cast("long").alias("false_positives"),
        F.lit(0.0).alias("fp_cost"), F.lit(100.0).alias("pct_oracle"))
    out = always.unionByName(body.drop("_oracle", "_oracle_hours")).unionByName(oracle)
    return out.select("ord", "strategy", F.round("savings", 2).alias("savings"),
                      F.col("hours_curtailed").cast("long").alias("hours_curtailed"),
                      F.col("false_positives").cast("long").alias("false_positives"),
                      F.round("fp_cost", 2).alias("fp_cost"),
                      F.round("pct_oracle", 4).alias("pct_oracle"))


def _with_scalar(df: DataFrame, one_row: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Attach columns of a one-row aggregate as scalar subqueries (evaluated
    once; no join, no nested loop)."""
    return df.select("*", *[one_row.select(c).scalar().alias(c) for c in cols])


def compare_datacenter(df: DataFrame, rt: str = "rt", dam: str = "dam", lag_rt: str = "lag_rt",
                       pred_price: str = "pred_price", pred_prc: str = "pred_prc",
                       price_threshold: int = 60, prc_tight: float = PRC_TIGHT,
                       capacity_mw: float = CAPACITY_MW, critical_pct: float = CRITICAL_PCT,
                       penalty: float = CURTAIL_PENALTY, include_true_oracle: bool = False) -> DataFrame:
    """The same strategies for a data centre that sheds half its flexible
    load; the 'oracle' sheds all flexible load above penalty / (1 - critical),
    which is not a true upper bound (pct may exceed 100).  With
    ``include_true_oracle`` a last row sheds all flexible load whenever
    RT > penalty, the real break-even."""
    r = _c(rt)
    flex = capacity_mw * (1.0 - critical_pct)
    load_half = capacity_mw - flex * 0.5
    full_cost = r * F.lit(capacity_mw)
    half_cost = r * F.lit(load_half) + F.lit(penalty * flex * 0.5)
    oracle_thresh = penalty / (1.0 - critical_pct)
    om = _true(r > F.lit(oracle_thresh))
    oracle_cost = r * F.lit(capacity_mw * critical_pct) + F.lit(penalty * flex)
    masks = _mining_masks(rt, dam, lag_rt, pred_price, pred_prc, price_threshold, prc_tight,
                          DATACENTER_BASELINE_THRESHOLDS)
    aggs = [F.coalesce(F.sum(F.when(om, full_cost - oracle_cost)), F.lit(0.0)).alias("_oracle"),
            F.count_if(om).alias("_oracle_hours")]
    for i, (_, m) in enumerate(masks):
        aggs += [F.coalesce(F.sum(F.when(m, full_cost - half_cost)), F.lit(0.0)).alias(f"{i}__savings"),
                 F.count_if(m).alias(f"{i}__hours_curtailed")]
    wide = materialize_small(df.agg(*aggs))   # one row, read by several branches
    names = [n for n, _ in masks]
    body = _with_scalar(_unpivot(wide, names, ["savings", "hours_curtailed"]), wide,
                        ["_oracle", "_oracle_hours"])
    body = body.select((F.col("ord") + 1).alias("ord"), "strategy", "savings", "hours_curtailed",
                       F.when(F.col("_oracle") > 0, F.col("savings") / F.col("_oracle") * 100)
                       .otherwise(F.lit(0.0)).alias("pct_oracle"))
    spark = df.sparkSession
    always = spark.createDataFrame([(0, "Always-on", 0.0, 0, 0.0)],
                                   "ord int, strategy string, savings double, hours_curtailed long, "
                                   "pct_oracle double")
    oracle = _with_scalar(spark.createDataFrame([(len(names) + 1, f"Oracle @>${oracle_thresh:.0f}")],
                                                "ord int, strategy string"), wide,
                          ["_oracle", "_oracle_hours"]).select(
        "ord", "strategy", F.col("_oracle").alias("savings"),
        F.col("_oracle_hours").alias("hours_curtailed"), F.lit(100.0).alias("pct_oracle"))
    out = always.unionByName(body).unionByName(oracle)
    if include_true_oracle:
        tm = _true(r > F.lit(penalty))
        true = df.agg(F.coalesce(F.sum(F.when(tm, (r - F.lit(penalty)) * F.lit(flex))), F.lit(0.0)).alias("sv"),
                      F.count_if(tm).alias("h"))
        true = _with_scalar(true, wide, ["_oracle"]).select(
            F.lit(len(names) + 2).alias("ord"), F.lit(f"True oracle @>${penalty:.0f}").alias("strategy"),
            F.col("sv").alias("savings"), F.col("h").alias("hours_curtailed"),
            F.when(F.col("_oracle") > 0, F.col("sv") / F.col("_oracle") * 100).otherwise(F.lit(0.0))
            .alias("pct_oracle"))
        out = out.unionByName(true)
    return out.select("ord", "strategy", F.round("savings", 2).alias("savings"),
                      F.col("hours_curtailed").cast("long").alias("hours_curtailed"),
                      F.round("pct_oracle", 4).alias("pct_oracle"))


def incremental_value(comparison: DataFrame, combined_prefix: str = "Combined",
                      baselines: Sequence[str] = INCREMENT_BASELINES) -> DataFrame:
    """Combined-system savings minus each baseline's savings."""
    comb = comparison.where(F.col("strategy").startswith(combined_prefix)) \
        .select(F.col("savings").alias("_comb")).limit(1)
    base = comparison.where(F.col("strategy").isin(*baselines)).select(
        F.col("strategy").alias("baseline"), F.col("savings").alias("_base"))
    return _with_scalar(base, comb, ["_comb"]).select(
        "baseline", F.round(F.col("_comb") - F.col("_base"), 2).alias("increment"))


def five_strategy_mining(df: DataFrame, rt: str = "rt", pred_price: str = "pred_price",
                         pred_prc: str = "pred_prc",
                         thresholds: Sequence[int] = FIVE_STRATEGY_THRESHOLDS,
                         prc_tight: float = PRC_TIGHT, capacity_mw: float = CAPACITY_MW,
                         revenue: float = MINING_REVENUE) -> DataFrame:
    """A always-on, B PRC-only, C price-only@t, D combined@t, E oracle."""
    r = _c(rt)
    net = (r - F.lit(revenue)) * F.lit(capacity_mw)
    b = _true(_c(pred_prc) < F.lit(prc_tight))
    rows: list[tuple[str, str, Column | None]] = [("A: Always-on", "-", None), ("B: PRC-only", "-", b)]
    for t in thresholds:
        c = _true(_c(pred_price) > F.lit(float(t)))
        rows += [("C: Price-only", f"${t}", c), ("D: Combined", f"${t}", b | c)]
    aggs = [F.coalesce(F.sum(net), F.lit(0.0)).alias("_total"),
            F.coalesce(F.sum(F.least(net, F.lit(0.0))), F.lit(0.0)).alias("_oracle_cost"),
            F.count_if(_true(r > F.lit(revenue))).alias("_oracle_hours")]
    for i, (_, _, m) in enumerate(rows):
        if m is None:
            aggs += [F.coalesce(F.sum(net), F.lit(0.0)).alias(f"{i}__total_cost"),
                     F.lit(0).cast("long").alias(f"{i}__hours_curtailed")]
        else:
            aggs += [F.coalesce(F.sum(F.when(~m, net)), F.lit(0.0)).alias(f"{i}__total_cost"),
                     F.count_if(m).alias(f"{i}__hours_curtailed")]
    n = len(rows)
    aggs += [F.coalesce(F.sum(F.least(net, F.lit(0.0))), F.lit(0.0)).alias(f"{n}__total_cost"),
             F.count_if(_true(r > F.lit(revenue))).alias(f"{n}__hours_curtailed")]
    wide = materialize_small(df.agg(*aggs))   # one row, read by several branches
    names = [f"{s}|{p}" for s, p, _ in rows] + ["E: Oracle|-"]
    long = _with_scalar(_unpivot(wide, names, ["total_cost", "hours_curtailed"]), wide,
                        ["_total", "_oracle_cost"])
    sav = F.col("_total") - F.col("total_cost")
    oracle_sav = F.col("_total") - F.col("_oracle_cost")
    return long.select(
        "ord", F.split("strategy", r"\|").getItem(0).alias("strategy"),
        F.split("strategy", r"\|").getItem(1).alias("price_threshold"),
        F.round("total_cost", 2).alias("total_cost"),
        F.col("hours_curtailed").cast("long").alias("hours_curtailed"),
        F.round(sav, 2).alias("savings_vs_A"),
        F.round(sav / oracle_sav * 100, 1).alias("pct_of_oracle"))


def five_strategy_datacenter(df: DataFrame, rt: str = "rt", pred_price: str = "pred_price",
                             pred_prc: str = "pred_prc",
                             thresholds: Sequence[int] = FIVE_STRATEGY_THRESHOLDS,
                             prc_scarcity: float = PRC_SCARCITY, prc_tight: float = PRC_TIGHT,
                             capacity_mw: float = CAPACITY_MW, critical_pct: float = CRITICAL_PCT,
                             penalty: float = CURTAIL_PENALTY) -> DataFrame:
    """Three load levels; scarcity sheds all flexible load, tight OR a
    price spike sheds half, and scarcity wins."""
    r = _c(rt)
    flex = capacity_mw * (1.0 - critical_pct)
    full = r * F.lit(capacity_mw)
    all_shed = r * F.lit(capacity_mw * critical_pct) + F.lit(penalty * flex)
    half_shed = r * F.lit(capacity_mw - flex * 0.5) + F.lit(penalty * flex * 0.5)
    p = _c(pred_prc)
    sc = _true(p < F.lit(prc_scarcity))
    tg = _true((p >= F.lit(prc_scarcity)) & (p < F.lit(prc_tight)))
    rows: list[tuple[str, str, Column, Column]] = [
        ("A: Always-on", "-", full, F.lit(False)),
        ("B: PRC-only", "-", F.when(sc, all_shed).when(tg, half_shed).otherwise(full), sc | tg)]
    for t in thresholds:
        spike = _true(_c(pred_price) > F.lit(float(t)))
        rows.append(("C: Price-only", f"${t}", F.when(spike, half_shed).otherwise(full), spike))
        rows.append(("D: Combined", f"${t}",
                     F.when(sc, all_shed).when(tg | spike, half_shed).otherwise(full), sc | tg | spike))
    oracle_thresh = penalty / (1.0 - critical_pct)
    om = _true(r > F.lit(oracle_thresh))
    rows.append(("E: Oracle", f">${oracle_thresh:.0f}", F.when(om, all_shed).otherwise(full), om))
    aggs = [F.coalesce(F.sum(full), F.lit(0.0)).alias("_total")]
    for i, (_, _, cost, m) in enumerate(rows):
        aggs += [F.coalesce(F.sum(cost), F.lit(0.0)).alias(f"{i}__total_cost"),
                 F.count_if(m).alias(f"{i}__hours_reduced")]
    wide = materialize_small(df.agg(*aggs))   # one row, read by several branches
    names = [f"{s}|{p_}" for s, p_, _, _ in rows]
    long = _with_scalar(_unpivot(wide, names, ["total_cost", "hours_reduced"]), wide, ["_total"])
    long = long.withColumn("savings_vs_A", F.col("_total") - F.col("total_cost"))
    oracle_sav = long.where(F.col("ord") == len(rows) - 1).select(F.col("savings_vs_A").alias("_os"))
    long = _with_scalar(long, oracle_sav, ["_os"])
    return long.select(
        "ord", F.split("strategy", r"\|").getItem(0).alias("strategy"),
        F.split("strategy", r"\|").getItem(1).alias("price_threshold"),
        F.round("total_cost", 2).alias("total_cost"),
        F.col("hours_reduced").cast("long").alias("hours_reduced"),
        F.round("savings_vs_A", 2).alias("savings_vs_A"),
        F.when(F.col("_os") > 0, F.round(F.col("savings_vs_A") / F.col("_os") * 100, 1))
         .otherwise(F.lit(0.0)).alias("pct_of_oracle"))


def fp_analysis(df: DataFrame, rt: str = "rt", pred_price: str = "pred_price",
                pred_prc: str = "pred_prc", thresholds: Sequence[int] = FIVE_STRATEGY_THRESHOLDS,
                prc_tight: float = PRC_TIGHT, capacity_mw: float = CAPACITY_MW,
                revenue: float = MINING_REVENUE) -> DataFrame:
    """For the combined strategy at each price threshold - curtailed,
    true-positive and false-positive hours, avoided cost, lost revenue, net."""
    r = _c(rt)
    prc_mask = _true(_c(pred_prc) < F.lit(prc_tight))
    aggs = []
    for i, t in enumerate(thresholds):
        d = prc_mask | _true(_c(pred_price) > F.lit(float(t)))
        fp = d & _true(r <= F.lit(revenue))
        tp = d & _true(r > F.lit(revenue))
        aggs += [F.count_if(d).alias(f"{i}__hours_curtailed"),
                 F.count_if(tp).alias(f"{i}__tp_hours"),
                 F.coalesce(F.sum(F.when(tp, (r - F.lit(revenue)) * F.lit(capacity_mw))), F.lit(0.0))
                 .alias(f"{i}__avoided_cost"),
                 F.count_if(fp).alias(f"{i}__fp_hours"),
                 F.coalesce(F.sum(F.when(fp, (F.lit(revenue) - r) * F.lit(capacity_mw))), F.lit(0.0))
                 .alias(f"{i}__lost_revenue")]
    wide = materialize_small(df.agg(*aggs))   # one row, read by several branches
    long = _unpivot(wide, [str(t) for t in thresholds],
                    ["hours_curtailed", "tp_hours", "avoided_cost", "fp_hours", "lost_revenue"],
                    label="threshold")
    return long.select(F.col("threshold").cast("int").alias("price_threshold"),
                       F.col("hours_curtailed").cast("long").alias("hours_curtailed"),
                       F.col("tp_hours").cast("long").alias("tp_hours"),
                       F.round("avoided_cost", 2).alias("avoided_cost"),
                       F.col("fp_hours").cast("long").alias("fp_hours"),
                       F.round("lost_revenue", 2).alias("lost_revenue"),
                       F.round(F.col("avoided_cost") - F.col("lost_revenue"), 2).alias("net_benefit"))


def exposure_hours(df: DataFrame, regime_col: str = "regime", rt: str = "rt",
                   price_floor: float = 100.0, capacity_mw: float = CAPACITY_MW) -> DataFrame:
    """Hours with comfortable reserves (Normal / Surplus) yet RT above
    ``price_floor``, and the energy bill of a full load in them."""
    m = _true(F.col(regime_col).isin("Normal", "Surplus") & (_c(rt) > F.lit(price_floor)))
    return df.agg(F.count_if(m).alias("exposure_hours"),
                  F.round(F.coalesce(F.sum(F.when(m, _c(rt) * F.lit(capacity_mw))), F.lit(0.0)), 2)
                  .alias("exposure_cost"),
                  F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------------------
# peak (4CP) strategies
# ---------------------------------------------------------------------------

def compare_peak_strategies(df: DataFrame, p: str, is_peak: str, window_col: str,
                            labels: DataFrame, label_year: str = "year",
                            year_col: str = "year", month_col: str = "month",
                            thresholds: Sequence[float] = PEAK_MODEL_THRESHOLDS,
                            season_months: Sequence[int] = (6, 7, 8, 9),
                            capacity_mw: float = CAPACITY_MW, revenue: float = MINING_REVENUE,
                            rate: float = TRANSMISSION_RATE) -> DataFrame:
    """No management / every window period / model at several thresholds
    / oracle, averaged per summer.  Keeps the reference's hard-coded four
    dodged peaks for the conservative row and integer truncation of averages."""
    summer = df.where(F.col(month_col).isin(*season_months))
    aggs = [F.countDistinct(year_col).alias("_ny"),
            F.count_if(F.col(window_col) == 1).alias("_aft"),
            F.coalesce(F.sum(F.col(is_peak)), F.lit(0)).alias("_peaks")]
    for i, t in enumerate(thresholds):
        cur = _true(F.col(p) > F.lit(float(t)))
        aggs += [F.count_if(cur).alias(f"_cur{i}"), F.count_if(cur & (F.col(is_peak) == 1)).alias(f"_dod{i}")]
    st = summer.agg(*aggs)
    years = summer.select(F.col(year_col).alias(label_year)).distinct()
    lab = labels.join(years, label_year, "left_semi").agg(F.count(F.lit(1)).alias("_lab"))
    st = _with_scalar(st, lab, ["_lab"])
    full = capacity_mw * rate
    ny = F.col("_ny").cast("double")
    avg_aft = F.floor(F.col("_aft") / ny)
    rows = [
        F.struct(F.lit(0).alias("ord"), F.lit("No 4CP management").alias("strategy"),
                 F.lit(0).cast("long").alias("hours_curtailed_per_summer"),
                 F.lit(0).cast("long").alias("peaks_dodged"), F.col("_lab").cast("long").alias("peaks_total"),
                 F.lit(full).alias("transmission_per_year"), F.lit(0.0).alias("production_lost_per_summer"),
                 F.lit(full).alias("net_cost_per_year")),
        F.struct(F.lit(1).alias("ord"), F.lit("Conservative (all afternoons)").alias("strategy"),
                 avg_aft.cast("long").alias("hours_curtailed_per_summer"),
                 F.lit(4).cast("long").alias("peaks_dodged"), F.lit(4).cast("long").alias("peaks_total"),
                 F.lit(0.0).alias("transmission_per_year"),
                 (avg_aft * F.lit(revenue * capacity_mw)).cast("double").alias("production_lost_per_summer"),
                 (avg_aft * F.lit(revenue * capacity_mw)).cast("double").alias("net_cost_per_year"))]
    for i, t in enumerate(thresholds):
        avg_cur = F.col(f"_cur{i}") / ny
        missed = (F.col("_peaks") - F.col(f"_dod{i}")) / ny
        trans = missed / 4 * F.lit(capacity_mw) * F.lit(rate)
        lost = avg_cur * F.lit(revenue * capacity_mw)
        rows.append(F.struct(F.lit(2 + i).alias("ord"), F.lit(f"Model @{t:.2f}").alias("strategy"),
                             F.floor(avg_cur).cast("long").alias("hours_curtailed_per_summer"),
                             F.col(f"_dod{i}").cast("long").alias("peaks_dodged"),
                             F.col("_peaks").cast("long").alias("peaks_total"),
                             trans.alias("transmission_per_year"), lost.alias("production_lost_per_summer"),
                             (trans + lost).alias("net_cost_per_year")))
    ppy = F.floor(F.col("_peaks") / ny)
    rows.append(F.struct(F.lit(2 + len(thresholds)).alias("ord"), F.lit("Oracle (peak hours only)").alias("strategy"),
                         ppy.cast("long").alias("hours_curtailed_per_summer"),
                         F.col("_peaks").cast("long").alias("peaks_dodged"),
                         F.col("_peaks").cast("long").alias("peaks_total"),
                         F.lit(0.0).alias("transmission_per_year"),
                         (ppy * F.lit(revenue * capacity_mw)).cast("double").alias("production_lost_per_summer"),
                         (ppy * F.lit(revenue * capacity_mw)).cast("double").alias("net_cost_per_year")))
    out = st.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.select("ord", "strategy", "hours_curtailed_per_summer", "peaks_dodged", "peaks_total",
                      *[F.round(c, 2).alias(c) for c in ("transmission_per_year", "production_lost_per_summer",
                                                         "net_cost_per_year")])


def calibrated_fold_backtest(df: DataFrame, pos_col: str, n_rows: int, pred_prc: str, rt: str,
                             use_case: str = "mining") -> DataFrame:
    """Tune (scarcity, tight) on the first half of a fold, evaluate the
    chosen pair on the second half.  The chosen pair travels as a one-row
    frame (no driver round trip)."""
    half = n_rows // 2
    tune = df.where(F.col(pos_col) < half)
    test = df.where(F.col(pos_col) >= half)
    sweep = optimize_prc_thresholds(tune, pred_prc, rt, use_case)
    best = materialize_small(sweep.where(F.col("is_best") == 1).select(
        "scarcity_threshold", "tight_threshold", F.col("savings").alias("tune_savings")))
    t = _with_scalar(test, best, ["scarcity_threshold", "tight_threshold", "tune_savings"])
    p, s, tt = _c(pred_prc), F.col("scarcity_threshold"), F.col("tight_threshold")
    r = _c(rt)
    if use_case == "mining":
        always = (r - F.lit(MINING_REVENUE)) * F.lit(CAPACITY_MW)
        guided = F.when(_true(p < s) | _true((p >= s) & (p < tt)), F.lit(0.0)).otherwise(always)
    else:
        flex = 1.0 - CRITICAL_PCT
        always = r * F.lit(CAPACITY_MW)
        load = (F.when(_true(p < s), F.lit(CAPACITY_MW * CRITICAL_PCT))
                 .when(_true((p >= s) & (p < tt)), F.lit(CAPACITY_MW * (CRITICAL_PCT + flex * 0.5)))
                 .otherwise(F.lit(CAPACITY_MW)))
        guided = r * load + F.lit(CURTAIL_PENALTY) * (F.lit(CAPACITY_MW) - load)
    return t.groupBy("scarcity_threshold", "tight_threshold", "tune_savings").agg(
        F.round(F.sum(always) - F.sum(guided), 2).alias("test_savings"),
        F.count(F.lit(1)).alias("test_rows"))
