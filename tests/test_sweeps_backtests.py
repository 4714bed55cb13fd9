"""Histogram sweeps equal brute force; back-test tie rules."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.operators import backtest as B
from hourglass.operators import sweep as SW


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(11)
    rows = []
    for i in range(1500):
        rt = round(rng.uniform(-10, 200), 2)
        p = None if rng.random() < 0.05 else float(rng.choice(range(0, 11000, 125)))
        pp = None if rng.random() < 0.05 else round(rng.uniform(0, 150), 2)
        rows.append((i, rt, p, pp))
    return spark.createDataFrame(rows, "id long, rt double, pred_prc double, pred_price double")


@pytest.mark.parametrize("closed", ["gt", "ge", "lt", "le"])
def test_threshold_sums_equal_brute_force(spark, scored, closed):
    ths = [0.0, 40.0, 55.5, 100.0, 149.99]
    got = SW.threshold_sums(scored, "pred_price", ths, closed, {"n": F.lit(1), "s": F.col("rt")}).toPandas()
    pdf = scored.toPandas()
    ops = {"gt": np.greater, "ge": np.greater_equal, "lt": np.less, "le": np.less_equal}
    for t in ths:
        m = ops[closed](pdf.pred_price, t).fillna(False).astype(bool)
        row = got[got.threshold == t].iloc[0]
        assert row.n == m.sum()
        assert row.s == pytest.approx(pdf.rt[m].sum(), abs=1e-6)


@pytest.mark.parametrize("use_case", ["mining", "datacenter"])
def test_prc_pairs_equal_brute_force(spark, scored, use_case):
    got = B.optimize_prc_thresholds(scored, "pred_prc", "rt", use_case).toPandas()
    assert len(got) == 197
    pdf = scored.toPandas()
    best, best_pair = 0.0, None
    for s, t in itertools.product(B.PRC_SCARCITY_GRID, B.PRC_TIGHT_GRID):
        if t <= s:
            continue
        p, rt = pdf.pred_prc, pdf.rt
        if use_case == "mining":
            always = (rt - 40) * 200
            guided = np.where((p < s) | ((p >= s) & (p < t)), 0.0, always)
        else:
            always = rt * 200
            guided = np.where(p < s, rt * 130 + 3500, np.where((p >= s) & (p < t), rt * 165 + 1750, rt * 200))
        sv = round(float(always.sum() - guided.sum()), 2)
        row = got[(got.scarcity_threshold == s) & (got.tight_threshold == t)].iloc[0]
        assert row.savings == pytest.approx(sv, abs=0.011)
        if sv > best:
            best, best_pair = sv, (s, t)
    flagged = got[got.is_best == 1]
    if best_pair is None:
        assert flagged.empty
    else:
        assert (flagged.scarcity_threshold.iloc[0], flagged.tight_threshold.iloc[0]) == best_pair


def test_sweep_ties_first_wins_and_all_negative(spark):
    # two equal-savings thresholds: the first wins
    df = spark.createDataFrame([(1.0, 200.0), (2.0, 10.0)], "id double, rt double")
    d = df.withColumn("pred_price", F.lit(50.0))
    out = B.optimize_price_mining(d, "pred_price", "rt", thresholds=[10.0, 20.0, 60.0]).toPandas()
    assert out[out.is_best == 1].threshold.tolist() == [10.0]
    # PRC search with nothing positive marks no pair
    neg = spark.createDataFrame([(10.0, 1000.0)], "rt double, pred_prc double")
    assert B.optimize_prc_thresholds(neg, "pred_prc", "rt").where("is_best = 1").count() == 0


def test_backtest_ties_rt_equal_revenue(spark):
    df = spark.createDataFrame([(40.0, 9000.0), (45.0, 4000.0), (30.0, 4000.0)], "rt double, pred_prc double")
    s = B.backtest_summary(B.mining_costs(df, "pred_prc", "rt", 5000.0)).first()
    assert s.hours_curtailed == 3   # RT == revenue has zero cost and counts as curtailed
    cmp = B.compare_mining(df.withColumn("dam", F.lit(None).cast("double"))
                             .withColumn("lag_rt", F.lit(None).cast("double"))
                             .withColumn("pred_price", F.lit(None).cast("double"))).toPandas()
    prc = cmp[cmp.strategy == "PRC model"].iloc[0]
    assert prc.false_positives == 1 and prc.fp_cost == pytest.approx(2000.0)   # <= revenue is a FP
    oracle = cmp[cmp.strategy == "Oracle"].iloc[0]
    assert oracle.hours_curtailed == 1 and oracle.savings == pytest.approx(1000.0)


def test_datacenter_oracle_can_exceed_upper_bound(spark):
    df = spark.createDataFrame([(100.0, 100.0, None, 0.0)], "rt double, dam double, lag_rt double, pred_prc double")
    out = B.compare_datacenter(df.withColumn("pred_price", F.lit(None).cast("double"))).toPandas()
    # shedding is worth it above $50 but the "oracle" only sheds above $143
    prc = out[out.strategy == "PRC model"].iloc[0]
    assert prc.savings > 0 and prc.pct_oracle == 0.0


def test_true_oracle_row_is_an_upper_bound(spark):
    df = spark.createDataFrame([(100.0, 0.0, None, 9000.0, None), (60.0, 0.0, None, 9000.0, None)],
                               "rt double, dam double, lag_rt double, pred_prc double, pred_price double")
    out = B.compare_datacenter(df, include_true_oracle=True).toPandas()
    true = out[out.strategy.str.startswith("True oracle")].iloc[0]
    assert true.savings == pytest.approx((100 - 50) * 70 + (60 - 50) * 70)
    assert true.savings >= out.savings.max() - 1e-9
