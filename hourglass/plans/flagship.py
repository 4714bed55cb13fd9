"""The flagship query: hourly feeds -> spine -> fill -> lags -> regimes ->
dispatch actions, summarised per action."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.decision import dispatch_action
from ..functions.numeric import regime
from ..operators import series as S
from . import inputs as I

TIGHT = 6750.0
PRICE = 40.0


def dispatch_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = S.with_position(I.hourly(spark, sf_dir), ["ts"], None, "pos")
    h = S.fill_forward_backward(h, ["rt", "prc"], None, "pos")
    h = S.halo_windows(h, [S.Lag("prc", 1, "prc_1h_lag"), S.Lag("rt", 1, "rt_1h_lag"),
                           S.Rolling("prc", 6, "mean", "prc_roll_mean_6h")], None, "pos")
    return (h.withColumn("regime", regime("prc"))
             .withColumn("predicted_regime", regime("prc_1h_lag"))
             .withColumn("action", dispatch_action("prc_1h_lag", "rt_1h_lag", TIGHT, PRICE)))


def dispatch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = dispatch_table(spark, sf_dir)
    return t.groupBy("action").agg(F.count(F.lit(1)).alias("n_hours"),
                                   F.round(F.avg("rt"), 6).alias("avg_rt"),
                                   F.round(F.avg("prc"), 6).alias("avg_prc"))
