"""Canonical derived inputs built from the driver tables.

* ``hourly``    - one market-like hourly series from ``events`` on a gap-free
                  spine (prices, load, wind, PRC proxy).
* ``intervals`` - one row per event, series = ``user_id``: the scale input for
                  windows, regimes, dispatch, back-tests, sweeps and metrics.
* ``daily``     - daily load from ``orders`` (1995-2001) for the month /
                  season / running-peak operators.

Every frame is lazy and grows with its source table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import time as T
from ..functions.numeric import regime
from ..operators import series as S
from ..operators.joins import spine_left_join, time_spine
from ..session import materialize_small
from ..sources.tables import table

# --- fixed definitions of the proxy columns (shared with the SQL oracle) ---
PRC_PER_CLICK_VALUE = 100.0   # hourly PRC = 100 * avg(click value)
PRC_PER_K = 120.0             # interval PRC = 120 * props.k
DAM_TRAILING_EVENTS = 3       # interval DAM = mean of the previous 3 events
# ---------------------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    return table(spark, sf_dir, "events", where)


def hourly_feeds(ev: DataFrame) -> DataFrame:
    """A1: all hourly feeds in ONE conditional aggregation (one scan, one
    shuffle; partial aggregation makes a hot hour harmless)."""
    v, et = F.col("value"), F.col("event_type")
    return (ev.groupBy(T.floor_hour("ts").alias("ts"))
              .agg(F.avg(v).alias("rt"),
                   F.avg(F.when(et == "view", v)).alias("dam"),
                   (F.lit(PRC_PER_CLICK_VALUE) * F.avg(F.when(et == "click", v))).alias("prc"),
                   F.sum(v).alias("load_total"),
                   F.sum(F.when(et == "purchase", v)).alias("hub_load"),
                   F.sum(F.when(et == "error", v)).alias("wind"),
                   F.sum(F.when(et == "view", v)).alias("zone_view"),
                   F.sum(F.when(et == "click", v)).alias("zone_click"),
                   F.sum(F.when(et == "signup", v)).alias("zone_signup"),
                   F.sum(F.when(et == "error", v)).alias("zone_error"),
                   F.count(F.lit(1)).alias("n_events")))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly table on the spine: missing hours are rows of NULLs.

    The hourly aggregate is bounded by the time range (hours x series), not by
    the event volume, and several branches read it (spine bounds, joins,
    position, fills), so it is computed once and checkpointed instead of
    re-scanning the raw events per branch."""
    feeds = materialize_small(hourly_feeds(events(spark, sf_dir)))
    spine = time_spine(feeds, "ts")
    return spine_left_join(spine, [feeds], ["ts"])


def intervals(spark: SparkSession, sf_dir: str, bucket_size: int | None = None,
              extra_specs=()) -> DataFrame:
    """One row per event, series ``user_id``, positional order ``(ts, event_id)``.

    rt = value; dam = mean of the previous 3 events; prc = 120 * props.k;
    pred_prc / pred_price = previous event's prc / rt (deterministic stand-ins
    for model scores).  ``extra_specs`` are evaluated in the same halo stage
    (one exchange and sort for all window features).
    """
    ev = events(spark, sf_dir)
    base = ev.select(
        "user_id", "ts", "event_id", "event_type",
        F.col("value").alias("rt"),
        (F.lit(PRC_PER_K) * F.get_json_object("props", "$.k").try_cast("int")).cast("double").alias("prc"))
    pos = S.with_position(base, ["ts", "event_id"], ["user_id"])
    specs = [S.TrailingMean("rt", DAM_TRAILING_EVENTS, "dam"),
             S.Lag("prc", 1, "pred_prc"),
             S.Lag("rt", 1, "pred_price"), *extra_specs]
    return S.halo_windows(pos, specs, ["user_id"], "pos", bucket_size)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily load series from orders (one aggregation)."""
    o = table(spark, sf_dir, "orders")
    d = materialize_small(   # bounded by calendar days, read by several branches
        o.groupBy(F.col("o_orderdate").cast("timestamp_ntz").alias("ts"))
         .agg(F.sum("o_totalprice").alias("load_total"),
              F.count(F.lit(1)).alias("n_orders"),
              F.avg("o_totalprice").alias("avg_price")))
    cal = T.calendar_columns("ts")
    return d.select("*", cal["month"].alias("month"), cal["year"].alias("year"),
                    cal["day_of_week"].alias("day_of_week"))


def with_regimes(df: DataFrame, prc_col: str = "prc", pred_col: str = "pred_prc") -> DataFrame:
    return df.withColumn("regime", regime(prc_col)).withColumn("pred_regime", regime(pred_col))


#: Further feeds of the market table, as SQL over the hourly table (the same text in both engines).
MARKET_FEEDS = {
    "wind_forecast": "wind * 0.9D + 3.0D",
    "wind_system": "wind + zone_click",
    "solar": "zone_signup",
    "solar_forecast": "zone_signup * 1.1D - 2.0D",
    "solar_capacity": "CASE WHEN hour(ts) % 7 = 0 THEN NULL ELSE zone_view END",
    "load_forecast": "load_total + zone_view - zone_click",
    "dam_system": "(dam + rt) / 2.0D",
    "temperature": "rt / 2.0D + hub_load / 100.0D",
    "adder_reserve": "greatest(rt - 50.0D, 0.0D)",
    "adder_offline": "greatest(rt - 55.0D, 0.0D)",
    "adder_reliability": "CASE WHEN day(ts) > 20 THEN greatest(rt - 60.0D, 0.0D) END",
}


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly table with all feeds, delivered by two sources: the first (rank 0)
    lacks every fifth hour, the second (rank 1) has all hours and other prices."""
    h = hourly(spark, sf_dir)
    full = h.select("*", *[F.expr(e).alias(c) for c, e in MARKET_FEEDS.items()])
    first = full.where(F.hour("ts") % 5 != 0).withColumn("source_rank", F.lit(0))
    return first.unionByName(full.withColumn("rt", F.col("rt") + 1000.0).withColumn("source_rank", F.lit(1)))
