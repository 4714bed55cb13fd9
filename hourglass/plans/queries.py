"""Registered queries: one per operator of the inventory, each a Spark plan
over the driver tables (whole tables, no row caps), most with an
independent DuckDB SQL oracle.

``QUERIES[name] = (fn(spark, sf_dir) -> DataFrame, oracle_sql | None)``
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import time as T
from ..operators import aggregate as A
from ..operators import dedup as DD
from ..operators import joins as J
from ..operators import series as S
from ..sources import tables as SRC
from . import inputs as I
from .sql_inputs import DAILY, HOURLY, INTERVALS, with_ctes

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def q(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def H(body: str, *extra: str) -> str:
    return with_ctes(HOURLY, *extra, body=body)


def IV(body: str, *extra: str) -> str:
    return with_ctes(INTERVALS, *extra, body=body)


def DY(body: str, *extra: str) -> str:
    return with_ctes(DAILY, *extra, body=body)


def scalar_attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate as scalar subqueries."""
    return df.select("*", *[one_row.select(c).scalar().alias(c) for c in one_row.columns])


# thresholds as loaded at scoring time (tight 6,750 MW; mining price $40)
SCORING_TIGHT = 6750.0
SCORING_PRICE = 40.0
ADVISORY_TIGHT = 6750.0


def _ivr(spark, sf):
    d = I.with_regimes(I.intervals(spark, sf))
    p = F.when(F.col("pred_prc").isNotNull(),
               F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - F.col("pred_prc") / F.lit(6000.0))))
    return d.withColumn("p_scarcity", p)


def _hourly_pos(spark, sf):
    return S.with_position(I.hourly(spark, sf), ["ts"], None, "pos")


def daily_features(spark: SparkSession, sf: str) -> DataFrame:
    """Daily series with running monthly max, season flag, peak labels and a
    deterministic peak probability."""
    d = S.with_position(I.daily(spark, sf), ["ts"], None, "pos")
    d = S.running_period_max(d, "load_total", ["year", "month"], "monthly_load_max", None, "pos")
    d = d.withColumn("is_4cp_season", T.in_season("month"))
    labels = (d.where(F.col("month").isin(6, 7, 8, 9))
               .groupBy("year", "month")
               .agg(F.min_by("ts", F.struct(-F.col("load_total"), F.col("ts"))).alias("ts")))
    d = J.flag_membership(d, labels, ["ts"], "is_peak")
    d = d.withColumn("load_vs_monthly_max", N.safe_ratio("load_total", "monthly_load_max"))
    p = F.when((F.col("is_4cp_season") == 1) & F.col("load_vs_monthly_max").isNotNull(),
               F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("load_vs_monthly_max") - F.lit(0.5)))) \
         .otherwise(F.lit(0.0))
    return d.withColumn("p_peak", p)


def _r(c, n=6):
    return F.round(F.col(c), n).alias(c)


# ===========================================================================
# S - scans
# ===========================================================================

@q("scan_parquet_glob", "SELECT * FROM events")
def scan_parquet_glob(spark, sf):
    return SRC.scan_parquet_glob(spark, f"{sf.rstrip('/')}/event*.parquet")


# ===========================================================================
# P - projections, predicates, scalars
# ===========================================================================

@q("filter_series", "SELECT * FROM events WHERE event_type = 'view'")
def filter_series(spark, sf):
    return I.events(spark, sf).where(F.col("event_type") == "view")


@q("filter_flag", "SELECT * FROM orders WHERE o_orderstatus = 'O'")
def filter_flag(spark, sf):
    return SRC.table(spark, sf, "orders").where(F.col("o_orderstatus") == "O")


@q("project_rename", "SELECT l_orderkey AS order_key, l_linenumber AS line, "
                     "l_extendedprice AS price_R FROM lineitem WHERE l_returnflag = 'R'")
def project_rename(spark, sf):
    zone = "R"
    li = SRC.table(spark, sf, "lineitem").where(F.col("l_returnflag") == zone)
    return li.select(F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line"),
                     F.col("l_extendedprice").alias(f"price_{zone}"))


@q("hour_ending_to_ts", """
SELECT event_id, printf('%02d:00', hour(ts) + 1) AS hour_ending,
       date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts_end,
       date_trunc('hour', ts) AS ts_begin
FROM events""")
def hour_ending_to_ts(spark, sf):
    ev = I.events(spark, sf)
    he = F.format_string("%02d:00", F.hour("ts") + 1)
    d = ev.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("d"), he.alias("hour_ending"))
    d = d.withColumn("ts_end", T.hour_ending_to_ts("d", "hour_ending"))
    return d.select("event_id", "hour_ending", "ts_end", T.shift_hours("ts_end", -1).alias("ts_begin"))


@q("interval_to_ts", """
SELECT event_id, date_trunc('hour', ts) + to_minutes(CAST(15 * (minute(ts) // 15) AS BIGINT)) AS interval_start
FROM events""")
def interval_to_ts(spark, sf):
    ev = I.events(spark, sf)
    return ev.select("event_id", T.interval_to_ts(F.to_date("ts"), F.hour("ts") + 1,
                                                  F.floor(F.minute("ts") / 15).cast("int") + 1)
                     .alias("interval_start"))


@q("utc_to_market_local", """
SELECT event_id, timezone('America/Chicago', timezone('UTC', ts)) AS ts_local FROM events""")
def utc_to_market_local(spark, sf):
    return I.events(spark, sf).select("event_id", T.utc_to_market_local("ts").alias("ts_local"))


@q("strip_tz_keep_wall", "SELECT event_id, CAST(ts AS TIMESTAMP) AS wall FROM events")
def strip_tz_keep_wall(spark, sf):
    ev = I.events(spark, sf)
    s = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("-06:00"))
    return ev.select("event_id", T.strip_tz_keep_wall(s).alias("wall"))


@q("to_numeric_coerce", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_num,
       TRY_CAST(event_type AS DOUBLE) AS type_num FROM events""")
def to_numeric_coerce(spark, sf):
    ev = I.events(spark, sf)
    return ev.select("event_id", N.to_numeric(F.get_json_object("props", "$.k")).alias("k_num"),
                     N.to_numeric("event_type").alias("type_num"))


@q("calendar_features", H("""
SELECT ts, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
       CAST(month(ts) AS INTEGER) AS month,
       CASE WHEN isodow(ts) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date, CAST(year(ts) AS INTEGER) AS year,
       round(sin(2 * pi() * hour(ts) / 24.0), 9) AS hour_sin,
       round(cos(2 * pi() * hour(ts) / 24.0), 9) AS hour_cos,
       CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 1 ELSE 0 END AS is_pre_rtcb,
       CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS days_since_start
FROM hourly"""))
def calendar_features(spark, sf):
    h = I.hourly(spark, sf)
    cal = T.calendar_columns("ts")
    cyc = T.cyclic_hour(F.hour("ts"))
    cal["date"] = cal["date"].cast("timestamp_ntz")
    return h.select("ts", *[v.alias(k) for k, v in cal.items()],
                    F.round(cyc["hour_sin"], 9).alias("hour_sin"), F.round(cyc["hour_cos"], 9).alias("hour_cos"),
                    T.era_flag("ts", "2024-01-15").alias("is_pre_rtcb"),
                    T.days_since("ts", "2024-01-01").alias("days_since_start"))


@q("log1p_transform", IV("""
SELECT event_id, round(ln(1 + rt + o), 9) AS rt_log, round(exp(ln(1 + rt + o)) - 1 - o, 6) AS rt_back
FROM iv, off""", "off AS (SELECT abs(min(rt)) + 1 AS o FROM iv)"))
def log1p_transform(spark, sf):
    iv = I.intervals(spark, sf)
    off = iv.agg((F.abs(F.min("rt")) + 1).alias("o"))
    d = scalar_attach(iv, off)
    lg = N.log1p_offset("rt", F.col("o"))
    return d.select("event_id", F.round(lg, 9).alias("rt_log"),
                    F.round(N.expm1_offset(lg, F.col("o")), 6).alias("rt_back"))


@q("cap_outliers_to_null", IV("""
SELECT event_id, CASE WHEN prc > 10000 THEN NULL ELSE prc END AS prc_capped,
       CASE WHEN rt - 50 < 0 THEN NULL ELSE rt - 50 END AS rt_excess FROM iv0"""))
def cap_outliers_to_null(spark, sf):
    ev = I.events(spark, sf)
    prc = (F.lit(I.PRC_PER_K) * F.get_json_object("props", "$.k").try_cast("int")).cast("double")
    return ev.select("event_id", N.cap_to_null(prc, 10000.0).alias("prc_capped"),
                     N.negative_to_null(F.col("value") - 50).alias("rt_excess"))


@q("ratio_net_features", H("""
SELECT ts, round(load_total - wind - zone_signup, 6) AS net_load,
       round(CASE WHEN load_total = 0 THEN NULL ELSE (wind + zone_signup) / load_total END, 9) AS renewable_pct,
       round(CASE WHEN hub_load = 0 THEN NULL ELSE wind / hub_load END, 9) AS wind_load_ratio,
       round(rt - dam, 6) AS spread
FROM hourly"""))
def ratio_net_features(spark, sf):
    h = I.hourly(spark, sf)
    return h.select("ts", F.round(F.col("load_total") - F.col("wind") - F.col("zone_signup"), 6).alias("net_load"),
                    F.round(N.safe_ratio(F.col("wind") + F.col("zone_signup"), "load_total"), 9).alias("renewable_pct"),
                    F.round(N.safe_ratio("wind", "hub_load"), 9).alias("wind_load_ratio"),
                    F.round(F.col("rt") - F.col("dam"), 6).alias("spread"))


@q("season_window_flags", DY("""
SELECT ts, is_4cp_season, CASE WHEN month IN (6,7,8,9) AND day_of_week BETWEEN 1 AND 3 THEN 1 ELSE 0 END AS in_window
FROM dailys"""))
def season_window_flags(spark, sf):
    d = I.daily(spark, sf)
    return d.select("ts", T.in_season("month").alias("is_4cp_season"),
                    ((F.col("month").isin(6, 7, 8, 9)) & F.col("day_of_week").between(1, 3))
                    .cast("int").alias("in_window"))


@q("bucketize_regime", IV("SELECT event_id, prc, regime FROM ivr"))
def bucketize_regime(spark, sf):
    return I.with_regimes(I.intervals(spark, sf)).select("event_id", "prc", "regime")


@q("price_tier", IV("""
SELECT event_id, rt, CASE WHEN rt < 0 THEN 'negative' WHEN rt >= 0 AND rt <= 40 THEN 'low'
  WHEN rt > 40 AND rt <= 100 THEN 'medium' WHEN rt > 100 THEN 'high' END AS tier FROM iv0"""))
def price_tier_q(spark, sf):
    ev = I.events(spark, sf)
    return ev.select("event_id", F.col("value").alias("rt"), N.price_tier("value").alias("tier"))


@q("numeric_projection", H("""
SELECT rt, dam, prc, load_total, hub_load, wind, zone_view, zone_click, zone_signup, zone_error
FROM hourly"""))
def numeric_projection(spark, sf):
    h = I.hourly(spark, sf)
    drop = {"n_events"}
    numeric = [f.name for f in h.schema.fields
               if f.name not in drop and f.dataType.typeName() in ("double", "float", "integer", "long")]
    return h.select(*numeric)


@q("fill_constant", IV("""
SELECT event_id, coalesce(dam, 0.0) AS dam, coalesce(pred_prc, 0.0) AS pred_prc,
       coalesce(pred_price, 0.0) AS pred_price FROM iv"""))
def fill_constant(spark, sf):
    return I.intervals(spark, sf).na.fill(0.0, ["dam", "pred_prc", "pred_price"]) \
        .select("event_id", "dam", "pred_prc", "pred_price")


@q("drop_null_rows", H("SELECT * FROM hourly WHERE dam IS NOT NULL AND prc IS NOT NULL"))
def drop_null_rows(spark, sf):
    return I.hourly(spark, sf).na.drop(subset=["dam", "prc"])


@q("date_range_split", IV("""
SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 'train'
  WHEN ts < TIMESTAMP '2024-01-22' THEN 'validation' ELSE 'test' END AS split
FROM iv0 WHERE NOT (ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-09')"""))
def date_range_split(spark, sf):
    ev = I.events(spark, sf)
    ts = F.col("ts")
    holdout = (ts >= F.to_timestamp_ntz(F.lit("2024-01-08"))) & (ts < F.to_timestamp_ntz(F.lit("2024-01-09")))
    split = (F.when(ts < F.to_timestamp_ntz(F.lit("2024-01-15")), "train")
              .when(ts < F.to_timestamp_ntz(F.lit("2024-01-22")), "validation").otherwise("test"))
    return ev.where(~holdout).select("event_id", split.alias("split"))


@q("coalesce_total", H("""
SELECT ts, coalesce(zone_view + zone_click + zone_signup + zone_error, load_total) AS total_resource
FROM hourly"""))
def coalesce_total(spark, sf):
    h = I.hourly(spark, sf)
    return h.select("ts", N.coalesce_total(["zone_view", "zone_click", "zone_signup", "zone_error"],
                                           "load_total").alias("total_resource"))


# ===========================================================================
# D - dedup / upsert   (lineitem key (l_orderkey, l_linenumber))
# ===========================================================================

_LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus"]
_LI_COLS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, " \
           "l_tax, l_returnflag, l_linestatus, l_shipdate"


def _li_sql(order_dir: str, where: str = "", src: str = "lineitem") -> str:
    o = ", ".join(f"{c} {order_dir}" for c in _LI_ORDER)
    return (f"SELECT {_LI_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
            f"ORDER BY {o}) AS rk FROM {src} {where}) WHERE rk = 1")


@q("dedup_keep_first", _li_sql("ASC"))
def dedup_keep_first(spark, sf):
    return DD.keep_first(SRC.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _LI_ORDER)


@q("dedup_latest_vintage", _li_sql("DESC"))
def dedup_latest_vintage(spark, sf):
    return DD.keep_latest(SRC.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _LI_ORDER)


@q("scd1_upsert", _li_sql("DESC"))
def scd1_upsert(spark, sf):
    li = SRC.table(spark, sf, "lineitem")
    cut = F.to_timestamp_ntz(F.lit("1996-01-01"))
    current = DD.keep_latest(li.where(F.col("l_shipdate") < cut), ["l_orderkey", "l_linenumber"], _LI_ORDER)
    changes = li.where(~(F.col("l_shipdate") < cut) | F.col("l_shipdate").isNull())
    return DD.scd1_upsert(current, changes, ["l_orderkey", "l_linenumber"], _LI_ORDER)


@q("priority_union", f"""
SELECT {_LI_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
     ORDER BY src, {', '.join(_LI_ORDER)}) AS rk
  FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS src FROM lineitem)) WHERE rk = 1""")
def priority_union(spark, sf):
    li = SRC.table(spark, sf, "lineitem")
    first = li.where(F.col("l_returnflag") == "R")
    second = li.where(~(F.col("l_returnflag") == "R") | F.col("l_returnflag").isNull())
    return DD.priority_union([first, second], ["l_orderkey", "l_linenumber"], _LI_ORDER)


# ===========================================================================
# J - joins
# ===========================================================================

@q("time_spine", H("SELECT ts FROM spine"))
def time_spine(spark, sf):
    return J.time_spine(I.hourly_feeds(I.events(spark, sf)), "ts")


@q("spine_left_join", H("SELECT * FROM hourly"))
def spine_left_join(spark, sf):
    return I.hourly(spark, sf)


@q("asof_backward", """
WITH u AS (
  SELECT user_id, ts, 1 AS side, event_id, NULL::DOUBLE AS view_value, NULL::TIMESTAMP AS view_ts
  FROM events WHERE event_type = 'purchase'
  UNION ALL
  SELECT user_id, ts, 0 AS side, event_id, value, ts FROM events WHERE event_type = 'view')
SELECT user_id, ts, event_id, value, view_value, view_ts FROM (
  SELECT u.user_id, u.ts, u.side, u.event_id, e.value,
         last_value(u.view_value IGNORE NULLS) OVER w AS view_value,
         last_value(u.view_ts IGNORE NULLS) OVER w AS view_ts
  FROM u LEFT JOIN events e ON u.side = 1 AND e.event_id = u.event_id
  WINDOW w AS (PARTITION BY u.user_id ORDER BY u.ts, u.side, u.event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
WHERE side = 1""")
def asof_backward(spark, sf):
    ev = I.events(spark, sf)
    purchases = ev.where(F.col("event_type") == "purchase").select("user_id", "ts", "event_id", "value")
    views = ev.where(F.col("event_type") == "view").select(
        "user_id", "ts", "event_id", F.col("value").alias("view_value"))
    return J.asof_backward(purchases, views, "ts", ["user_id"], ["view_value"], "event_id", "event_id",
                           matched_ts_col="view_ts")


@q("semi_join_labels", H("""
SELECT h.ts, h.load_total, CASE WHEN lab.ts IS NULL THEN 0 ELSE 1 END AS is_peak
FROM hourly h LEFT JOIN lab ON h.ts = lab.ts""", """lab AS (SELECT ts FROM (SELECT ts, row_number() OVER
  (PARTITION BY date_trunc('week', ts) ORDER BY load_total DESC, ts) AS rk
  FROM hourly WHERE load_total IS NOT NULL) WHERE rk = 1)"""))
def semi_join_labels(spark, sf):
    h = I.hourly(spark, sf)
    labels = (h.where(F.col("load_total").isNotNull())
               .groupBy(T.trunc_ntz("ts", "week").alias("wk"))
               .agg(F.min_by("ts", F.struct(-F.col("load_total"), F.col("ts"))).alias("ts")))
    return J.flag_membership(h.select("ts", "load_total"), labels, ["ts"], "is_peak")


@q("score_alignment", IV("""
SELECT event_id, pred_price, dam FROM iv WHERE pred_price IS NOT NULL AND dam IS NOT NULL"""))
def score_alignment(spark, sf):
    iv = I.intervals(spark, sf)
    a = iv.where(F.col("pred_price").isNotNull()).select("event_id", "pred_price")
    b = iv.where(F.col("dam").isNotNull()).select("event_id", "dam")
    return J.align_scored(a, b, ["event_id"])


# ===========================================================================
# A - aggregations
# ===========================================================================

@q("resample_mean", """
SELECT event_type, date_trunc('hour', ts) AS ts, round(avg(value), 9) AS value
FROM events GROUP BY 1, 2""")
def resample_mean(spark, sf):
    r = A.resample(I.events(spark, sf), "ts", ["value"], "mean", ["event_type"])
    return r.select("event_type", "ts", _r("value", 9))


@q("resample_min", """
SELECT event_type, date_trunc('hour', ts) AS ts, min(value) AS value FROM events GROUP BY 1, 2""")
def resample_min(spark, sf):
    return A.resample(I.events(spark, sf), "ts", ["value"], "min", ["event_type"])


@q("group_profile", """
SELECT CAST(hour(ts) AS INTEGER) AS hour, round(avg(value), 9) AS mean_value, count(value) AS n
FROM events WHERE NOT (ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-08') GROUP BY 1""")
def group_profile(spark, sf):
    ev = I.events(spark, sf)
    excl = (F.col("ts") >= F.to_timestamp_ntz(F.lit("2024-01-01"))) & \
           (F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-08")))
    g = A.group_profile(ev, F.hour("ts").alias("hour"), "value", exclude=excl)
    return g.select("hour", _r("mean_value", 9), "n")


@q("event_count_by_day", IV("""
SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date, count(*) AS n_hours FROM iv0
WHERE prc > 0 AND prc <= 3000 GROUP BY 1"""))
def event_count_by_day(spark, sf):
    iv = I.with_regimes(I.events(spark, sf).select(
        "ts", (F.lit(I.PRC_PER_K) * F.get_json_object("props", "$.k").try_cast("int")).cast("double")
        .alias("prc"), F.lit(None).cast("double").alias("pred_prc")))
    out = A.event_count_by_day(iv, "ts", F.col("regime") == "Scarcity")
    return out.withColumn("date", F.col("date").cast("timestamp_ntz"))


@q("value_counts", IV("SELECT regime, count(*) AS n FROM ivr GROUP BY 1"))
def value_counts(spark, sf):
    return A.value_counts(I.with_regimes(I.intervals(spark, sf)), "regime")


@q("describe", IV("""
SELECT 'rt' AS "column", count(rt) AS count, round(avg(rt), 6) AS mean, round(stddev_samp(rt), 6) AS std,
       min(rt) AS min, round(quantile_cont(rt, 0.25), 6) AS q25, round(quantile_cont(rt, 0.5), 6) AS q50,
       round(quantile_cont(rt, 0.75), 6) AS q75, max(rt) AS max FROM iv0
UNION ALL
SELECT 'prc', count(prc), round(avg(prc), 6), round(stddev_samp(prc), 6), min(prc),
       round(quantile_cont(prc, 0.25), 6), round(quantile_cont(prc, 0.5), 6),
       round(quantile_cont(prc, 0.75), 6), max(prc) FROM iv0"""))
def describe(spark, sf):
    ev = I.events(spark, sf).select(
        F.col("value").alias("rt"),
        (F.lit(I.PRC_PER_K) * F.get_json_object("props", "$.k").try_cast("int")).cast("double").alias("prc"))
    d = A.describe(ev, ["rt", "prc"])
    return d.select("column", "count", *[_r(c) for c in ("mean", "std")], "min",
                    *[_r(c) for c in ("q25", "q50", "q75")], "max")


_QS = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


_QL = "[" + ", ".join(str(x) for x in _QS) + "]::DOUBLE[]"


@q("quantiles", f"""
SELECT q, round(v, 6) AS value FROM (
  SELECT unnest(qs) AS q, unnest(vs) AS v FROM (
    SELECT {_QL} AS qs, quantile_cont(value, {_QL}) AS vs FROM events))""")
def quantiles(spark, sf):
    return A.exact_quantiles(I.events(spark, sf), "value", _QS).select("q", _r("value"))


@q("null_profile", H("""
SELECT 'dam' AS "column", count(*) FILTER (WHERE dam IS NULL) AS n_null,
       min(ts) FILTER (WHERE dam IS NULL) AS first_null, max(ts) FILTER (WHERE dam IS NULL) AS last_null FROM hourly
UNION ALL SELECT 'prc', count(*) FILTER (WHERE prc IS NULL), min(ts) FILTER (WHERE prc IS NULL),
       max(ts) FILTER (WHERE prc IS NULL) FROM hourly
UNION ALL SELECT 'hub_load', count(*) FILTER (WHERE hub_load IS NULL), min(ts) FILTER (WHERE hub_load IS NULL),
       max(ts) FILTER (WHERE hub_load IS NULL) FROM hourly
UNION ALL SELECT 'wind', count(*) FILTER (WHERE wind IS NULL), min(ts) FILTER (WHERE wind IS NULL),
       max(ts) FILTER (WHERE wind IS NULL) FROM hourly"""))
def null_profile(spark, sf):
    return A.null_profile(I.hourly(spark, sf), ["dam", "prc", "hub_load", "wind"], "ts")


@q("histogram", """
WITH s AS (SELECT min(value) AS mn, max(value) AS mx FROM events)
SELECT CAST(least(floor((value - mn) * 100.0 / (mx - mn)), 99) AS INTEGER) AS bin,
       round(mn + least(floor((value - mn) * 100.0 / (mx - mn)), 99) * ((mx - mn) / 100), 6) AS lower,
       round(mn + (least(floor((value - mn) * 100.0 / (mx - mn)), 99) + 1) * ((mx - mn) / 100), 6) AS upper,
       count(*) AS n
FROM events, s WHERE value IS NOT NULL GROUP BY 1, 2, 3""")
def histogram(spark, sf):
    h = A.histogram(I.events(spark, sf), "value", 100)
    return h.select("bin", _r("lower"), _r("upper"), "n")


_CORR_COLS = ("dam", "prc", "load_total", "hub_load", "wind")


@q("correlation", H("\n".join(
    [("UNION ALL " if i else "") + f"SELECT '{c}' AS feature, round(corr({c}, rt), 6) AS corr FROM hourly"
     for i, c in enumerate(_CORR_COLS)])))
def correlation(spark, sf):
    return A.correlation(I.hourly(spark, sf), "rt", list(_CORR_COLS)).select("feature", _r("corr"))


@q("daily_rollup", H("""
SELECT CAST(date AS TIMESTAMP) AS date, round(aft_load_max, 6) AS aft_load_max, round(aft_load_mean, 6) AS aft_load_mean,
       round(aft_load_std, 6) AS aft_load_std, round(temp_max, 6) AS temp_max,
       round(temp_mean, 6) AS temp_mean, round(wind_mean, 6) AS wind_mean, price_max,
       round(load_max, 6) AS load_max,
       round(lag(cm) OVER (ORDER BY date), 6) AS monthly_peak_prev_raw,
       round(temp_max - lag(temp_max) OVER (ORDER BY date), 6) AS temp_change
FROM d1""", """d0 AS (
  SELECT CAST(ts AS DATE) AS date,
         max(load_total) FILTER (WHERE hour(ts) BETWEEN 14 AND 19) AS aft_load_max,
         avg(load_total) FILTER (WHERE hour(ts) BETWEEN 14 AND 19) AS aft_load_mean,
         stddev_samp(load_total) FILTER (WHERE hour(ts) BETWEEN 14 AND 19) AS aft_load_std,
         max(hub_load) AS temp_max, avg(hub_load) AS temp_mean, avg(wind) AS wind_mean,
         max(rt) AS price_max, max(load_total) AS load_max
  FROM hourly GROUP BY 1)""", """d1 AS (SELECT *, CASE WHEN load_max IS NULL THEN NULL ELSE
  max(load_max) OVER (PARTITION BY year(date), month(date) ORDER BY date
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS cm FROM d0)"""))
def daily_rollup(spark, sf):
    d = A.daily_rollup(I.hourly(spark, sf))
    return d.select(F.col("date").cast("timestamp_ntz").alias("date"), *[_r(c) for c in ("aft_load_max", "aft_load_mean", "aft_load_std", "temp_max",
                                              "temp_mean", "wind_mean")], "price_max", _r("load_max"),
                    F.round("monthly_peak_prev", 6).alias("monthly_peak_prev_raw"), _r("temp_change"))


# ===========================================================================
# W - positional window operators
# ===========================================================================

_LAGS = [("rt", 1), ("rt", 24), ("rt", 168), ("dam", 1), ("dam", 24), ("dam", 168),
         ("load_total", 24), ("wind", 24), ("wind", 168), ("prc", 1), ("prc", 24), ("prc", 168)]


@q("lag_features", H("SELECT ts, " + ", ".join(
    f"lag({c}, {k}) OVER (ORDER BY ts) AS {c}_{k}h_lag" for c, k in _LAGS) + " FROM hourly"))
def lag_features(spark, sf):
    h = _hourly_pos(spark, sf)
    out = S.halo_windows(h, [S.Lag(c, k, f"{c}_{k}h_lag") for c, k in _LAGS], None, "pos")
    return out.select("ts", *[f"{c}_{k}h_lag" for c, k in _LAGS])


@q("lag_features_by_series", IV("""
SELECT event_id, pos, round(dam, 9) AS dam, pred_prc, pred_price,
       lag(rt, 24) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rt_24_lag FROM iv"""))
def lag_features_by_series(spark, sf):
    out = I.intervals(spark, sf, extra_specs=[S.Lag("rt", 24, "rt_24_lag")])
    return out.select("event_id", "pos", _r("dam", 9), "pred_prc", "pred_price", "rt_24_lag")


@q("spike_lag_flag", IV("""
SELECT event_id, coalesce(CAST(lag(rt) OVER (PARTITION BY user_id ORDER BY ts, event_id) > 100 AS INTEGER), 0)
  AS price_spike_lag FROM iv0"""))
def spike_lag_flag(spark, sf):
    iv = I.intervals(spark, sf, extra_specs=[S.LagAbove("rt", 100.0, "price_spike_lag")])
    return iv.select("event_id", "price_spike_lag")


def _roll_sql(c, n, fn):
    f = {"mean": "avg", "std": "stddev_samp", "max": "max"}[fn]
    w = f"(ORDER BY ts ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"round(CASE WHEN count({c}) OVER {w} = {n} THEN {f}({c}) OVER {w} END, 6) AS {c}_roll_{fn}_{n}h"


_ROLLS = [(c, n, fn) for c in ("rt", "dam", "load_total", "wind") for n in (6, 24) for fn in ("mean", "std")] + \
         [("prc", 6, "mean"), ("prc", 6, "std"), ("prc", 24, "mean"), ("hub_load", 3, "max")]


@q("rolling_stats", H("SELECT ts, " + ", ".join(_roll_sql(*r) for r in _ROLLS) + " FROM hourly"))
def rolling_stats(spark, sf):
    h = _hourly_pos(spark, sf)
    specs = [S.Rolling(c, n, fn, f"{c}_roll_{fn}_{n}h") for c, n, fn in _ROLLS]
    out = S.halo_windows(h, specs, None, "pos")
    return out.select("ts", *[_r(s.name) for s in specs])


@q("rolling_by_series", IV("""
SELECT event_id,
  round(CASE WHEN count(rt) OVER w = 6 THEN avg(rt) OVER w END, 6) AS rt_roll_mean_6,
  round(CASE WHEN count(rt) OVER w = 6 THEN stddev_samp(rt) OVER w END, 6) AS rt_roll_std_6,
  CASE WHEN count(rt) OVER w3 = 3 THEN max(rt) OVER w3 END AS rt_roll_max_3
FROM iv0 WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING),
  w3 AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"""))
def rolling_by_series(spark, sf):
    specs = [S.Rolling("rt", 6, "mean", "rt_roll_mean_6"), S.Rolling("rt", 6, "std", "rt_roll_std_6"),
             S.Rolling("rt", 3, "max", "rt_roll_max_3")]
    out = I.intervals(spark, sf, extra_specs=specs)
    return out.select("event_id", _r("rt_roll_mean_6"), _r("rt_roll_std_6"), "rt_roll_max_3")


@q("ramp_diff", H("""
SELECT ts, round(load_total - lag(load_total) OVER (ORDER BY ts), 6) AS load_total_ramp,
  round(hub_load - lag(hub_load) OVER (ORDER BY ts), 6) AS hub_load_ramp,
  round(wind - lag(wind) OVER (ORDER BY ts), 6) AS wind_ramp,
  round(rt - lag(rt) OVER (ORDER BY ts), 6) AS rt_ramp FROM hourly"""))
def ramp_diff(spark, sf):
    h = _hourly_pos(spark, sf)
    specs = [S.Diff("load_total", "load_total_ramp"), S.Diff("hub_load", "hub_load_ramp"),
             S.Diff("wind", "wind_ramp"), S.Diff("rt", "rt_ramp")]
    return S.halo_windows(h, specs, None, "pos").select("ts", *[_r(s.name) for s in specs])


@q("running_period_max", DY("""
SELECT ts, round(load_total, 6) AS load_total,
       round(CASE WHEN load_total IS NULL THEN NULL ELSE monthly_load_max END, 6) AS monthly_load_max
FROM daily"""))
def running_period_max(spark, sf):
    d = S.with_position(I.daily(spark, sf), ["ts"], None, "pos")
    d = S.running_period_max(d, "load_total", ["year", "month"], "monthly_load_max", None, "pos")
    return d.select("ts", _r("load_total"), _r("monthly_load_max"))


@q("vs_running_max", DY("""
SELECT ts, round(load_vs_monthly_max, 9) AS load_vs_monthly_max,
       round(load_total - monthly_load_max, 6) AS load_above_monthly_max,
       round(CASE WHEN monthly_load_max = 0 THEN NULL ELSE avg_price * n_orders / monthly_load_max END, 9)
         AS load_fcst_vs_monthly_max
FROM dailys"""))
def vs_running_max(spark, sf):
    d = daily_features(spark, sf)
    fc = F.col("avg_price") * F.col("n_orders")
    return d.select("ts", F.round("load_vs_monthly_max", 9).alias("load_vs_monthly_max"),
                    F.round(F.col("load_total") - F.col("monthly_load_max"), 6).alias("load_above_monthly_max"),
                    F.round(N.safe_ratio(fc, "monthly_load_max"), 9).alias("load_fcst_vs_monthly_max"))


@q("forward_back_fill", H("""
SELECT ts, coalesce(rt_f, rt_b) AS rt, coalesce(dam_f, dam_b) AS dam, coalesce(prc_f, prc_b) AS prc FROM f
""", """f AS (SELECT ts, last_value(rt IGNORE NULLS) OVER w AS rt_f, last_value(dam IGNORE NULLS) OVER w AS dam_f,
            last_value(prc IGNORE NULLS) OVER w AS prc_f,
            first_value(rt IGNORE NULLS) OVER w2 AS rt_b, first_value(dam IGNORE NULLS) OVER w2 AS dam_b,
            first_value(prc IGNORE NULLS) OVER w2 AS prc_b
       FROM hourly WINDOW w AS (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                          w2 AS (ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""))
def forward_back_fill(spark, sf):
    h = _hourly_pos(spark, sf)
    return S.fill_forward_backward(h, ["rt", "dam", "prc"], None, "pos").select("ts", "rt", "dam", "prc")


@q("interpolate_linear", H("""
SELECT ts, round(CASE WHEN prc IS NOT NULL THEN prc
                      WHEN p0 IS NOT NULL AND p1 IS NOT NULL THEN (v1 - v0) / (p1 - p0) * (pos - p0) + v0
                      WHEN p0 IS NOT NULL THEN v0 END, 6) AS prc FROM p""", """p AS (SELECT ts, pos, prc,
          last_value(CASE WHEN prc IS NOT NULL THEN pos END IGNORE NULLS) OVER w AS p0,
          last_value(prc IGNORE NULLS) OVER w AS v0,
          first_value(CASE WHEN prc IS NOT NULL THEN pos END IGNORE NULLS) OVER w2 AS p1,
          first_value(prc IGNORE NULLS) OVER w2 AS v1
        FROM hourly_pos WINDOW w AS (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                               w2 AS (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""))
def interpolate_linear(spark, sf):
    h = _hourly_pos(spark, sf)
    return S.interpolate_linear(h, ["prc"], None, "pos").select("ts", _r("prc"))


@q("warmup_drop", H("SELECT ts, rt, prc FROM hourly_pos WHERE pos >= 168"))
def warmup_drop(spark, sf):
    return S.position_filter(_hourly_pos(spark, sf), 168).select("ts", "rt", "prc")


@q("lag_react_signal", IV("""
SELECT event_id, CAST(coalesce(pred_price, 0) > 60 AS INTEGER) AS lag_react_60 FROM iv"""))
def lag_react_signal(spark, sf):
    iv = I.intervals(spark, sf)
    return iv.select("event_id", (F.coalesce("pred_price", F.lit(0.0)) > 60).cast("int").alias("lag_react_60"))


@q("rank_within_group", DY("""
SELECT ts, year, month, round(p_peak, 9) AS p_peak,
       row_number() OVER (PARTITION BY year, month ORDER BY p_peak DESC, ts) AS rank FROM dailys"""))
def rank_within_group(spark, sf):
    from pyspark.sql import Window
    d = daily_features(spark, sf)
    w = Window.partitionBy("year", "month").orderBy(F.col("p_peak").desc(), "ts")
    return d.select("ts", "year", "month", _r("p_peak", 9), F.row_number().over(w).cast("long").alias("rank"))


# ===========================================================================
# T / U - sort, limit, union
# ===========================================================================

@q("tail_n", H("SELECT ts, rt, prc FROM hourly ORDER BY ts DESC LIMIT 24"))
def tail_n(spark, sf):
    return I.hourly(spark, sf).orderBy(F.col("ts").desc()).limit(24).select("ts", "rt", "prc")


@q("top_k_importance", H("""
SELECT feature, abs_corr FROM (SELECT feature, round(abs(c), 6) AS abs_corr FROM (
""" + "\nUNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, rt) AS c FROM hourly" for c in _CORR_COLS) +
    ")) ORDER BY abs_corr DESC, feature LIMIT 3"))
def top_k_importance(spark, sf):
    c = A.correlation(I.hourly(spark, sf), "rt", list(_CORR_COLS))
    return c.select("feature", F.round(F.abs("corr"), 6).alias("abs_corr")) \
            .orderBy(F.col("abs_corr").desc(), "feature").limit(3)


@q("filtered_sample", IV("""
SELECT event_id, ts, rt FROM iv0 WHERE rt > 300 ORDER BY rt DESC, event_id LIMIT 10"""))
def filtered_sample(spark, sf):
    ev = I.events(spark, sf, F.col("value") > 300)
    return ev.orderBy(F.col("value").desc(), "event_id").limit(10) \
             .select("event_id", "ts", F.col("value").alias("rt"))


@q("union_all", """
SELECT 'orders' AS source, CAST(o_orderdate AS TIMESTAMP) AS ts, o_totalprice AS value FROM orders
UNION ALL SELECT 'lineitem', l_shipdate, l_extendedprice FROM lineitem""")
def union_all(spark, sf):
    o = SRC.table(spark, sf, "orders").select(F.lit("orders").alias("source"),
                                              F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("value"))
    li = SRC.table(spark, sf, "lineitem").select(F.lit("lineitem").alias("source"),
                                                 F.col("l_shipdate").alias("ts"),
                                                 F.col("l_extendedprice").alias("value"))
    return o.unionByName(li)


@q("time_lag_features", H("""
SELECT h.ts, a.rt AS rt_1h_ago, b.rt AS rt_24h_ago, b.prc AS prc_24h_ago
FROM hourly h LEFT JOIN hourly a ON a.ts = h.ts - INTERVAL 1 HOUR
              LEFT JOIN hourly b ON b.ts = h.ts - INTERVAL 24 HOUR"""))
def time_lag_features(spark, sf):
    """W1 with ``mode='time'``: lags by clock offset instead of row count."""
    h = I.hourly(spark, sf).select("ts", "rt", "prc")
    out = S.time_lags(h, "ts", [("rt", 1), ("rt", 24), ("prc", 24)])
    return out.select("ts", "rt_1h_ago", "rt_24h_ago", "prc_24h_ago")
