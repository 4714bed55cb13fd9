"""Source / sink queries (S1-S8) and single-operator views of composite
queries (P6, P9, P12-P14, P16, W3-W5, T1, A12, M12, M13).

Source queries first land the given table in the shared scratch folder in
the delivery format being exercised (CSV files, mixed CSV + parquet, schema
variants, per-sheet files, nested JSON documents) with a Spark write, then
read it back through the operator - so the work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import time as T
from ..operators import aggregate as A
from ..operators import models as M
from ..operators import series as S
from ..sources import sinks
from ..sources import tables as SRC
from ..streaming.streams import scratch_dir
from . import inputs as I
from .queries import H, IV, _hourly_pos, _r, q
from .queries_models import model_table

_EV = "SELECT * FROM events"


def _events_raw(spark, sf):
    return spark.read.parquet(f"{sf.rstrip('/')}/events.parquet")


def _write_csv(df, path):
    (df.write.mode("overwrite").option("header", True).option("timestampNTZFormat", SRC.CSV_TS_FORMAT)
       .csv(path))


# ---------------------------------------------------------------------------
# S1-S8
# ---------------------------------------------------------------------------

@q("bronze_ingest", "SELECT event_id, ts, user_id, event_type, value, props, "
                    "CASE WHEN event_type = 'click' THEN value END AS click_value FROM events")
def bronze_ingest(spark, sf):
    ev = _events_raw(spark, sf)
    base = scratch_dir(spark, "bronze-batch")
    # an older delivery without the newer column, and a newer one with it
    ev.where(F.col("event_type") != "click").write.parquet(f"{base}/part=old")
    ev.where(F.col("event_type") == "click").withColumn("click_value", F.col("value")) \
      .write.parquet(f"{base}/part=new")
    b = SRC.bronze_ingest(spark, base)
    return b.where(F.col("_ingested_at").isNotNull() & F.col("source_file").isNotNull()) \
            .select("event_id", "ts", "user_id", "event_type", "value", "props", "click_value")


@q("scan_csv_multi", _EV)
def scan_csv_multi(spark, sf):
    ev = _events_raw(spark, sf)
    path = scratch_dir(spark, "csv")
    _write_csv(ev.repartition(5, "event_type"), path)
    return SRC.scan_csv_multi(spark, f"{path}/*.csv", ev.schema).select(*ev.columns)


@q("scan_mixed_format", _EV)
def scan_mixed_format(spark, sf):
    ev = _events_raw(spark, sf)
    base = scratch_dir(spark, "mixed")
    is_csv = F.col("event_type").isin("view", "click")
    _write_csv(ev.where(is_csv), f"{base}/csv")
    ev.where(~is_csv).write.parquet(f"{base}/pq")
    out = SRC.scan_mixed_format(spark, f"{base}/csv/*.csv", f"{base}/pq", ev.schema)
    return out.select(*ev.columns)


_VARIANTS = {"event_id": ["event_id", "EventId"], "ts": ["interval_start_local", "time_local", "ts"],
             "value": ["value", "spp"]}


@q("schema_variant_normalize", "SELECT event_id, ts, value FROM events")
def schema_variant_normalize(spark, sf):
    ev = _events_raw(spark, sf)
    base = scratch_dir(spark, "variants")
    # two delivery eras with different column names and case
    ev.where(F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-15"))) \
      .select(F.col("event_id").alias("EventId"), F.col("ts").alias("Interval_Start_Local"),
              F.col("value").alias("SPP")).write.parquet(f"{base}/a")
    ev.where(~(F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-15")))) \
      .select("event_id", F.col("ts").alias("time_local"), "value").write.parquet(f"{base}/b")
    return SRC.union_variants([spark.read.parquet(f"{base}/a"), spark.read.parquet(f"{base}/b")], _VARIANTS)


@q("long_sheets_union", """
SELECT date_trunc('hour', ts) AS ts, round(avg(value), 9) AS value FROM events
WHERE event_type <> 'signup' GROUP BY 1""")
def long_sheets_union(spark, sf):
    ev = _events_raw(spark, sf)
    base = scratch_dir(spark, "sheets")
    names = ["view", "click", "purchase", "error", "signup"]
    for n in names:
        # one landed file per sheet with padded header names; "signup" plays
        # the report-info sheet that must be skipped
        ev.where(F.col("event_type") == n).select(F.col("ts").alias(" SCED Timestamp "),
                                                  F.col("value").alias("PRC ")).write.parquet(f"{base}/{n}")
    sheets = [spark.read.parquet(f"{base}/{n}") for n in names]
    u = SRC.long_sheets_union(sheets, skip_names=("signup",), names=names)
    r = A.resample(u, "SCED Timestamp", ["PRC"], "mean")
    return r.select("ts", F.round("PRC", 9).alias("value"))


@q("nested_arrays_to_rows", H("SELECT ts, round(rt, 9) AS rt, round(load_total, 6) AS load_total FROM feeds"))
def nested_arrays_to_rows(spark, sf):
    feeds = I.hourly_feeds(I.events(spark, sf))
    # one JSON document per day: {"hourly": {"time": [...], "rt": [...], "load_total": [...]}}
    # (at most 24 entries per array: bounded by the calendar)
    docs = feeds.groupBy(F.to_date("ts").alias("d")).agg(
        F.sort_array(F.collect_list(F.struct("ts", "rt", "load_total"))).alias("h"))
    docs = docs.select(F.struct(F.transform("h", lambda x: F.date_format(x["ts"], "yyyy-MM-dd'T'HH:mm"))
                                .alias("time"),
                                F.transform("h", lambda x: x["rt"]).alias("rt"),
                                F.transform("h", lambda x: x["load_total"]).alias("load_total")).alias("hourly"))
    path = scratch_dir(spark, "json")
    docs.write.json(path)
    raw = spark.read.json(path)
    out = SRC.nested_arrays_to_rows(raw, "hourly", "time", ["rt", "load_total"])
    return out.select("ts", F.round("rt", 9).alias("rt"), F.round("load_total", 6).alias("load_total"))


@q("sink_parquet", H("SELECT * FROM hourly"))
def sink_parquet(spark, sf):
    h = I.hourly(spark, sf)
    path = scratch_dir(spark, "sink")
    sinks.sink_parquet(h.withColumn("day", F.to_date("ts")), path, partition_by=["day"], sort_within=["ts"])
    return spark.read.parquet(path).drop("day").select(*h.columns)


@q("sort_by_time", H("SELECT ts, rt FROM hourly"))
def sort_by_time(spark, sf):
    """The sorted landing read back."""
    path = scratch_dir(spark, "sorted")
    sinks.sink_sorted(I.hourly(spark, sf).select("ts", "rt"), path, ["ts"])
    return spark.read.parquet(path)


@q("sorted_landing", "SELECT count(*) AS n_rows, true AS rows_in_order, true AS files_disjoint FROM events")
def sorted_landing(spark, sf):
    """Every event in files by time; the manifest tells whether the files are disjoint and each one is in order."""
    path = scratch_dir(spark, "sorted-events")
    ev = I.events(spark, sf)
    size = max(1, sinks.estimated_bytes(ev) // 6)
    sinks.sink_sorted(ev, path, ["ts", "event_id"], min(size, sinks.FILE_BYTES))      # several files at any size
    return sinks.sorted_verdict(sinks.sorted_manifest(spark, path, ["ts", "event_id"]))


# ---------------------------------------------------------------------------
# single-operator views
# ---------------------------------------------------------------------------

@q("hour_ending_to_beginning", "SELECT event_id, date_trunc('hour', ts) - INTERVAL 1 HOUR AS ts_prev_hour FROM events")
def hour_ending_to_beginning(spark, sf):
    ev = I.events(spark, sf)
    return ev.select("event_id", T.shift_hours(T.floor_hour("ts"), -1).alias("ts_prev_hour"))


@q("floor_hour", "SELECT event_id, date_trunc('hour', ts) AS ts_hour FROM events")
def floor_hour(spark, sf):
    return I.events(spark, sf).select("event_id", T.floor_hour("ts").alias("ts_hour"))


@q("cyclic_encoding", H("""
SELECT ts, round(sin(2 * pi() * hour(ts) / 24.0), 9) AS hour_sin,
       round(cos(2 * pi() * hour(ts) / 24.0), 9) AS hour_cos FROM hourly"""))
def cyclic_encoding(spark, sf):
    c = T.cyclic_hour(F.hour("ts"))
    return I.hourly(spark, sf).select("ts", F.round(c["hour_sin"], 9).alias("hour_sin"),
                                      F.round(c["hour_cos"], 9).alias("hour_cos"))


@q("era_flag", "SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 1 ELSE 0 END AS is_pre_rtcb FROM events")
def era_flag(spark, sf):
    return I.events(spark, sf).select("event_id", T.era_flag("ts", "2024-01-15").alias("is_pre_rtcb"))


@q("days_since_start", """
SELECT event_id, CAST(date_diff('day', DATE '2023-12-25', CAST(ts AS DATE)) AS INTEGER) AS days_since_start
FROM events""")
def days_since_start(spark, sf):
    return I.events(spark, sf).select("event_id", T.days_since("ts", "2023-12-25").alias("days_since_start"))


@q("target_offset", IV("SELECT abs(min(rt)) + 1 AS price_offset FROM iv WHERE ts < TIMESTAMP '2024-01-22'"))
def target_offset(spark, sf):
    iv = I.intervals(spark, sf).where(F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-22")))
    return iv.agg((F.abs(F.min("rt")) + 1).alias("price_offset"))


def _roll_only(fn):
    def run(spark, sf):
        h = _hourly_pos(spark, sf)
        specs = [S.Rolling(c, n, fn, f"{c}_roll_{fn}_{n}h") for c in ("rt", "load_total") for n in (6, 24)]
        return S.halo_windows(h, specs, None, "pos").select("ts", *[_r(s.name) for s in specs])
    return run


def _roll_only_sql(fn):
    f = {"mean": "avg", "std": "stddev_samp", "max": "max"}[fn]
    cols = []
    for c in ("rt", "load_total"):
        for n in (6, 24):
            w = f"(ORDER BY ts ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
            cols.append(f"round(CASE WHEN count({c}) OVER {w} = {n} THEN {f}({c}) OVER {w} END, 6) "
                        f"AS {c}_roll_{fn}_{n}h")
    return H("SELECT ts, " + ", ".join(cols) + " FROM hourly")


for _fn, _key in (("mean", "rolling_mean"), ("std", "rolling_std"), ("max", "rolling_max")):
    q(_key, _roll_only_sql(_fn))(_roll_only(_fn))


@q("mask_counts", IV("""
SELECT count(*) FILTER (WHERE coalesce(prc > 0 AND prc <= 3000, false)) AS n_scarcity,
       sum(rt) FILTER (WHERE prc > 0 AND prc <= 3000) AS sum_scarcity,
       count(*) FILTER (WHERE coalesce(rt > 100, false)) AS n_spike, sum(rt) FILTER (WHERE rt > 100) AS sum_spike,
       count(*) FILTER (WHERE coalesce(pred_prc < 5000 AND rt <= 40, false)) AS n_false_curtail,
       sum(rt) FILTER (WHERE pred_prc < 5000 AND rt <= 40) AS sum_false_curtail
FROM iv"""))
def mask_counts(spark, sf):
    iv = I.intervals(spark, sf)
    masks = {"scarcity": (F.col("prc") > 0) & (F.col("prc") <= 3000), "spike": F.col("rt") > 100,
             "false_curtail": (F.col("pred_prc") < 5000) & (F.col("rt") <= 40)}
    out = A.mask_counts(iv, masks, "rt")
    return out.select(*[F.round(c, 6).alias(c) if c.startswith("sum_") else F.col(c) for c in out.columns])


@q("impute_for_trees", IV("""
SELECT event_id, round(coalesce(dam, avg(dam) OVER ()), 6) AS dam_imp, CAST(dam IS NULL AS DOUBLE) AS dam_isnull,
       round(coalesce(pred_price, avg(pred_price) OVER ()), 6) AS pred_price_imp,
       CAST(pred_price IS NULL AS DOUBLE) AS pred_price_isnull FROM iv"""))
def impute_for_trees(spark, sf):
    cols = ["dam", "pred_price"]
    iv = M.with_null_indicators(I.intervals(spark, sf), cols)
    out = M.imputer(cols).fit(iv).transform(iv)
    return out.select("event_id", *[F.round(f"{c}_imp", 6).alias(f"{c}_imp") for c in cols],
                      *[f"{c}_isnull" for c in cols])


@q("feature_set_select", IV("""
SELECT event_id, pred_prc AS prc_lag1, lag(prc, 2) OVER w AS prc_lag2,
  round(CASE WHEN count(prc) OVER w6 = 6 THEN avg(prc) OVER w6 END, 6) AS prc_roll_mean_6,
  pred_price AS rt_lag1, round(dam, 9) AS dam, CAST(hour(ts) AS DOUBLE) AS hour
FROM iv WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id),
  w6 AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)"""))
def feature_set_select(spark, sf):
    mt = model_table(spark, sf)
    feats = M.feature_set("prc_1h")
    out = sinks.project_features(mt, ["event_id", *feats])
    return out.select("event_id", "prc_lag1", "prc_lag2", _r("prc_roll_mean_6"), "rt_lag1", _r("dam", 9), "hour")
