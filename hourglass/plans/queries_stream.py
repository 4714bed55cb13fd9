"""Streaming queries (K1-K4): each lands a backlog derived from a driver table
in the shared scratch folder, runs the stream to completion
(``availableNow``) and returns the sink as a batch DataFrame, so the result
is checked against the batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import shuffle_partitions
from ..streaming import streams as K
from .queries import _LI_ORDER, _li_sql, _r, q


#: Micro-batches that a landed backlog is read in, about.
BATCHES = 6
#: Parts of a year of deliveries that may go to different files; there are as many files as shuffle partitions.
YEAR_PARTS = 4096


def _landed(spark, df, name, split, n_files=None):
    """Land a table as a backlog of files; returns folder, schema and files a micro-batch."""
    base = K.scratch_dir(spark, f"land-{name}")
    K.land_files(df, base, split, n_files)
    return base, df.schema, max(1, -(-len(spark.read.schema(df.schema).parquet(base).inputFiles()) // BATCHES))


def _table(spark, sf, name):
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


@q("stream_file_ingest", "SELECT * FROM events")
def stream_file_ingest(spark, sf):
    src, schema, files = _landed(spark, _table(spark, sf, "events"), "events", F.pmod(F.xxhash64("event_id"), F.lit(64)))
    out = K.scratch_dir(spark, "bronze")
    K.file_ingest(spark, src, schema, out, out + "-ckpt", files)
    b = spark.read.parquet(out)
    return b.where(F.col("_ingested_at").isNotNull() & F.col("source_file").isNotNull()) \
            .drop("_ingested_at", "source_file")


#: deliveries: columns appear later, and one column changes its type
_EVOLVED = """
SELECT event_id, ts, event_type, CASE WHEN day(ts) <= 20 OR user_id % 7 <> 0 THEN user_id END AS user_id,
       CASE WHEN day(ts) > 10 THEN value END AS value, CASE WHEN day(ts) > 20 THEN props END AS props,
       CASE WHEN day(ts) > 20 AND user_id % 7 = 0 THEN 'u' || user_id END AS rescued_user_id
FROM events"""


@q("stream_evolving_schema", _EVOLVED)
def stream_evolving_schema(spark, sf):
    """The second run meets files with two new columns and with text in ``user_id``, on the same checkpoint."""
    ev = _table(spark, sf, "events")
    first = ["event_id", "ts", "user_id", "event_type"]
    day = F.dayofmonth("ts")
    text = F.when(F.col("user_id") % 7 == 0, F.concat(F.lit("u"), "user_id")).otherwise(F.col("user_id").cast("string"))
    base, out = K.scratch_dir(spark, "land-evolving"), K.scratch_dir(spark, "evolving")
    schema = ev.select(*first).schema
    ev.where(day <= 10).select(*first).write.mode("append").parquet(base)
    K.evolving_ingest(spark, base, schema, out, out + "-ckpt")
    ev.where((day > 10) & (day <= 20)).select(*first, "value").write.mode("append").parquet(base)
    ev.where(day > 20).select(*first, "value", "props").withColumn("user_id", text).write.mode("append").parquet(base)
    rows = K.evolving_ingest(spark, base, schema, out, out + "-ckpt")
    return rows.select("event_id", "ts", "event_type", "user_id", "value", "props", F.col(K.RESCUED)["user_id"].alias("rescued_user_id"))


@q("stream_scd1", _li_sql("DESC"))
def stream_scd1(spark, sf):
    # a year comes in many files and a batch has several, so that landing and merging spread over all tasks
    part = F.struct(F.year("l_shipdate"), F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(YEAR_PARTS)))
    src, schema, files = _landed(spark, _table(spark, sf, "lineitem"), "lineitem", part, shuffle_partitions(spark))
    out = K.scratch_dir(spark, "scd1")
    return K.scd1_stream(spark, src, schema, ["l_orderkey", "l_linenumber"], _LI_ORDER, out, out + "-ckpt", files)


@q("snapshot_merge", _li_sql("DESC"))
def snapshot_merge(spark, sf):
    """K2: batches merged into the versioned snapshot, each one twice (a replay is a no-op), with compaction every third."""
    from ..sources.versions import VersionedTable
    li = _table(spark, sf, "lineitem")
    table = VersionedTable(spark, K.scratch_dir(spark, "snapshot"), max_deltas=3)
    for i in range(7):
        batch = li.where(F.year("l_shipdate") % 7 == i)
        for _ in range(2):
            table.merge(batch, i, ["l_orderkey", "l_linenumber"], _LI_ORDER)
    return table.read(["l_orderkey", "l_linenumber"], _LI_ORDER)


@q("stream_resample", """
SELECT date_trunc('hour', ts) AS ts, event_type, round(avg(value), 9) AS mean_value, min(value) AS min_value,
       count(*) AS n FROM events GROUP BY 1, 2""")
def stream_resample(spark, sf):
    src, schema, files = _landed(spark, _table(spark, sf, "events"), "events", F.dayofmonth("ts"))
    out = K.scratch_dir(spark, "resample")
    r = K.resample_stream(spark, src, schema, "ts", "value", ["event_type"], out, out + "-ckpt", max_files_per_trigger=files)
    return r.select("ts", "event_type", _r("mean_value", 9), "min_value", "n")


@q("stream_dedup", "SELECT * FROM events")
def stream_dedup(spark, sf):
    ev = _table(spark, sf, "events")
    src, schema, files = _landed(spark, ev.unionByName(ev), "events", F.dayofmonth("ts"))
    out = K.scratch_dir(spark, "dedup")
    return K.dedup_stream(spark, src, schema, "ts", ["event_id"], out, out + "-ckpt", max_files_per_trigger=files)


def _stretched(spark, sf):
    """``events`` over half a year, in files that mix all of it."""
    ev = _table(spark, sf, "events")
    return ev.withColumn("ts", F.expr("ts + make_dt_interval(cast(event_id * 7919 % 180 as int))"))


_STRETCHED = "SELECT * REPLACE (ts + to_days(CAST(event_id * 7919 % 180 AS INTEGER)) AS ts) FROM events"


@q("stream_resample_late", f"""
SELECT date_trunc('hour', ts) AS ts, event_type, round(avg(value), 9) AS mean_value, min(value) AS min_value, count(*) AS n
FROM ({_STRETCHED}) GROUP BY 1, 2""")
def stream_resample_late(spark, sf):
    """K3 with a retention far below the disorder: result and late rows together are the batch result."""
    src, schema, files = _landed(spark, _stretched(spark, sf), "late", F.xxhash64("event_id"))
    out = K.scratch_dir(spark, "late")
    r = K.resample_stream(spark, src, schema, "ts", "value", ["event_type"], out, out + "-ckpt", "2 days", files)
    r = K.resample_reconciled(spark, r, out, schema, "ts", "value", ["event_type"])
    return r.select("ts", "event_type", _r("mean_value", 9), "min_value", "n")


@q("stream_dedup_late", _STRETCHED)
def stream_dedup_late(spark, sf):
    """K4 likewise: no first delivery is lost, and none is kept twice."""
    rows = _stretched(spark, sf)
    src, schema, files = _landed(spark, rows.unionByName(rows), "late", F.xxhash64("event_id"))
    out = K.scratch_dir(spark, "late")
    d = K.dedup_stream(spark, src, schema, "ts", ["event_id"], out, out + "-ckpt", "2 days", files)
    return K.dedup_reconciled(spark, d, out, schema, "ts", ["event_id"])
