"""Structured Streaming operators (K1-K4).

* K1 :func:`file_ingest`   incremental parquet ingest stamped with ingestion
                           time and source file (bronze);
     :func:`evolving_ingest` the same for files whose columns change.
* K2 :func:`scd1_stream`   per key keep the highest sequence; late revisions
                           win; each micro-batch is merged into a versioned
                           snapshot, so the stream itself has no state.
* K3 :func:`resample_stream` hourly tumbling-window mean / min / count in update
                           mode into the upsert log; lossless unless the user
                           sets a retention.
* K4 :func:`dedup_stream`  duplicate-delivery suppression, likewise.

With a retention K3 and K4 keep only what it spans: the open hours or the
recent keys are a versioned table, which also stores the watermark.  Rows
behind the watermark go, as they are, to the side table ``<out>-late``, and
:func:`resample_reconciled` / :func:`dedup_reconciled` add them to the result.

Streams run with ``trigger(availableNow=True)`` so a backlog is processed in
bounded micro-batches and the query stops.  All state, checkpoints and sinks
live under the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType, TimestampType

from ..operators.dedup import keep_first, keep_latest
from ..operators.series import series_keys
from ..session import ensure_checkpoint_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/hourglass-{name}-{uuid.uuid4().hex[:12]}"


def land_files(df: DataFrame, path: str, split_by, n_files: int | None = None) -> str:
    """Land a (derived) table as several files so a stream sees a backlog of
    deliveries.  ``split_by`` (name or Column) decides which rows share a file; without
    ``n_files`` the number of files follows ``spark.sql.shuffle.partitions`` and AQE."""
    d = df.repartition(n_files, split_by) if n_files else df.repartition(split_by)
    d.write.mode("overwrite").parquet(path)
    return path


def file_stream(spark: SparkSession, path: str, schema: StructType,
                max_files_per_trigger: int | None = 1) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def _run(writer, name: str):
    q = writer.trigger(availableNow=True).queryName(f"{name}_{uuid.uuid4().hex[:6]}").start()
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise RuntimeError(str(q.exception()))
    return q


# ---------------------------------------------------------------------------
# K1
# ---------------------------------------------------------------------------

def file_ingest(spark: SparkSession, src: str, schema: StructType, out: str, ckpt: str,
                max_files_per_trigger: int | None = 1) -> str:
    """K1: append every new file's rows to the bronze table with
    ``_ingested_at`` and ``source_file``."""
    s = file_stream(spark, src, schema, max_files_per_trigger)
    s = s.withColumn("_ingested_at", F.current_timestamp()) \
         .withColumn("source_file", F.col("_metadata.file_path"))
    _run(s.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
          .outputMode("append"), "bronze")
    return out


#: Column of :func:`evolving_ingest` with what did not fit the type of its column.
RESCUED = "_rescued"


def evolving_ingest(spark: SparkSession, src: str, schema: StructType, out: str, ckpt: str,
                    max_files_per_trigger: int = 16) -> DataFrame:
    """K1: ingest files whose columns change, without losing a column or a value.

    ``schema`` is what is expected at first.  A micro-batch tells which files
    are new (at most ``max_files_per_trigger``); they are read with their own
    schemas, files of one schema together.  A column that the table doesn't
    have widens it.  A value that cannot be cast to its column's type without
    loss is kept as text in the map ``_rescued``, and the column is null.  The
    widened schema is committed with the batch (``<out>-schema``), so the stream
    goes on from its checkpoint after a restart, and a replayed batch writes
    the same folder again.
    """
    from ..sources.versions import VersionedTable, widened
    log = VersionedTable(spark, f"{out}-schema")

    def write(batch: DataFrame, batch_id: int) -> None:
        state = log.current()
        known = StructType.fromJson(json.loads(state["extra"]["schema"])) if state else schema
        files = [r[0] for r in batch.distinct().collect()]  # at most max_files_per_trigger
        groups: dict[str, list[str]] = {}
        for f in sorted(files):
            groups.setdefault(spark.read.parquet(f).schema.json(), []).append(f)
        parts = []
        for own, paths in sorted(groups.items()):
            part = spark.read.schema(StructType.fromJson(json.loads(own))).parquet(*paths)
            parts.append(part.select("*", F.col("_metadata.file_path").alias("source_file")))
            known = widened(known, StructType.fromJson(json.loads(own)))
        rows = None
        for part in parts:
            cast = _fitted(part, known).withColumn("_ingested_at", F.current_timestamp())
            rows = cast if rows is None else rows.unionByName(cast)
        if rows is not None:
            rows.write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")
            log.merge(spark.createDataFrame([(batch_id,)], "id long"), batch_id, ["id"], [], {"schema": known.json()})

    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(src)
    _run(s.select(F.col("_metadata.file_path").alias("file")).writeStream.option("checkpointLocation", ckpt).foreachBatch(write), "evolving")
    return read_evolved(spark, out, schema)


def _fitted(part: DataFrame, known: StructType) -> DataFrame:
    """The rows of ``part`` with the columns of ``known``; values that don't fit go to the map."""
    cols, lost = [], []
    for f in known.fields:
        if f.name not in part.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        own = part.schema[f.name].dataType
        if own == f.dataType:
            cols.append(F.col(f.name))
            continue
        value = F.col(f.name).try_cast(f.dataType)
        whole = F.coalesce(value.try_cast(own) == F.col(f.name), F.lit(False)) & value.isNotNull()
        cols.append(F.when(whole, value).alias(f.name))
        lost.append(F.when(F.col(f.name).isNotNull() & ~whole, F.struct(F.lit(f.name).alias("key"), F.col(f.name).cast("string").alias("value"))))
    kept = F.filter(F.array(*lost), lambda x: x.isNotNull()) if lost else F.lit(None).cast("array<struct<key:string,value:string>>")
    rescued = F.when(F.size(kept) > 0, F.map_from_entries(kept)).cast("map<string,string>").alias(RESCUED)
    return part.select(*cols, rescued, "source_file")


def read_evolved(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """All ingested rows with the last committed schema; rows from before a column came have null there."""
    from ..sources.versions import VersionedTable
    state = VersionedTable(spark, f"{out}-schema").current()
    known = StructType.fromJson(json.loads(state["extra"]["schema"])) if state else schema
    whole = StructType([*known.fields, StructField(RESCUED, MapType(StringType(), StringType())),
                        StructField("source_file", StringType()), StructField("_ingested_at", TimestampType())])
    return spark.read.schema(whole).parquet(out).select(*whole.names) if state else spark.createDataFrame([], whole)


# ---------------------------------------------------------------------------
# upsert log sink (K2, K3)
# ---------------------------------------------------------------------------

def upsert_log_writer(path: str):
    """foreachBatch function: each micro-batch's updated rows go to
    ``path/_batch=<id>`` with overwrite, so a replayed batch is a no-op."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/_batch={batch_id}")
    return write


def read_upsert_log(spark: SparkSession, path: str, key_cols: Sequence[str]) -> DataFrame:
    """Current snapshot: per key the row of the latest batch."""
    log = spark.read.parquet(path)
    return keep_latest(log, key_cols, ["_batch"]).drop("_batch")


# ---------------------------------------------------------------------------
# K2
# ---------------------------------------------------------------------------

def scd1_stream(spark: SparkSession, src: str, schema: StructType, key_cols: Sequence[str],
                seq_cols: Sequence[str], out: str, ckpt: str,
                max_files_per_trigger: int | None = 1) -> DataFrame:
    """K2: merge each micro-batch into a versioned parquet snapshot (``sources/versions.py``).

    Per key the greatest sequence wins, whatever batch it comes in.  The
    stream keeps no state of its own, a replayed batch is a no-op, and a read
    costs the snapshot and a bounded number of batches."""
    from ..sources.versions import VersionedTable
    table = VersionedTable(spark, out)
    s = file_stream(spark, src, schema, max_files_per_trigger)
    _run(s.writeStream.option("checkpointLocation", ckpt)
          .foreachBatch(lambda batch, batch_id: table.merge(batch, batch_id, key_cols, seq_cols)), "scd1")
    found = table.read(key_cols, seq_cols)
    return spark.createDataFrame([], schema) if found is None else found


# ---------------------------------------------------------------------------
# K3
# ---------------------------------------------------------------------------

def resample_stream(spark: SparkSession, src: str, schema: StructType, ts_col: str, value_col: str,
                    series_cols: Sequence[str], out: str, ckpt: str, retention: str | None = None,
                    max_files_per_trigger: int | None = 1) -> DataFrame:
    """K3: hourly mean / min / count per series with a tumbling window.

    Without ``retention`` no row is late: state is one row per hour and series
    and grows with the time span alone, whatever the order of the files.  With
    one, an hour is closed once the newest event time is ``retention`` past its
    end: closed hours are appended to the result and leave the state, which is
    a versioned table of the open hours.  Rows of closed hours are kept as
    they are in ``<out>-late``.  Event time must be ``timestamp`` for a window,
    so the NTZ clock is cast (session zone UTC) and cast back on output."""
    if retention:
        return _resample_open_hours(spark, src, schema, ts_col, value_col, list(series_cols), out, ckpt, retention, max_files_per_trigger)
    s = file_stream(spark, src, schema, max_files_per_trigger)
    s = s.withColumn("_et", F.col(ts_col).cast("timestamp"))
    agg = s.groupBy(F.window("_et", "1 hour").alias("w"), *series_cols).agg(
        F.avg(value_col).alias("mean_value"), F.min(value_col).alias("min_value"),
        F.count(F.lit(1)).alias("n"))
    res = agg.select(F.col("w.start").cast("timestamp_ntz").alias("ts"), *series_cols,
                     "mean_value", "min_value", "n")
    _run(res.writeStream.outputMode("update").option("checkpointLocation", ckpt)
         .foreachBatch(upsert_log_writer(out)), "resample")
    return read_upsert_log(spark, out, ["ts", *series_cols])


def _micros(ts_col: str):
    """Wall-clock microseconds; the same in any session time zone that has no clock changes (streams run in UTC)."""
    return F.unix_micros(F.col(ts_col).cast("timestamp"))


def _span(spark: SparkSession, retention: str) -> int:
    """Microseconds of an interval text."""
    return spark.sql(f"SELECT unix_micros(TIMESTAMP '2000-01-01' + INTERVAL {retention}) - unix_micros(TIMESTAMP '2000-01-01')").first()[0]


def _late_to(out: str, late: DataFrame, batch_id: int) -> None:
    late.write.mode("overwrite").parquet(f"{out}-late/_batch={batch_id}")


def late_rows(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """The rows that came behind the watermark, as they were."""
    return spark.read.schema(schema).parquet(f"{out}-late").select(*schema.names)


def _hourly_parts(rows: DataFrame, ts_col: str, value_col: str, series: Sequence[str]) -> DataFrame:
    """Sums that can be added up: hour, series, s, c (non-null values), m (minimum), n (rows)."""
    from ..functions.time import floor_hour
    return rows.groupBy(floor_hour(ts_col).alias("ts"), *series).agg(
        F.sum(value_col).alias("s"), F.count(value_col).alias("c"), F.min(value_col).alias("m"), F.count(F.lit(1)).alias("n"))


def _added(parts: DataFrame, series: Sequence[str]) -> DataFrame:
    return parts.groupBy("ts", *series).agg(F.sum("s").alias("s"), F.sum("c").alias("c"), F.min("m").alias("m"), F.sum("n").alias("n"))


def _resampled(parts: DataFrame, series: Sequence[str]) -> DataFrame:
    return parts.select("ts", *series, F.try_divide("s", "c").alias("mean_value"), F.col("m").alias("min_value"), "n", "s", "c")


def _resample_open_hours(spark, src, schema, ts_col, value_col, series, out, ckpt, retention, max_files_per_trigger) -> DataFrame:
    from ..sources.versions import VersionedTable
    table, keep, hour = VersionedTable(spark, f"{out}-open"), _span(spark, retention), 3_600_000_000

    def write(batch: DataFrame, batch_id: int) -> None:
        state = table.current()
        if state and state["batch"] >= batch_id:
            return
        mark = state["extra"]["watermark"] if state else None
        behind = F.lit(False) if mark is None else F.coalesce(_micros(ts_col) < mark, F.lit(False))
        _late_to(out, batch.where(behind), batch_id)
        newest = batch.agg(F.max(_micros(ts_col))).first()[0]
        # hours close whole, so the watermark is the start of the first open one
        reached = mark if newest is None else max((newest - keep) // hour * hour, mark if mark is not None else -(1 << 62))
        parts = _hourly_parts(batch.where(~behind), ts_col, value_col, series)
        old = table._parts(state) if state else None
        every = _added(parts if old is None else parts.unionByName(old), series)
        closed = F.coalesce(_micros("ts") < reached, F.lit(False)) if reached is not None else F.lit(False)
        _resampled(every.where(closed), series).write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")
        table.replace(batch_id, lambda _, __: every.where(~closed), {"watermark": reached})

    s = file_stream(spark, src, schema, max_files_per_trigger)
    _run(s.writeStream.option("checkpointLocation", ckpt).foreachBatch(write), "resample")
    state = table.current()
    still = _resampled(table._parts(state), series)
    return spark.read.schema(still.schema).parquet(out).select(*still.columns).unionByName(still)


def resample_reconciled(spark: SparkSession, result: DataFrame, out: str, schema: StructType, ts_col: str, value_col: str,
                        series_cols: Sequence[str]) -> DataFrame:
    """The result of K3 with the late rows added to their hours."""
    series = list(series_cols)
    before = result.select("ts", *series, "s", "c", F.col("min_value").alias("m"), "n")
    late = _hourly_parts(late_rows(spark, out, schema), ts_col, value_col, series)
    return _resampled(_added(before.unionByName(late), series), series)


# ---------------------------------------------------------------------------
# K4
# ---------------------------------------------------------------------------

def dedup_stream(spark: SparkSession, src: str, schema: StructType, ts_col: str, key_cols: Sequence[str],
                 out: str, ckpt: str, retention: str | None = None,
                 max_files_per_trigger: int | None = 1) -> DataFrame:
    """K4: drop re-delivered rows.

    Without ``retention`` every key is remembered (state is one key each), so
    no first delivery is lost in whatever order files come.  With one, a
    versioned table holds the keys of the last ``retention`` of event time, and
    rows that are further back are kept as they are in ``<out>-late``."""
    s = file_stream(spark, src, schema, max_files_per_trigger)
    if not retention:
        d = s.dropDuplicates(list(key_cols))
        _run(d.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
             .outputMode("append"), "dedup")
        return spark.read.schema(d.schema).parquet(out)
    from ..sources.versions import VersionedTable
    table, keep, keys = VersionedTable(spark, f"{out}-seen"), _span(spark, retention), list(key_cols)

    def write(batch: DataFrame, batch_id: int) -> None:
        state = table.current()
        if state and state["batch"] >= batch_id:
            return
        mark = state["extra"]["watermark"] if state else None
        behind = F.lit(False) if mark is None else F.coalesce(_micros(ts_col) < mark, F.lit(False))
        _late_to(out, batch.where(behind), batch_id)
        newest = batch.agg(F.max(_micros(ts_col))).first()[0]
        reached = mark if newest is None else max(newest - keep, mark if mark is not None else newest - keep)
        fresh = keep_latest(batch.where(~behind), keys, [ts_col])
        seen = table._parts(state) if state else None
        if seen is not None:
            known, _ = series_keys(seen.select(*keys), keys)
            fresh, key = series_keys(fresh, keys)
            fresh = fresh.join(known.select("_hg_s"), key, "left_anti").drop("_hg_s")
        fresh.write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")
        added = spark.read.schema(schema).parquet(f"{out}/_batch={batch_id}").select(*keys, _micros(ts_col).alias("_at"))
        every = added if seen is None else seen.unionByName(added)
        table.replace(batch_id, lambda _, __: every if reached is None else every.where(F.coalesce(F.col("_at") >= reached, F.lit(True))), {"watermark": reached})

    _run(s.writeStream.option("checkpointLocation", ckpt).foreachBatch(write), "dedup")
    return spark.read.schema(schema).parquet(out).select(*schema.names)


def dedup_reconciled(spark: SparkSession, result: DataFrame, out: str, schema: StructType, ts_col: str, key_cols: Sequence[str]) -> DataFrame:
    """The result of K4 with those late rows whose key it lacks."""
    keys = list(key_cols)
    both = result.withColumn("_hg_late", F.lit(0)).unionByName(late_rows(spark, out, schema).withColumn("_hg_late", F.lit(1)))
    return keep_first(both, keys, ["_hg_late", ts_col]).drop("_hg_late")
