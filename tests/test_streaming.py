"""Stream results equal the batch results (K1-K4)."""

import pytest
from pyspark.sql import functions as F

from hourglass.sources.versions import Conflict, VersionedTable

from hourglass.streaming import streams as K


def test_scd1_stream_late_revision_across_files(spark):
    base = K.scratch_dir(spark, "t-scd1")
    schema = "k string, seq int, v double"
    # three deliveries; the late revision (seq 5) arrives before an older one
    for i, rows in enumerate([[("a", 1, 1.0), ("b", 1, 2.0)], [("a", 5, 9.0)], [("a", 3, 4.0), ("b", 2, 3.0)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/src")
    src_schema = spark.read.parquet(f"{base}/src").schema
    got = K.scd1_stream(spark, f"{base}/src", src_schema, ["k"], ["seq"], f"{base}/out", f"{base}/ckpt")
    assert {r.k: r.v for r in got.collect()} == {"a": 9.0, "b": 3.0}
    # replaying from the same checkpoint processes nothing new
    again = K.scd1_stream(spark, f"{base}/src", src_schema, ["k"], ["seq"], f"{base}/out", f"{base}/ckpt")
    assert {r.k: r.v for r in again.collect()} == {"a": 9.0, "b": 3.0}


def test_resample_and_dedup_stream_equal_batch(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    base = K.scratch_dir(spark, "t-events")
    K.land_files(ev.unionByName(ev), f"{base}/src", F.dayofmonth("ts"), 6)
    schema = spark.read.parquet(f"{base}/src").schema
    d = K.dedup_stream(spark, f"{base}/src", schema, "ts", ["event_id"], f"{base}/d", f"{base}/dc")
    assert d.count() == ev.count() and d.select("event_id").distinct().count() == ev.count()
    r = K.resample_stream(spark, f"{base}/src", schema, "ts", "value", ["event_type"], f"{base}/r", f"{base}/rc")
    batch = (ev.unionByName(ev).groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "event_type")
               .agg(F.count("*").alias("n_batch")))
    j = r.join(batch, ["ts", "event_type"], "full")
    assert j.where(F.col("n").isNull() | F.col("n_batch").isNull() | (F.col("n") != F.col("n_batch"))).count() == 0


def test_file_ingest_stamps_rows(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    base = K.scratch_dir(spark, "t-bronze")
    K.land_files(ev, f"{base}/src", "event_type", 3)
    out = K.file_ingest(spark, f"{base}/src", ev.schema, f"{base}/out", f"{base}/ckpt")
    b = spark.read.parquet(out)
    assert b.count() == ev.count()
    assert b.where(F.col("_ingested_at").isNull() | F.col("source_file").isNull()).count() == 0


def test_streams_lose_nothing_over_half_a_year_in_any_file_order(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    long = ev.withColumn("ts", F.expr("ts + make_dt_interval(cast(event_id * 7919 % 180 as int))"))
    base = K.scratch_dir(spark, "t-long")
    K.land_files(long.unionByName(long), f"{base}/src", F.xxhash64("event_id"), 6)
    schema = spark.read.parquet(f"{base}/src").schema
    d = K.dedup_stream(spark, f"{base}/src", schema, "ts", ["event_id"], f"{base}/d", f"{base}/dc")
    assert d.count() == ev.count() and d.select("event_id").distinct().count() == ev.count()
    r = K.resample_stream(spark, f"{base}/src", schema, "ts", "value", ["event_type"], f"{base}/r", f"{base}/rc")
    assert r.agg(F.sum("n")).first()[0] == 2 * ev.count()
    # with a retention far below the span, late rows go aside as they are, and nothing is lost
    k = K.dedup_stream(spark, f"{base}/src", schema, "ts", ["event_id"], f"{base}/k", f"{base}/kc", retention="1 hour")
    late = K.late_rows(spark, f"{base}/k", schema)
    assert late.count() > 0 and k.count() < ev.count()
    whole = K.dedup_reconciled(spark, k, f"{base}/k", schema, "ts", ["event_id"])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, long.collect()))
    # replaying from the same checkpoint changes nothing
    again = K.dedup_stream(spark, f"{base}/src", schema, "ts", ["event_id"], f"{base}/k", f"{base}/kc", retention="1 hour")
    assert again.count() == k.count()
    assert len(VersionedTable(spark, f"{base}/k-seen").versions()) <= 2


def test_closed_hours_open_hours_and_late_rows_add_up(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    long = ev.withColumn("ts", F.expr("ts + make_dt_interval(cast(event_id * 7919 % 180 as int))"))
    base = K.scratch_dir(spark, "t-hours")
    K.land_files(long, f"{base}/src", F.xxhash64("event_id"), 6)
    schema = spark.read.parquet(f"{base}/src").schema
    r = K.resample_stream(spark, f"{base}/src", schema, "ts", "value", ["event_type"], f"{base}/r", f"{base}/rc", retention="36 hours")
    n_late = K.late_rows(spark, f"{base}/r", schema).count()
    assert n_late > 0 and r.agg(F.sum("n")).first()[0] + n_late == ev.count()
    state = VersionedTable(spark, f"{base}/r-open")
    assert state._parts(state.current()).count() < 200          # only hours within the retention are state
    whole = K.resample_reconciled(spark, r, f"{base}/r", schema, "ts", "value", ["event_type"])
    batch = long.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "event_type").agg(F.avg("value").alias("v"), F.count("*").alias("k"))
    j = whole.join(batch, ["ts", "event_type"], "full")
    assert j.count() == batch.count()
    assert j.where("n IS DISTINCT FROM k OR abs(mean_value - v) > 1e-9").count() == 0


def test_snapshot_reads_stay_cheap_and_crashes_leave_one_state(spark, monkeypatch):
    path = K.scratch_dir(spark, "t-snap")
    table = VersionedTable(spark, path, max_deltas=4)
    want = {}
    for i in range(25):
        rows = [(k, i, float(i)) for k in range(i % 5, 20, 3)] + [(99, -i, float(i))]
        want.update({k: v for k, _, v in rows if k != 99})
        batch = spark.createDataFrame(rows, "k int, seq int, v double")
        if i % 6 == 2:  # the writer dies before the commit; the batch comes again
            with monkeypatch.context() as m:
                m.setattr(table, "_commit", lambda state: (_ for _ in ()).throw(RuntimeError("lost")))
                with pytest.raises(RuntimeError, match="lost"):
                    table.merge(batch, i, ["k"], ["seq"])
        assert table.merge(batch, i, ["k"], ["seq"])
        assert not table.merge(batch, i, ["k"], ["seq"])        # a replay
        assert len(table.current()["deltas"]) < 4
    want[99] = 0.0                                              # later batches had lower sequences
    assert {r.k: r.v for r in table.read(["k"], ["seq"]).collect()} == want
    assert len(table.versions()) <= 5 and len([n for n in table._names() if n.startswith("base")]) <= 3
    # two writers from one version: the second has to start again
    state = table.current()
    with pytest.raises(Conflict):
        table._commit(state)


def test_snapshot_widens_and_null_keys_are_one_key(spark):
    table = VersionedTable(spark, K.scratch_dir(spark, "t-wide"))
    table.merge(spark.createDataFrame([(1, 1), (None, 1)], "k int, seq int"), 0, ["k"], ["seq"])
    table.merge(spark.createDataFrame([(1, 2, "x"), (None, 2, "y")], "k int, seq int, w string"), 1, ["k"], ["seq"])
    table.merge(spark.createDataFrame([(2, 2)], "k int, seq int"), 2, ["k"], ["seq"])
    assert {tuple(r) for r in table.read(["k"], ["seq"]).collect()} == {(1, 2, "x"), (None, 2, "y"), (2, 2, None)}
    assert VersionedTable(spark, K.scratch_dir(spark, "t-none")).read(["k"], ["seq"]) is None


def test_evolving_ingest_keeps_every_value(spark):
    base = K.scratch_dir(spark, "t-evolve")
    schema = spark.createDataFrame([], "id long, v int").schema
    spark.createDataFrame([(1, 10), (2, None)], "id long, v int").coalesce(1).write.mode("append").parquet(f"{base}/src")
    assert K.evolving_ingest(spark, f"{base}/src", schema, f"{base}/out", f"{base}/ckpt").count() == 2
    spark.createDataFrame([(3, "30", "new"), (4, "4x", None)], "id long, v string, extra string").coalesce(1).write.mode("append").parquet(f"{base}/src")
    spark.createDataFrame([(5, 50.0), (6, 6.5)], "id long, v double").coalesce(1).write.mode("append").parquet(f"{base}/src")
    spark.createDataFrame([(7,)], "id long").coalesce(1).write.mode("append").parquet(f"{base}/src")
    for _ in range(2):  # the second run has nothing to do
        rows = K.evolving_ingest(spark, f"{base}/src", schema, f"{base}/out", f"{base}/ckpt")
        got = {r.id: (r.v, r.extra, r[K.RESCUED]) for r in rows.collect()}
        assert got == {1: (10, None, None), 2: (None, None, None), 3: (30, "new", None), 4: (None, None, {"v": "4x"}),
                       5: (50, None, None), 6: (None, None, {"v": "6.5"}), 7: (None, None, None)}
        assert rows.where("source_file IS NULL OR _ingested_at IS NULL").count() == 0
