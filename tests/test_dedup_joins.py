"""Dedup / upsert semantics and joins."""

import datetime as dt

from pyspark.sql import functions as F

from hourglass.operators import dedup as DD
from hourglass.operators import joins as J


def test_keep_latest_vintage_out_of_order(spark):
    df = spark.createDataFrame([("h1", "b", 2.0), ("h1", "c", 3.0), ("h1", "a", 1.0), ("h2", "a", 9.0)],
                               "k string, source_file string, v double")
    got = {r.k: r.v for r in DD.keep_latest(df, ["k"], ["source_file"]).collect()}
    assert got == {"h1": 3.0, "h2": 9.0}


def test_scd1_late_revision_and_replay(spark):
    cur = spark.createDataFrame([("h1", 1, 10.0), ("h2", 1, 20.0)], "k string, seq int, v double")
    late = spark.createDataFrame([("h1", 3, 11.0), ("h2", 0, 99.0)], "k string, seq int, v double")
    once = DD.scd1_upsert(cur, late, ["k"], ["seq"])
    twice = DD.scd1_upsert(once, late, ["k"], ["seq"])
    exp = {"h1": 11.0, "h2": 20.0}
    assert {r.k: r.v for r in once.collect()} == exp
    assert {r.k: r.v for r in twice.collect()} == exp


def test_priority_first_source_wins(spark):
    csv = spark.createDataFrame([("t1", 1.0)], "ts string, v double")
    gap = spark.createDataFrame([("t1", 2.0), ("t2", 2.0)], "ts string, v double")
    api = spark.createDataFrame([("t1", 3.0), ("t2", 3.0), ("t3", 3.0)], "ts string, v double")
    got = {r.ts: r.v for r in DD.priority_union([csv, gap, api], ["ts"]).collect()}
    assert got == {"t1": 1.0, "t2": 2.0, "t3": 3.0}


def test_in_use_flag_filter_before_dedup(spark):
    df = spark.createDataFrame([("t1", "N", 1.0), ("t1", "Y", 2.0), ("t2", "N", 3.0)], "ts string, f string, v double")
    got = {r.ts: r.v for r in DD.keep_first(df.where(F.col("f") == "Y"), ["ts"], ["v"]).collect()}
    assert got == {"t1": 2.0}


def test_dst_duplicate_keep_first(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 11, 3, 1, 30), 0, 5.0), (dt.datetime(2024, 11, 3, 1, 30), 1, 7.0)],
                               "ts timestamp_ntz, row int, v double")
    assert DD.keep_first(df, ["ts"], ["row"]).first().v == 5.0


def test_asof_backward_exact_match_and_no_match(spark):
    left = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5), 100), (1, dt.datetime(2024, 1, 1, 1), 101),
                                  (2, dt.datetime(2024, 1, 1, 3), 102)], "k long, ts timestamp_ntz, id long")
    right = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 2), 1, 10.0), (1, dt.datetime(2024, 1, 1, 5), 2, 20.0),
                                   (1, dt.datetime(2024, 1, 1, 5), 3, 30.0), (2, dt.datetime(2024, 1, 1, 9), 4, 40.0)],
                                  "k long, ts timestamp_ntz, rid long, v double")
    out = J.asof_backward(left, right, "ts", ["k"], ["v"], "id", "rid", "matched_ts", num_blocks=3)
    got = {r.id: (r.v, r.matched_ts) for r in out.collect()}
    assert got[100] == (30.0, dt.datetime(2024, 1, 1, 5))   # exact match, highest id wins
    assert got[101] == (None, None)                         # nothing earlier
    assert got[102] == (None, None)                         # other key only later


def test_asof_matches_pandas_merge_asof_on_events(spark):
    import pandas as pd
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    p = ev.where(F.col("event_type") == "purchase").select("user_id", "ts", "event_id")
    v = ev.where(F.col("event_type") == "view").select("user_id", "ts", F.col("event_id").alias("vid"),
                                                      F.col("value").alias("vv"))
    out = J.asof_backward(p, v, "ts", ["user_id"], ["vv"], "event_id", "vid", num_blocks=5).toPandas()
    lp, rp = p.toPandas().sort_values("ts"), v.toPandas().sort_values(["ts", "vid"])
    exp = pd.merge_asof(lp, rp, on="ts", by="user_id", direction="backward")
    m = out.merge(exp, on="event_id", suffixes=("", "_e"))
    assert len(m) == len(lp)
    assert (m.vv.fillna(-1) == m.vv_e.fillna(-1)).all()


def test_time_spine_has_gaps_as_rows(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0),), (dt.datetime(2024, 1, 1, 5),)], "ts timestamp_ntz")
    assert J.time_spine(df, "ts").count() == 6


def test_flag_membership(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "ts long")
    lab = spark.createDataFrame([(2,), (2,), (9,)], "ts long")
    got = {r.ts: r.f for r in J.flag_membership(df, lab, ["ts"], "f").collect()}
    assert got == {1: 0, 2: 1, 3: 0}
