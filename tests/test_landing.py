"""Deliveries spread over files, and versions are read by the newest row of a key."""

import datetime as dt

from hourglass.operators.dedup import keep_latest
from hourglass.plans import queries_stream as QS
from hourglass.sources.versions import newest


def test_deliveries_of_one_year_spread_over_files(spark, tmpdir_path, monkeypatch):
    cols = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date"
    rows = [(i % 300, i, 1, 1, 1.0, 1.0, 0.0, 0.0, "A", "F", dt.date(1995, 1 + i % 12, 1)) for i in range(800)]
    li = spark.createDataFrame(rows, cols)
    li.write.mode("overwrite").parquet(f"{tmpdir_path}/lineitem.parquet")
    landed = {}
    kept = QS.K.scd1_stream

    def stream(spark, src, schema, keys, seq, out, ckpt, files):
        landed["files"] = spark.read.schema(schema).parquet(src).select("_metadata.file_path").distinct().count()
        landed["batch"] = files
        return kept(spark, src, schema, keys, seq, out, ckpt, files)

    monkeypatch.setattr(QS.K, "scd1_stream", stream)
    got = QS.stream_scd1(spark, tmpdir_path)
    want = keep_latest(li, ["l_orderkey", "l_linenumber"], QS._LI_ORDER)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert landed["files"] > 4 and landed["batch"] > 1


def test_newest_equals_keep_latest(spark):
    rows = [(k, s, b, f"{k}{s}{b}") for k in ("a", None, "c") for b, s in ((0, None), (1, 5), (2, 3), (3, 5))]
    df = spark.createDataFrame(rows, "k string, s int, b long, v string")
    assert sorted(map(str, newest(df, ["k"], ["s", "b"]).collect())) == sorted(map(str, keep_latest(df, ["k"], ["s", "b"]).collect()))
