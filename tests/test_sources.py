"""Scans and sinks on landed micro-fixture files."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from hourglass.sources import sinks
from hourglass.sources import tables as SRC


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_scan_csv_multi_and_mixed(spark, tmpdir_path):
    d = tmpdir_path
    _write(f"{d}/a.csv", "SettlementPointName,DeliveryDate,DeliveryHour,DeliveryInterval,SettlementPointPrice\n"
                         "HUB_A,2024-01-01,1,1,10.0\nHUB_A,2024-01-01,1,2,12.0\nHUB_B,2024-01-01,1,1,9.0\n")
    _write(f"{d}/b.csv", "SettlementPointName,DeliveryDate,DeliveryHour,DeliveryInterval,SettlementPointPrice\n"
                         "HUB_A,2024-01-01,2,1,bad\n")
    schema = StructType([StructField("SettlementPointName", StringType()), StructField("DeliveryDate", StringType()),
                         StructField("DeliveryHour", IntegerType()), StructField("DeliveryInterval", IntegerType()),
                         StructField("SettlementPointPrice", DoubleType())])
    df = SRC.scan_csv_multi(spark, f"{d}/*.csv", schema, with_source=True)
    assert df.count() == 4
    assert df.where(F.col("SettlementPointPrice").isNull()).count() == 1   # bad numeric -> NULL
    assert df.select("source_file").distinct().count() == 2
    pq = f"{d}/pq"
    spark.createDataFrame([("HUB_A", "2024-01-02", 1, 1, 5.0)], schema).write.parquet(pq)
    mixed = SRC.scan_mixed_format(spark, [f"{d}/a.csv"], [pq], schema)
    assert mixed.count() == 4


def test_schema_variants_normalised(spark):
    a = spark.createDataFrame([("2025-12-06 00:00:00", 5.0)], "SCED_Timestamp_UTC string, RTRDPA double")
    b = spark.createDataFrame([("2025-12-07 00:00:00", 6.0)], "scedtimestamp string, rtrdpa double")
    variants = {"ts": ["sced_timestamp_utc", "scedtimestamp"], "rtrdpa": ["rtrdpa"]}
    out = SRC.union_variants([a, b], variants)
    assert out.columns == ["ts", "rtrdpa"] and out.count() == 2
    with pytest.raises(ValueError):
        SRC.normalize_variants(spark.createDataFrame([(1,)], "x int"), variants)


def test_long_sheets_union_skips_info_sheets(spark):
    s1 = spark.createDataFrame([("2021-01-01 00:05", 1.0)], "` SCED Timestamp ` string, `PRC ` double")
    s2 = spark.createDataFrame([("x", 0.0)], "` SCED Timestamp ` string, `PRC ` double")
    out = SRC.long_sheets_union([s1, s2], names=["Jan", "Report Info"])
    assert out.columns == ["SCED Timestamp", "PRC"] and out.count() == 1


def test_nested_arrays_to_rows_with_name_variants(spark, tmpdir_path):
    doc = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5, 2.5],
                      "relative_humidity_2m": [80.0, 81.0]}}
    p = os.path.join(tmpdir_path, "w.json")
    _write(p, json.dumps(doc))
    raw = spark.read.option("multiLine", True).json(p)
    out = SRC.nested_arrays_to_rows(raw, "hourly", "time", ["temperature_2m", "relativehumidity_2m"],
                                    aliases={"relative_humidity_2m": "relativehumidity_2m"}).orderBy("ts")
    rows = out.collect()
    assert [r.temperature_2m for r in rows] == [1.5, 2.5]
    assert [r.relativehumidity_2m for r in rows] == [80.0, 81.0]


def test_parquet_glob_and_sink_roundtrip(spark, tmpdir_path):
    df = SRC.scan_parquet_glob(spark, "/root/testdata/sf0.001/event*.parquet", with_source=True)
    out = f"{tmpdir_path}/sink"
    sinks.sink_parquet(df.withColumn("day", F.to_date("ts")), out, partition_by=["day"], sort_within=["ts"])
    assert spark.read.parquet(out).count() == df.count()


def test_model_with_metadata_roundtrip(spark, tmpdir_path):
    from pyspark.ml import PipelineModel
    from hourglass.operators.models import fit_linear
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "x double, y double")
    m = fit_linear(df, ["x"], "y")
    sinks.save_model_with_metadata(spark, m, f"{tmpdir_path}/m", {"features": ["x"], "mae": 0.0})
    m2, meta = sinks.load_model_metadata(spark, f"{tmpdir_path}/m", PipelineModel)
    assert meta["features"] == ["x"]
    assert m2.transform(df).agg(F.max(F.abs(F.col("prediction") - F.col("y")))).first()[0] < 1e-9


def test_sorted_landing_is_sorted_and_disjoint(spark, tmpdir_path):
    from hourglass.sources import sinks
    df = spark.range(5000).select((F.col("id") * 7919 % 997).alias("k"), "id")
    sinks.sink_sorted(df, tmpdir_path + "/a", ["k", "id"], file_bytes=8000)
    manifest = sinks.sorted_manifest(spark, tmpdir_path + "/a", ["k", "id"])
    assert manifest.count() > 3
    assert tuple(sinks.sorted_verdict(manifest).first()) == (5000, True, True)
    df.repartition(3).write.parquet(tmpdir_path + "/b")                      # neither in order nor disjoint
    assert tuple(sinks.sorted_verdict(sinks.sorted_manifest(spark, tmpdir_path + "/b", ["k", "id"])).first()) == (5000, False, False)
    df.repartition(3).sortWithinPartitions("k", "id").write.parquet(tmpdir_path + "/c")
    assert tuple(sinks.sorted_verdict(sinks.sorted_manifest(spark, tmpdir_path + "/c", ["k", "id"])).first()) == (5000, True, False)
