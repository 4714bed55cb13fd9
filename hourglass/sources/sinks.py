"""Sinks (S8) and model artefacts with sidecar metadata."""

from __future__ import annotations

import json
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def sink_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                 sort_within: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write a table; sorting happens only inside partitions at write."""
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


#: bytes of a file of a sorted landing, about (as the optimizer estimates the rows)
FILE_BYTES = 128 << 20


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the frame's size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def sink_sorted(df: DataFrame, path: str, order_cols: Sequence[str], file_bytes: int = FILE_BYTES) -> None:
    """Files that are sorted inside and hold disjoint ranges of ``order_cols``.

    Range partitioning samples the rows, so the ranges hold about as many rows
    each; their number follows the estimated size.
    """
    size = estimated_bytes(df)
    n = min(max(1, -(-size // file_bytes)), 100_000)
    df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols).write.mode("overwrite").parquet(path)


def sorted_manifest(spark: SparkSession, path: str, order_cols: Sequence[str]) -> DataFrame:
    """Per file of a landing: n_rows, least and greatest key, and inversions (rows below the row before them)."""
    key = F.struct(*order_cols)
    rows = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"), key.alias("key"))
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))   # a file has about FILE_BYTES
    return rows.withColumn("turn", F.coalesce((F.col("key") < before).cast("int"), F.lit(0))).groupBy("file").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("key").alias("least"), F.max("key").alias("greatest"), F.sum("turn").alias("inversions"))


def sorted_verdict(manifest: DataFrame) -> DataFrame:
    """One row: n_rows, rows_in_order, files_disjoint.  The manifest has a row per file."""
    # files that overlap share a point, so a file whose greatest key lies beyond the next file's least one tells it
    after = F.lead("least").over(Window.orderBy("least", "greatest"))
    return manifest.withColumn("over", F.coalesce((F.col("greatest") > after).cast("int"), F.lit(0))).agg(
        F.sum("n_rows").alias("n_rows"), (F.sum("inversions") == 0).alias("rows_in_order"), (F.sum("over") == 0).alias("files_disjoint"))


def save_model_with_metadata(spark: SparkSession, model, path: str, metadata: dict) -> None:
    """Spark ML persistence plus a one-row JSON sidecar (features,
    ranges, metrics, params)."""
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(metadata, default=float),)], "json string") \
        .coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load_model_metadata(spark: SparkSession, path: str, model_cls):
    """(model, metadata dict)."""
    model = model_cls.load(f"{path}/model")
    meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    return model, meta


def project_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Exactly the frozen feature list, in order."""
    return df.select(*features)
