"""Scans of the driver tables and landed feed files (S2-S5, S7), with NaN
normalised to NULL at the scan."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from ..functions.numeric import nan_to_null

CSV_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def normalize_nan(df: DataFrame) -> DataFrame:
    """Every floating column: NaN -> NULL (pandas' missing value)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out.append(nan_to_null(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def table(spark: SparkSession, sf_dir: str, name: str, where: Column | None = None) -> DataFrame:
    """One driver table, NaN-normalised, and its rows that meet ``where``.

    Filters on a normalised floating column cannot reach the parquet scan, so
    ``where`` is applied to the raw columns, where it is pushed down, and again
    to the normalised ones: a raw NaN is above every number and passes the
    first.  ``where`` must not hold for a missing value."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if where is None:
        return normalize_nan(df)
    return normalize_nan(df.where(where)).where(where)


def scan_parquet_glob(spark: SparkSession, pattern: str, schema: StructType | None = None,
                      with_source: bool = False) -> DataFrame:
    """All files matching ``pattern`` in one scan (no per-file loop)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(pattern)
    if with_source:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return normalize_nan(df)


def bronze_ingest(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """S1 (batch form): every file under ``path`` with schema evolution
    (``mergeSchema``: a superset schema, missing columns NULL), stamped with
    ingestion time and source file."""
    r = spark.read.option("mergeSchema", "true")
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    return normalize_nan(df).withColumn("_ingested_at", F.current_timestamp()) \
        .withColumn("source_file", F.col("_metadata.file_path"))


def scan_csv_multi(spark: SparkSession, paths: str | Sequence[str], schema: StructType,
                   header: bool = True, with_source: bool = False) -> DataFrame:
    """N CSV files (list or glob) with an explicit schema, one scan."""
    df = (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
          .option("timestampNTZFormat", CSV_TS_FORMAT)
          .csv(paths if isinstance(paths, str) else list(paths)))
    if with_source:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return normalize_nan(df)


def scan_mixed_format(spark: SparkSession, csv_paths: str | Sequence[str], parquet_paths: str | Sequence[str],
                      schema: StructType) -> DataFrame:
    """S3: one feed delivered as both CSV and parquet files -> one frame.
    Paths may be globs; Spark expands them on the cluster's file system."""
    parts = []
    if csv_paths:
        parts.append(scan_csv_multi(spark, csv_paths, schema))
    if parquet_paths:
        pq = [parquet_paths] if isinstance(parquet_paths, str) else list(parquet_paths)
        parts.append(normalize_nan(spark.read.schema(schema).parquet(*pq)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def normalize_variants(df: DataFrame, variants: dict[str, Sequence[str]]) -> DataFrame:
    """Case-fold column names, then map each canonical column to the first
    variant present (decided on the driver from ``df.columns`` - metadata
    only).  Raises if a canonical column has no variant."""
    lowered = {c.lower().strip(): c for c in df.columns}
    cols = []
    for canon, options in variants.items():
        hit = next((lowered[o.lower()] for o in options if o.lower() in lowered), None)
        if hit is None:
            raise ValueError(f"none of {list(options)} present for {canon}: {df.columns}")
        cols.append(F.col(f"`{hit}`").alias(canon))
    return df.select(*cols)


def union_variants(frames: Iterable[DataFrame], variants: dict[str, Sequence[str]]) -> DataFrame:
    """Normalise each delivered schema variant and union them."""
    out = None
    for f in frames:
        n = normalize_variants(f, variants)
        out = n if out is None else out.unionByName(n, allowMissingColumns=True)
    return out


def long_sheets_union(frames: Iterable[DataFrame], skip_names: Sequence[str] = ("report info", "sheet1"),
                      names: Sequence[str] | None = None) -> DataFrame:
    """S6 (re-aimed): landed per-sheet files with stripped header names are
    unioned; sheets whose name is in ``skip_names`` are dropped.  The caller
    aggregates the union once (no per-sheet aggregate)."""
    out = None
    frames = list(frames)
    names = list(names) if names is not None else [None] * len(frames)
    for f, name in zip(frames, names):
        if name is not None and name.strip().lower() in skip_names:
            continue
        g = f.select(*[F.col(f"`{c}`").alias(c.strip()) for c in f.columns])
        out = g if out is None else out.unionByName(g, allowMissingColumns=True)
    return out


def nested_arrays_to_rows(df: DataFrame, struct_col: str, time_field: str,
                          value_fields: Sequence[str], aliases: dict[str, str] | None = None) -> DataFrame:
    """``{hourly: {time: [...], x: [...], y: [...]}}`` -> one row per time.
    Field-name variants are resolved with ``aliases`` (first present wins)."""
    fields = {f.name for f in df.schema[struct_col].dataType.fields}
    aliases = aliases or {}
    arrays = [F.col(f"{struct_col}.{time_field}").alias(time_field)]
    for v in value_fields:
        options = [v] + [a for a, canon in aliases.items() if canon == v]
        hit = next((o for o in options if o in fields), None)
        arrays.append((F.col(f"{struct_col}.{hit}") if hit else F.lit(None).cast("array<double>")).alias(v))
    zipped = df.select(F.explode(F.arrays_zip(*arrays)).alias("_z"))
    return zipped.select(F.to_timestamp_ntz(F.col(f"_z.{time_field}")).alias("ts"),
                         *[F.col(f"_z.{v}").alias(v) for v in value_fields])
