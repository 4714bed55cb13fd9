"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def sized_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Partition sizing for a given input volume.

    * scan splits of ``target_partition_bytes`` (256 MiB by default), so
      each scan task holds a bounded slice;
    * initial shuffle partitions ~ input / target (at least 3 waves of the
      cores) - AQE coalesces them down at run time when stages are small
      and splits skewed ones;
    * advisory post-shuffle size equal to the target.

    100 TB on 1,000 executors x 8 cores gives ~370k initial shuffle
    partitions (AQE coalesces them); ``with_position`` cuts a numeric order column
    into 4 x partitions blocks and a temporal one into spans of time.
    """
    parts = max(3 * total_cores, int(input_bytes // target_partition_bytes) + 1)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def build_session(master: str | None = None, app: str = "hourglass",
                  shuffle_partitions: int | None = None, input_bytes: int | None = None,
                  total_cores: int | None = None) -> SparkSession:
    """Session with AQE on, UTC clock, no UI.

    On a cluster pass ``master=None`` and let spark-submit decide; give
    ``input_bytes`` / ``total_cores`` to size partitions with
    :func:`sized_conf`.  Locally ``local[N]`` with shuffle partitions sized to
    the cores.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    cores = os.cpu_count() or 8
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or cores),
        "spark.driver.memory": "16g",
    }
    if input_bytes:
        conf.update(sized_conf(input_bytes, total_cores or cores))
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is given by the deployment (a shared filesystem)
    and is only read here; when nothing is configured (local runs, tests) a
    local folder is made and registered with the SparkContext.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="hourglass-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checkpoint_once(df):
    """Reliable checkpoint that evaluates the plan once.

    An eager ``checkpoint()`` counts the rows and then writes the files in a
    second job that would recompute the whole upstream plan; persisting
    first lets the write read the cached blocks.  The cache is released as
    soon as the checkpoint files exist (they live in the shared folder named
    by ``spark.checkpoint.dir`` and survive executor loss).
    """
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


def stored(df):
    """The rows of ``df``, computed once, as a parquet table in the shared checkpoint folder.

    For tables as long as the input that several passes read: the write is
    one pass (nothing is cached first), and a later pass reads the columns
    it needs.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/hourglass-stored-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_small(df):
    """Compute a small intermediate result once and cut its lineage.

    Used for tables bounded by classes, thresholds or strategies that several
    branches of a plan read (otherwise each branch would re-run the whole
    upstream pipeline).  ``localCheckpoint`` is never used.
    """
    return checkpoint_once(df)
