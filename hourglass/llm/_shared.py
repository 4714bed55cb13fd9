"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.session import ensure_checkpoint_dir

#: The white space that separates words: space and code points 9 to 13.
SPACES = " \t\n\x0b\x0c\r"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application, as ``--py-files`` would.

    Functions that run in tasks are looked up there by module name, so an
    operator calls this before it makes any.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="hourglass-code-")) / "hourglass_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again.

    This cuts the lineage: a lost executor costs a re-read, and a table that
    several later steps read is computed once.
    """
    path = scratch(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bits of a key filter for each key, and at most (16 MiB in the driver and each executor).
FILTER_BITS_A_KEY, FILTER_BITS = 16, 1 << 27


def key_filter(keys: DataFrame, n: int) -> np.ndarray:
    """A Bloom filter of the column ``h`` (64-bit hashes) of ``n`` rows, as 64-bit words.

    The words are combined in an aggregation; the driver gets the words alone.
    More keys than fit its greatest size only make it let more rows pass.
    """
    bits = 1 << 16
    while bits < min(FILTER_BITS, n * FILTER_BITS_A_KEY):
        bits *= 2
    at = keys.select(F.explode(F.array(F.col("h").bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned("h", 32).bitwiseAND(F.lit(bits - 1)))).alias("at"))
    words = at.select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, int(at & 63))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def may_hold(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the filter may hold the hashes; no key that it was made of is missed."""
    h, mask = h.view(np.uint64), np.uint64(len(words) * 64 - 1)
    ok = np.ones(len(h), bool)
    for at in (h & mask, (h >> np.uint64(32)) & mask):
        ok &= (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return ok


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Bytes of rows in one Arrow batch on its way to a task's Python function.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Cut this session's Arrow batches by bytes, as rows hold whole texts; a limit that the session was given stays.

    By Spark's default a batch has 10,000 rows or 64 MB, and an executor holds it in several copies for each task.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def released(run):
    """A function of batches that gives its worker's free Arrow memory back at the end of a task; idle workers keep it otherwise."""
    def wrapped(batches):
        import pyarrow as pa

        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return wrapped


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key's text modulo n; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts (one aggregated row)."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def sum_by(ids: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact integer sums of ``values`` by ``ids`` (0..n-1)."""
    out = np.zeros(n, np.int64)
    if len(ids):
        order = np.argsort(ids, kind="stable")
        at = ids[order]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        out[at[first]] = np.add.reduceat(values[order].astype(np.int64), first)
    return out
