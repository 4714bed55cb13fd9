"""Exact de-duplication against immutable snapshots screened by binary-fuse filters.

A snapshot is a set of texts that never changes.  Its digests are dealt to
shards by their leading bits; each shard has a static 8-bit binary-fuse
filter (about 9 bits a digest, no false negatives, 0.4 % false positives)
and exact buckets (one row per digest).  A new batch is first reduced to
distinct digests, which groups its own duplicates separately.  The filters
screen these: a digest they reject is new, one they pass joins the exact
buckets.  Texts that meet under one digest are compared byte for byte.

Texts are equal when identical after deleting white space (space and code
points 9 to 13).  Of equal texts the row with the most code points in the
original text, then the smallest doc_id, stays.

Defined results: a null text counts as empty, all empty texts are equal; a
null doc_id is the last choice to stay and its row is kept only if all rows
of its group have none; rows with equal doc_id and equal text share their
result; an empty table gives an empty result; other columns are not read by
``dedup`` and passed through by ``keep_one``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import SPACES, crc_mod, mix64, ship, written

#: Digests per filter shard: bounds a shard's build in memory.
SHARD_DIGESTS = 400_000
KEY = "conv(substring(digest, 1, 16), 16, -10)"


# --- binary-fuse filter -----------------------------------------------------

def _slots(keys: np.ndarray, seed: int, segment: int, segments: int) -> np.ndarray:
    """Three slots a key, in three consecutive segments."""
    h = mix64(keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
    first = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    base = first.astype(np.int64) * segment
    g = mix64(h ^ np.uint64(0xD6E8FEB86659FD93))
    mask = np.uint64(segment - 1)
    return np.stack([base + (g & mask).astype(np.int64),
                     base + segment + ((g >> np.uint64(21)) & mask).astype(np.int64),
                     base + 2 * segment + ((g >> np.uint64(42)) & mask).astype(np.int64)])


def _print8(keys: np.ndarray, seed: int) -> np.ndarray:
    return (mix64(keys ^ np.uint64(seed * 2 + 1)) >> np.uint64(56)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, bytes]:
    """(seed, segment length, table) over distinct uint64 keys.

    Keys that are alone in a slot are peeled off in rounds; going back over
    the rounds, each gets the byte that makes its three slots xor to its
    fingerprint.  A seed that doesn't peel to nothing is replaced.
    """
    n = len(keys)
    segment = 1 << max(2, min(18, int(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
    size = int(n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 3)))) + 8
    segments = max(1, -(-size // segment) - 2)
    for seed in range(1, 1000):
        slots = _slots(keys, seed, segment, segments)
        total = (segments + 2) * segment
        count = np.bincount(slots.ravel(), minlength=total)
        held = np.zeros(total, np.int64)  # xor of the numbers of a slot's keys
        for row in slots:
            np.bitwise_xor.at(held, row, np.arange(n))
        rounds, left = [], n
        alone = np.flatnonzero(count == 1)
        while len(alone):
            key, at = np.unique(held[alone], return_index=True)
            rounds.append((key, alone[at]))
            left -= len(key)
            touched = slots[:, key].ravel()
            np.subtract.at(count, touched, 1)
            np.bitwise_xor.at(held, touched, np.tile(key, 3))
            touched = np.unique(touched)
            alone = touched[count[touched] == 1]
        if not left:
            break
    else:
        raise ValueError("no seed peels; are the keys distinct?")
    table, prints = np.zeros(total, np.uint8), _print8(keys, seed)
    for key, at in reversed(rounds):
        others = table[slots[0, key]] ^ table[slots[1, key]] ^ table[slots[2, key]] ^ table[at]
        table[at] = others ^ prints[key]
    return seed, segment, table.tobytes()


def may_contain(keys: np.ndarray, seed: int, segment: int, table: bytes) -> np.ndarray:
    t = np.frombuffer(table, np.uint8)
    a, b, c = _slots(keys, seed, segment, len(t) // segment - 2)
    return (t[a] ^ t[b] ^ t[c]) == _print8(keys, seed)


# --- snapshot and screening ---------------------------------------------------

def digests(docs: DataFrame, *extra: Column) -> DataFrame:
    """(doc_id, digest, chars, extra...): the digest of the normalised text."""
    text = F.coalesce(docs["text"], F.lit(""))
    norm = F.translate(text, SPACES, "")
    return docs.select(docs["doc_id"], F.sha2(norm.cast("binary"), 256).alias("digest"), F.length(text).cast("long").alias("chars"), *extra)


def buckets(rows: DataFrame) -> DataFrame:
    """One row per digest: number of rows and the row that stays."""
    best = F.max(F.struct("chars", F.expr("doc_id IS NOT NULL").alias("has_id"), F.expr("~cast(doc_id as long)").alias("neg"))).alias("best")
    return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), best)


def shard_of(n_shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(n_shards)).cast("int")


def snapshot_filters(exact: DataFrame, n_shards: int) -> DataFrame:
    """One filter a shard over a snapshot's exact buckets."""
    def build(table: pa.Table) -> pa.Table:
        keys = np.unique(np.array(table.column("key").to_pylist(), np.int64).view(np.uint64))
        seed, segment, blob = build_filter(keys)
        return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "seed": pa.array([seed], pa.int32()),
                         "segment": pa.array([segment], pa.int32()), "blob": pa.array([blob], pa.binary())})

    keyed = exact.select(shard_of(n_shards).alias("shard"), F.expr(f"cast({KEY} as long)").alias("key"))
    return keyed.groupBy("shard").applyInArrow(build, "shard int, seed int, segment int, blob binary")


def screen(incoming: DataFrame, filters: DataFrame, n_shards: int) -> DataFrame:
    """The digests of a batch that the snapshot's filters don't reject."""
    def test(new: pa.Table, filt: pa.Table) -> pa.Table:
        if not filt.num_rows or not new.num_rows:
            return new.slice(0, 0).select(["digest"])
        f = filt.to_pylist()[0]
        keys = np.array(new.column("key").to_pylist(), np.int64).view(np.uint64)
        return new.filter(pa.array(may_contain(keys, f["seed"], f["segment"], f["blob"]))).select(["digest"])

    keyed = incoming.select("digest", shard_of(n_shards).alias("shard"), F.expr(f"cast({KEY} as long)").alias("key"))
    return keyed.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(test, "digest string")


def collisions(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Digests of ``groups`` whose rows aren't all the same bytes (normally none).

    Only rows whose digest has several rows are compared; the least and the
    greatest normalised text are found with partial aggregation, so a large
    group is reduced before the shuffle.
    """
    norm = F.translate(F.coalesce("text", F.lit("")), SPACES, "").cast("binary")
    many = groups.where("n > 1").select("digest")
    rows = docs.select(norm.alias("norm")).withColumn("digest", F.sha2("norm", 256)).join(many, "digest", "left_semi")
    return rows.groupBy("digest").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi")).where("lo <> hi").select("digest")


def dedup(spark: SparkSession, docs: DataFrame, in_snapshot: Column | None = None, shard_digests: int = SHARD_DIGESTS) -> DataFrame:
    """Groups of equal texts: doc_id, keep_id, group_size, kept, text_sha256, one row per input row.

    ``in_snapshot`` tells the rows of the immutable snapshot from those of
    the new batch (by default, by the id's hash).
    """
    ship(spark)
    in_snapshot = crc_mod(docs["doc_id"], 2) == 0 if in_snapshot is None else in_snapshot
    rows = written(digests(docs, in_snapshot.alias("old")), "digests")
    old = written(buckets(rows.where("old")), "buckets")
    new = written(buckets(rows.where("NOT old")), "batch")
    n_shards = max(1, math.ceil(max(old.count(), new.count()) / shard_digests))
    hits = screen(new, snapshot_filters(old, n_shards), n_shards)
    # exact buckets of the digests that passed the screen; all others are in one side only
    met = written(old.join(hits, "digest", "left_semi"), "met")
    other = new.select("digest", F.col("n").alias("n2"), F.col("best").alias("best2"))
    both = met.join(other, "digest").select("digest", F.expr("n + n2").alias("n"), F.greatest("best", "best2").alias("best"))
    one_side = old.unionByName(new).join(met.select("digest"), "digest", "left_anti")
    groups = written(one_side.unionByName(both), "groups")
    clash = written(collisions(docs, groups), "clash")
    return assemble(docs, rows, groups, clash)


def assemble(docs: DataFrame, rows: DataFrame, groups: DataFrame, clash: DataFrame) -> DataFrame:
    out = rows.join(groups, "digest").select("doc_id", F.expr("~best.neg").alias("keep_id"), F.col("n").alias("group_size"), F.col("digest").alias("text_sha256"))
    if not clash.isEmpty():
        # different bytes under one digest: group these rows by the bytes themselves
        norm = F.translate(F.coalesce(docs["text"], F.lit("")), SPACES, "")
        apart = digests(docs, norm.alias("norm")).join(clash, "digest", "left_semi")
        exact = apart.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("chars", F.expr("doc_id IS NOT NULL").alias("has_id"), F.expr("~cast(doc_id as long)").alias("neg"))).alias("best"))
        redo = apart.join(exact, ["digest", "norm"]).select("doc_id", F.expr("~best.neg").alias("keep_id"), F.col("n").alias("group_size"), F.col("digest").alias("text_sha256"))
        out = out.join(clash.withColumnRenamed("digest", "text_sha256"), "text_sha256", "left_anti").select(*redo.columns).unionByName(redo)
    return out.select("doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), "text_sha256")


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns; repeats of one doc_id and text count as one."""
    verdict = dedup(spark, docs.select("doc_id", "text"))
    stay = verdict.where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    norm = F.sha2(F.translate(F.coalesce(docs["text"], F.lit("")), SPACES, "").cast("binary"), 256)
    held = docs.select(F.struct(*docs.columns).alias("row"), norm.alias("_own"))
    found = held.join(stay, held["row.doc_id"].eqNullSafe(stay["_id"]) & (held["_own"] == stay["_sha"]), "left_semi")
    return found.withColumn("_id", F.col("row.doc_id")).dropDuplicates(["_id", "_own"]).select("row.*")
