"""Mixing sources to target weights by Sainte-Lague apportionment.

Every source is dealt to shards by the hash of its documents.  A shard's
documents, in seeded order, form one run of words that is cut into blocks of
equal size.  The blocks of the whole mix are divided among the sources by
the highest quotients target / (s + 1/2) (Sainte-Lague), each source's
blocks among its shards in the same way by shard size, so every shard has
an integer quota.  A shard with n blocks and quota q takes each block
q div n times, and q mod n of them once more, by seeded systematic selection
(a seeded start, equal steps).  Which blocks a document touches is
arithmetic on its place in the run, so no block is ever a row.

Targets: sources in code-point order, null last, weigh 5, 2, 1, repeating;
together they get 150 % of all words; a target stops at twice its source's
size and the excess is shared by weight among the rest.

Defined results: a null text has size 0 and is never taken; a null source
is a source; rows with equal id and text are separate documents; an empty
table gives an empty result; other columns are passed through by ``mixed``.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ._shared import SPACES, ship, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
#: Words of a block.
BLOCK = 16
#: Rows of a shard, on average: a source with a third of all rows has a third of the shards.
SHARD_ROWS = 20_000
SEED = 17
#: Parts of a copy that are carried from document to document.
PART = 1 << 30


def n_words(text: Column) -> Column:
    """Runs of characters other than white space."""
    flat = F.trim(F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES)))
    return F.when(flat == "", 0).otherwise(F.size(F.split(flat, " +"))).cast("long")


def targets(sizes: np.ndarray, weights: np.ndarray, share: float = SHARE, most: float = MOST) -> np.ndarray:
    """Weighted shares of ``share`` times all words, none above ``most`` times its source's size."""
    sizes, cap = sizes.astype(float), most * sizes.astype(float)
    out, free = np.zeros(len(sizes)), np.ones(len(sizes), bool)
    rest = share * sizes.sum()
    while free.any():
        want = rest * weights / weights[free].sum()
        over = free & (want > cap)
        if not over.any():
            out[free] = want[free]
            break
        out[over] = cap[over]
        rest -= cap[over].sum()
        free &= ~over
    return out


def sainte_lague(votes: np.ndarray, seats: int) -> np.ndarray:
    """Seats by the highest quotients votes / (s + 1/2); ties go to the earlier row.

    A divisor that gives almost all seats is found by halving; the last few
    are dealt one by one by their quotients.
    """
    votes = np.maximum(votes.astype(float), 0)
    out = np.zeros(len(votes), np.int64)
    if seats <= 0 or votes.sum() <= 0:
        return out
    lo, hi = 0.0, votes.max() * 2 + 1  # divisors that give too many seats, too few
    for _ in range(200):
        mid = (lo + hi) / 2
        if mid <= 0 or mid in (lo, hi):
            break
        if np.floor(votes / mid + 0.5).sum() > seats:
            lo = mid
        else:
            hi = mid
    out = np.floor(votes / hi + 0.5).astype(np.int64)
    heap = [(-votes[i] / (out[i] + 0.5), i) for i in np.flatnonzero(votes > 0)]
    heapq.heapify(heap)
    for _ in range(seats - int(out.sum())):
        _, i = heap[0]
        out[i] += 1
        heapq.heapreplace(heap, (-votes[i] / (out[i] + 0.5), i))
    return out


def source_plan(sources: DataFrame, block: int) -> DataFrame:
    """Target and block quota of each source; one row per source goes through one task."""
    def plan(p: pd.DataFrame) -> pd.DataFrame:
        p = p.assign(_null=p["source"].isna(), _key=[x if isinstance(x, str) else "" for x in p["source"]]).sort_values(["_null", "_key"])
        p = p.reset_index(drop=True)
        size = p["source_size"].to_numpy(np.int64)
        weight = np.resize(np.array(WEIGHTS, float), len(p)) if len(p) else np.zeros(0)
        goal = targets(size, weight)
        quota = sainte_lague(goal, int(round(goal.sum() / block)))
        return pd.DataFrame({"source": [None if n else k for n, k in zip(p["_null"], p["_key"])], "source_size": size, "target": goal, "quota": quota})

    return sources.groupBy(F.lit(0).alias("one")).applyInPandas(lambda p: plan(p[["source", "source_size"]]), "source string, source_size long, target double, quota long")


def shard_plan(shards: DataFrame, block: int, most: float = MOST) -> DataFrame:
    """Integer quotas of a source's shards; none above ``most`` times its blocks.  One row per shard of a source."""
    def plan(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("shard").reset_index(drop=True)
        size, seats = p["shard_size"].to_numpy(np.int64), int(p["quota"].iloc[0])
        room = (most * -(-size // block)).astype(np.int64)
        seats = min(seats, int(room.sum()))
        got = np.zeros(len(p), np.int64)
        while (left := seats - int(got.sum())) > 0:
            got = np.minimum(got + sainte_lague(np.where(got < room, size, 0), left), room)
        return pd.DataFrame({"src_key": p["src_key"], "shard": p["shard"], "n_blocks": -(-size // block), "shard_quota": got})

    return shards.groupBy("src_key").applyInPandas(lambda p: plan(p), "src_key string, shard int, n_blocks long, shard_quota long")


def _placed(docs: DataFrame, block: int, shard_rows: int, seed: int) -> DataFrame:
    """Each document's words taken, with two hashes (_order, _check) that name its row."""
    ship(docs.sparkSession)
    key = F.concat(F.when(F.col("source").isNull(), "0").otherwise("1"), F.coalesce("source", F.lit("")))
    rows = docs.select(docs["doc_id"].alias("_id"), docs["source"].cast("string").alias("source"), n_words(docs["text"]).alias("_size"),
                       F.xxhash64(F.lit(seed), docs["doc_id"], docs["text"]).alias("_order"), F.xxhash64(F.lit("check"), docs["doc_id"], docs["text"]).alias("_check"))
    rows = written(rows.withColumn("src_key", key), "sizes")
    per = written(rows.groupBy("src_key", "source").agg(F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("n_rows")), "sources")
    plan = source_plan(per.select("source", "source_size"), block).withColumn("src_key", key).drop("source")
    plan = written(plan.join(per.select("src_key", F.ceil(F.col("n_rows") / shard_rows).cast("int").alias("n_shards")), "src_key"), "plan")
    dealt = rows.join(plan, "src_key").withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "_order"), F.col("n_shards")).cast("int"))
    quotas = shard_plan(dealt.groupBy("src_key", "shard", "quota").agg(F.sum("_size").alias("shard_size")), block)
    w = W.partitionBy("src_key", "shard").orderBy("_order", "_check").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = dealt.withColumn("_end", F.sum("_size").over(w)).withColumn("_start", F.col("_end") - F.col("_size")).join(quotas, ["src_key", "shard"])
    n = F.greatest(F.col("n_blocks"), F.lit(1))
    placed = placed.withColumns({"_n": n, "_once": F.floor(F.col("shard_quota") / n), "_more": F.pmod(F.col("shard_quota"), n),
                                 "_from": F.pmod(F.xxhash64(F.lit(seed), F.lit("start"), "src_key", "shard"), n)})

    def chosen(b: Column) -> Column:
        """How many of the first b blocks are taken once more."""
        return F.floor((b * F.col("_more") + F.col("_from")) / F.col("_n"))

    def words(x: Column) -> Column:
        """Words of these blocks in front of word x: whole blocks, then a part of x's own."""
        b = F.floor(x / block)
        return chosen(b) * block + (chosen(b + 1) - chosen(b)) * F.pmod(x, F.lit(block))

    taken = F.col("_size") * F.col("_once") + words(F.col("_end")) - words(F.col("_start"))
    return placed.withColumn("taken", taken.cast("long"))


def mix(docs: DataFrame, block: int = BLOCK, shard_rows: int = SHARD_ROWS, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per document."""
    return _placed(docs, block, shard_rows, seed).select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target", "taken")


def mixed(docs: DataFrame, block: int = 1024, shard_rows: int = SHARD_ROWS, seed: int = SEED) -> DataFrame:
    """The mix itself: whole documents, each as often as the part of it that is taken, rounded up or down.

    What rounding adds or leaves out is carried along the documents of a shard
    in order of size from a seeded start, so it never sums to more than about
    the words of the shard's longest document, at whatever ratio.  Blocks are
    larger here than most documents, so that these are taken or left as a
    whole.  Rows with equal id and text count together; their other columns
    come from one of them.
    """
    placed = _placed(docs.select("doc_id", "source", "text"), block, shard_rows, seed).where("_size > 0")
    # parts of PART, as integers, so that sums don't depend on their order
    placed = placed.withColumn("_part", F.round(F.col("taken") / F.col("_size") * PART).cast("long"))
    w = W.partitionBy("src_key", "shard").orderBy("_size", "_order", "_check").rowsBetween(W.unboundedPreceding, W.currentRow)
    to = F.sum("_part").over(w) + F.pmod(F.xxhash64(F.lit(seed), F.lit("round"), "src_key", "shard"), F.lit(PART))
    copies = placed.withColumn("_to", to).withColumn("_copies", F.floor(F.col("_to") / PART) - F.floor((F.col("_to") - F.col("_part")) / PART))
    times = copies.groupBy("_order", "_check").agg(F.sum("_copies").cast("int").alias("_times")).where("_times > 0")
    named = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("_order"), F.xxhash64(F.lit("check"), "doc_id", "text").alias("_check"))
    copies = named.dropDuplicates(["_order", "_check"]).join(times, ["_order", "_check"])
    return copies.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_times"))).select("row.*")
