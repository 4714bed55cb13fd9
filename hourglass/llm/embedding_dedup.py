"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

1. A bounded sample (SAMPLE rows with the least hashes) gives the mean and, by
   iterative quantisation, several rotations; the signs of a rotated vector are
   balanced bits.  Rows with equal label and equal components are one class, so
   copies never meet as pairs.
2. The code is cut into substrings, one Hamming table each: classes of a label
   that agree in a whole substring meet in a bucket.  The number of tables
   comes from pairs simulated at the threshold: at most MISS of them share
   none.  The length of a substring follows the logarithm of the largest label,
   so that chance puts about MATES classes of a label into a bucket at any size.
   Bucket mates within RADIUS of the first CHECK_BITS bits are candidates; a
   task passes on, for each row, the least row it reaches, not the pairs.
3. Connected candidates form a cluster.  Its original vectors are compared in
   double precision, in blocks of rows; a task returns counts and the least row
   reached, again no pairs.

Buckets and clusters beyond BLOCK rows are cut into blocks, and every two blocks
meet in a task, so no group is held whole and no row is dropped.

Defined results: a null label, a null, empty or zero vector, and one with a null
or non-finite component link with nothing; vectors of different length are
never compared; a repeated row counts as another vector; a null vec_id names
no component that has other ids; an empty table gives an empty result; other
columns are not read.  A pair that shares no substring, and whose ends no chain
of candidates joins, is missed (the README has the recall against all pairs).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import mix64, ship, written
from .minhash import components

#: Rows that the rotations are learned from, and rounds of learning.
SAMPLE, ROUNDS = 4096, 40
#: Bits of one rotation at most.
WIDTH = 64
#: Part of the simulated pairs at the threshold that may share no table.
MISS = 1e-3
#: Simulated pairs.
TRIALS = 20_000
#: Classes of a label that chance puts into one bucket, and the least length of a substring.
MATES, MIN_BITS = 64, 8
#: Tables at most (the simulation needs about 10 to 30).
TABLES = 64
#: Bits of the code that candidates are checked by.
CHECK_BITS = 128
#: Rows of a block of a large bucket or cluster.
BLOCK = 4096
#: Cells of a matrix that is compared at a time.
CELLS = 1 << 22


class Coder:
    """Codes of vectors: mean, projections and learned rotations."""

    def __init__(self, sample: np.ndarray, threshold: float, largest: int):
        """``sample``: unit vectors as rows; ``largest``: classes of the largest label."""
        rng = np.random.default_rng(11)
        self.dim = sample.shape[1]
        self.mean = sample.mean(axis=0)
        centred = sample - self.mean
        axes = np.linalg.svd(centred, full_matrices=False)[2][: min(WIDTH, self.dim)]
        # as many axes as the space has, also for a sample of fewer rows
        axes = np.linalg.qr(np.vstack([axes, rng.standard_normal((min(WIDTH, self.dim), self.dim))]).T)[0].T[: min(WIDTH, self.dim)]
        projected = centred @ axes.T
        self.bits = max(MIN_BITS, int(np.ceil(np.log2(max(largest, 1) / MATES))) if largest > MATES else MIN_BITS)
        self.bits = min(self.bits, 32)
        # pairs at the threshold: a sample row and a row that is turned in a random direction
        one = sample[rng.integers(0, len(sample), TRIALS)]
        off = rng.standard_normal(one.shape)
        off -= (off * one).sum(axis=1, keepdims=True) * one
        norm = np.linalg.norm(off, axis=1, keepdims=True)
        other = threshold * one + np.sqrt(1 - threshold * threshold) * off / np.where(norm > 0, norm, 1)
        self.planes = np.zeros((0, self.dim))
        self.tables, self.radius = 0, 0
        missed = np.ones(TRIALS, bool)
        while self.tables < TABLES and missed.mean() > MISS or len(self.planes) < CHECK_BITS:
            turn = _rotation(projected, rng)
            self.planes = np.vstack([self.planes, turn.T @ axes])
            while (self.tables + 1) * self.bits <= len(self.planes) and self.tables < TABLES and missed.mean() > MISS:
                part = slice(self.tables * self.bits, (self.tables + 1) * self.bits)
                differ = (self._signs(one, part) != self._signs(other, part)).any(axis=1)
                missed &= differ
                self.tables += 1
        part = slice(0, CHECK_BITS)
        apart = (self._signs(one, part) != self._signs(other, part)).sum(axis=1)
        self.radius = int(np.ceil(apart.mean() + 6 * apart.std()))

    def _signs(self, rows: np.ndarray, part: slice) -> np.ndarray:
        return (rows - self.mean) @ self.planes[part].T > 0

    def code(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Substrings (row, table) as integers, and the check bits as two 64-bit numbers a row."""
        need = max(self.tables * self.bits, CHECK_BITS)
        sign = self._signs(rows, slice(0, need))
        weight = (np.uint64(1) << np.arange(self.bits, dtype=np.uint64))
        sub = sign[:, : self.tables * self.bits].reshape(len(rows), self.tables, self.bits)
        sub = (sub * weight).sum(axis=2, dtype=np.uint64)
        check = np.packbits(sign[:, :CHECK_BITS], axis=1).view("<u8")
        return sub, check


def _rotation(rows: np.ndarray, rng) -> np.ndarray:
    """A rotation that brings the rows near the corners of a cube: signs and rotation are fitted in turn."""
    turn = np.linalg.qr(rng.standard_normal((rows.shape[1],) * 2))[0]
    for _ in range(ROUNDS):
        corner = np.where(rows @ turn > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(rows.T @ corner)
        turn = left @ right
    return turn


def vectors(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, their components as read, unit vectors in double precision) of the usable vectors, by length."""
    size = np.array(col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    flat = col.flatten()
    flat = flat.to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0)
    start = np.cumsum(size) - size
    for d in np.unique(size[size > 0]):
        at = np.flatnonzero(size == d)
        raw = flat[start[at][:, None] + np.arange(d)]
        v = raw.astype(np.float64)
        ok = np.isfinite(v).all(axis=1)
        top = np.abs(np.where(np.isfinite(v), v, 0)).max(axis=1)
        ok &= top > 0
        v = v[ok] / top[ok, None]  # squares neither overflow nor vanish
        yield at[ok], raw[ok], v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least row that each of n rows reaches by the pairs (i, j)."""
    lab = np.arange(n)
    while True:
        a, b = lab[i], lab[j]
        live = a != b
        if not live.any():
            return lab
        i, j = i[live], j[live]
        np.minimum.at(lab, np.maximum(a, b)[live], np.minimum(a, b)[live])
        while (lab[lab] != lab).any():
            lab = lab[lab]


def classes_of(vecs: DataFrame, coder: Coder) -> DataFrame:
    """vec_id, lab, cid (digest of label and components), subs, c0, c1: one row per vector; cid is null where it links with nothing."""
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            label = batch.column(1)
            cid, lab, subs, c0, c1 = [None] * n, [None] * n, [None] * n, np.zeros(n, np.int64), np.zeros(n, np.int64)
            for rows, raw, unit in vectors(batch.column(2)):
                padded = np.zeros((len(rows), coder.dim))
                width = min(coder.dim, unit.shape[1])
                padded[:, :width] = unit[:, :width]
                sub, check = coder.code(padded)
                for k, r in enumerate(rows):
                    if (x := label[int(r)].as_py()) is not None:
                        lab[r] = f"{raw.shape[1]}:{x}"
                        cid[r] = hashlib.md5(lab[r].encode() + b"\0" + raw[k].tobytes()).digest()
                        subs[r] = sub[k].astype("<u4").tobytes()
                        c0[r], c1[r] = check[k].view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lab, pa.string()), pa.array(cid, pa.binary()), pa.array(subs, pa.binary()), pa.array(c0), pa.array(c1)],
                                             names=["vec_id", "lab", "cid", "subs", "c0", "c1"])

    return vecs.mapInArrow(run, "vec_id long, lab string, cid binary, subs binary, c0 long, c1 long")


def buckets(classes: DataFrame, tables: int) -> DataFrame:
    """(key, no, c0, c1): a row per class and table; the key hashes label, table and substring."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                sub = np.frombuffer(b"".join(part.column("subs").to_pylist()), "<u4").reshape(-1, tables).astype(np.uint64)
                key = mix64(part.column("h").to_numpy().view(np.uint64)[:, None] + np.arange(1, tables + 1, dtype=np.uint64))
                key = mix64(key + sub).ravel().view(np.int64)
                again = pa.array(np.repeat(np.arange(part.num_rows), tables))
                yield pa.RecordBatch.from_arrays([pa.array(key), *(part.column(c).take(again) for c in ("no", "c0", "c1"))], names=["key", "no", "c0", "c1"])

    return classes.select("no", "c0", "c1", "subs", F.xxhash64("lab").alias("h")).mapInArrow(run, "key long, no long, c0 long, c1 long")


def in_blocks(members: DataFrame, sizes: DataFrame, keys: list[str]) -> DataFrame:
    """Members dealt to groups (keys, lo, hi) of two blocks at most; ``sizes`` has keys and c > BLOCK."""
    cut = members.join(sizes, keys, "left").withColumn("blocks", F.coalesce(F.ceil(F.col("c") / BLOCK).cast("int"), F.lit(1)))
    cut = cut.withColumn("blk", F.pmod(F.xxhash64("no"), F.col("blocks")).cast("int"))
    dealt = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("lo", F.least("blk", "other")).withColumn("hi", F.greatest("blk", "other")).drop("c", "blocks", "other")
    return dealt.repartition(*keys, "lo", "hi").sortWithinPartitions(*keys, "lo", "hi")


def large_groups(counts: DataFrame) -> DataFrame:
    """The rows of ``counts`` beyond BLOCK; broadcast only if counted to be few."""
    big = written(counts.where(F.col("c") > BLOCK), "large")
    return F.broadcast(big) if big.count() <= 10_000 else big


def by_groups(dealt: DataFrame, keys: list[str], find, schema: str) -> DataFrame:
    """``find(table, first row and size of each group)`` on runs of whole groups; a task holds a batch and one open group."""
    names = [*keys, "lo", "hi"]

    def heads(t) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        new[:1] = True
        for c in names:
            x = t.column(c)
            x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
            x = x.dictionary_encode().indices.to_numpy() if pa.types.is_string(x.type) else x.to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(new)

    def run(batches):
        kept: list = []

        def ready(parts):
            t = pa.Table.from_batches(parts).combine_chunks()
            first = heads(t)
            return find(t, first, np.diff(np.r_[first, t.num_rows]))

        for batch in batches:
            if not batch.num_rows:
                continue
            if kept and any(kept[-1].column(c)[-1] != batch.column(c)[0] for c in names):
                yield from ready(kept)
                kept = []
            cut = heads(batch)[-1]
            if cut:
                yield from ready([*kept, batch.slice(0, cut)])
                kept = [batch.slice(cut)]
            else:
                kept.append(batch)
        if kept:
            yield from ready(kept)

    return dealt.mapInArrow(run, schema)


def near_in_buckets(radius: int):
    """(no, root): rows and the least row they reach within their groups by bits at most ``radius`` apart."""
    def find(t, first, size):
        c0, c1, no = (t.column(c).to_numpy() for c in ("c0", "c1", "no"))
        c0, c1 = c0.view(np.uint64), c1.view(np.uint64)
        lo, hi, blk = (t.column(c).to_numpy() for c in ("lo", "hi", "blk"))
        found = [(np.zeros(0, np.int64),) * 2]
        for m in np.unique(size[size > 1]):
            starts = first[size == m]
            i, j = np.triu_indices(m, 1) if m <= 128 else (None, None)
            if i is not None:  # all groups of one size at once
                for at in range(0, len(starts), max(1, CELLS // len(i))):
                    x, y = (starts[at : at + max(1, CELLS // len(i)), None] + k for k in (i, j))
                    near = np.bitwise_count(c0[x] ^ c0[y]).astype(np.int16) + np.bitwise_count(c1[x] ^ c1[y]) <= radius
                    found.append((x[near], y[near]))
                continue
            for s in starts:
                g = slice(s, s + m)
                for at in range(0, m, max(1, CELLS // m)):
                    rows = np.arange(s + at, min(s + at + max(1, CELLS // m), s + m))
                    near = np.bitwise_count(c0[rows, None] ^ c0[None, g]).astype(np.int16) + np.bitwise_count(c1[rows, None] ^ c1[None, g]) <= radius
                    x, y = np.nonzero(near)
                    found.append((rows[x], s + y))
        i, j = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        ok = (lo[i] == hi[i]) | (blk[i] != blk[j])
        root = roots(len(no), i[ok], j[ok])
        moved = np.flatnonzero(root != np.arange(len(no)))
        yield pa.RecordBatch.from_arrays([pa.array(no[moved]), pa.array(no[root[moved]])], names=["a", "b"])

    return find


def links_in_clusters(threshold: float):
    """(no, links, root): linked weight of each row within its group, and the least row it reaches by links."""
    def find(t, first, size):
        w, no, lo, hi, blk = (t.column(c).to_numpy() for c in ("w", "no", "lo", "hi", "blk"))
        col = t.column("embedding")
        col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
        for s, m in zip(first, size):
            (rows, _, unit), = vectors(col.slice(s, m))  # classes hold usable vectors of one length
            links, found = np.zeros(m, np.int64), [(np.zeros(0, np.int64),) * 2]
            weight, block = w[s : s + m], blk[s : s + m]
            step = max(1, CELLS // m)
            lab = np.arange(m)
            for at in range(0, m, step):
                near = unit[at : at + step] @ unit.T >= threshold
                if lo[s] != hi[s]:
                    near &= block[at : at + step, None] != block[None, :]
                k = np.arange(at, min(at + step, m))
                near[k - at, k] = False
                links[k] = near @ weight
                x, y = np.nonzero(near)
                found = roots(m, np.r_[np.arange(m), x + at], np.r_[lab, y])
                lab = found
            yield pa.RecordBatch.from_arrays([pa.array(no[s : s + m]), pa.array(links), pa.array(no[s + lab])], names=["no", "links", "root"])

    return find


def near_vectors(spark: SparkSession, table: DataFrame, threshold: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``table`` (vec_id, embedding, label)."""
    ship(spark)
    kind = table.schema["embedding"].dataType.simpleString()
    emb = F.col("embedding") if kind == "array<float>" else F.col("embedding").cast("array<double>")
    vecs = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("lab"), emb.alias("embedding"))
    vec_type = vecs.schema["embedding"].dataType.simpleString()

    usable = vecs.where("lab IS NOT NULL AND size(embedding) > 0")
    largest, dim = usable.groupBy("lab").agg(F.count(F.lit(1)).alias("c"), F.max(F.size("embedding")).alias("d")).agg(F.max("c"), F.max("d")).first()
    largest, dim = largest or 0, dim or 1
    picked = usable.where(F.size("embedding") == dim).orderBy(F.xxhash64("vec_id", "embedding")).limit(SAMPLE).select("embedding")
    sample = [u for _, _, u in vectors(picked.toArrow().column(0).combine_chunks())] if largest else []
    coder = Coder(sample[0] if sample and len(sample[0]) else np.eye(dim), threshold, largest)

    rows = written(classes_of(vecs, coder), "vectors")
    grouped = rows.where("cid IS NOT NULL").groupBy("cid").agg(F.count(F.lit(1)).alias("w"), F.min("vec_id").alias("least"), F.first("lab").alias("lab"),
                                                               F.first("subs").alias("subs"), F.first("c0").alias("c0"), F.first("c1").alias("c1"))
    classes = written(grouped.withColumn("no", F.monotonically_increasing_id()), "classes")

    members = buckets(classes, coder.tables)
    big = large_groups(members.groupBy("key").agg(F.count(F.lit(1)).alias("c")))
    near = by_groups(in_blocks(members, big, ["key"]), ["key"], near_in_buckets(coder.radius), "a long, b long").distinct()
    clusters = written(components(near), "clusters").withColumnRenamed("cid", "no").withColumnRenamed("comp", "cluster")

    def digests(batches):
        for batch in batches:
            cid, label = [None] * batch.num_rows, batch.column(0)
            for at, raw, _ in vectors(batch.column(1)):
                for k, r in enumerate(at):
                    cid[r] = hashlib.md5(f"{raw.shape[1]}:{label[int(r)].as_py()}".encode() + b"\0" + raw[k].tobytes()).digest()
            keep = pa.array([c is not None for c in cid])
            yield pa.RecordBatch.from_arrays([pa.array(cid, pa.binary()).filter(keep), batch.column(1).filter(keep)], names=["cid", "embedding"])

    wanted = clusters.join(classes.select("no", "cid", "w", "lab"), "no")
    own = usable.select("lab", "embedding").mapInArrow(digests, f"cid binary, embedding {vec_type}")
    # one vector a class: copies of a class are dropped where they meet their class
    with_vec = wanted.join(own, "cid").groupBy("no", "cluster", "w", "lab").agg(F.first("embedding").alias("embedding"))
    sizes = large_groups(wanted.groupBy("cluster", "lab").agg(F.count(F.lit(1)).alias("c")))
    verified = written(by_groups(in_blocks(with_vec, sizes, ["cluster", "lab"]), ["cluster", "lab"], links_in_clusters(threshold), "no long, links long, root long"), "links")

    comps = components(verified.select(F.col("no").alias("a"), F.col("root").alias("b"))).withColumnRenamed("cid", "no")
    linked = classes.select("no", "cid", "w", "least").join(verified.groupBy("no").agg(F.sum("links").alias("links")), "no", "left").join(comps, "no", "left")
    linked = linked.withColumn("comp", F.coalesce("comp", "no"))
    result = linked.join(linked.groupBy("comp").agg(F.min("least").alias("component_id")), "comp")
    result = result.select("cid", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "cid").join(result, "cid", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("cid").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.expr("vec_id <=> component_id"))
