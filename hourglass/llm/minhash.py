"""Near-duplicates by MinHash with sequential Bayesian verification.

1. Each text becomes the set of its distinct word shingles (64-bit hashes)
   and a signature of PERMS minima, 16 bits of each.  Texts with equal sets form
   a class at once, so copies never meet as pairs.
2. Classes that agree in a band of ROWS minima are candidates.  A pair with
   similarity 0.8 agrees in none of the bands with probability 3e-6.
3. Candidates compare their signatures in batches of STEP minima.  With a
   uniform prior, m agreements in h minima leave the similarity a
   Beta(m + 1, h - m + 1) posterior; a pair is dropped when the probability
   of reaching the threshold falls below MISS.
4. Survivors are verified on their full sets, and linked.

A bucket is not expanded into pairs.  A first round compares its members with
one of them, which joins most of a group of near copies, and connected
components are updated.  Buckets whose members are then in different
components are compared once more, only across components: small ones give the
pairs that outlive the Bayesian test; larger ones are cut into blocks, and a
task with two blocks and their sets gives the verified links alone.

Defined results: a null or blank text has an empty set and is linked with
nothing; fewer words than a shingle make one shingle of the whole sequence;
a null doc_id never names a component that has other ids; rows with equal
id and text share their result; an empty table gives an empty result; other
columns are not read by ``near_dups`` and passed through by ``keep_one``.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import bounded_batches, key_filter, may_hold, mix64, released, ship, written

BANDS, ROWS = 32, 5
PERMS = BANDS * ROWS
#: Minima compared at a time, and the chosen miss probability of the test.
STEP, MISS = 32, 1e-7
#: Members of a bucket that one task compares with as many others, and bytes of their sets.
BLOCK, BLOCK_BYTES = 1500, 32 << 20
#: Keys that are broadcast as they are (16 bytes each).
LISTED = 2_000_000
#: Buckets up to this size give their pairs as rows.
SMALL = 64
#: Pairs with another component that are verified first.
FIRST = 8
_A = (mix64(np.arange(1, PERMS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_C = (mix64(np.arange(1001, PERMS + 1001, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_MUL = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Distinct shingle hashes of texts; word hashes are remembered up to a bound."""

    def __init__(self, k: int):
        self.k, self.known = k, {}

    def __call__(self, text: str | None) -> np.ndarray:
        import xxhash

        words = text.encode().lower().split() if text else []  # bytes: A-Z only, and exactly the six spaces
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > 100_000:
            self.known.clear()
        known = self.known
        h = [known.get(w) for w in words]
        if None in h:
            for i, x in enumerate(h):
                if x is None:
                    h[i] = known[words[i]] = xxhash.xxh3_64_intdigest(words[i])
        a = np.array(h, np.uint64)
        n = min(self.k, len(a))
        out = np.full(len(a) - n + 1, n, np.uint64)
        for i in range(n):
            out = mix64(out * _MUL + a[i : len(a) - n + 1 + i])
        return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """16 bits of each of PERMS minima of seeded permutations of the 32-bit shingle hashes."""
    out = np.full(PERMS, 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(x), 2048):
        out = np.minimum(out, ((x[None, i : i + 2048] ^ _C[:, None]) * _A[:, None]).min(axis=1))
    return ((out * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def least_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """(minima compared, agreements needed to go on): the posterior P(s >= t) equals P(Binomial(h + 1, t) <= m)."""
    out = []
    for h in range(STEP, PERMS + 1, STEP):
        n, total, m = h + 1, 0.0, -1
        while total < miss:
            m += 1
            total += math.exp(math.lgamma(n + 1) - math.lgamma(m + 1) - math.lgamma(n - m + 1) + m * math.log(threshold) + (n - m) * math.log1p(-threshold))
        out.append((h, m))
    return out


def outlive(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (rows of a and b) that pass the size bound and every batch of the test, and their agreements."""
    left = np.flatnonzero(np.minimum(na, nb) >= threshold * np.maximum(na, nb) - 1e-9)
    same = np.zeros(len(left), np.int64)
    for h, need in least_matches(threshold):
        same += (a[left, h - STEP : h] == b[left, h - STEP : h]).sum(axis=1)
        ok = same >= need
        left, same = left[ok], same[ok]
    return left, same


def _matrix(col) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), "<u2").reshape(-1, PERMS)


def text_key():
    """Digest of a text as 16 bytes; null counts as empty."""
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, text_key, n (set size), cid (digest of the set), sig: one row per document."""
    def run(batches):
        shingle = Shingler(k)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                n, cid, sig = [], [], []
                for text in part.column(2):
                    s = shingle(text.as_py())
                    n.append(len(s))
                    cid.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                    sig.append(signature(s).astype("<u2").tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(cid, pa.binary()), pa.array(sig, pa.binary())],
                                                 names=["doc_id", "text_key", "n", "cid", "sig"])

    bounded_batches(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
    return src.mapInArrow(released(run), "doc_id long, text_key binary, n long, cid binary, sig binary")


def bands(classes: DataFrame) -> DataFrame:
    """(key, cid), BANDS rows a class: the key hashes the band's minima; its last bits are the band's number."""
    def run(batches):
        for batch in batches:
            m = _matrix(batch.column("sig")).astype(np.uint64).reshape(-1, BANDS, ROWS)
            band = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), m.shape[:2])
            key = band
            for i in range(ROWS):
                key = mix64(key * _MUL + m[:, :, i])
            key = key // np.uint64(BANDS) * np.uint64(BANDS) + band
            cid = batch.column("cid").take(pa.array(np.repeat(np.arange(batch.num_rows), BANDS)))
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), cid], names=["key", "cid"])

    return classes.select("cid", "sig").mapInArrow(released(run), "key long, cid binary")


def bayes_test(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that outlive the sequential test on their signatures."""
    def run(batches):
        for p in batches:
            if p.num_rows:
                left, _ = outlive(_matrix(p.column("sig_a")), _matrix(p.column("sig_b")), p.column("n_a").to_numpy(), p.column("n_b").to_numpy(), threshold)
                yield pa.RecordBatch.from_arrays([p.column("a").take(pa.array(left)), p.column("b").take(pa.array(left))], names=["a", "b"])

    def side(x: str) -> DataFrame:
        return classes.select(F.col("cid").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "sig_a", "sig_b")
    return both.mapInArrow(released(run), "a binary, b binary")


def exact_test(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= pct * union."""
    def run(batches):
        for p in batches:
            a, b, keep = p.column("set_a"), p.column("set_b"), []
            for i in range(p.num_rows):
                x, y = np.frombuffer(a[i].as_py(), "<u8"), np.frombuffer(b[i].as_py(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= pct * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([p.column("a").filter(mask), p.column("b").filter(mask)], names=["a", "b"])

    def side(x: str) -> DataFrame:
        return sets.select(F.col("cid").alias(x), F.col("shingles").alias(f"set_{x}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")
    return both.mapInArrow(released(run), "a binary, b binary")


def full_sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(cid, shingles): the sets of the wanted classes, taken again from one text of each.

    The texts stay where they are (``screened``); a set that is let pass in
    vain finds no class.
    """
    one = rows.join(wanted, "cid", "left_semi").groupBy("cid").agg(F.min(F.struct("doc_id", "text_key")).alias("f")).select(F.xxhash64("f.doc_id", "f.text_key").alias("h"))

    def run(batches):
        shingle = Shingler(k)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                sets = [shingle(t.as_py()) for t in batch.column(0).slice(lo, 1000)]
                yield pa.RecordBatch.from_arrays([pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], pa.binary()),
                                                  pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], names=["cid", "shingles"])

    named = docs.select("text", F.xxhash64(F.col("doc_id").cast("long"), text_key()).alias("h"))
    found = screened(named, one, True)[0].select("text").mapInArrow(released(run), "cid binary, shingles binary")
    return found.join(wanted, "cid", "left_semi").groupBy("cid").agg(F.first("shingles").alias("shingles"))


def screened(named: DataFrame, keys: DataFrame, *sides: bool) -> list[DataFrame]:
    """The rows of ``named`` whose hash ``h`` is among the keys (True) or is not (False).

    Up to LISTED keys are broadcast.  Beyond that a filter of bounded size is,
    which may also count rows as listed that are not; no row is moved either way.
    """
    held = written(keys.distinct(), "keys")
    n = held.count()
    if n <= LISTED:
        return [named.join(F.broadcast(held), "h", "left_semi" if hits else "left_anti") for hits in sides]
    words = held.sparkSession.sparkContext.broadcast(key_filter(held, n))

    def side(hits: bool) -> DataFrame:
        def run(batches):
            for batch in batches:
                mask = may_hold(words.value, batch.column("h").to_numpy())
                yield batch.filter(pa.array(mask if hits else ~mask))

        return named.mapInArrow(released(run), named.schema)

    return [side(hits) for hits in sides]


def components(edges: DataFrame) -> DataFrame:
    """(cid, comp) of the nodes of (a, b): comp is the least node reachable.

    Alternating large-star and small-star steps; every step is a grouped
    minimum and a join, and each round's edges are written to the shared folder.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")) if large else both.where("b < a").groupBy("a").agg(F.min("b").alias("m"))
        side = both.where("b > a") if large else both.where("b < a")
        out = side.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            out = out.unionByName(least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def mark(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = mark(e)
    while before[0]:
        e = written(star(star(e, True), False), "edges")
        after = mark(e)
        if after == before:
            break
        before = after
    return e.groupBy("a").agg(F.min("b").alias("comp")).withColumnRenamed("a", "cid").unionByName(e.select(F.col("b").alias("cid"), F.col("b").alias("comp")).distinct())


def open_members(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Members of the buckets that span several components, with comp."""
    with_comp = members.join(comps, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    open_keys = with_comp.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    return with_comp.join(open_keys, "key", "left_semi")


def star_pairs(members: DataFrame) -> DataFrame:
    """Pairs of the least member of each bucket with the others."""
    pivot = members.groupBy("key").agg(F.min("cid").alias("b"))
    return members.select("key", F.col("cid").alias("a")).join(pivot, "key").where("a <> b").select("a", "b").distinct()


def _groups(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """First row and size of each group (key, lo, hi) of a sorted table."""
    key, lo, hi = (t.column(c).to_numpy() for c in ("key", "lo", "hi"))
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
    return first, np.diff(np.r_[first, len(key)])


def _small_pairs(t: pa.Table, threshold: float, pct: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs, across components, of small groups that outlive the test."""
    first, size = _groups(t)
    n, sig = t.column("n").to_numpy(), _matrix(t.column("sig"))
    comp = np.frombuffer(b"".join(t.column("comp").to_pylist()), "<u8").reshape(-1, 2)
    found = [(np.zeros(0, int),) * 2]
    for m in np.unique(size[size > 1]):
        i, j = np.triu_indices(m, 1)
        start = first[size == m][:, None]
        i, j = (start + i).ravel(), (start + j).ravel()
        ok = (comp[i] != comp[j]).any(axis=1)
        i, j = i[ok], j[ok]
        for at in range(0, len(i), 50_000):
            x, y = i[at : at + 50_000], j[at : at + 50_000]
            left, _ = outlive(sig[x], sig[y], n[x], n[y], threshold)
            found.append((x[left], y[left]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _large_links(t: pa.Table, threshold: float, pct: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of large groups: for each row, one to every larger component that has a similar member.

    Survivors of the test are verified on the full sets, those with the most
    agreements first, until one holds or all have failed.  A pair is left to
    the first band that it shares.
    """
    n, sig, band = t.column("n").to_numpy(), _matrix(t.column("sig")), t.column("band").to_numpy()
    lo, hi, blk = (t.column(c).to_numpy() for c in ("lo", "hi", "blk"))
    comp = np.frombuffer(b"".join(t.column("comp").to_pylist()), "<u8").reshape(-1, 2)
    sets = t.column("shingles")
    take = lambda r: np.frombuffer(sets[int(r)].as_py(), "<u8")
    out_i, out_j = [], []

    def holds(x: int, ys: np.ndarray) -> np.ndarray:
        own, others = take(x), [take(y) for y in ys]
        flat = np.concatenate(others)
        at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
        both = np.add.reduceat(own[at] == flat, np.r_[0, np.cumsum([len(o) for o in others])[:-1]], dtype=np.int64)
        return 100 * both >= pct * (n[x] + n[ys] - both)

    for start, m in zip(*_groups(t)):
        rows = np.arange(start, start + m)
        _, no, count = np.unique(comp[rows], axis=0, return_inverse=True, return_counts=True)
        rank = np.argsort(np.lexsort((np.arange(len(count)), count)))[no.ravel()]  # of a row's component, by size
        for i in np.flatnonzero(rank < rank.max()):
            js = np.flatnonzero((rank > rank[i]) & ((lo[start] == hi[start]) | (blk[rows] != blk[rows[i]])))
            if not len(js):
                continue
            x, ys = rows[i], rows[js]
            left, same = outlive(np.broadcast_to(sig[x], (len(ys), PERMS)), sig[ys], np.full(len(ys), n[x]), n[ys], threshold)
            ys, other = ys[left], rank[js[left]]
            mine = (sig[ys] == sig[x]).reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == band[x]
            order = np.lexsort((-same[mine], other[mine]))
            ys, other = ys[mine][order], other[mine][order]
            place = np.arange(len(ys)) - np.searchsorted(other, other)
            done: set[int] = set()
            for which in (np.flatnonzero(place < FIRST), np.flatnonzero(place >= FIRST)):
                for at in range(0, len(which), 256):
                    part = which[at : at + 256]
                    part = part[~np.isin(other[part], list(done))]
                    for g in part[holds(x, ys[part])] if len(part) else ():
                        if int(other[g]) not in done:
                            done.add(int(other[g]))
                            out_i.append(x)
                            out_j.append(ys[g])
    return np.array(out_i, int), np.array(out_j, int)


def _in_groups(sent: DataFrame, find, threshold: float, pct: int) -> DataFrame:
    """The pairs (a, b) that ``find`` returns for the groups (key, lo, hi); a task holds one batch and one open group."""
    def run(batches):
        kept: list = []  # rows of the group that may go on in the next batch

        def ready(parts: list):
            t = pa.Table.from_batches(parts).combine_chunks()
            cid = t.column("cid").to_pylist()
            pairs = [(min(cid[i], cid[j]), max(cid[i], cid[j])) for i, j in zip(*find(t, threshold, pct))]
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([batch.column(c).to_numpy() for c in ("key", "lo", "hi")])
            if kept and any(kept[-1].column(c)[-1].as_py() != ids[i, 0] for i, c in enumerate(("key", "lo", "hi"))):
                yield ready(kept)
                kept = []
            cut = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0))
            if len(cut):
                yield ready([*kept, batch.slice(0, cut[-1] + 1)])
                kept = [batch.slice(cut[-1] + 1)]
            else:
                kept.append(batch)
        if kept:
            yield ready(kept)

    return sent.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(released(run), "a binary, b binary").distinct()


def rest_links(labelled: DataFrame, classes: DataFrame, sets: DataFrame, threshold: float, pct: int) -> DataFrame:
    """Verified links across the components of open buckets, each component pair of a bucket at least once if linked.

    Small buckets give the pairs that outlive the test, which are verified
    as rows.  Larger ones are cut into blocks of bounded size; a task gets two
    blocks with their full sets and gives verified links only.
    """
    sizes = labelled.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    dealt = labelled.join(sizes, "key").join(classes, "cid").withColumn("band", F.col("key").bitwiseAND(F.lit(BANDS - 1)).cast("int"))
    one = F.lit(0)
    small = dealt.where(F.col("c") <= SMALL).select("key", one.alias("lo"), one.alias("hi"), "n", "cid", "comp", "sig")
    pairs = written(_in_groups(small, _small_pairs, threshold, pct), "survivors")
    large = dealt.where(F.col("c") > SMALL)
    blocks = large.groupBy("key").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") * 8 / BLOCK_BYTES)).cast("int").alias("blocks"))
    large = large.join(blocks, "key").join(sets, "cid").withColumn("blk", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    sent = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sent = sent.select("key", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"), "blk", "band", "n", "cid", "comp", "sig", "shingles")
    return exact_test(pairs, sets, pct).unionByName(_in_groups(sent, _large_links, threshold, pct))


def _verdict(spark: SparkSession, docs: DataFrame, k: int, pct: int) -> DataFrame:
    """doc_id, text_key, n, comp, component_id."""
    ship(spark)
    threshold = pct / 100
    rows = written(sketches(docs, k), "sketches")
    classes = written(rows.where("cid IS NOT NULL").groupBy("cid").agg(F.first("n").alias("n"), F.first("sig").alias("sig")), "classes")
    shared = bands(classes).groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    members = written(bands(classes).join(shared, "key", "left_semi"), "members")
    wanted = members.select("cid").distinct()
    classes = written(classes.join(wanted, "cid", "left_semi"), "candidates")  # the only ones compared from here on
    wanted = classes.select("cid")
    sets = written(full_sets(docs, rows, wanted, k), "sets")
    stars = written(bayes_test(star_pairs(members), classes, threshold), "survivors")
    links = written(exact_test(stars, sets, pct), "links")
    comps = written(components(links), "components")
    more = written(rest_links(open_members(members, comps), classes, sets, threshold, pct), "links")
    before = comps.select(F.col("cid").alias("a"), F.col("comp").alias("b"))
    comps = written(components(more.unionByName(before)), "components")
    labelled = rows.select("doc_id", "text_key", "n", "cid").join(comps, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    least = labelled.where("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return labelled.join(least, "comp", "left").select("doc_id", "text_key", "n", "comp", F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def near_dups(spark: SparkSession, docs: DataFrame, k: int = 5, pct: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document."""
    return _verdict(spark, docs, k, pct).select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.expr("doc_id <=> component_id").alias("kept"))


def keep_one(spark: SparkSession, docs: DataFrame, k: int = 5, pct: int = 80) -> DataFrame:
    """One document of each component, with all its columns; texts without words all stay (equal rows of id and text once).

    Most documents stay, and are not moved: only rows whose id and digest go or
    occur twice meet the exact list (``screened``).
    """
    v = written(_verdict(spark, docs.select("doc_id", "text"), k, pct).select("doc_id", "text_key", "comp"), "verdict")
    first = v.where("comp IS NOT NULL").groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("f")).select("f.doc_id", "f.text_key")
    stay = written(first.unionByName(v.where("comp IS NULL").select("doc_id", "text_key")).distinct(), "stay")
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_key"] == b["text_key"])
    every = v.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("c"))
    once = every.where("c = 1").select("doc_id", "text_key")
    doubtful = every.where("c > 1").select("doc_id", "text_key").unionByName(once.join(stay, same(once, stay), "left_anti"))
    key = F.unhex(F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary")))
    id_ = docs["doc_id"].cast("long")
    named = docs.select(F.struct(*docs.columns).alias("row"), id_.alias("_id"), key.alias("_key"), F.xxhash64(id_, key).alias("h"))
    sure, found = screened(named, doubtful.select(F.xxhash64("doc_id", "text_key").alias("h")), False, True)
    listed = stay.toDF("_stay_id", "_stay_key")
    found = found.join(listed, found["_id"].eqNullSafe(listed["_stay_id"]) & (found["_key"] == listed["_stay_key"]), "left_semi").dropDuplicates(["_id", "_key"])
    return sure.select("row.*").unionByName(found.select("row.*"))
