"""Source divergence audit by a recount through minimal perfect hashes.

1. Exact frequency filter: the documents that hold each term are counted by
   language; terms in at least LEAST of them are kept.
2. The kept terms of a language are cut into shards of about SHARD terms, and a
   task builds a minimal perfect hash of each: levels of bits, where a term that
   falls alone on its bit stays and the others go on to the next level; its rank
   among the set bits is its slot.  The terms are stored in slot order.
3. Second pass over all documents: a term's slot is looked up, the stored term is
   compared byte by byte, and the slot of the document's (language, source)
   group is incremented in a dense array.  Tasks pass these on by shard, as
   packed slots and counts, which are added up in dense arrays again.
4. Scaled probabilities and divergences follow shard by shard in whole numbers.

The hashes are broadcast if their measured size is at most BROADCAST_BYTES.
Beyond it the second pass counts terms within a task, and the counted terms of
a shard meet its hash; the results are equal.  A language with more than
SOURCES sources has smaller shards, so that a shard of all its sources stays
bounded.

Defined results: null text, lang and source count as ''; a group without kept
terms still has its pairs (value 0 if its language keeps no term); terms are
split and lower-cased bytewise, which only touches A to Z; repeated rows count
each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import ship, written

#: Documents of a language that a kept term is in, at least.
LEAST = 3
#: Terms of a shard.
SHARD = 1 << 14
#: Bytes of all hashes and stored terms that may be broadcast.
BROADCAST_BYTES = 48 << 20
#: Sources of a language beyond which its shards get smaller.
SOURCES = 256
#: Bytes of the dense slots of a task; full ones are passed on and cleared.
DENSE_BYTES = 128 << 20
#: Terms that a task counts before it looks them up or passes them on.
HELD = 400_000
#: Parts in which the counts of one source and shard are added up before they meet.
PARTS = 32
#: Sources of a language that a task compares with as many others.
TILE = 128
#: Ranks of the terms of a group that are returned.
TOP = 200
SCALE = 1_000_000_000
#: Bytes of terms: A-Z become a-z, other ASCII separates.
_TO_TERMS = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(_TO_TERMS).split() if text else []


def hashes(keys: list[bytes], seed: int) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(k, seed) for k in keys), np.uint64, len(keys))


def _spots(h: np.ndarray, level: int, bits: int) -> np.ndarray:
    x = (h ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(20)) % np.uint64(bits)


class PerfectHash:
    """Minimal perfect hash of byte strings with the strings in slot order."""

    def __init__(self, seed: int, sizes: list[int], bits: bytes, ends: bytes, blob: bytes):
        self.seed, self.sizes = seed, sizes
        self.bit = np.unpackbits(np.frombuffer(bits, np.uint8))[: sum(sizes)].astype(bool)
        self.rank = np.cumsum(self.bit, dtype=np.int32) - 1
        self.ends, self.blob = np.frombuffer(ends, "<i8"), np.frombuffer(blob, np.uint8)
        self.starts = np.r_[0, self.ends[:-1]]

    @staticmethod
    def build(keys: list[bytes]) -> tuple[int, list[int], bytes, bytes, bytes]:
        """The arguments of the constructor, for distinct keys in any order."""
        keys = sorted(keys)
        seed = 0
        while len(np.unique(h := hashes(keys, seed))) < len(keys):
            seed += 1
        sizes, levels, left = [], [], np.arange(len(keys))
        place = np.full(len(keys), -1)
        while len(left):
            size = 2 * len(left) + 1
            at = _spots(h[left], len(sizes), size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            stays = alone[at]
            place[left[stays]] = sum(sizes) + at[stays].astype(np.int64)
            sizes.append(size)
            levels.append(alone)
            left = left[~stays]
        bit = np.concatenate(levels) if levels else np.zeros(0, bool)
        ordered = [keys[i] for i in np.argsort(place)]
        ends = np.cumsum([len(k) for k in ordered]).astype("<i8")
        return seed, sizes, np.packbits(bit).tobytes(), ends.tobytes(), b"".join(ordered)

    def slots(self, keys: list[bytes], h: np.ndarray) -> np.ndarray:
        """Slots of the keys, -1 for those that are not stored.  ``h``: their hashes with seed 0."""
        if self.seed:
            h = hashes(keys, self.seed)
        slot, left, base = np.full(len(keys), -1), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = _spots(h[left], level, size).astype(np.int64) + base
            hit = self.bit[at]
            slot[left[hit]] = self.rank[at[hit]]
            left, base = left[~hit], base + size
        # the stored terms decide
        size = np.fromiter(map(len, keys), np.int64, len(keys))
        ask = np.flatnonzero(slot >= 0)
        ask = ask[self.ends[slot[ask]] - self.starts[slot[ask]] == size[ask]]
        n = size[ask]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        mine = np.frombuffer(b"".join([keys[i] for i in ask]), np.uint8)
        differ = mine != self.blob[np.repeat(self.starts[slot[ask]], n) + inner]
        wrong = np.zeros(len(ask), bool)
        wrong[np.repeat(np.arange(len(ask)), n)[differ]] = True
        out = np.full(len(keys), -1)
        out[ask[~wrong]] = slot[ask[~wrong]]
        return out

    def stored(self) -> list[bytes]:
        whole = self.blob.tobytes()
        return [whole[a:b] for a, b in zip(self.starts, self.ends)]


HASH_FIELDS = "seed int, sizes array<int>, bits binary, ends binary, blob binary"


def frequent(docs: DataFrame, least: int) -> DataFrame:
    """(lang, term): terms in at least ``least`` documents of the language."""
    def run(batches):
        held: dict[str, Counter] = {}
        size = 0

        def out():
            for lang, c in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["lang", "term", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                c = held.setdefault(lang, Counter())
                size -= len(c)
                c.update(set(terms(text.as_py())))
                size += len(c)
                if size > HELD:
                    yield from out()
                    size = 0
        yield from out()

    counted = docs.select("lang", "text").mapInArrow(run, "lang string, term binary, n long")
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("lang", "term")


def perfect_hashes(kept: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, shard, n, hash fields): one row a shard of about SHARD terms."""
    def build(t: pa.Table) -> pa.Table:
        names = ("lang", "shard", "n", "seed", "sizes", "bits", "ends", "blob")
        keys = t.column("term").to_pylist()
        row = (t.column("lang")[0].as_py(), t.column("shard")[0].as_py(), len(keys), *PerfectHash.build(keys))
        types = (pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array([v], ty) for v, ty in zip(row, types)], names=list(names))

    dealt = kept.join(sizes, "lang").select("lang", "term", F.pmod(F.crc32("term"), F.col("shards")).cast("int").alias("shard"))
    return dealt.groupBy("lang", "shard").applyInArrow(build, "lang string, shard int, n long, " + HASH_FIELDS)


def _counted(batches, take, limit: int):
    """Terms of the (lang, source) groups, given to ``take`` whenever ``limit`` are held and at the end."""
    held: dict[tuple[str, str], Counter] = {}
    size = 0
    for batch in batches:
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")):
            c = held.setdefault((lang, source), Counter())
            size -= len(c)
            c.update(terms(text.as_py()))
            size += len(c)
            if size > limit:
                yield from take(held)
                held, size = {}, 0
    yield from take(held)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in the narrowest of 1, 2, 4 and 8 bytes."""
    top = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[0]}", offset=1).astype(np.int64)


PACKED = "lang string, source string, shard int, part int, slots binary, counts binary"
_PACKED = [("lang", pa.string()), ("source", pa.string()), ("shard", pa.int32()), ("part", pa.int32()), ("slots", pa.binary()), ("counts", pa.binary())]


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(_PACKED)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, _PACKED)], names=[n for n, _ in _PACKED])


def recount_broadcast(docs: DataFrame, tables: DataFrame) -> DataFrame:
    """Packed counts of the groups' kept terms by shard, through broadcast hashes."""
    rows = [tuple(r) for r in tables.select("lang", "shards", "shard", "seed", "sizes", "bits", "ends", "blob").collect()]  # at most BROADCAST_BYTES
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() % PARTS
        by_lang: dict[str, dict[int, PerfectHash]] = {}
        shards: dict[str, int] = {}
        for lang, count, shard, seed, sizes, bits, ends, blob in shared.value:
            by_lang.setdefault(lang, {})[shard] = PerfectHash(seed, list(sizes), bytes(bits), bytes(ends), bytes(blob))
            shards[lang] = count
        base = {lang: np.cumsum([0, *(len(t[s].ends) if s in t else 0 for s in range(shards[lang]))]) for lang, t in by_lang.items()}
        dense: dict[tuple[str, str], np.ndarray] = {}

        def out():
            for (lang, source), slots in dense.items():
                at = np.flatnonzero(slots)
                cuts = np.searchsorted(at, base[lang])
                rows = [(lang, source, s, part, pack(at[lo:hi] - base[lang][s]), pack(slots[at[lo:hi]])) for s, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])) if hi > lo]
                for lo in range(0, len(rows), 1000):
                    yield _packed(rows[lo : lo + 1000])
            dense.clear()

        def places(lang: str, keys: list[bytes]) -> dict[bytes, int]:
            """Slot of each stored key among all of the language."""
            shard = np.fromiter(map(zlib.crc32, keys), np.int64, len(keys)) % shards[lang]
            h, slot = hashes(keys, 0), np.full(len(keys), -1)
            for s, table in by_lang[lang].items():
                own = np.flatnonzero(shard == s)
                if len(own):
                    found = table.slots([keys[i] for i in own], h[own])
                    slot[own] = np.where(found >= 0, found + base[lang][s], -1)
            return dict(zip(keys, slot.tolist()))

        def take(held):
            of_lang: dict[str, dict] = {}
            for (lang, _), c in held.items():
                of_lang.setdefault(lang, {}).update(dict.fromkeys(c))
            for lang, keys in of_lang.items():
                if lang not in by_lang:
                    continue
                slot_of = places(lang, list(keys))
                for (other, source), c in held.items():
                    if other != lang or not c:
                        continue
                    if (lang, source) not in dense:
                        if dense and sum(x.nbytes for x in dense.values()) + 8 * base[lang][-1] > DENSE_BYTES:
                            yield from out()
                        dense[lang, source] = np.zeros(base[lang][-1], np.int64)
                    slot = np.fromiter(map(slot_of.__getitem__, c), np.int64, len(c))
                    n = np.fromiter(c.values(), np.int64, len(c))
                    dense[lang, source][slot[slot >= 0]] += n[slot >= 0]

        yield from _counted(batches, take, HELD)
        yield from out()

    return docs.select("lang", "source", "text").mapInArrow(run, PACKED)


def recount_grouped(docs: DataFrame, tables: DataFrame, sizes: DataFrame) -> DataFrame:
    """As ``recount_broadcast``, for hashes of any size: counted terms meet their shard's hash.

    The terms of a shard come in order of their part; a task holds one hash,
    and as many terms as it counts at a time.
    """
    def run(batches):
        def take(held):
            for (lang, source), c in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array([source] * len(c), pa.string()), pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())],
                                                 names=["lang", "source", "term", "n"])
        return _counted(batches, take, HELD)

    counted = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term binary, n long")
    counted = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
    # sources are dealt to parts, so that a shard of a language with many of them is not one task
    sharded = counted.join(sizes.select("lang", "shards"), "lang").withColumn("shard", F.pmod(F.crc32("term"), F.col("shards")).cast("int"))
    sharded = sharded.withColumn("part", F.pmod(F.xxhash64("source"), F.lit(PARTS)).cast("int"))
    held = tables.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))

    def look(t: pa.Table, r: pa.Table) -> pa.Table:
        rows = []
        if t.num_rows and r.num_rows:
            table = PerfectHash(*(r.column(c)[0].as_py() for c in ("seed", "sizes", "bits", "ends", "blob")))
            keys, n, source = t.column("term").to_pylist(), t.column("n").to_numpy(), np.array(t.column("source").to_pylist(), object)
            slot = table.slots(keys, hashes(keys, 0))
            for s in sorted(set(source[slot >= 0])):
                own = np.flatnonzero((slot >= 0) & (source == s))
                own = own[np.argsort(slot[own])]
                rows.append((r.column("lang")[0].as_py(), s, r.column("shard")[0].as_py(), r.column("part")[0].as_py(), pack(slot[own]), pack(n[own])))
        return pa.Table.from_batches([_packed(rows)])

    by = ("lang", "shard", "part")
    return sharded.select(*by, "source", "term", "n").groupBy(*by).cogroup(held.groupBy(*by)).applyInArrow(look, PACKED)


def added_up(packed: DataFrame, by_part: bool) -> DataFrame:
    """One row per source and shard (and part): the counts of its rows, in a dense array at a time."""
    keys = ["lang", "source", "shard"] + ["part"] * by_part

    def run(batches):
        here, dense, done = None, np.zeros(0, np.int64), []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("lang", "source", "shard", "part", "slots", "counts")]
            for lang, source, shard, part, slots, counts in zip(*cols):
                key = (lang, source, shard, part if by_part else 0)
                if key != here:
                    if here:
                        at = np.flatnonzero(dense)
                        done.append((*here, pack(at), pack(dense[at])))
                    here, dense = key, np.zeros(0, np.int64)
                    if len(done) >= 500:
                        yield _packed(done)
                        done = []
                at = unpack(slots)
                if len(at) and at[-1] >= len(dense):  # slots are in order
                    dense = np.r_[dense, np.zeros(int(at[-1]) + 1 - len(dense), np.int64)]
                dense[at] += unpack(counts)
        if here:
            at = np.flatnonzero(dense)
            done.append((*here, pack(at), pack(dense[at])))
        yield _packed(done)

    return packed.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, PACKED)


def scaled(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (n + 1) / total) in 64 bits, for n below 9e13."""
    x = (n + 1) * 100_000
    return 1 + x // total * 10_000 + x % total * 10_000 // total


def _pair_sums(t: pa.Table, r: pa.Table, tile: int) -> pa.Table:
    """Sums of f over the terms of one shard, for the sources of two tiles."""
    gi, hi, k, lang = (r.column(c)[0].as_py() for c in ("gi", "hi", "keys", "lang"))
    g, total = r.column("g").to_numpy(), r.column("total").to_numpy()
    row_of = {int(x): i for i, x in enumerate(g)}
    p = np.repeat(scaled(np.zeros(len(g), np.int64), np.maximum(total, 1))[:, None], k, axis=1)
    for x, slots, counts in zip(*(t.column(c).to_pylist() for c in ("c_g", "slots", "counts"))):
        p[row_of[x], unpack(slots)] = scaled(unpack(counts), total[row_of[x]])
    mine, others = np.flatnonzero(g // tile == gi), np.flatnonzero(g // tile == hi)
    value = np.zeros((len(mine), len(others)), np.int64)
    for row, i in enumerate(mine if k else []):
        d = p[i][None, :] - p[others]
        value[row] = (d * d // p[others]).sum(axis=1)
    at, to = np.nonzero(mine[:, None] != others[None, :])
    return pa.table([pa.array([lang] * len(at), pa.string()), pa.array(g[mine[at]]), pa.array(g[others[to]]), pa.array(value[at, to])], names=["lang", "g", "h", "value"])


def _standing_out(t: pa.Table, r: pa.Table, top: int) -> pa.Table:
    """Of one shard, the ``top`` terms of each source that stand out most against the language."""
    lang, sources = r.column("lang")[0].as_py(), t.column("source").to_pylist()
    cells = [(unpack(a), unpack(b)) for a, b in zip(t.column("slots").to_pylist(), t.column("counts").to_pylist())]
    keys = PerfectHash(*(r.column(c)[0].as_py() for c in ("seed", "sizes", "bits", "ends", "blob"))).stored()
    place = np.empty(len(keys), np.int64)
    place[sorted(range(len(keys)), key=keys.__getitem__)] = np.arange(len(keys))
    whole = np.zeros(len(keys), np.int64)
    for at, n in cells:
        whole[at] += n
    out: tuple[list, list, list] = ([], [], [])
    for source, total, lang_total, (at, n) in zip(sources, t.column("total").to_pylist(), t.column("lang_total").to_pylist(), cells):
        p, q = scaled(n, total), scaled(whole[at], lang_total)
        at, value = at[p > q], ((p - q) * (p - q) // q)[p > q]
        best = np.lexsort((place[at], -value))[:top]
        out[0].extend([source] * len(best))
        out[1].extend(keys[i].decode() for i in at[best])
        out[2].extend(value[best].tolist())
    return pa.table([pa.array([lang] * len(out[0]), pa.string()), pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], names=["lang", "source", "item", "value"])


def audit(spark: SparkSession, docs: DataFrame, least: int = LEAST, top: int = TOP, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """lang, source, part, item, value, rank: distances to other sources (all) and the terms that stand out (``top``)."""
    ship(spark)
    docs = docs.select(*(F.coalesce(docs[c], F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kept = written(frequent(docs, least), "kept")
    every = written(docs.select("lang", "source").distinct(), "sources")
    crowd = F.greatest(F.lit(1.0), F.col("s") / SOURCES)
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v")).join(every.groupBy("lang").agg(F.count(F.lit(1)).alias("s")), "lang")
    sizes = written(sizes.select("lang", "v", F.ceil(F.col("v") * crowd / SHARD).cast("int").alias("shards")), "sizes")
    tables = written(perfect_hashes(kept, sizes).join(sizes, "lang"), "hashes")
    volume = tables.agg(F.sum(F.octet_length("bits") + F.octet_length("ends") + F.octet_length("blob"))).first()[0] or 0
    packed = recount_broadcast(docs, tables) if volume <= broadcast_bytes else recount_grouped(docs, tables, sizes)
    counts = written(added_up(added_up(packed, True), False), "counts")

    def total_of(batches):
        for batch in batches:
            n = [int(unpack(c).sum()) for c in batch.column("counts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("source"), pa.array(n, pa.int64())], names=["lang", "source", "n"])

    totals = counts.select("lang", "source", "counts").mapInArrow(total_of, "lang string, source string, n long").groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = every.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0, ["n", "v", "shards"])
    numbered = groups.withColumn("g", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long"))
    of_lang = numbered.groupBy("lang").agg((F.max("g") / TILE).cast("int").alias("last_tile"), (F.sum("n") + F.max("v")).alias("lang_total"))
    groups = written(numbered.select("lang", "source", "g", (F.col("n") + F.col("v")).alias("total"), "shards").join(of_lang, "lang"), "groups")

    # pair: each source takes part as the first and as the second of two tiles
    width = TILE
    tile = F.expr(f"int(g div {width})")
    both = F.expr("explode(array_distinct(flatten(transform(sequence(0, last_tile), x -> array(struct(t AS gi, x AS hi), struct(x AS gi, t AS hi))))))")
    sources = groups.withColumn("t", tile).withColumn("pair", both).withColumn("shard", F.explode(F.sequence(F.lit(0), F.greatest(F.col("shards"), F.lit(1)) - 1)))
    sources = sources.join(tables.select("lang", "shard", F.col("n").alias("keys")), ["lang", "shard"], "left")
    sources = sources.select("lang", "shard", "pair.gi", "pair.hi", "g", "total", F.coalesce("keys", F.lit(0)).alias("keys"))
    cells = counts.join(groups.select("lang", "source", "g", "last_tile"), ["lang", "source"]).withColumn("t", tile).withColumn("pair", both)
    cells = cells.select(*(F.col(c).alias(to) for c, to in (("lang", "c_lang"), ("shard", "c_shard"), ("pair.gi", "c_gi"), ("pair.hi", "c_hi"), ("g", "c_g"), ("slots", "slots"), ("counts", "counts"))))
    by = ("lang", "shard", "gi", "hi")
    sums = cells.groupBy(*(f"c_{c}" for c in by)).cogroup(sources.groupBy(*by)).applyInArrow(lambda t, r: _pair_sums(t, r, width), "lang string, g long, h long, value long")
    pairs = sums.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    names = groups.select("lang", "g", "source")
    pairs = pairs.join(names, ["lang", "g"]).join(names.select("lang", F.col("g").alias("h"), F.col("source").alias("item")), ["lang", "h"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    # term: a shard's counts of all sources give those of the language; its best terms are ranked among all shards'
    cells = counts.join(groups.select("lang", "source", "total", "lang_total"), ["lang", "source"])
    cells = cells.select(F.col("lang").alias("c_lang"), F.col("shard").alias("c_shard"), "source", "slots", "counts", "total", "lang_total")
    stored = tables.select("lang", "shard", "seed", "sizes", "bits", "ends", "blob")
    best = cells.groupBy("c_lang", "c_shard").cogroup(stored.groupBy("lang", "shard")).applyInArrow(lambda t, r: _standing_out(t, r, top), "lang string, source string, item string, value long")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(best.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
