"""Removal of every byte covered by a 400-byte string that starts anywhere else.

Per-shard suffix arrays decide which strings repeat.  To bring equal strings
to one shard, every 400-byte string is named by the least 16-byte hash inside
it (its anchor) and the bytes around the anchor that all strings of the same
offset range share (the core, 208 bytes or more).  Equal strings have equal
anchors, offsets and cores, whatever stands around them.  Neighbouring strings
of one anchor and range form a piece.  Pieces whose core occurs once hold no
repeat and go no further.  Equal pieces are counted as one, so thousands of
copies cost one text.  Where one core has different pieces, their texts go to
the shard of the core:

* Larsson-Sadakane refinement sorts the suffixes: groups of equal rank are
  split by the rank h bytes further on, h doubles, and sorted groups are left.
* Common prefixes follow Kasai's rule: where the predecessors of neighbouring
  suffixes are neighbours too and have a symbol in common, the prefix is one shorter, so only the heads of
  such runs are compared.
* A core with very many pieces is cut into several shards.  Each sends its
  sorted string hashes on, by range of hash, and the lists of all its shards
  are merged by binary search in each other.

Defined results: a null text counts as empty; texts below 400 bytes keep all
bytes, unless nothing; the same string twice in one document is a repeat;
repeated rows repeat each other; the kept bytes need not be valid UTF-8; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import mix64, ship, written

LENGTH, GRAM = 400, 16
WINDOW = LENGTH - GRAM + 1
#: First offset of the second range of anchor offsets.
SPLIT = 193
#: Bytes looked at in one go.
BLOCK = 1 << 20
#: Bytes of pieces in a shard, on average; pieces of one core in a shard.
SHARD_BYTES, SHARD_PIECES = 3 << 19, 2048
#: Hash ranges among which the strings of cut cores are merged.
RANGES = 256
_TABLE = mix64(np.arange(1, 257, dtype=np.uint64))
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse modulo 2**64; kept for the next text."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        have = tuple(np.cumprod(np.r_[np.uint64(1), np.full(n - 1, np.uint64(x))], dtype=np.uint64) for x in (base, pow(base, -1, 1 << 64)))
        _powers[base] = have
    return have[0][:n], have[1][:n]


class Rolling:
    """64-bit hashes of any byte ranges of a text by prefix sums over powers of an odd base."""

    def __init__(self, data: np.ndarray, base: int):
        power, self.back = powers(base, len(data) + 1)
        self.sums = np.r_[np.uint64(0), np.cumsum(_TABLE[data] * power[:-1], dtype=np.uint64)]

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix64((self.sums[stop] - self.sums[start]) * self.back[start] + (stop - start).astype(np.uint64))

    def every(self, size: int) -> np.ndarray:
        """Hashes of all ranges of one size."""
        return mix64((self.sums[size:] - self.sums[:-size]) * self.back[: len(self.sums) - size] + np.uint64(size))


def sliding_argmin(x: np.ndarray, w: int) -> np.ndarray:
    """Position of the least of each w neighbours (the first of equal ones)."""
    n = len(x)
    low = np.uint64((1 << 24) - 1)
    packed = (x & ~low) | np.arange(n, dtype=np.uint64)
    m = -(-n // w) * w
    grid = np.full(m, np.iinfo(np.uint64).max)
    grid[:n] = packed
    grid = grid.reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[: n - w + 1], ahead[w - 1 : n]) & low).astype(np.int64)


def pieces_of(texts: list[bytes], block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Text number, and key, hash 1, hash 2, first start and number of starts of the texts' pieces.

    Short texts are looked at together, long ones in blocks.
    """
    number, out = [np.zeros(0, np.int64)], [np.zeros((5, 0), np.int64)]
    size = np.array([len(t) for t in texts], np.int64)
    i = 0
    while i < len(texts):
        if size[i] > block:
            for lo in range(0, int(size[i]) - LENGTH + 1, block):
                _, p = _pieces(texts[i][lo : lo + block + LENGTH - 1], np.zeros(1, np.int64))
                p[3] += lo
                number.append(np.full(p.shape[1], i))
                out.append(p)
            i += 1
            continue
        j = i + max(1, int(np.searchsorted(np.cumsum(size[i:]), block, side="right")))
        first = np.cumsum(size[i:j]) - size[i:j]
        n, p = _pieces(b"".join(texts[i:j]), first)
        number.append(n + i)
        out.append(p)
        i = j
    return np.concatenate(number), np.concatenate(out, axis=1)


def _pieces(raw: bytes, text_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(raw) < LENGTH:
        return np.zeros(0, np.int64), np.zeros((5, 0), np.int64)
    data = np.frombuffer(raw, np.uint8)
    one, two = Rolling(data, _BASES[0]), Rolling(data, _BASES[1])
    anchor = sliding_argmin(one.every(GRAM), WINDOW)
    start = np.arange(len(anchor))
    name = anchor * 2 + (anchor - start >= SPLIT)
    whole = np.ones(len(anchor), bool)  # strings that end in the text they start in
    for d in text_start[1:]:
        whole[max(0, d - LENGTH + 1) : d] = False
    change = name[1:] != name[:-1]
    change |= whole[1:] != whole[:-1]
    head = np.r_[True, change]
    head[text_start[text_start < len(head)]] = True
    first = np.flatnonzero(head)
    count = np.diff(np.r_[first, len(name)])
    first, count = first[whole[first]], count[whole[first]]
    a, far = name[first] >> 1, (name[first] & 1) == 1
    # the core of each range lies in all its strings: from the least to the greatest offset
    core_lo, core_hi = np.where(far, a - SPLIT, a), np.where(far, a + GRAM, a - SPLIT + 1 + LENGTH)
    key = mix64(one.of(core_lo, core_hi) ^ mix64(two.of(core_lo, core_hi) + far.astype(np.uint64)))
    end = first + count - 1 + LENGTH
    text = np.searchsorted(text_start, first, side="right") - 1
    return text, np.stack([key.view(np.int64), one.of(first, end).view(np.int64), two.of(first, end).view(np.int64), first - text_start[text], count])


# --- suffix arrays --------------------------------------------------------------

def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by their suffixes up to ``depth`` symbols at least (Larsson-Sadakane refinement)."""
    n = len(data)
    rank = np.full(n + 1, -1, np.int64)
    wide = np.r_[data.astype(np.int64) + 1, 0, 0]
    bits = int(wide.max()).bit_length()
    h = 3 if 3 * bits <= 63 else 1
    key = (wide[:-2] << 2 * bits) | (wide[1:-1] << bits) | wide[2:] if h == 3 else wide[:-2]
    order = np.argsort(key)

    def settle(places: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Ranks the suffixes at these places by their sorted keys (a group's rank is the place of its
        first member); returns the places in groups that aren't sorted yet."""
        head = np.r_[True, keys[1:] != keys[:-1]]
        rank[order[places]] = np.maximum.accumulate(np.where(head, places, 0))
        return places[~(head & np.r_[head[1:], True])]

    places = settle(np.arange(n), key[order])
    while h < depth and len(places):
        member = order[places]
        key = rank[member] * (n + 1) + rank[np.minimum(member + h, n)] + 1
        again = np.argsort(key)
        order[places] = member[again]
        places = settle(places, key[again])
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each suffix in ``order`` with the one before, exact up to ``most`` symbols."""
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    head = np.r_[True, (before[1:] != before[:-1] + 1) | (before[:-1] < 0) | (data[:-1] != data[before[:-1]])]
    i = np.flatnonzero(head & (before >= 0))
    length = np.zeros(n, np.int64)
    padded = np.r_[data, np.full(64, -1, data.dtype)]
    step, done = 8, np.zeros(len(i), np.int64)
    open_ = np.arange(len(i))
    while len(open_) and int(done[open_].min()) < most:
        x, y = i[open_] + done[open_], before[i[open_]] + done[open_]
        differ = padded[x[:, None] + np.arange(step)] != padded[y[:, None] + np.arange(step)]
        differ |= np.maximum(x, y)[:, None] + np.arange(step) >= n
        any_ = differ.any(axis=1)
        done[open_] += np.where(any_, differ.argmax(axis=1), step)
        open_ = open_[~any_]
        open_ = open_[done[open_] < most]
        step = 32
    run = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    length[i] = done
    plcp = np.maximum(length[run] - (np.arange(n) - run), 0)
    return plcp[order]


def repeated_starts(texts: list[bytes]) -> list[np.ndarray]:
    """For each piece text, whether the 400-byte string at each start is also elsewhere in these pieces."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    data = np.zeros(int(sizes.sum()), np.int32)
    ends = np.cumsum(sizes) - 1
    inner = np.ones(len(data), bool)
    inner[ends] = False
    data[inner] = np.frombuffer(b"".join(texts), np.uint8)
    data[ends] = 256 + np.arange(len(texts))  # a separator of its own after each piece
    order = suffix_array(data, LENGTH)
    long = common_prefixes(data, order, max(map(len, texts))) >= LENGTH
    hit = np.zeros(len(data), bool)
    hit[order] = long | np.r_[long[1:], False]
    return [hit[e - len(t) : e - LENGTH + 1] for t, e in zip(texts, ends)]


def runs(mask: np.ndarray) -> list[int]:
    """First and last place of each run of true values, flat."""
    edge = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
    return np.stack([edge[::2], edge[1::2] - 1], axis=1).ravel().tolist()


# --- the operator -------------------------------------------------------------

def piece_table(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            texts = [t.encode() if t else b"" for t in batch.column(1).to_pylist()]
            number, p = pieces_of(texts)
            owner = batch.column(0).to_numpy()[number]
            for lo in range(0, p.shape[1], 50_000):
                q = p[:, lo : lo + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(q[0]), pa.array(q[1]), pa.array(q[2]), pa.array(owner[lo : lo + 50_000]), pa.array(q[3]), pa.array(q[4])], names=["key", "h1", "h2", "rk", "start", "starts"])

    return docs.select("rk", "text").mapInArrow(run, "key long, h1 long, h2 long, rk long, start long, starts long")


MARKS = "key long, h1 long, h2 long, runs array<int>, sub int, range int, list binary"


def shard_marks(texts: DataFrame) -> DataFrame:
    """Repeated starts of each piece, by the suffix array of its shard.

    Shards of ``cut`` cores also give their lists: a row for each range of
    hashes with the sorted hashes of the strings there, the number of each
    one's piece, its place, and the pieces' names.
    """
    def run(t: pa.Table) -> pa.Table:
        content, copies = t.column("piece").to_pylist(), t.column("n").to_numpy()
        key, h1, h2, sub = (t.column(c).to_numpy() for c in ("key", "h1", "h2", "sub"))
        marks = [m if n < 2 else np.ones(len(m), bool) for m, n in zip(repeated_starts(content), copies)]
        out = [(key[i], h1[i], h2[i], runs(m), sub[i], -1, None) for i, m in enumerate(marks) if m.any()]
        if t.column("cut")[0].as_py():  # then all pieces are of one core
            size = np.array([len(c) - LENGTH + 1 for c in content])
            h = np.concatenate([Rolling(np.frombuffer(c, np.uint8), _BASES[0]).every(LENGTH) for c in content])
            owner = np.repeat(np.arange(len(content)), size)
            place = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
            order = np.argsort(h)
            edge = np.searchsorted(h[order], np.arange(RANGES, dtype=np.uint64) << np.uint64(56))
            for r, part in enumerate(np.split(order, edge[1:])):
                if len(part):
                    o = owner[part]
                    blob = np.stack([h[part].view(np.int64), h1[o], h2[o], place[part]]).tobytes()
                    out.append((key[0], 0, 0, [], sub[0], r, blob))
        cols = list(zip(*out)) or [()] * 7
        types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.binary())
        return pa.table([pa.array(c, x) for c, x in zip(cols, types)], names=["key", "h1", "h2", "runs", "sub", "range", "list"])

    return texts.groupBy("shard").applyInArrow(run, MARKS)


def merged_marks(marks: DataFrame) -> DataFrame:
    """Starts of cut cores' pieces whose string is in another shard's list, found by binary search."""
    def run(t: pa.Table) -> pa.Table:
        lists = [np.frombuffer(b, np.int64).reshape(4, -1) for b in t.column("list").to_pylist()]
        found = {}
        for i, (h, h1, h2, place) in enumerate(lists):
            other = np.sort(np.concatenate([x[0] for j, x in enumerate(lists) if j != i] or [h[:0]]))
            if len(other):
                for k in np.flatnonzero(other[np.minimum(np.searchsorted(other, h), len(other) - 1)] == h):
                    found.setdefault((int(h1[k]), int(h2[k])), []).append(int(place[k]))
        key = t.column("key")[0].as_py()
        return pa.table([pa.array([key] * len(found), pa.int64()), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()),
                         pa.array([[p for q in v for p in (q, q)] for v in found.values()], pa.list_(pa.int32()))], names=["key", "h1", "h2", "runs"])

    return marks.where("range >= 0").groupBy("key", "range").applyInArrow(run, "key long, h1 long, h2 long, runs array<int>")


def remove_repeats(spark: SparkSession, docs: DataFrame, shard_bytes: int = SHARD_BYTES, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary): one row per document."""
    ship(spark)
    named = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    named = named.withColumn("rk", F.xxhash64("doc_id", "text"))
    every = written(piece_table(named), "pieces")
    shared = written(every.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"), "keys")
    found = written(every.join(shared, "key", "left_semi"), "shared")
    distinct = written(found.groupBy("key", "h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rk", "start", "starts")).alias("at")), "distinct")
    variety = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("v"))
    several = variety.where("v > 1").withColumn("subs", F.ceil(F.col("v") / shard_pieces).cast("int"))
    wanted = written(distinct.join(several, "key").select("key", "h1", "h2", "n", "at.*", "subs"), "wanted")
    size = wanted.agg(F.sum(F.col("starts") + LENGTH - 1)).first()[0] or 0
    n_shards = max(1, math.ceil(size / shard_bytes))
    piece = F.expr(f"substring(cast(text as binary), cast(start + 1 as int), cast(starts + {LENGTH - 1} as int))")
    texts = named.select("rk", "text").join(wanted, "rk").select("key", "h1", "h2", "n", (F.col("subs") > 1).alias("cut"), F.pmod(F.xxhash64("h1"), F.col("subs")).cast("int").alias("sub"), piece.alias("piece"))
    texts = texts.dropDuplicates(["key", "h1", "h2"])  # repeated rows have one name
    texts = texts.withColumn("shard", F.when(F.col("cut"), F.xxhash64("key", "sub")).otherwise(F.pmod(F.xxhash64("key"), F.lit(n_shards))))
    marks = written(shard_marks(texts), "marks")
    whole = distinct.join(several, "key", "left_anti").select("key", "h1", "h2", F.expr("array(0, cast(at.starts - 1 as int))").alias("runs"))
    marked = whole.unionByName(marks.where("range < 0").select("key", "h1", "h2", "runs")).unionByName(merged_marks(marks))
    spans = found.join(marked, ["key", "h1", "h2"]).select("rk", F.transform("runs", lambda x: x + F.col("start")).alias("spans"))
    # a document's spans: at most a few for each of its strings
    per_doc = spans.groupBy("rk").agg(F.flatten(F.collect_list("spans")).alias("spans"))

    def cut_out(batches):
        for batch in batches:
            n, gone, parts, kept = [], [], [], []
            for text, spans_ in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw = text.encode()
                lost = np.zeros(len(raw) + 1, np.int32)
                if spans_:
                    at = np.array(spans_, np.int64).reshape(-1, 2)
                    np.add.at(lost, at[:, 0], 1)
                    np.add.at(lost, at[:, 1] + LENGTH, -1)
                mask = np.cumsum(lost)[:-1] > 0
                n.append(len(raw))
                gone.append(int(mask.sum()))
                parts.append(int((np.diff(np.r_[False, mask].astype(np.int8)) == 1).sum()))
                kept.append(np.frombuffer(raw, np.uint8)[~mask].tobytes() if gone[-1] else raw)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(parts, pa.int64()), pa.array(kept, pa.binary())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    joined = named.join(per_doc, "rk", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(cut_out, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
