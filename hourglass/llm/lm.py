"""Language-model scoring by deleted interpolation.

Texts are lower-cased (A-Z), split into words, and closed by one end token.
Counts of all n-grams up to ORDER come from the learning documents.  One part
of these (the deleted part) is kept out of the counts while the mixture is
learned: expectation-maximisation fits, for each bucket of context frequency,
the weights of the n-gram maximum-likelihood estimates of all orders and of
a uniform floor, so that the deleted part becomes most probable.  Texts are
then scored with the counts of all learning documents:

    P(w | h) = l0(b) / (V + 1) + sum over k of lk(b) * c(h_k w) / c(h_k)

where b is the highest order whose context was seen and the binary logarithm
of its count.

Counting and looking up are one exchange.  Documents are dealt to batches by
hash.  A batch sends each distinct n-gram once, with its count, to the bucket
of the n-gram's hash; the bucket sums the counts of all batches and answers
every batch with the totals of what it sent, in the same order.  So a word
that makes up a third of all tokens costs one entry a batch, and no task
holds the model.  n-grams are named by 64-bit hashes.

Defined results: a null or empty text is the end token alone; a null doc_id
hashes like the empty text, which belongs to the learning documents; rows with
equal id and text are separate documents; without learning documents all
counts are 0 and the floor remains; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import crc_mod, mix64, ship, text_bytes, written

ORDER = 2
#: crc32(doc_id) mod 7: held out from learning, and deleted while the mixture is learned.
FOLDS, HELD_OUT, DELETED = 7, 2, 3
#: UTF-8 bytes of text in a batch, and of n-grams in a bucket, on average.
BATCH_BYTES, BUCKET_BYTES = 12 << 20, 16 << 20
#: Steps of the probability grid per factor 2; the mixture is learned on grid cells.
GRID = 8
EM_ROUNDS = 60
_END, _START = np.uint64(0x51ED270B7F4A7C15), np.uint64(0xA0761D6478BD642F)
_MUL = np.uint64(0x9E3779B97F4A7C15)


# --- packed arrays ------------------------------------------------------------

def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct uint64 keys as compressed byte planes of their differences."""
    import zstandard
    d = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    planes = np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_keys(blob: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts in the narrowest of 1, 2, 4 and 8 bytes, compressed."""
    import zstandard
    top = int(counts.max()) if len(counts) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(counts.astype(f"<u{width}").tobytes())


def unpack_counts(blob: bytes) -> np.ndarray:
    import zstandard
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), f"<u{blob[0]}").astype(np.int64)


# --- n-grams of a batch -------------------------------------------------------

class Batch:
    """n-gram hashes of the documents of a batch, order by order, aligned with their tokens."""

    def __init__(self, table: pa.Table, order: int):
        import xxhash

        number: dict[bytes, int] = {}
        ids: list[int] = []
        sizes = []
        for text in table.column("text").to_pylist():
            words = text.encode().lower().split() if text else []
            ids += [number.setdefault(w, len(number)) for w in words]
            sizes.append(len(words) + 1)
        h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in number), np.uint64, len(number))
        self.n_tokens = np.array(sizes, np.int64)
        self.first = np.cumsum(self.n_tokens) - self.n_tokens
        n = int(self.n_tokens.sum())
        token = np.full(n, _END)
        inner = np.ones(n, bool)
        inner[self.first + self.n_tokens - 1] = False
        token[inner] = h[np.array(ids, np.int64)] if ids else h[:0]
        self.grams = [mix64(token)]
        for _ in range(1, order):
            before = np.empty_like(token)
            before[1:] = self.grams[-1][:-1]
            before[self.first] = _START
            self.grams.append(mix64(before * _MUL + token))
        self.uniq, self.at = zip(*(np.unique(g, return_inverse=True) for g in self.grams)) if n else (self.grams, [np.zeros(0, np.int64)] * order)

    def in_training(self, train: np.ndarray, k: int) -> np.ndarray:
        """Occurrences of the k-th order's distinct n-grams in the marked documents."""
        return np.bincount(self.at[k], weights=np.repeat(train, self.n_tokens), minlength=len(self.uniq[k])).astype(np.int64)


def bucket_cuts(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Where the sorted keys pass from one bucket (an equal range of hashes) to the next."""
    edge = np.array([(b << 64) // n_buckets for b in range(n_buckets)], dtype=object)
    return np.r_[np.searchsorted(keys, np.array([int(x) for x in edge], np.uint64)), len(keys)]


def requests(docs: DataFrame, order: int, n_buckets: int) -> DataFrame:
    """What the batches send: per batch, order and bucket the distinct n-grams and their counts in learning documents."""
    def run(table: pa.Table) -> pa.Table:
        b = Batch(table, order)
        train = table.column("train").to_numpy().astype(np.float64)
        batch, deleted = table.column("batch")[0].as_py(), table.column("deleted")[0].as_py()
        out = []
        for k in range(order):
            counts, cuts = b.in_training(train, k), bucket_cuts(b.uniq[k], n_buckets)
            for i in np.flatnonzero(cuts[1:] > cuts[:-1]):
                part = slice(cuts[i], cuts[i + 1])
                out.append((int(i), batch, deleted, k, pack_keys(b.uniq[k][part]), pack_counts(counts[part])))
        cols = list(zip(*out)) or [()] * 6
        types = (pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=["bucket", "batch", "deleted", "k", "keys", "counts"])

    return docs.groupBy("batch").applyInArrow(run, "bucket int, batch long, deleted boolean, k int, keys binary, counts binary")


def replies(sent: DataFrame) -> DataFrame:
    """The buckets' answers: totals of what each batch sent, of all learning documents and (to deleted
    batches) of the deleted part.  A row with batch null has the bucket's distinct, all and deleted training tokens."""
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        ks = table.column("k").to_numpy()
        out = []
        distinct = tokens = gone = 0
        for k in np.unique(ks):
            rows = [table.slice(int(i), 1).to_pylist()[0] for i in np.flatnonzero(ks == k)]
            keys = [unpack_keys(r["keys"]) for r in rows]
            counts = [unpack_counts(r["counts"]) for r in rows]
            uniq, at = np.unique(np.concatenate(keys), return_inverse=True)
            lost = np.concatenate([c if r["deleted"] else np.zeros(len(c), np.int64) for r, c in zip(rows, counts)])
            total = np.bincount(at, weights=np.concatenate(counts), minlength=len(uniq)).astype(np.int64)
            deleted = np.bincount(at, weights=lost, minlength=len(uniq)).astype(np.int64)
            if k == 0:
                distinct, tokens, gone = int((total > 0).sum()), int(total.sum()), int(deleted.sum())
            start = 0
            for r, x in zip(rows, keys):
                i = at[start : start + len(x)]
                start += len(x)
                out.append((r["batch"], bucket, int(k), pack_counts(total[i]), pack_counts(deleted[i]) if r["deleted"] else None, 0, 0, 0))
        out.append((None, bucket, 0, None, None, distinct, tokens, gone))
        types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["batch", "bucket", "k", "total", "lost", "distinct", "tokens", "gone"])

    return sent.groupBy("bucket").applyInArrow(run, "batch long, bucket int, k int, total binary, lost binary, distinct long, tokens long, gone long")


def _aligned(table: pa.Table, b: Batch, column: str) -> list[np.ndarray]:
    """The counts of a batch's n-grams, order by order, aligned with its tokens."""
    rows = sorted(table.select(["k", "bucket", column]).to_pylist(), key=lambda r: (r["k"], r["bucket"]))
    out = []
    for k in range(len(b.grams)):
        parts = [unpack_counts(r[column]) for r in rows if r["k"] == k]
        out.append((np.concatenate(parts) if parts else np.zeros(0, np.int64))[b.at[k]])
    return out


def estimates(b: Batch, counts: list[np.ndarray], n_tokens: int, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of context frequency, maximum-likelihood estimates by order) of each token."""
    est = np.zeros((len(counts), len(counts[0])))
    est[0] = counts[0] / max(n_tokens, 1)
    bucket = np.zeros(len(counts[0]), np.int64)
    for k in range(1, len(counts)):
        ctx = np.empty(len(counts[0]), np.int64)
        ctx[1:] = counts[k - 1][:-1]
        ctx[b.first] = n_docs
        seen = ctx > 0
        est[k, seen] = counts[k][seen] / ctx[seen]
        bucket[seen] = 64 * k + np.log2(ctx[seen]).astype(np.int64)
    return bucket, est


def em(cells: list[tuple], floor: float, order: int) -> dict[int, np.ndarray]:
    """Mixture weights (uniform, order 1, order 2 ...) of each bucket from grid cells (bucket, steps..., n)."""
    out = {}
    by: dict[int, list] = {}
    for c in cells:
        by.setdefault(c[0], []).append(c[1:])
    for bucket, rows in by.items():
        a = np.array(rows, float)
        p = np.c_[np.full(len(a), floor), np.where(a[:, :order] < 0, 0, 2.0 ** (-a[:, :order] / GRID))]
        n = a[:, order]
        seen = p.max(axis=0) > 0
        w = seen / seen.sum()
        for _ in range(EM_ROUNDS):
            r = w * p
            w = (n[:, None] * r / r.sum(axis=1, keepdims=True)).sum(axis=0) / n.sum()
        # every part that can be seen keeps a little weight, so that no probability is 0
        w = 0.999999 * w + 0.000001 * seen / seen.sum()
        out[bucket] = w
    return out


def weights_of(bucket: np.ndarray, learned: dict[int, np.ndarray], order: int) -> np.ndarray:
    """Weights by token; a bucket that EM has not met takes those of the nearest one of its order, or equal ones."""
    uniq, at = np.unique(bucket, return_inverse=True)
    table = np.zeros((len(uniq), order + 1))
    for i, b in enumerate(uniq):
        near = [x for x in learned if x // 64 == b // 64]
        if near:
            table[i] = learned[min(near, key=lambda x: (abs(x - b), x))]
        else:
            table[i, : b // 64 + 2] = 1 / (b // 64 + 2)
    return table[at]


def score(spark: SparkSession, docs: DataFrame, order: int = ORDER, batch_bytes: int = BATCH_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per document."""
    ship(spark)
    size = text_bytes(docs)
    n_batches, n_buckets = max(1, math.ceil(size / batch_bytes)), max(1, math.ceil(order * size / bucket_bytes))
    fold = crc_mod(docs["doc_id"], FOLDS)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), (fold != HELD_OUT).alias("train"), (fold == DELETED).alias("deleted"))
    # deleted documents have batches of their own (odd numbers)
    rows = rows.withColumn("batch", 2 * F.pmod(F.xxhash64("doc_id", "text"), F.when(F.col("deleted"), math.ceil(n_batches / FOLDS)).otherwise(n_batches)) + F.col("deleted").cast("int"))
    answers = written(replies(requests(rows, order, n_buckets)), "ngrams")
    totals = answers.where("batch IS NULL").agg(F.sum("distinct"), F.sum("tokens"), F.sum("gone")).first()
    n_distinct, n_all, n_deleted = (x or 0 for x in totals)
    n_docs, n_deleted_docs = docs.agg(F.count(F.when(fold != HELD_OUT, 1)), F.count(F.when(fold == DELETED, 1))).first()
    floor = 1 / (n_distinct + 1)
    answers = answers.where("batch IS NOT NULL").drop("distinct", "tokens", "gone")
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def learn(table: pa.Table, answer: pa.Table) -> pa.Table:
        """Grid cells of the deleted documents' tokens, by counts without these documents."""
        if not table.num_rows:
            return pa.table({"cell": pa.array([], pa.list_(pa.int32())), "n": pa.array([], pa.int64())})
        b = Batch(table, order)
        kept = [t - x for t, x in zip(_aligned(answer, b, "total"), _aligned(answer, b, "lost"))]
        bucket, est = estimates(b, kept, n_all - n_deleted, n_docs - n_deleted_docs)
        with np.errstate(divide="ignore"):
            steps = np.where(est > 0, np.round(-np.log2(est) * GRID), -1).astype(np.int64)
        cells, n = np.unique(np.stack([bucket, *steps], axis=1), axis=0, return_counts=True)
        return pa.table({"cell": pa.array(cells.tolist(), pa.list_(pa.int32())), "n": pa.array(n, pa.int64())})

    def final(table: pa.Table, answer: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table([pa.array([], t) for t in types], names=names)
        b = Batch(table, order)
        counts = _aligned(answer, b, "total")
        bucket, est = estimates(b, counts, n_all, n_docs)
        w = weights_of(bucket, learned, order)
        p = w[:, 0] * floor + (w[:, 1:] * est.T).sum(axis=1)
        base = np.log10((counts[0] + 1) / (n_all + n_distinct + 1))
        add = lambda x: np.add.reduceat(x, b.first)
        return pa.table([table.column("doc_id"), pa.array(~table.column("train").to_numpy()), pa.array(b.n_tokens), pa.array(add((counts[0] > 0).astype(np.int64))),
                         pa.array(np.full(len(b.first), n_all)), pa.array(add(base)), pa.array(add(np.log10(p)))], names=names)

    gone = rows.where("deleted")
    cells = gone.groupBy("batch").cogroup(answers.where("batch % 2 = 1").groupBy("batch")).applyInArrow(learn, "cell array<int>, n long")
    # at most one cell for each bucket and step of the probability grid, whatever the input's size
    found = cells.groupBy("cell").agg(F.sum("n").alias("n")).collect()
    learned = em([(*r.cell, r.n) for r in found], floor, order)
    return rows.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(final, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
