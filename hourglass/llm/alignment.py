"""Alignment of two tokenizers by inverted bitmaps of their linked tokens.

Both tokenizers cut the same bytes (a space and the text).  Tokens whose byte
ranges overlap are linked; offsets where both end a token cut them into groups.

1. One pass encodes every document, gives its counts and groups, and inverts its
   links: for each pair of ids a compressed bitmap of the documents that hold it
   (sorted 16-bit numbers, or one bit a document where these are longer), and
   planes with the bits of the number of links in each of these documents.
   Batches are OR-merged to one bitmap per pair and container of DOCS documents.
2. Popcounts of the bitmaps, summed over the containers (which share no
   document), count the documents of a pair.  A pair is a best one if no other
   pair of its first id has more.
3. The postings go back to their containers with these counts, and a task adds
   them up for the documents of one container in dense arrays.

Defined results: a null or empty text, and one whose joined tokens differ from
space and text in either tokenizer, has no tokens (zeros, and '' for the groups);
special tokens inside texts are plain text; repeated rows and ids are documents
of their own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import ship, written
from .bpe import PATTERN, byte_alphabet

#: Documents of a container; its numbers fit 16 bits.
DOCS = 8192
#: Postings that a task holds before it closes a container.
HELD = 2_000_000
#: Characters that are encoded at a time (a longer text is one batch).
BATCH = 1 << 20

DOC_FIELDS = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
POSTING_FIELDS = [("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64()), ("docs", pa.binary()), ("planes", pa.binary())]


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..size-1, with room for a separator, and their number."""
    text = [str(i).encode() for i in range(size)]
    room = max(map(len, text)) + 1
    return np.frombuffer(b"".join(t.ljust(room) for t in text), np.uint8).reshape(size, room), np.array([len(t) for t in text])


def byte_level(raw: bytes):
    """An encoder of many texts (special tokens as plain text), and the bytes of each id, of a byte-level BPE (JSON).

    Where the merges stand in the order of their ids, as they do in published
    vocabularies, ranks are ids and tiktoken gives the same tokens four times
    as fast; otherwise the tokenizers library encodes.
    """
    spec = json.loads(raw)
    vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    names = [b""] * (max([*vocab.values(), *special.values()]) + 1)
    for name, i in vocab.items():
        names[i] = name.encode() if name in special else bytes(alphabet[c] for c in name)
    for name, i in special.items():
        names[i] = name.encode()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    made = [vocab[a + b] for a, b in pairs]
    before = spec.get("pre_tokenizer") or {}
    if made == sorted(set(made)) and not spec.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space"):
        import tiktoken

        ranks = {names[i]: i for name, i in vocab.items() if name not in special}
        plain = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [plain.encode_ordinary(t) for t in texts], names
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(raw.decode())
    tok.encode_special_tokens = True
    tok.no_padding()
    tok.no_truncation()
    return lambda texts: [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)], names


class Aligner:
    """Byte-level BPE (JSON) and sentencepiece model, given as bytes."""

    def __init__(self, raw_a: bytes, raw_b: bytes):
        import sentencepiece

        self.encode_a, names = byte_level(raw_a)
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=raw_b)
        self.a = self._table(names)
        pieces = [(self.sp.id_to_piece(i), self.sp.is_byte(i)) for i in range(self.sp.get_piece_size())]
        self.b = self._table([bytes([int(p[3:5], 16)]) if is_byte else p.replace("▁", " ").encode() for p, is_byte in pieces])
        self.width = len(pieces)  # a pair's number is a * width + b
        self.digits, self.n_digits = _digits(max(len(names), len(pieces)))

    @staticmethod
    def _table(names: list[bytes]):
        size = np.array([len(n) for n in names], np.int64)
        return size, np.cumsum(size) - size, np.frombuffer(b"".join(names), np.uint8)

    @staticmethod
    def _joined(ids: np.ndarray, table) -> bytes:
        size, start, blob = table
        n = size[ids]
        return blob[np.repeat(start[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())].tobytes()

    def tokens(self, texts: list[str]):
        """ids and tokens per text of both tokenizers; texts that a tokenizer changes get none."""
        whole = [(" " + t).encode() for t in texts]
        out = []
        for ids, table in ((self.encode_a([" " + t for t in texts]), self.a), (self.sp.encode(texts, num_threads=1), self.b)):
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.int64, n.sum())
            joined, ends = self._joined(flat, table), np.r_[0, np.cumsum(table[0][flat])][np.cumsum(n)]
            starts = np.r_[0, ends[:-1]]
            out.append((flat, n, np.array([joined[s:e] == w for s, e, w in zip(starts, ends, whole)], bool)))
        ok = out[0][2] & out[1][2]
        return [(flat[np.repeat(ok, n)], np.where(ok, n, 0)) for flat, n, _ in out]

    def align(self, texts: list[str]):
        """Per text n_a, n_b, n_groups, n_links, groups_sha256; per link its text and pair number."""
        (a, n_a), (b, n_b) = self.tokens(texts)
        end_a, end_b = np.cumsum(self.a[0][a]), np.cumsum(self.b[0][b])
        last = np.cumsum(n_a)
        doc_end = np.r_[0, end_a][last]  # texts without tokens end where the one before does
        cut = np.sort(np.concatenate([end_a, end_b]), kind="stable")  # two sorted runs
        cut = cut[np.r_[True, cut[1:] != cut[:-1]]] if len(cut) else cut
        at_a, at_b = np.searchsorted(end_a, cut), np.searchsorted(end_b, cut)
        doc = np.searchsorted(doc_end, cut)
        common = cut[(end_a[at_a] == cut) & (end_b[at_b] == cut)]
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        n_groups = np.bincount(np.searchsorted(doc_end, common), minlength=len(texts))
        n_links = np.bincount(doc, minlength=len(texts))

        # the tokens in the order of the group text, each with its separator
        place = np.r_[np.arange(len(a)) + np.searchsorted(group_b, group_a), np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")]
        ids = np.empty(len(a) + len(b), np.int64)
        ids[place] = np.r_[a, b]
        closes = np.empty(len(ids), np.uint8)
        comma, bar, semicolon, nothing = b",|;\0"
        ends_b = np.r_[group_b[1:] != group_b[:-1], True] if len(b) else np.zeros(0, bool)
        mark_b = np.where(ends_b, semicolon, comma)
        mark_b[np.cumsum(n_b)[n_b > 0] - 1] = nothing
        ends_a = np.r_[group_a[1:] != group_a[:-1], True] if len(a) else np.zeros(0, bool)
        closes[place] = np.r_[np.where(ends_a, bar, comma), mark_b]
        size = self.n_digits[ids]
        rows = self.digits[ids]
        rows[np.arange(len(ids)), size] = closes
        size = size + (closes != nothing)
        text = rows[np.arange(rows.shape[1]) < size[:, None]].tobytes()
        upto = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(n_a + n_b)]]
        sha = [hashlib.sha256(text[s:e]).hexdigest() if e > s else "" for s, e in zip(upto[:-1], upto[1:])]
        return (n_a, n_b, n_groups, n_links, sha), doc, a[at_a] * self.width + b[at_b]


def pack(pair: np.ndarray, doc: np.ndarray, links: np.ndarray, docs_held: int = DOCS):
    """Postings sorted by pair and document as (pairs, documents of each, bitmaps, planes); the last two as (bytes, sizes)."""
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, np.int64)
    n = np.diff(np.r_[first, len(pair)])
    of = np.repeat(np.arange(len(first)), n)
    rank = np.arange(len(pair)) - first[of]
    full = docs_held // 8  # bytes of one bit a document; lists of numbers stay below
    dense = 2 * n >= full
    size = np.where(dense, full, 2 * n)
    start = np.cumsum(size) - size
    docs = np.zeros(size.sum(), np.uint8)
    few = ~dense[of]
    docs.view("<u2")[start[of[few]] // 2 + rank[few]] = doc[few]
    bit = ~few
    np.bitwise_or.at(docs, start[of[bit]] + doc[bit] // 8, (128 >> (doc[bit] % 8)).astype(np.uint8))
    # planes: bit j of links - 1, eight documents of the posting a byte
    more = links - 1
    depth = np.zeros(len(first), np.int64)
    if len(first):
        top = np.maximum.reduceat(more, first)
        depth = np.where(top > 0, np.floor(np.log2(np.maximum(top, 1))).astype(np.int64) + 1, 0)
    row = (n + 7) // 8
    begin = np.cumsum(depth * row) - depth * row
    planes = np.zeros((depth * row).sum(), np.uint8)
    for j in range(int(depth.max(initial=0))):
        on = np.flatnonzero((more >> j) & 1)
        np.bitwise_or.at(planes, begin[of[on]] + j * row[of[on]] + rank[on] // 8, (128 >> (rank[on] % 8)).astype(np.uint8))
    return pair[first], n, (docs, size), (planes, depth * row)


def unpack(docs: list[bytes], planes: list[bytes], docs_held: int = DOCS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posting, document, links) of all documents of the postings."""
    size = np.fromiter(map(len, docs), np.int64, len(docs))
    flat = np.frombuffer(b"".join(docs), np.uint8)
    full = docs_held // 8
    dense = size == full
    inside = np.repeat(dense, size)
    of_few = np.repeat(np.flatnonzero(~dense), size[~dense] // 2)
    few = flat[~inside].view("<u2").astype(np.int64)
    at, bit = np.nonzero(np.unpackbits(flat[inside].reshape(-1, full), axis=1)) if dense.any() else (np.zeros(0, np.int64),) * 2
    of, doc = np.r_[of_few, np.flatnonzero(dense)[at]], np.r_[few, bit]
    order = np.argsort(of, kind="stable")
    of, doc = of[order], doc[order]
    n = np.bincount(of, minlength=len(docs))
    rank = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    p_size = np.fromiter(map(len, planes), np.int64, len(planes))
    begin, row = np.cumsum(p_size) - p_size, (n + 7) // 8
    depth = np.where(row > 0, p_size // np.maximum(row, 1), 0)
    bits = np.frombuffer(b"".join(planes), np.uint8)
    links = np.ones(len(of), np.int64)
    for j in range(int(depth.max(initial=0))):
        on = np.flatnonzero(depth[of] > j)
        byte = bits[begin[of[on]] + j * row[of[on]] + rank[on] // 8]
        links[on] += ((byte >> (7 - rank[on] % 8)) & 1).astype(np.int64) << j
    return of, doc, links


def _binary(data: np.ndarray, size: np.ndarray) -> pa.Array:
    ends = np.r_[0, np.cumsum(size)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])


_aligners: dict[str, Aligner] = {}


def aligner_of(raw_a: bytes, raw_b: bytes) -> Aligner:
    """One aligner for each pair of models and Python worker."""
    key = hashlib.sha256(raw_a + raw_b).hexdigest()
    if key not in _aligners:
        _aligners[key] = Aligner(raw_a, raw_b)
    return _aligners[key]


def _read(path: str) -> bytes:
    import pyarrow.fs as pafs

    fs, at = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
    with fs.open_input_file(at) as f:
        return f.read()


def inverted(spark: SparkSession, docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of documents (container, idx, doc_id, counts) and of postings (container, a, b, n, docs, planes).

    A container belongs to one task, so a table written from this has both
    kinds of rows from the same run of the task.
    """
    raw = spark.sparkContext.broadcast((_read(path_a), _read(path_b)))  # two vocabulary files of fixed size
    ship(spark)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kinds = "container long, idx int, doc_id " + id_type + ", n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a int, b int, n long, docs binary, planes binary"
    names = ["container", "idx", "doc_id", *(f for f, _ in DOC_FIELDS), *(f for f, _ in POSTING_FIELDS)]

    def run(batches):
        from pyspark import TaskContext

        align = aligner_of(*raw.value)
        part = TaskContext.get().partitionId() << 32
        state = {"serial": 0, "docs": 0, "held": [], "size": 0}

        def close():
            """The postings of the container."""
            if state["held"]:
                key = np.concatenate([k for k, _ in state["held"]])
                links = np.concatenate([c for _, c in state["held"]])
                order = np.argsort(key, kind="stable")
                key, links = key[order], links[order]
                pair, n, bitmaps, planes = pack(key // DOCS, key % DOCS, links, DOCS)
                bit_ends, plane_ends = np.r_[0, np.cumsum(bitmaps[1])], np.r_[0, np.cumsum(planes[1])]
                for lo in range(0, len(pair), 50_000):
                    hi = min(lo + 50_000, len(pair))
                    k = hi - lo
                    cols = [pa.array(np.full(k, part | state["serial"])), pa.nulls(k, pa.int32()), pa.nulls(k, id_arrow[0]), *(pa.nulls(k, ty) for _, ty in DOC_FIELDS),
                            pa.array((pair[lo:hi] // align.width).astype(np.int32)), pa.array((pair[lo:hi] % align.width).astype(np.int32)), pa.array(n[lo:hi]),
                            _binary(bitmaps[0][bit_ends[lo] : bit_ends[hi]], bitmaps[1][lo:hi]), _binary(planes[0][plane_ends[lo] : plane_ends[hi]], planes[1][lo:hi])]
                    yield pa.RecordBatch.from_arrays(cols, names=names)
            state.update(serial=state["serial"] + 1, docs=0, held=[], size=0)

        id_arrow = [None]
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            id_arrow[0] = ids.type
            lo = 0
            while lo < batch.num_rows:
                some, chars = [], 0
                while lo + len(some) < batch.num_rows and chars < BATCH and state["docs"] + len(some) < DOCS:
                    some.append(texts[lo + len(some)].as_py() or "")
                    chars += len(some[-1])
                full = [i for i, t in enumerate(some) if t]
                (n_a, n_b, n_groups, n_links, sha), doc, pair = align.align([some[i] for i in full])
                k = len(some)
                spread = [np.zeros(k, np.int64) for _ in range(4)]
                for to, x in zip(spread, (n_a, n_b, n_groups, n_links)):
                    to[full] = x
                every = [""] * k
                for i, s in zip(full, sha):
                    every[i] = s
                number = state["docs"] + np.array(full, np.int64)
                key, links = np.unique(pair * DOCS + number[doc], return_counts=True)
                state["held"].append((key, links))
                state["size"] += len(key)
                cols = [pa.array(np.full(k, part | state["serial"])), pa.array(np.arange(state["docs"], state["docs"] + k, dtype=np.int32)), ids.slice(lo, k),
                        *map(pa.array, spread), pa.array(every, pa.string()), *(pa.nulls(k, ty) for _, ty in POSTING_FIELDS)]
                yield pa.RecordBatch.from_arrays(cols, names=names)
                state["docs"] += k
                lo += k
                if state["docs"] >= DOCS or state["size"] >= HELD:
                    yield from close()
        yield from close()

    return docs.select("doc_id", "text").mapInArrow(run, kinds)


def document_scores(postings: DataFrame) -> DataFrame:
    """(container, idx, n_best, count_sum) from postings with ``count`` and ``best``; a task holds one container's sums."""
    def run(batches):
        here, sums = None, None

        def out():
            at = np.flatnonzero(sums[1])
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), here)), pa.array(at.astype(np.int32)), pa.array(sums[0][at]), pa.array(sums[1][at])],
                                              names=["container", "idx", "n_best", "count_sum"])

        for batch in batches:
            ids = batch.column("container").to_numpy()
            cuts = np.r_[0, np.flatnonzero(ids[1:] != ids[:-1]) + 1, len(ids)] if len(ids) else np.zeros(1, int)
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if ids[lo] != here:
                    if here is not None:
                        yield out()
                    here, sums = int(ids[lo]), np.zeros((2, DOCS), np.int64)
                piece = batch.slice(lo, hi - lo)
                of, doc, links = unpack(piece.column("docs").to_pylist(), piece.column("planes").to_pylist(), DOCS)
                best = piece.column("best").to_numpy(zero_copy_only=False).astype(bool)
                np.add.at(sums[0], doc, links * best[of])
                np.add.at(sums[1], doc, links * piece.column("count").to_numpy()[of])
        if here is not None:
            yield out()

    dealt = postings.select("container", "docs", "planes", "count", "best").repartition("container").sortWithinPartitions("container")
    return dealt.mapInArrow(run, "container long, idx int, n_best long, count_sum long")


def pair_counts(postings: DataFrame) -> DataFrame:
    """(a, b, count, best): documents that hold the pair, and whether no pair of its a has more."""
    counts = postings.groupBy("a", "b").agg(F.sum("n").alias("count"))
    top = counts.groupBy("a").agg(F.max("count").alias("top"))
    return counts.join(top, "a").select("a", "b", "count", (F.col("count") == F.col("top")).alias("best"))


def align(spark: SparkSession, docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per document."""
    both = written(inverted(spark, docs, path_a, path_b), "postings")
    postings = both.where("a IS NOT NULL").select("container", "a", "b", "n", "docs", "planes")
    counts = written(pair_counts(postings), "pairs")
    scores = document_scores(postings.join(counts, ["a", "b"]))
    rows = both.where("idx IS NOT NULL").select("container", "idx", "doc_id", *(f for f, _ in DOC_FIELDS))
    zero = F.lit(0).cast("long")
    out = rows.join(scores, ["container", "idx"], "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
