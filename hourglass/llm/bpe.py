"""BPE encoding by backtracking over longest token matches, decoding by an offset table.

Encoding never replays the merge list.  An Aho-Corasick automaton over the
vocabulary gives the longest token at a position; a token may follow its
left neighbour only if the pair-compatibility table says that the merges
would keep the border between the two.  If no token fits, the last one is
taken back and the position is marked as dead, so each position is left at
most once and the work is linear in the piece.  The result equals the merges'.

Decoding gathers each id's bytes from one blob by an offset table.

Defined results: a null text counts as empty (no ids, empty text); special
tokens in a text become their id; repeated rows are encoded each; an empty
table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ._shared import bounded_batches, released, ship

#: The published pre-tokenizer pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts beyond this many characters are cut where a piece starts in any case.
LONG_TEXT = 1 << 20
#: Entries of the per-process memo of pieces, and of the pair table; both start anew when full.
MEMO = 300_000
#: Bytes of ids that a task gathers for one output batch.
OUT_BYTES = 4 << 20


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in the vocabulary file: printable
    bytes for themselves, the others, in order, from code point 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Codec:
    """Encoder and decoder of one byte-level BPE vocabulary (JSON bytes)."""

    def __init__(self, raw: bytes):
        import ahocorasick
        import regex

        spec = json.loads(raw)
        model = spec["model"]
        alphabet = byte_alphabet()
        self.size = max([*model["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        names = [b""] * self.size
        for name, i in model["vocab"].items():
            names[i] = bytes(alphabet[c] for c in name)
        by_bytes = {b: i for i, b in enumerate(names) if b}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.special.items():
            names[i] = content.encode()
        # merge rank and the two halves of each merged token
        self.pair: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            left, right = model["vocab"][a], model["vocab"][b]
            self.pair[left, right] = rank
            self.halves.setdefault(model["vocab"][a + b], (left, right, rank))
        # what the merges can make: single bytes and merged tokens
        usable = {i for b, i in by_bytes.items() if len(b) == 1} | set(self.halves)
        self.length = [len(b) for b in names]
        self.shorter = [-1] * self.size
        auto = ahocorasick.Automaton()
        for i in usable:
            auto.add_word(names[i].decode("latin-1"), i)
        for i in usable:
            b = names[i]
            for n in range(len(b) - 1, 0, -1):
                if (p := by_bytes.get(b[:n])) in usable:
                    self.shorter[i] = p
                    break
        auto.make_automaton()
        self.longest = auto.iter_long
        self.whole = {names[i]: i for i in usable}
        self.fits: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, bytes] = {}
        self.find = regex.compile(PATTERN).findall
        self.cut = regex.compile(r"(?<=\p{L}) (?=\p{L})").search
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self.blob = np.frombuffer(b"".join(names), np.uint8)
        self.offset = np.r_[0, np.cumsum(self.length)].astype(np.int64)

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges keep the border between neighbours a and b.

        The merges that made a and b are undone from the latest to the
        earliest.  At each step the two parts that touch the border must not
        have a merge of their own that comes before the one just undone.
        """
        key = (a, b)
        known = self.fits.get(key)
        if known is not None:
            return known
        undone = len(self.pair)  # rank of the merge undone last
        right_was_last = True
        while True:
            rank = self.pair.get((a, b))
            # of equal ranks the left one merges first, so undoing the right side lets an equal rank through
            if rank is not None and (rank < undone or rank == undone and right_was_last):
                ok = False
                break
            x, y = self.halves.get(a), self.halves.get(b)
            if x is None and y is None:
                ok = True
                break
            if y is None or x is not None and x[2] > y[2]:
                undone, a, right_was_last = x[2], x[1], False
            else:
                undone, b, right_was_last = y[2], y[0], True
        if len(self.fits) >= MEMO:
            self.fits.clear()
        self.fits[key] = ok
        return ok

    def piece(self, b: bytes) -> list[int]:
        """Ids of one pre-token."""
        one = self.whole.get(b)
        if one is not None and one not in self.halves:
            return [one]
        s, n = b.decode("latin-1"), len(b)
        length, shorter, longest, compatible = self.length, self.shorter, self.longest, self.compatible
        dead = bytearray(n + 1)
        out: list[int] = []
        pos, token = 0, one if one is not None else next(longest(s))[1]
        while True:
            end = pos + length[token]
            if not dead[end] and (not out or compatible(out[-1], token)):
                out.append(token)
                if end == n:
                    return out
                pos, token = end, next(longest(s, end))[1]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                dead[pos] = 1
                token = out.pop()
                pos -= length[token]

    def missing(self, piece: str) -> bytes:
        ids = np.array(self.piece(piece.encode()), "<u4").tobytes()
        if len(piece) <= 64:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[piece] = ids
        return ids

    def plain(self, text: str) -> list[bytes]:
        out, memo, missing = [], self.memo.get, self.missing
        while text:
            part, text = text, ""
            if len(part) > LONG_TEXT and (m := self.cut(part, LONG_TEXT)):
                part, text = part[: m.start()], part[m.start():]
            out += [memo(p) or missing(p) for p in self.find(part)]
        return out

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        out: list[bytes] = []
        for part in self.split(text) if self.split else [text]:
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            elif part:
                out += self.plain(part)
        return b"".join(out)

    def decode_bytes(self, ids: bytes) -> bytes:
        every, out = np.frombuffer(ids, "<u4").astype(np.int64), []
        for i in range(0, len(every), LONG_TEXT):
            part = every[i : i + LONG_TEXT]
            start, size = self.offset[part], self.offset[part + 1] - self.offset[part]
            before = np.cumsum(size) - size
            out.append(self.blob[np.repeat(start - before, size) + np.arange(size.sum())].tobytes())
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec_of(raw: bytes) -> Codec:
    """One codec for each vocabulary and Python worker."""
    key = hashlib.sha256(raw).hexdigest()
    if key not in _codecs:
        _codecs[key] = Codec(raw)
    return _codecs[key]


def encode_documents(spark: SparkSession, docs: DataFrame, tokenizer_path: str, keep: tuple[str, ...] = ("doc_id",),
                     with_ids: bool = True) -> DataFrame:
    """Encode and decode every whole text.

    Returns the ``keep`` columns, n_tokens, ids_sha256, decoded_sha256 and,
    if ``with_ids``, ids (array of int).  The vocabulary file has a fixed size
    (1.6 MB) and goes to the tasks as one broadcast.
    """
    import pyarrow.fs as pafs
    fs, path = pafs.FileSystem.from_uri(tokenizer_path) if "://" in tokenizer_path else (pafs.LocalFileSystem(), tokenizer_path)
    with fs.open_input_file(path) as f:
        raw = spark.sparkContext.broadcast(f.read())
    ship(spark)
    bounded_batches(spark)
    fields = [docs.schema[c] for c in keep]
    src = docs.select(*keep, docs["text"].alias("_text"))
    schema = "".join(f"`{x.name}` {x.dataType.simpleString()}, " for x in fields) + "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches):
        codec = codec_of(raw.value)
        for batch in batches:
            rows: list[tuple] = []
            first = size = 0
            texts = batch.column(len(fields))
            for i in range(batch.num_rows):
                b = codec.encode(texts[i].as_py())
                rows.append((len(b) // 4, hashlib.sha256(b).hexdigest(), hashlib.sha256(codec.decode(b).encode()).hexdigest(), b if with_ids else b""))
                size += len(b)
                if size >= OUT_BYTES or i == batch.num_rows - 1:
                    n, sha, back, ids = zip(*rows)
                    cols = [batch.column(c).slice(first, len(rows)) for c in range(len(fields))] + [pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())]
                    if with_ids:
                        flat = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
                        cols.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), flat))
                    yield pa.RecordBatch.from_arrays(cols, names=[*keep, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids])
                    rows, first, size = [], i + 1, 0

    return src.mapInArrow(released(run), schema)
