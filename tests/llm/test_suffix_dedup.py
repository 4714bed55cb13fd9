import random
from collections import Counter

import numpy as np
import pytest

from hourglass.llm import suffix_dedup as S


def brute(rows):
    seen = Counter()
    raws = [(t or "").encode() for _, t, *_ in rows]
    for raw in raws:
        seen.update(hash(raw[i : i + 400]) for i in range(len(raw) - 399))
    out = []
    for (i, *_), raw in zip(rows, raws):
        gone = np.zeros(len(raw) + 1, int)
        for s in range(len(raw) - 399):
            if seen[hash(raw[s : s + 400])] > 1:
                gone[s : s + 400] = 1
        spans = int((np.diff(np.r_[0, gone]) == 1).sum())
        out.append((str(i), len(raw), int(gone.sum()), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return sorted(out)


def got(spark, docs, **kw):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.remove_repeats(spark, docs, **kw).collect())


def test_suffix_array_and_common_prefixes():
    r = np.random.default_rng(1)
    for n in (1, 2, 50, 400):
        data = np.r_[r.integers(0, 3, n), 300].astype(np.int32)
        order = S.suffix_array(data, 1000)
        assert order.tolist() == sorted(range(n + 1), key=lambda i: data[i:].tolist())
        lcp = S.common_prefixes(data, order, n + 1)
        for a, b, x in zip(order, order[1:], lcp[1:]):
            k = 0
            while max(a, b) + k <= n and data[a + k] == data[b + k]:
                k += 1
            assert x == k


@pytest.mark.parametrize("block", [S.BLOCK, 6000, 700])
def test_pieces_cover_every_start_once(block):
    r = random.Random(2)
    texts = [bytes(r.choice(b"abc ") for _ in range(n)) for n in (5000, 10, 400, 399, 0, 401, 2000, 5000)]
    number, p = S.pieces_of(texts, block)
    for i, t in enumerate(texts):
        own = p[:, number == i]
        starts = [s for first, count in zip(own[3], own[4]) for s in range(first, first + count)]
        assert sorted(starts) == list(range(len(t) - 399))


@pytest.fixture()
def rows(odd_rows):
    r = random.Random(3)
    text = lambda n: "".join(r.choice("abcdefgh é") for _ in range(n))
    common, longer = text(330), text(900)
    rows = odd_rows[:8] + [(7, "x" * 3000), (8, "ab" * 700)]
    for i in range(60):
        a, b = r.randint(0, 300), r.randint(0, 300)
        body = text(a) + (longer[a : a + r.randint(300, 600)] if i % 2 else common) + text(b)
        rows.append((100 + i, body + (rows[-1][1] or "") * (i % 7 == 0)))
    return rows + [(300, longer), (301, longer), (301, longer), (302, text(399)), (303, text(400)), (304, longer[:400])]


@pytest.mark.parametrize("pieces", [8192, 3])
def test_removes_exactly_the_covered_bytes(spark, make_docs, rows, pieces):
    assert got(spark, make_docs(rows, extra=True), shard_bytes=20_000, shard_pieces=pieces) == brute(rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(spark, docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_empty(spark, make_docs):
    assert S.remove_repeats(spark, make_docs([])).count() == 0
