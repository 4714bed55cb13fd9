import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from hourglass.llm import lm as L


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def fold(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7


def test_packing():
    r = np.random.default_rng(1)
    keys = np.unique(r.integers(0, 2**64, 1000, np.uint64))
    assert (L.unpack_keys(L.pack_keys(keys)) == keys).all()
    for top in (1, 200, 60_000, 2**40):
        counts = r.integers(0, top, 500)
        assert (L.unpack_counts(L.pack_counts(counts)) == counts).all()


def model(rows, order, weights):
    """(n_tokens, n_known, N, base, score) per row, from plain counters; weights: learned, by bucket."""
    def grams(ts, k):
        full = ["<s>"] * (k - 1) + ts
        return [tuple(full[i : i + k]) for i in range(len(ts))]

    train = [tokens(t) for i, t, *_ in rows if fold(i) != 2]
    count = [Counter(g for ts in train for g in grams(ts, k)) for k in range(1, order + 1)]
    n, v = sum(count[0].values()), len(count[0])
    out, table = [], {}
    for i, text, *_ in rows:
        ts = tokens(text)
        of = [grams(ts, k) for k in range(1, order + 1)]
        base = score = known = 0
        for pos, w in enumerate(ts):
            c = count[0][w,]
            known += c > 0
            base += math.log10((c + 1) / (n + v + 1))
            est, bucket = [c / max(n, 1)], 0
            for k in range(2, order + 1):
                g = of[k - 1][pos]
                ctx = len(train) if pos == 0 else count[k - 2][of[k - 2][pos - 1]]
                est.append(count[k - 1][g] / ctx if ctx else 0)
                if ctx:
                    bucket = 64 * (k - 1) + int(math.log2(ctx))
            wt = table[bucket] if bucket in table else table.setdefault(bucket, L.weights_of(np.array([bucket]), weights, order)[0])
            score += math.log10(wt[0] / (v + 1) + sum(a * b for a, b in zip(wt[1:], est)))
        out.append((str(i), fold(i) == 2, len(ts), known, n, round(base, 6), round(score, 6)))
    return sorted(out)


@pytest.fixture()
def rows(odd_rows):
    r = random.Random(8)
    words = ["the", "a", "of", "Cat", "dog", "sat", "é", "mat", "on"]
    return odd_rows + [(i, " ".join(r.choice(words[: 3 + j % 7]) for j in range(r.randint(0, 60)))) for i in range(100, 300)]


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_plain_counters(spark, make_docs, rows, monkeypatch, order):
    learned = {}
    real = L.em
    monkeypatch.setattr(L, "em", lambda *a: learned.update(real(*a)) or learned)
    out = L.score(spark, make_docs(rows, extra=True), order, batch_bytes=2000, bucket_bytes=3000).collect()
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in out)
    want = model(rows, order, learned)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-7, atol=1e-5)


def test_em_finds_the_weights():
    r = np.random.default_rng(3)
    p = 2.0 ** (-np.array([[80, 8], [8, 80], [40, 16]]) / L.GRID)
    w = np.array([0.3, 0.7])
    mass = p @ w
    got = L.em([(0, *np.round(-np.log2(q) * L.GRID).astype(int), int(1e6 * m)) for q, m in zip(p, mass)], 1e-9, 2)[0]
    like = lambda x: sum(m * math.log(q @ x) for q, m in zip(p, mass))
    assert abs(got.sum() - 1) < 1e-9
    assert all(like(got[1:]) >= like(np.array([a, 1 - a])) - 1e-3 for a in r.random(50))


def test_held_out_texts_are_better_explained_than_by_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = [r for r in L.score(spark, docs).collect() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_no_documents_to_learn_from(spark, make_docs):
    held = next(i for i in range(100) if fold(i) == 2)
    (r,) = L.score(spark, make_docs([(held, "a b")])).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0) and math.isfinite(r.score)
    assert L.score(spark, make_docs([])).count() == 0
