import random

import numpy as np
import pytest

from hourglass.llm import minhash as M


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k, pct):
    """(doc_id, set size, least id reachable) over all pairs."""
    sets = [shingles(t, k) for _, t, *_ in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) * 100 >= pct * max(len(sets[i]), len(sets[j])) and 100 * len(sets[i] & sets[j]) >= pct * len(sets[i] | sets[j]):
                top[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted((str(r[0]), len(sets[i]), str(least.get(find(i)))) for i, r in enumerate(rows))


def got(spark, docs, k, pct):
    out = M.near_dups(spark, docs, k, pct).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out)


def test_odd_rows(spark, make_docs, odd_rows):
    assert got(spark, make_docs(odd_rows, extra=True), 4, 80) == brute(odd_rows, 4, 80)
    assert M.near_dups(spark, make_docs([])).count() == 0


def near_copies(seed, groups, size, words, edits):
    r = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{r.randint(0, 500)}" for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(r.randint(0, edits)):
                text[r.randrange(words)] = f"x{r.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(text)))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("block, small", [(1500, 64), (7, 1), (1500, 1)])
def test_near_copies_around_the_threshold(spark, make_docs, monkeypatch, block, small):
    monkeypatch.setattr(M, "BLOCK", block)
    monkeypatch.setattr(M, "SMALL", small)
    rows = near_copies(1, 40, 12, 90, 8)
    want = brute(rows, 4, 80)
    assert 100 < len({w[2] for w in want}) < len(rows)
    assert got(spark, make_docs(rows), 4, 80) == want


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(spark, docs, 4, 80) == brute(rows, 4, 80)
    assert got(spark, docs, 5, 80) == brute(rows, 5, 80)


@pytest.mark.parametrize("listed", [M.LISTED, 0])
def test_keep_one(spark, make_docs, odd_rows, monkeypatch, listed):
    monkeypatch.setattr(M, "LISTED", listed)
    rows = near_copies(3, 5, 6, 200, 3) + [(1000, None), (1001, " "), (1001, " ")]
    docs = make_docs(rows, extra=True)
    out = M.keep_one(spark, docs, 4, 80)
    assert out.columns == docs.columns
    want = {int(w[2]) for w in brute(rows, 4, 80)}
    assert sorted(r.doc_id for r in out.collect()) == sorted(want)


def test_posterior_bound():
    for h, need in M.least_matches(0.8):
        s = np.linspace(0, 1, 200_001)
        for m, drop in ((need - 1, True), (need, False)):
            post = s**m * (1 - s) ** (h - m)
            assert (post[s >= 0.8].sum() / post.sum() < M.MISS) == drop


def test_components(spark):
    r = random.Random(9)
    edges = [(i, i + 1) for i in range(50)] + [(r.randint(100, 160), r.randint(100, 160)) for _ in range(40)]
    df = spark.createDataFrame([(a.to_bytes(2, "big"), b.to_bytes(2, "big")) for a, b in edges], "a binary, b binary")
    out = {int.from_bytes(x.cid, "big"): int.from_bytes(x.comp, "big") for x in M.components(df).collect()}
    top = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            top[a] = top[b] = min(top[a], top[b])
    assert out == {x: t for x, t in top.items() if any(x in e and e[0] != e[1] for e in edges)}
