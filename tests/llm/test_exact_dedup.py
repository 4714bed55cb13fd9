import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.llm import exact_dedup as X


@pytest.mark.parametrize("n", [1, 2, 7, 100, 5000, 120_000])
def test_filter_has_no_false_negatives(n):
    r = np.random.default_rng(n)
    keys = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
    seed, segment, blob = X.build_filter(keys)
    assert X.may_contain(keys, seed, segment, blob).all()
    other = r.integers(0, 2**63, 50_000).astype(np.uint64)
    assert X.may_contain(other, seed, segment, blob).mean() < 0.01


def brute(rows):
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault("".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r"), []).append((i, text or ""))
    out = []
    for norm, members in groups.items():
        best = max(members, key=lambda m: (len(m[1]), m[0] is not None, -(m[0] or 0)))
        out += [(i, best[0], len(members), i == best[0], hashlib.sha256(norm.encode()).hexdigest()) for i, _ in members]
    return sorted(map(str, out))


def test_odd_rows(spark, make_docs, odd_rows):
    got = X.dedup(spark, make_docs(odd_rows, extra=True), shard_digests=2).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(odd_rows)
    assert X.dedup(spark, make_docs([])).count() == 0


def test_extreme_ids(spark, make_docs):
    rows = [(-(2**63), "same text"), (2**63 - 1, "same  text"), (0, "same text"), (-(2**63), "other"), (5, "other"), (2**63 - 1, "third"), (None, "third")]
    assert sorted(str(tuple(r)) for r in X.dedup(spark, make_docs(rows)).collect()) == brute(rows)
    assert {(r.doc_id, r.text) for r in X.keep_one(spark, make_docs(rows)).collect()} == {(2**63 - 1, "same  text"), (-(2**63), "other"), (2**63 - 1, "third")}


@pytest.mark.parametrize("old", ["true", "false", "doc_id % 3 = 0"])
def test_any_split_into_snapshot_and_batch_gives_the_same(spark, make_docs, old):
    rows = [(i, f"text {i % 37} " + " " * (i % 4)) for i in range(300)]
    docs = make_docs(rows)
    got = X.dedup(spark, docs, F.expr(old), shard_digests=10).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows)


def test_rows_of_one_digest_with_other_bytes_are_told_apart(spark, make_docs):
    docs = make_docs([(1, "a a"), (2, "aa"), (3, "b")])
    rows = X.digests(docs)
    clash = rows.where("doc_id = 1").select("digest")
    out = {r.doc_id: (r.keep_id, r.group_size) for r in X.assemble(docs, rows, X.buckets(rows), clash).collect()}
    assert out == {1: (1, 2), 2: (1, 2), 3: (3, 1)}


def test_keep_one_returns_the_documents_columns(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows, extra=True)
    out = X.keep_one(spark, docs)
    assert out.columns == docs.columns
    # (1, None) (2, '') (3, blank) (null, null): 3 has the most code points
    assert sorted((r.doc_id for r in out.collect()), key=str) == [10, 3, 5, 6, 7, 8]
