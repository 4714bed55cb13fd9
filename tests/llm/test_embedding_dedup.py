import numpy as np
import pytest
from pyspark.sql import types as T

from hourglass.llm import embedding_dedup as ed

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def expected(rows, threshold=0.98):
    """All pairs, in double precision."""
    unit = []
    for _, v, label in rows:
        ok = v is not None and len(v) and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        u = np.array(v, np.float32).astype(float) if ok else None
        unit.append(u / np.abs(u).max() / np.linalg.norm(u / np.abs(u).max()) if ok else None)
    n = len(rows)
    near = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j])
             and unit[i] @ unit[j] >= threshold] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        comp = (min(ids) if ids else None) if len(seen) > 1 else rows[i][0]
        out.append((rows[i][0], len(near[i]), comp, rows[i][0] == comp))
    return out


def key(r):
    return tuple((x is None, x) if x is not None else (True, 0) for x in r)


def planted(seed, n=300, dim=32):
    """Groups of near copies around the threshold, exact copies, chains, several labels."""
    r = np.random.default_rng(seed)
    base = r.standard_normal((n, dim))
    rows = [(i, v.astype(np.float32).tolist(), int(i % 3)) for i, v in enumerate(base)]
    for k in range(n, 2 * n):
        src = int(r.integers(0, 40))
        c = r.uniform(0.95, 1.0)
        off = r.standard_normal(dim)
        b = base[src] / np.linalg.norm(base[src])
        off -= off @ b * b
        v = (c * b + np.sqrt(1 - c * c) * off / np.linalg.norm(off)) * r.uniform(0.1, 10)
        rows.append((k, v.astype(np.float32).tolist(), src % 3))
    rows += [(2 * n + i, rows[5][1], rows[5][2]) for i in range(60)]
    return rows


@pytest.mark.parametrize("block", [4096, 16])
def test_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(ed, "BLOCK", block)
    rows = planted(3)
    got = [tuple(r) for r in ed.near_vectors(spark, spark.createDataFrame(rows, SCHEMA)).collect()]
    want = expected(rows)
    links = sum(r[1] for r in want)
    assert sum(r[1] for r in got) >= 0.99 * links and links > 3000
    same = sum(a == b for a, b in zip(sorted(got), sorted(want)))
    assert same >= 0.99 * len(rows)
    assert all(g[1] <= w[1] for g, w in zip(sorted(got), sorted(want)))  # no link below the threshold


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (6, [None, 1.0], 0), (7, [1.0, 2.0], None), (8, [1.0, 2.0], None),
            (9, [1.0, 2.0], 0), (10, [2.0, 4.0], 0), (11, [1.0, 2.0], 1), (12, [1.0, 2.0, 0.0], 0), (9, [1.0, 2.0], 0), (None, [1.0, 2.0], 1), (None, [5.0, -2.0], 1),
            (13, [1e-30, 2e-30], 0), (14, [1e30, 2e30], 0), (15, [-1.0, -2.0], 0), (16, [3.0], 0), (17, [4.0], 0), (18, [-4.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("cid", "no", "lab", "links", "comp", "kept", "key", "w"):
        df = df.withColumn(c, df.vec_id.cast("string"))
    got = sorted((tuple(r) for r in ed.near_vectors(spark, df).collect()), key=key)
    assert got == sorted(expected(rows), key=key)


def test_no_rows_and_no_usable_rows(spark):
    assert ed.near_vectors(spark, spark.createDataFrame([], SCHEMA)).count() == 0
    assert [tuple(r) for r in ed.near_vectors(spark, spark.createDataFrame([(1, None, None)], SCHEMA)).collect()] == [(1, 0, 1, True)]


def test_codes_keep_the_chosen_miss_probability():
    r = np.random.default_rng(1)
    rows = r.standard_normal((2000, 64))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    for largest in (100, 100_000, 10_000_000):
        coder = ed.Coder(rows, 0.98, largest)
        off = r.standard_normal(rows.shape)
        off -= (off * rows).sum(axis=1, keepdims=True) * rows
        other = 0.98 * rows + np.sqrt(1 - 0.98**2) * off / np.linalg.norm(off, axis=1, keepdims=True)
        (a, ca), (b, cb) = coder.code(rows), coder.code(other)
        assert (a == b).any(axis=1).mean() > 0.99
        assert (np.bitwise_count(ca ^ cb).sum(axis=1) <= coder.radius).all()
        assert coder.tables < ed.TABLES and coder.bits >= np.log2(largest / ed.MATES)
        assert 0.4 < np.unpackbits(ca.view(np.uint8), axis=1).mean() < 0.6  # balanced


def test_roots():
    assert ed.roots(7, np.array([6, 5, 3, 1]), np.array([5, 3, 6, 0])).tolist() == [0, 0, 2, 3, 4, 3, 3]
    assert ed.roots(3, np.zeros(0, int), np.zeros(0, int)).tolist() == [0, 1, 2]
