import random
import re
from collections import Counter

import pytest

from hourglass.llm import divergence as dv

FIND = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, least=3, top=200):
    rows = [tuple(x or "" for x in r) for r in rows]  # text, lang, source
    out = []
    for lang in {r[1] for r in rows}:
        mine = [(FIND.findall(t.translate(LOWER)), s) for t, la, s in rows if la == lang]
        df = Counter(w for ws, _ in mine for w in set(ws))
        kept = sorted(w for w, n in df.items() if n >= least)
        counts = {s: Counter(w for ws, x in mine if x == s for w in ws if df[w] >= least) for s in {s for _, s in mine}}
        whole = sum(counts.values(), Counter())

        def p(c):
            n = sum(c.values())
            return {w: 1 + 1_000_000_000 * (c[w] + 1) // (n + len(kept)) for w in kept}

        ps, q = {s: p(c) for s, c in counts.items()}, p(whole)
        for s in counts:
            pairs = [(sum((ps[s][w] - ps[o][w]) ** 2 // ps[o][w] for w in kept), o) for o in counts if o != s]
            words = [((ps[s][w] - q[w]) ** 2 // q[w], w) for w in kept if counts[s][w] and ps[s][w] > q[w]]
            for part, items, limit in (("pair", pairs, None), ("term", words, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(items[:limit])]
    return sorted(out)


def rows_of(seed, n=400):
    r = random.Random(seed)
    words = ["alpha", "Beta", "gamma3x", "élan", "ÉLAN", "日本", "x", "\U0001f600z", "don't", "under_score", "K", "K"] + [f"w{'abcdefghij'[i % 10]}{'klmnop'[i // 10]}" for i in range(60)]
    rows = []
    for _ in range(n):
        lang, source = r.choice(["en", "en", "en", "de", None]), r.choice(["a", "a", "a", "b", "c", "é", None, "z1", "z2"])
        k = 1 + len(source or "")
        rows.append((" ".join(r.choice(words[:: k if r.random() < 0.7 else 1]) for _ in range(r.choice([0, 3, 30]))), lang, source))
    return rows + [(None, "en", "only"), ("", "xx", "s1"), (None, "xx", "s2"), ("lone words here", "yy", "s"), ("q " * 30_000, "en", "a"), ("q" * 100_000, "en", "b")]


def frame(make_docs, rows, extra=False):
    return make_docs([(i, t, la, s) for i, (t, la, s) in enumerate(rows)], extra=extra)


@pytest.mark.parametrize("broadcast, shard, tile, held", [(dv.BROADCAST_BYTES, dv.SHARD, dv.TILE, dv.HELD), (dv.BROADCAST_BYTES, 10, 2, 50), (0, 10, 3, 50)])
def test_equals_plain_counts(spark, make_docs, monkeypatch, broadcast, shard, tile, held):
    for name, value in (("SHARD", shard), ("TILE", tile), ("HELD", held), ("SOURCES", 3 if tile == 2 else dv.SOURCES)):
        monkeypatch.setattr(dv, name, value)
    monkeypatch.setattr(dv, "DENSE_BYTES", 1000 if held == 50 else dv.DENSE_BYTES)
    rows = rows_of(2)
    out = dv.audit(spark, frame(make_docs, rows, extra=True), top=20, broadcast_bytes=broadcast)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in out.collect()) == expected(rows, top=20)


def test_no_rows(spark, make_docs):
    assert dv.audit(spark, make_docs([])).count() == 0


def test_perfect_hash_is_minimal_and_verified():
    keys = [f"k{i}".encode() for i in range(5000)] + [b"\xc3\xa9", b"x" * 10_000]
    table = dv.PerfectHash(*dv.PerfectHash.build(keys))
    slots = table.slots(keys, dv.hashes(keys, 0))
    assert sorted(slots) == list(range(len(keys)))
    assert [table.stored()[s] for s in slots] == keys
    others = [f"q{i}".encode() for i in range(5000)]
    assert set(table.slots(others, dv.hashes(others, 0))) == {-1}


def test_scaled_is_exact():
    import numpy as np
    r = random.Random(1)
    n = [r.randrange(0, 9 * 10**13) for _ in range(1000)]
    total = [x + r.randrange(1, 10**14) for x in n]
    assert dv.scaled(np.array(n), np.array(total)).tolist() == [1 + 10**9 * (a + 1) // b for a, b in zip(n, total)]
