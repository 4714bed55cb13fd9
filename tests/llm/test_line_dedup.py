import hashlib
import random

import pytest
from pyspark.sql import functions as F

from hourglass.llm import line_dedup as L


def cut(text, window=3, average=4):
    """Chunks (lists of lines) of a text, by a plain loop."""
    if text is None:
        return []
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) % L.PRIME for x in text.split("\n")]
    out, now = [], []
    for i, line in enumerate(text.split("\n")):
        now.append(line)
        roll = sum(h[i - j] * pow(L.BASE, j, L.PRIME) % L.PRIME for j in range(window) if i >= j) % L.PRIME
        if roll % average == 0 or i == len(h) - 1:
            out.append(now)
            now = []
    return out


def brute(rows):
    docs = sorted({(r[0] is None, r[0] or 0, hashlib.md5(f"{'-' if r[0] is None else r[0]}|{r[1] or ''}".encode()).hexdigest(), r[0], r[1]) for r in rows}, key=lambda d: d[:3])
    seen, result = set(), {}
    for *_, i, text in docs:
        gone = lines = 0
        kept = []
        chunks = cut(text)
        for c in chunks:
            key = "\n".join(c)
            if len(c) >= 2 and key in seen:
                gone, lines = gone + 1, lines + len(c)
            else:
                kept += c
            if len(c) >= 2:
                seen.add(key)
        result[i, text] = (str(i), sum(map(len, chunks)), len(chunks), gone, lines, None if text is None else "\n".join(kept))
    return sorted((result[r[0], r[1]] for r in rows), key=str)


def got(spark, docs):
    return sorted(((str(r.doc_id), *tuple(r)[1:]) for r in L.dedup_lines(spark, docs).collect()), key=str)


@pytest.fixture()
def rows(odd_rows):
    r = random.Random(5)
    line = lambda: " ".join(r.choice("abcdefgh") for _ in range(6))
    passage = [line() for _ in range(30)]
    rows = list(odd_rows)
    for i in range(60):
        a = r.randint(0, 20)
        rows.append((100 + i, "\n".join([line() for _ in range(r.randint(0, 9))] + passage[a : a + r.randint(2, 20)] + [line() for _ in range(r.randint(0, 9))])))
    return rows + [(300, "\n\n\n\n\n\n\n\n"), (301, "\n".join(passage)), (302, "\n".join(passage))]


def test_equals_the_plain_loop(spark, make_docs, rows):
    want = brute(rows)
    assert sum(w[3] for w in want) > 50
    assert got(spark, make_docs(rows, extra=True)) == want
    assert L.dedup_lines(spark, make_docs([])).count() == 0


def test_boundaries_resist_shifts():
    r = random.Random(6)
    passage = [str(r.random()) for _ in range(200)]
    a = {"\n".join(c) for c in cut("\n".join(passage))}
    b = {"\n".join(c) for c in cut("\n".join(["new"] * 7 + passage))}
    assert len(a & b) >= len(a) - 3


def test_no_python_in_the_plan(spark, make_docs, rows):
    plan = L.dedup_lines(spark, make_docs(rows))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_chunks_of_one_hash_but_other_bytes_stay(spark, make_docs, monkeypatch):
    monkeypatch.setattr(L, "chunk_hash", lambda text: F.substring(text, 1, 1))
    line = lambda i: f"x{i}"
    same = "\n".join(["y1", "y2", "y3"])
    docs = make_docs([(i, "\n".join(map(line, range(10 * i, 10 * i + 9)))) for i in range(4)] + [(8, same), (9, same)])
    out = {r.doc_id: r.n_removed_lines for r in L.dedup_lines(spark, docs).collect()}
    want = 9 - sum(len(c) for c in cut(same) if len(c) < 2) - 6
    assert out == {0: 0, 1: 0, 2: 0, 3: 0, 8: 0, 9: want}


def brute_passages(rows):
    docs = sorted({(r[0] is None, r[0] or 0, hashlib.md5(f"{'-' if r[0] is None else r[0]}|{r[1] or ''}".encode()).hexdigest(), r[0], r[1]) for r in rows}, key=lambda d: d[:3])
    seen, result = set(), {}
    for *_, i, text in docs:
        lines, gone = [] if text is None else text.split("\n"), set()
        for n in (2, 1):
            for a in range(len(lines) - n + 1):
                unit = tuple(lines[a : a + n])
                if n == 2 or len(unit[0].split()) > 50:
                    gone |= set(range(a, a + n)) if unit in seen else set()
                    seen.add(unit)
        result[i, text] = (str(i), len(lines), len(gone), None if text is None else "\n".join(x for a, x in enumerate(lines) if a not in gone))
    return sorted((result[r[0], r[1]] for r in rows), key=str)


def test_passages_equal_the_plain_loop(spark, make_docs, rows):
    long = " ".join(f"v{i}" for i in range(51))
    rows = rows + [(400, f"one\n{long}\ntwo"), (401, f"{long}\nthree"), (402, long[:-4]), (403, f"x\n{long[:-4]}"), (404, "a\na\na\na\na")]
    want = brute_passages(rows)
    got = sorted(((str(r.doc_id), *tuple(r)[1:]) for r in L.dedup_passages(spark, make_docs(rows, extra=True)).collect()), key=str)
    assert got == want
    assert {w[0]: w[2] for w in want if w[0] in ("400", "401", "403", "404")} == {"400": 0, "401": 1, "403": 0, "404": 4}
    assert L.dedup_passages(spark, make_docs([])).count() == 0


def test_no_repeated_passage_keeps_a_line(spark, make_docs):
    r = random.Random(7)
    line = lambda: str(r.random())
    passages = [[line() for _ in range(n)] for n in range(2, 22)]
    later = [[line() for _ in range(r.randint(0, 3))] + p + [line() for _ in range(r.randint(0, 3))] for p in passages]
    docs = make_docs([(0, "\n".join(x for p in passages for x in [*p, line()]))] + [(i + 1, "\n".join(x)) for i, x in enumerate(later)])
    out = {x.doc_id: x for x in L.dedup_passages(spark, docs).collect()}
    assert out[0].n_removed_lines == 0
    for i, (p, x) in enumerate(zip(passages, later)):
        assert out[i + 1].n_removed_lines == len(p) and out[i + 1].kept == "\n".join(y for y in x if y not in p)


def test_passages_of_one_hash_but_other_bytes_stay(spark, make_docs, monkeypatch):
    monkeypatch.setattr(L, "passage_hash", lambda text: F.substring(text, 1, 1))
    docs = make_docs([(1, "xa\nxb"), (2, "xc\nxd"), (3, "ya\nzb"), (4, "ya\nzb")])
    assert {x.doc_id: x.n_removed_lines for x in L.dedup_passages(spark, docs).collect()} == {1: 0, 2: 0, 3: 0, 4: 2}
