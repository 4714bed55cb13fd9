import math
import random
import re

import pytest

from hourglass.llm import quality as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def test_base_counts():
    r = random.Random(2)
    for _ in range(300):
        text = "".join(r.choice(["a", "b ", "c\n", "é ", "#", "\t", " a b c ", "\x1f", "\r\n", "|x "]) for _ in range(r.randint(0, 60)))
        assert Q.measure(text)[:5] == brute(text)
    assert Q.measure(None)[:5] == Q.measure("")[:5] == (0,) * 5


def test_bound_is_the_exact_binomial():
    for n, k, p, d in [(500, 0, 0.01, 0.05), (500, 1, 0.01, 0.05), (900, 2, 0.01, 0.05), (3000, 12, 0.01, 0.001), (20, 3, 0.5, 0.05)]:
        tail = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert Q.upper_bound_holds(k, n, p, d) == (tail <= d)
    assert not Q.upper_bound_holds(0, 0, 0.5, 0.5)


def test_cutoffs_keep_the_risk_and_catch_what_they_can():
    counts = [("en", 0, 5, 20_000, 0), ("en", 0, 80, 2, 900), ("de", 0, 5, 10, 0), ("de", 0, 80, 0, 50)]
    cut = Q.cutoffs(counts)
    assert cut == {("en", 0): 79}  # loosest of the best; the few German labels certify nothing


def test_judge(spark, make_docs, odd_rows):
    docs = make_docs([*odd_rows, (11, " ".join(f"w{i}" for i in range(60)))], extra=True)
    labels = spark.createDataFrame([(4, 1, 0), (6, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = Q.judge(docs, labels).collect()
    assert len(out) == len(odd_rows) + 1
    assert {r.doc_id for r in out if r.kept} == {11}
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [11]
    assert Q.keep_good(make_docs([]), labels.limit(0)).count() == 0


def test_bad_documents_go_and_good_ones_stay(spark, make_docs):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(3, 9)))
    rows = [(i, " ".join(word() + ("%%%" if i % 5 == 0 else "") for _ in range(60))) for i in range(6000)]
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(6000)], "doc_id long, quality int, toxic int")
    kept = {x.doc_id for x in Q.keep_good(make_docs(rows), labels).collect()}
    assert kept == {i for i in range(6000) if i % 5}


def test_a_stratum_of_few_labels_certifies_all_rules_as_one():
    need = Q.labels_needed(4)
    assert need == 217
    for n in (need - 1, need):
        counts = [c for s in "abcd" for c in [(s, 0, 0, n, 0, 900), (s, 0, 30, 0, 40, 90), (s, 5, 0, n, 0, 900), (s, 5, 9, 0, 40, 90)]]
        assert Q.cutoffs(counts) == ({(s, r): k for s in "abcd" for r, k in [(0, 29), (5, 8)]} if n == need else {})


def test_the_order_does_not_read_good_labels():
    r = random.Random(8)
    counts = [(s, q, cell, r.randint(0, 9), r.randint(0, 9), r.randint(0, 99)) for s in ("en", None) for q in range(7) for cell in range(0, 101, 7)]
    assert Q.orders(counts) == Q.orders([(*c[:3], 0, *c[4:]) for c in counts])


def test_good_documents_that_two_rules_reject_count_once(spark):
    held = [("en", 1, [0] * 7)] * 800 + [("en", 1, [9, 0, 9, 0, 0, 0, 0])] * 8 + [("en", 0, [9, 0, 9, 0, 0, 0, 0])] * 900
    docs = spark.createDataFrame([(i, s, 60, 0, c) for i, (s, _, c) in enumerate(held)], "doc_id long, lang string, n_words long, n_repeat_words long, _cells array<int>")
    labels = spark.createDataFrame([(i, q) for i, (_, q, _) in enumerate(held)], "doc_id long, quality int")
    sequence = [(0, 8), (2, 8)]
    rows = docs.withColumnRenamed("lang", "stratum").withColumn("step", Q.first_step({"en": sequence})).groupBy("step").count().collect()
    assert {r["step"]: r["count"] for r in rows} == {0: 908, 2: 800}
    # 16 rejections among 808 would not be certified at 2 %
    assert Q.learn(docs, labels) == {("en", 0): 8}
