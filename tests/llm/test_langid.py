import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.llm import langid as L
from hourglass.llm._shared import crc_mod


def test_features_are_of_the_whole_text(monkeypatch):
    text = "Une fois, 123 la NUIT était là. " * 300
    whole = L.features(text)
    assert abs((whole**2).sum() - 1) < 1e-9
    monkeypatch.setattr(L, "CHUNK", 100)
    assert np.allclose(L.features(text), whole)
    assert (L.features("a  b") == L.features("A, 7 b")).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = crc_mod(F.col("doc_id"), 4)
    out = L.identify(spark, docs, fold != 2).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").collect()
    right = np.mean([r.lang == r.lang_pred for r in out])
    assert len(out) > 150 and right >= 0.98
    assert all(0 <= r.score <= 1 for r in out)


def test_odd_rows(spark, make_docs, odd_rows):
    fixed = [(1000 + i, t, lang, "s") for i in range(12) for t, lang in (("the cat and the dog sat on it", "en"), ("der hund und die katze sitzen", "de"), ("kissa ja koira istuvat", "xx"))]
    docs = make_docs([*odd_rows, *fixed, (50, "... 123 !", "en", "s")], extra=True)
    out = L.identify(spark, docs, F.lit(True), per_lang=10).collect()
    assert len(out) == len(odd_rows) + len(fixed) + 1
    assert {r.doc_id for r in out if r.lang_pred == "und" and r.doc_id is not None} == {1, 2, 3, 50}
    assert {r.lang_pred for r in out} == {"en", "de", "xx", "und"}
    told = [(r.doc_id, r.lang_pred) for r in out if (r.doc_id or 0) >= 1000]
    assert sorted(x for _, x in told) == sorted(["en", "de", "xx"] * 12)
    assert all(r.lang_pred == "und" and r.score == 0 for r in L.identify(spark, docs, F.lit(False)).collect())
    assert L.identify(spark, make_docs([]), F.lit(True)).count() == 0


def test_sample_is_bounded(spark, make_docs):
    docs = make_docs([(i, f"text {i}", "en" if i % 10 else "de", "s") for i in range(2000)])
    rows = L.sample(docs, F.lit(True), per_lang=50).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in rows} == {"en": 50, "de": 50}


def test_votes():
    margin = {("lang", "a", "b"): 1.0, ("lang", "a", "c"): -0.5, ("lang", "b", "c"): 0.2}
    assert L.vote("lang", ["a", "b", "c"], None, margin)[0] == "a"
    assert L.vote("lang", ["a"], None, {}) == ("a", 1.0)
