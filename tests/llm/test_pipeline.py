"""``corpus_pipeline`` stage by stage against plain Python, each stage on all that its predecessor kept."""

import hashlib
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from hourglass.llm._shared import written
from hourglass.llm.mixing import targets
from hourglass.llm.queries import tokenizer_path

from test_minhash import brute as components_of
from test_quality import brute as counts_of


def corpus(odd_rows):
    """Junk with labels, exact and near copies, short and odd rows, three sources and a null one."""
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(3, 9)))
    rows = [(100 + i, " ".join(word() + ("%%%" if i % 7 == 0 else "") for _ in range(r.choice([40, 60, 90, 300]))), "en", r.choice(["a", "b", "c", None])) for i in range(700)]
    rows += [(2000 + i, t.replace(" ", "\n" if i % 2 else "  ", 3), la, s) for i, (_, t, la, s) in enumerate(rows[:60])]      # equal but for white space
    rows += [(3000 + i, t + " " + word(), la, s) for i, (_, t, la, s) in enumerate(rows[60:120])]                             # near copies
    rows += [rows[5], rows[5], (-(2**63), rows[8][1], "en", "a"), (None, rows[9][1], "en", "a"), (None, " ".join(word() for _ in range(70)), None, None)]
    return rows + [(r_[0], r_[1], *(r_[2:] or ("de", "b"))) for r_ in odd_rows]


def squeezed(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def key(row):
    return str(row.doc_id), row.text or ""


def test_stages_against_brute_force(spark, make_docs, odd_rows, tmp_path):
    rows = corpus(odd_rows)
    make_docs(rows, extra=True).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(i % 7 != 2), 0) for i in range(100, 800)]        # row i of the corpus is junk if i % 7 == 0, id 100 + i
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in P.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "source_mixing", "bpe"]
    kept = {}
    for name, stage in P.STAGES[:-1]:
        out = written(stage(spark, docs, str(tmp_path)), name)
        assert out.columns == docs.columns
        kept[name] = out.collect()
        docs = out

    # quality: what the base rules reject goes; of the rest only rows with symbols, which a certified cutoff may reject
    base = [x for x in spark.read.parquet(str(tmp_path / "documents.parquet")).collect()]
    n = {key(x): counts_of(x.text) for x in base}
    passes = lambda x: n[key(x)][0] >= 50 and 100 * n[key(x)][4] <= 50 * n[key(x)][0]
    good = Counter(key(x) for x in kept["quality_rules"])
    assert not good - Counter(key(x) for x in base if passes(x))
    gone = Counter(key(x) for x in base if passes(x)) - good
    assert gone and all(n[k][2] for k in gone) and not any(n[k][2] for k in good if k[0].isdigit() and 100 <= int(k[0]) < 800)

    # exact: of equal texts the longest row, then the least id; repeats of one row count once
    groups = {}
    for x in kept["quality_rules"]:
        groups.setdefault(squeezed(x.text), []).append(x)
    want = {key(max(g, key=lambda x: (len(x.text or ""), x.doc_id is not None, -(x.doc_id or 0)))) for g in groups.values()}
    assert Counter(key(x) for x in kept["exact_dedup"]) == Counter(want)

    # near: one of each component of 5-word shingles at 0.8
    before = [(x.doc_id, x.text) for x in kept["exact_dedup"]]
    least = {c for _, _, c in components_of(before, 5, 80)}
    assert sorted(str(x.doc_id) for x in kept["near_dedup"] if x.doc_id is not None) == sorted(c for c in least if c != "None")
    assert len(kept["near_dedup"]) < len(before)

    # mixing: whole documents, repeated; each source within its longest document of its target
    size = lambda x: len((x.text or "").split())
    per, longest = Counter(), Counter()
    for x in kept["near_dedup"]:
        per[x.source] += size(x)
        longest[x.source] = max(longest[x.source], size(x))
    order = sorted(s for s in per if s is not None) + [None] * (None in per)
    goal = dict(zip(order, targets(np.array([per[s] for s in order]), np.resize([5.0, 2, 1], len(order)))))
    mixed = Counter()
    for x in kept["source_mixing"]:
        mixed[x.source] += size(x)
    assert set(map(key, kept["source_mixing"])) <= set(map(key, kept["near_dedup"]))
    assert max(Counter(map(key, kept["source_mixing"])).values()) <= 2
    for s in order:
        assert abs(mixed[s] - goal[s]) <= longest[s] + 1024

    # tokens: the whole run gives the ids of the tokenizers library for each document of the mix
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    tok.no_padding()
    tok.no_truncation()
    ids = [tok.encode(x.text or "", add_special_tokens=False).ids for x in kept["source_mixing"]]
    want = Counter((str(x.doc_id), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest()) for x, i in zip(kept["source_mixing"], ids))
    got = P.run(spark, str(tmp_path)).collect()
    assert Counter((str(x.doc_id), x.ids_sha256) for x in got) == want


def test_empty_tables(spark, make_docs, tmp_path):
    make_docs([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_rows_without_text_or_labels(spark, make_docs, tmp_path):
    make_docs([(1, None), (None, None), (2, ""), (3, " ")]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(None, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0
    long = " ".join(f"w{i}" for i in range(80))
    make_docs([(1, long, None, None)], extra=True).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert {x.doc_id for x in P.run(spark, str(tmp_path)).select(F.col("doc_id")).collect()} <= {1}
