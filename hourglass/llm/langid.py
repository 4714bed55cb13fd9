"""Language identification by hierarchical discrimination.

Texts become normalised counts of hashed byte trigrams (letters only).  One
set of linear support vector machines, one versus one, predicts the language
family; within the family, further one-versus-one machines separate the
closely related languages.  The machines are Spark's LinearSVC, trained on a
bounded sample: at most PER_LANG labelled texts of a language, those with the
least hash of id and text.

Defined results: a null text, or one without a letter, is ``und`` with score
0, as is every text if nothing was learned; rows without language are not
learned from; a language outside FAMILIES is a family of its own; a text
counts whole, however long; repeated rows get equal results; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ._shared import ship, written

#: Families of language codes.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indic": ("bn", "hi", "mr", "ne", "ur"),
}
FAMILY = {lang: f for f, langs in FAMILIES.items() for lang in langs}
DIM = 4096
#: Bound of the training sample.
PER_LANG = 1000
#: Languages whose counts are broadcast; more are joined.
LANGS = 10_000
CHUNK = 1 << 20
#: Bytes as the trigrams see them: letters and bytes of longer code points, everything else a blank.
_SEEN = np.array([b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint32)


def features(text: str) -> np.ndarray:
    """Square roots of the trigrams' shares."""
    data = _SEEN[np.frombuffer(text.lower().encode(), np.uint8)]
    data = np.r_[np.uint32(32), data[(data != 32) | np.r_[True, data[:-1] != 32]], np.uint32(32)]  # runs of blanks as one
    count = np.zeros(DIM)
    for lo in range(0, len(data) - 2, CHUNK):
        d = data[lo : lo + CHUNK + 2]
        code = ((d[:-2] * np.uint32(65599) + d[1:-1]) * np.uint32(65599) + d[2:]) * np.uint32(2654435761)
        count += np.bincount(code >> np.uint32(20), minlength=DIM)
    return np.sqrt(count / max(count.sum(), 1))


def sample(docs: DataFrame, learnable: Column, per_lang: int = PER_LANG) -> DataFrame:
    """(lang, text): at most ``per_lang`` rows of a language."""
    rows = docs.where(learnable & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    # one count per language; a share of the hash range, somewhat above what is needed, is all that leaves the scan
    counts = written(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("c")), "languages")
    counts = F.broadcast(counts) if counts.count() <= LANGS else counts
    few = rows.join(counts, "lang").where(F.pmod("h", F.lit(1 << 30)) < (1 << 30) * F.least(F.lit(1.0), 2.0 * per_lang / F.col("c") + 20.0 / F.col("c")))
    few = written(few.select("lang", "text", "h"), "drawn")  # about twice per_lang rows of a language
    best = W.partitionBy("lang").orderBy("h", "text")
    return few.withColumn("place", F.row_number().over(best)).where(F.col("place") <= per_lang).select("lang", "text")


def train(spark: SparkSession, rows: DataFrame) -> dict:
    """Weights of all machines: {"families": ..., "pairs": {(level, a, b): (weights, intercept)}}; positive means a."""
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.functions import array_to_vector

    def run(batches):
        for batch in batches:
            x = np.array([features(t) for t in batch.column(1).to_pylist()]).reshape(-1, DIM)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * DIM), pa.array(x.ravel()))], names=["lang", "x"])

    table = written(rows.mapInArrow(run, "lang string, x array<double>"), "features").withColumn("x", array_to_vector("x"))
    n = {r.lang: r.c for r in table.groupBy("lang").agg(F.count(F.lit(1)).alias("c")).collect()}
    family = {lang: FAMILY.get(lang, lang) for lang in n}
    groups = {f: sorted(x for x in n if family[x] == f) for f in set(family.values())}
    pairs = {}

    def fit(level: str, a: str, b: str, of: dict[str, str]) -> None:
        left, right = ([x for x in n if of[x] == side] for side in (a, b))
        weight = {True: 1 / sum(n[x] for x in left), False: 1 / sum(n[x] for x in right)}
        top = max(weight.values())
        both = table.where(F.col("lang").isin(left + right)).withColumn("label", F.col("lang").isin(left).cast("double"))
        both = both.withColumn("w", F.when(F.col("label") == 1, weight[True] / top).otherwise(weight[False] / top))
        m = LinearSVC(featuresCol="x", labelCol="label", weightCol="w", maxIter=40, regParam=1e-4, standardization=False).fit(both)
        pairs[level, a, b] = (m.coefficients.toArray(), m.intercept)

    for a, b in combinations(sorted(groups), 2):
        fit("family", a, b, family)
    for langs in groups.values():
        for a, b in combinations(langs, 2):
            fit("lang", a, b, {x: x for x in n})
    return {"groups": groups, "pairs": pairs}


def vote(level: str, names: list[str], pairs: dict, margin: dict) -> tuple[str, float]:
    """The winner of the pairs' votes (ties: the greater sum of margins, then the name) and its least certainty."""
    if len(names) == 1:
        return names[0], 1.0
    wins, total = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0)
    for a, b in combinations(names, 2):
        m = margin[level, a, b]
        wins[a if m >= 0 else b] += 1
        total[a] += m
        total[b] -= m
    best = min(names, key=lambda x: (-wins[x], -total[x], x))
    own = [margin[level, a, b] if a == best else -margin[level, a, b] for a, b in combinations(names, 2) if best in (a, b)]
    return best, float(1 / (1 + np.exp(-2 * min(own))))


def predict(spark: SparkSession, docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held columns, lang_pred, score; the model has one weight vector for each pair of families or languages."""
    groups, keys = model["groups"], list(model["pairs"])
    weights = np.array([model["pairs"][k][0] for k in keys], np.float32).reshape(len(keys), DIM)
    bias = np.array([model["pairs"][k][1] for k in keys])
    shared = spark.sparkContext.broadcast((weights, bias))
    held = [c for c in docs.columns if c != "_text"]

    def run(batches):
        import regex
        letter = regex.compile(r"\p{L}").search
        w, b = shared.value
        for batch in batches:
            langs, scores = [], []
            for text in batch.column("_text").to_pylist():
                if not groups or not text or not letter(text):
                    langs.append("und")
                    scores.append(0.0)
                    continue
                margin = dict(zip(keys, w @ features(text).astype(np.float32) + b))
                f, sure = vote("family", sorted(groups), keys, margin)
                lang, also = vote("lang", groups[f], keys, margin)
                langs.append(lang)
                scores.append(sure * also)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in held), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*held, "lang_pred", "score"])

    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in held)
    return docs.mapInArrow(run, schema + "lang_pred string, score double")


def identify(spark: SparkSession, docs: DataFrame, learnable: Column, per_lang: int = PER_LANG) -> DataFrame:
    """doc_id, held_out (not learnable), lang_pred, score: one row per document."""
    ship(spark)
    model = train(spark, sample(docs.select("doc_id", "text", "lang"), learnable, per_lang))
    return predict(spark, docs.select("doc_id", (~learnable).alias("held_out"), F.col("text").alias("_text")), model)
