"""Quality rules with risk-controlled thresholds.

Every text gets fixed base counts and a few shares (symbols, capitals,
repeats ...).  For each stratum (language) the rules form one sequence of
nested rejections: each step tightens the cutoff of one rule, and a document is
rejected at a step if any rule rejects it there.  The order comes from the
texts without a label and the bad ones alone (see ``orders``), so it is fixed
before any good label is looked at.  A labelled holdout decides how far the
sequence goes: at each step the number of good documents that all rules
together would reject is turned into an exact (Clopper-Pearson) upper bound of
the false-rejection rate.  Testing stops at the first step whose bound exceeds
ALPHA (fixed-sequence testing, so steps and rules need no correction); the
confidence is divided by the number of strata (Bonferroni).  Among the
certified steps, the one that rejects the most bad documents is taken, if it
rejects any, each rejected good one counting as ``GOOD_COST`` bad ones.  A
stratum with too few good labels (``labels_needed``) certifies nothing and
rejects nothing.

So with probability 1 - DELTA, in every stratum, all rules together reject at
most ALPHA of the good documents.

Defined results: a null text has no words and fails the base rules; a null
language is a stratum of its own; labels that are null are not used; a
document labelled twice counts twice; empty tables give empty results;
other columns are passed through by ``keep_good`` and not read otherwise.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import SPACES, bounded_batches, released, ship, written

#: Allowed false rejections of good documents per stratum, over all rules.
ALPHA = 0.02
#: Probability that any of the bounds fails to hold.
DELTA = 0.05
#: Rejected bad documents that make up for a rejected good one.
GOOD_COST = 20
#: Cutoffs a rule can have: a document is rejected if its share is above k / GRID.
GRID = 100
RULES = ("symbol_share", "capital_share", "repeat_share", "dup_line_share", "short_word_share", "digit_share", "bang_share")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MIN_WORDS, MAX_REPEAT_PCT = 50, 50


def _table(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars.encode())] = True
    return t


SYMBOLS, BLANK = _table("#*$%&|<>"), _table(SPACES)
CAPITALS, LETTERS, DIGITS = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"), _table("0123456789")


def repeat_words(words: list) -> int:
    """Words that lie in a 3-word window that occurs twice or more."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict = {}
    number = np.fromiter((seen.setdefault(w, len(seen)) for w in windows), np.int64, len(windows))
    again = np.bincount(number)[number] > 1
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : i + len(again)] |= again
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The base counts, then lines, capitals, letters, short words, digits and exclamation marks."""
    if not text:
        return (0,) * 11
    raw = text.encode()
    words = raw.split()  # bytes split at exactly the white space of SPACES
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    n_chars = len(text) - int(hist[BLANK].sum())
    return (len(words), n_chars, int(hist[SYMBOLS].sum()), len(lines) - len(set(lines)), repeat_words(words), len(lines),
            int(hist[CAPITALS].sum()), int(hist[LETTERS].sum()), sum(len(w) < 3 for w in words), int(hist[DIGITS].sum()), int(hist[33]))


def shares(m: np.ndarray) -> np.ndarray:
    """The rules' shares, one column each, from the rows of ``measure``."""
    m = m.astype(np.float64)
    words, chars, lines = np.maximum(m[:, 0], 1), np.maximum(m[:, 1], 1), np.maximum(m[:, 5], 1)
    return np.stack([np.minimum(m[:, 2] / words, 1.0), m[:, 6] / np.maximum(m[:, 7], 1), m[:, 4] / words, m[:, 3] / lines,
                     m[:, 8] / words, m[:, 9] / chars, np.minimum(m[:, 10] / words, 1.0)], axis=1)


def base_failed(n_words, n_repeat):
    return (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PCT * n_words)


def measured(src: DataFrame) -> DataFrame:
    """The columns of ``src``, the base counts, and per rule the grid cell of its share (``_cells``).

    The texts are the column ``_text``, which is dropped, or the field text of a column ``row``.
    """
    ship(src.sparkSession)
    bounded_batches(src.sparkSession)
    cols = [c for c in src.columns if c != "_text"]
    schema = T.StructType([*(src.schema[c] for c in cols), *(T.StructField(c, T.LongType()) for c in BASE), T.StructField("_cells", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for batch in batches:
            texts = batch.column("_text") if "_text" in batch.schema.names else pc.struct_field(batch.column("row"), "text")
            m = np.array([measure(t) for t in texts.to_pylist()], np.int64).reshape(-1, 11)
            # cell c: the share is in ((c - 1) / GRID, c / GRID], so cutoff k rejects the cells above k
            cells = np.ceil(np.round(shares(m) * GRID, 9)).astype(np.int32)
            out = [batch.column(c) for c in cols] + [pa.array(m[:, i]) for i in range(5)]
            out.append(pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * len(RULES)), pa.array(cells.ravel())))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return src.mapInArrow(released(run), schema)


def _log_tail(k: int, n: int, p: float) -> float:
    """log P(Binomial(n, p) <= k) for k below the mean, where the terms shrink as k falls."""
    top = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    total = term = 1.0
    for i in range(k, 0, -1):
        term *= i * (1 - p) / ((n - i + 1) * p)
        total += term
        if term < 1e-17 * total:
            break
    return top + math.log(total)


def upper_bound_holds(k: int, n: int, alpha: float, delta: float) -> bool:
    """Whether the exact 1 - delta upper bound of k rejections among n is at most alpha."""
    if n <= 0 or k >= n * alpha:
        return False
    return _log_tail(k, n, alpha) <= math.log(delta)


def labels_needed(n_strata: int, alpha: float = ALPHA, delta: float = DELTA) -> int:
    """Good labels from which a stratum can certify a step that rejects none of them."""
    return math.ceil(math.log(delta / max(1, n_strata)) / math.log1p(-alpha))


def orders(counts: list[tuple]) -> dict[str | None, list[tuple[int, int]]]:
    """The sequence of each stratum, as (rule, cutoff) steps, from counts (stratum, rule, cell, good, bad, unlabelled).

    Good counts are not read.  The next step is the cutoff that rejects the most further bad documents for each
    unlabelled one (one is added, for ratios of small counts); ties go to the earlier rule, then the looser cutoff.
    A cutoff that rejects no further bad document is no step.
    """
    out = {}
    for s in {c[0] for c in counts}:
        caught = np.zeros((2, len(RULES), GRID + 2), np.int64)
        for _, r, cell, _, bad, *rest in (c for c in counts if c[0] == s):
            caught[:, r, min(cell, GRID + 1)] += bad, rest[0] if rest else 0
        caught = caught[:, :, ::-1].cumsum(2)[:, :, ::-1]  # at cell k and above
        at, out[s] = [GRID + 1] * len(RULES), []
        while True:
            best = None
            for r, now in enumerate(at):
                for k in range(now - 1, -1, -1):
                    more, cost = (caught[:, r, k + 1] - (caught[:, r, now + 1] if now <= GRID else 0)).tolist()
                    if more and (best is None or more * (best[1] + 1) > best[0] * (cost + 1)):
                        best = more, cost, r, k
            if best is None:
                break
            at[best[2]] = best[3]
            out[s].append(best[2:])
    return out


def cutoffs(counts: list[tuple], alpha: float = ALPHA, delta: float = DELTA, union=None) -> dict[tuple[str | None, int], int]:
    """Cutoff by (stratum, rule) from counts (stratum, rule, cell, good, bad, unlabelled; the last may be left out).

    ``union(sequences)`` gives counts (stratum, step, good, bad) of the labelled documents by the first step that
    rejects them, the length of the sequence for none.  Without it a document counts once for each rule that
    rejects it, which is never too few.
    """
    sequences = orders(counts)
    tests = max(1, len(sequences))
    steps = union(sequences) if union else [(s, next((i for i, (q, k) in enumerate(sequences[s]) if q == r and cell > k), len(sequences[s])), g, b) for s, r, cell, g, b, *_ in counts]
    out = {}
    for s, sequence in sequences.items():
        n = max((sum(c[3] for c in counts if c[0] == s and c[1] == r) for r in range(len(RULES))), default=0)
        good, bad = np.zeros(len(sequence) + 1, np.int64), np.zeros(len(sequence) + 1, np.int64)
        for _, i, g, b in (x for x in steps if x[0] == s):
            good[i] += g
            bad[i] += b
        lost, caught, taken, gain = good.cumsum(), bad.cumsum(), 0, 0
        for i in range(len(sequence)):
            if not upper_bound_holds(int(lost[i]), n, alpha, delta / tests):
                break
            if (g := int(caught[i]) - GOOD_COST * int(lost[i])) > gain:
                taken, gain = i + 1, g
        out |= {(s, r): k for r, k in sequence[:taken]}  # later steps of a rule are tighter
    return out


def first_step(sequences: dict[str | None, list[tuple[int, int]]]):
    """Column: the first step of its stratum's sequence that rejects a document, the length of the sequence for none."""
    out = F.lit(0)
    for s, sequence in sorted(sequences.items(), key=str):
        hits = [F.when(F.col("_cells")[r] > k, i) for i, (r, k) in enumerate(sequence)]
        out = F.when(F.col("stratum").eqNullSafe(F.lit(s)), F.coalesce(*hits, F.lit(len(sequence)))).otherwise(out)
    return out


def learn(measured_docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> dict[tuple[str | None, int], int]:
    """Cutoffs from the labelled documents; only counts by stratum, rule and grid cell, and by stratum and step, reach
    the driver (languages x 7 x 102 rows at most each).  Documents that fail the base rules don't take part."""
    lab = labels.where("quality IS NOT NULL").select(F.col("doc_id").alias("_id"), "quality")
    held = measured_docs.where(~base_failed(F.col("n_words"), F.col("n_repeat_words"))).select("doc_id", F.col("lang").alias("stratum"), "_cells")
    held = written(held.join(lab, held["doc_id"] == lab["_id"], "left").select("stratum", "quality", "_cells"), "cells")
    good, bad = F.count(F.when(F.col("quality") == 1, 1)).alias("good"), F.count(F.when(F.col("quality") != 1, 1)).alias("bad")
    cells = held.select("stratum", "quality", F.posexplode("_cells").alias("rule", "cell"))
    rows = cells.groupBy("stratum", "rule", "cell").agg(good, bad, F.count(F.when(F.col("quality").isNull(), 1)).alias("unlabelled")).collect()
    labelled = {r["stratum"] for r in rows if r["good"] or r["bad"]}

    def union(sequences):
        return [tuple(r) for r in held.where("quality IS NOT NULL").groupBy("stratum", first_step(sequences).alias("step")).agg(good, bad).collect()]

    return cutoffs([tuple(r) for r in rows if r["stratum"] in labelled], alpha, delta, union)


def passes(cut: dict[tuple[str | None, int], int]):
    """Column: no rule of the document's stratum rejects it."""
    ok = F.lit(True)
    for (stratum, rule), k in sorted(cut.items(), key=str):
        ok = ok & ~(F.col("lang").eqNullSafe(F.lit(stratum)) & (F.col("_cells")[rule] > k))
    return ok


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """doc_id, lang, the base counts, base_failed and kept: one row per document."""
    m = measured(docs.select("doc_id", "lang", F.col("text").alias("_text")))
    cut = learn(m, labels, alpha, delta)
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return m.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & passes(cut)).drop("_cells")


def keep_good(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The documents that are kept, with their own columns."""
    cut = learn(measured(docs.select("doc_id", "lang", F.col("text").alias("_text"))), labels, alpha, delta)
    whole = measured(docs.select(F.struct(*docs.columns).alias("row"), "lang"))
    return whole.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")) & passes(cut)).select("row.*")
