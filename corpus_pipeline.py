"""The corpus pipeline: quality rules, exact dedup, near dedup, mixing, tokens.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the rows that the next stage works on.  All but the last return the
columns of ``documents``.

Defined results: a null text counts as empty, has no words, and goes with the
quality rules; a null doc_id, lang or source is a value like others; repeated
rows of one id and text count once from the exact dedup on, and as often as the
mix takes them after the mixing; empty tables give an empty result; other
columns are carried along under any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourglass.llm import bpe, exact_dedup, minhash, mixing, quality
from hourglass.llm._shared import load, written
from hourglass.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a certified cutoff reject go."""
    return quality.keep_good(docs, load(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_dedup.keep_one(spark, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (5 words, 0.8) stays."""
    return minhash.keep_one(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, repeated or left out so that the sources get their targets."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    return bpe.encode_documents(spark, docs, tokenizer_path(), keep=("doc_id", "source"))


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact), ("near_dedup", near), ("source_mixing", mix_sources), ("bpe", encode)]

#: SQL cannot express learned cutoffs, seeded choices and the tokenizer; tests/llm/test_pipeline.py compares each stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
