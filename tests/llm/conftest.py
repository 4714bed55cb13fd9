import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Names that operators use inside; the extra columns must not disturb them.
CLASH = ("digest", "n", "key", "shard", "size", "kept", "cid", "comp", "n_words", "_cells", "_text", "_id", "_order", "_key", "taken", "quota", "_sha", "_own", "_check", "_copy", "row", "text_key")


@pytest.fixture()
def make_docs(spark):
    def make(rows, extra=False):
        """rows: (doc_id, text[, lang, source]); extra: add a column of each name in CLASH."""
        full = [(r[0], r[1], *(r[2:] or ("en", "a")), len(r[1] or "")) for r in rows]
        schema = T.StructType([*SCHEMA, *(T.StructField(c, T.StringType()) for c in CLASH)]) if extra else SCHEMA
        return spark.createDataFrame([f + ("x",) * len(CLASH) * extra for f in full], schema)
    return make


@pytest.fixture()
def odd_rows():
    """Nulls, blanks, repeats, ties, a very long text and white space of all kinds."""
    words = [f"w{i * 7919 % 997}" for i in range(60_000)]
    return [(1, None), (2, ""), (3, " \t\n"), (4, "a b c d e"), (4, "a b c d e"), (5, "a b  c d\te"), (None, "a b c d e"), (None, None), (6, " ".join(words)),
            (7, "x" * 200_000), (8, "é b c \U0001f600 <|endoftext|>"), (9, "a b c d e", None, None), (10, "\n".join(["same line here"] * 5))]
