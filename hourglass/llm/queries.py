"""Registered queries of the operators, with DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, divergence, embedding_dedup, exact_dedup, langid, line_dedup, lm, minhash, mixing, quality, suffix_dedup, warc
from ._shared import crc_mod, load


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(spark, load(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(spark, load(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, load(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(spark, load(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(spark, load(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 4) != 2)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(spark, load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines", F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op7_line_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_passages(spark, load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed_lines", F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(spark, load(spark, sf_dir, "documents"))
    # what is left, as text: a cut inside a character leaves a replacement character
    left = F.expr("make_valid_utf8(cast(kept AS string))").alias("kept_text")
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), F.octet_length("kept").cast("long").alias("n_kept"), left)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dups(spark, load(spark, sf_dir, "documents"), k=4, pct=80)


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(spark, load(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(spark, load(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return alignment.align(spark, load(spark, sf_dir, "documents"), tokenizer_path(), public_tokenizers.path("piece_bpe_32k.model"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"

SQL_3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS payload_digest, md5(body) AS m FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, m, payload_bytes) AS ref FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND ref <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND ref <> page_id THEN ref END AS refers_to FROM g"""

SQL_4 = f"""
WITH n AS (SELECT doc_id, sha256({NORM}) AS text_sha256, length(coalesce(text, '')) AS chars FROM documents),
g AS (SELECT text_sha256, count(*) AS group_size, arg_min(doc_id, (-chars, doc_id)) AS keep_id FROM n GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)"""

SQL_7 = f"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
h AS (SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) % {line_dedup.PRIME} AS h FROM lines),
r AS (SELECT *, (h + coalesce(lag(h, 1) OVER w, 0) * {line_dedup.BASE} % {line_dedup.PRIME}
        + coalesce(lag(h, 2) OVER w, 0) * {pow(line_dedup.BASE, 2, line_dedup.PRIME)} % {line_dedup.PRIME}) % {line_dedup.PRIME} % {line_dedup.AVERAGE} = 0 AS cut
      FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM r),
t AS (SELECT doc_id, chunk, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS n FROM c GROUP BY ALL),
f AS (SELECT *, n >= {line_dedup.MIN_LINES} AND row_number() OVER (PARTITION BY body ORDER BY doc_id, chunk) > 1 AS gone FROM t)
SELECT d.doc_id, coalesce(sum(n), 0)::BIGINT AS n_lines, count(f.doc_id) AS n_chunks, count(*) FILTER (gone) AS n_removed_chunks,
       coalesce(sum(n) FILTER (gone), 0)::BIGINT AS n_removed_lines,
       sha256(coalesce(string_agg(body, chr(10) ORDER BY chunk) FILTER (NOT gone), '')) AS kept_sha256
FROM documents d LEFT JOIN f ON d.doc_id = f.doc_id GROUP BY d.doc_id"""

SQL_7_PASSAGES = rf"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
p AS (SELECT *, line || chr(10) || lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS pair,
             len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) > {line_dedup.LONG_WORDS} AS long FROM lines),
f AS (SELECT *, pair IS NOT NULL AND row_number() OVER (PARTITION BY pair ORDER BY doc_id, i) > 1 AS twin,
             long AND row_number() OVER (PARTITION BY line ORDER BY doc_id, i) > 1 AS alone FROM p),
g AS (SELECT *, twin OR alone OR coalesce(lag(twin) OVER (PARTITION BY doc_id ORDER BY i), false) AS gone FROM f)
SELECT d.doc_id, count(g.doc_id) AS n_lines, count(*) FILTER (gone) AS n_removed_lines,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id GROUP BY d.doc_id"""

SQL_11 = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x), n AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c ON c.x = vec_id LEFT JOIN n ON n.x = vec_id"""

SQL_12 = rf"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT i, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT i) >= {divergence.LEAST}),
gs AS (SELECT DISTINCT lang, source FROM d),
k AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
c AS (SELECT gs.lang, gs.source, kept.term, coalesce(k.n, 0) AS n FROM gs JOIN kept ON gs.lang = kept.lang LEFT JOIN k ON k.lang = gs.lang AND k.source = gs.source AND k.term = kept.term),
p AS (SELECT *, 1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER g + count(*) OVER g) AS p FROM c WINDOW g AS (PARTITION BY lang, source)),
a AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
q AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER g + count(*) OVER g) AS q FROM a WINDOW g AS (PARTITION BY lang)),
f AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
e AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(f.value, 0)::BIGINT AS value
      FROM gs x JOIN gs y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source
      UNION ALL SELECT p.lang, p.source, 'term', p.term, ((p - q) * (p - q) // q)::BIGINT FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM e)
SELECT lang, source, part, item, value, rank::INT AS rank FROM o WHERE part = 'pair' OR rank <= {divergence.TOP}"""

#: name: (query, SQL).  Where SQL is None, tests/llm compare with brute force: the tokenizer's merges (1), EM (2),
#: trained machines (5), certified cutoffs (6), all 400-byte strings (8), apportionment (9), components (10),
#: links of token occurrences (13).
QUERIES: dict = {
    "op1_bpe": (op1_bpe, None),
    "op2_lm_scoring": (op2_lm_scoring, None),
    "op3_warc": (op3_warc, SQL_3),
    "op4_exact_dedup": (op4_exact_dedup, SQL_4),
    "op5_language_id": (op5_language_id, None),
    "op6_quality_rules": (op6_quality_rules, None),
    "op7_line_dedup": (op7_line_dedup, SQL_7),
    "op7_line_passages": (op7_line_passages, SQL_7_PASSAGES),
    "op8_suffix_dedup": (op8_suffix_dedup, None),
    "op9_source_mixing": (op9_source_mixing, None),
    "op10_minhash_near_dedup": (op10_minhash_near_dedup, None),
    "op11_embedding_near_dedup": (op11_embedding_near_dedup, SQL_11),
    "op12_source_divergence": (op12_source_divergence, SQL_12),
    "op13_tokenizer_alignment": (op13_tokenizer_alignment, None),
    "pipeline": (pipeline, None),
}
