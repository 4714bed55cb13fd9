"""Removal of repeated line chunks with content-defined boundaries, in DataFrame functions only.

A text's lines are hashed, and a rolling hash over the hashes of WINDOW lines
ends a chunk where it is 0 modulo AVERAGE.  Boundaries depend on nearby lines
alone, so a passage is cut in the same way wherever it stands (shift
resistance).  Chunks of MIN_LINES lines or more that occur again anywhere, in
the same or another document, are compared byte for byte; the first occurrence
(least doc_id, then place) stays and the others are removed.

Only hashes and places are shuffled to find repeats, counted with partial
aggregation, so a passage in a third of all documents is reduced before the
shuffle.  Texts move once, to meet the places of their own repeats.

A chunk is a repeat only if both its borders fall inside the repeated passage,
so most short passages stay.  ``dedup_passages`` has no borders: every
MIN_LINES consecutive lines, and every single line of more than LONG_WORDS
words, that occur again at a later place are marked there, and all marked lines
go.  So a passage of MIN_LINES lines or more goes as a whole, wherever it
stands and whatever is beside it; the first of all equal lines always stays.

Defined results: a null text stays null and has no lines; an empty text is one
empty line; a null doc_id comes last; rows with equal id and text share their
result, as one document; chunks of one hash but different bytes all stay; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import SPACES, written

#: Lines the rolling hash covers, mean lines of a chunk, least lines of a chunk that is removed.
WINDOW, AVERAGE, MIN_LINES = 3, 4, 2
#: A line of more words is a passage by itself.
LONG_WORDS = 50
#: Modulus and base of the rolling hash.
PRIME, BASE = 2147483647, 1000003


def line_hash(line: Column) -> Column:
    """The first 32 bits of the MD5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long") % PRIME


def chunked(docs: DataFrame, window: int, average: int) -> DataFrame:
    """doc_id, dkey (names the document), lines (null for a null text) and chunks (place, first line, lines)."""
    dkey = F.md5(F.concat_ws("|", F.coalesce(docs["doc_id"].cast("string"), F.lit("-")), F.coalesce(docs["text"], F.lit(""))).cast("binary"))
    rows = docs.select(docs["doc_id"].alias("doc_id"), dkey.alias("dkey"), F.split(docs["text"], "\n", -1).alias("lines"))
    rows = rows.withColumn("hashes", F.coalesce(F.transform("lines", line_hash), F.array().cast("array<long>")))

    def rolling(i: Column) -> Column:
        parts = [F.coalesce(F.get("hashes", i - j), F.lit(0)) * pow(BASE, j, PRIME) % PRIME for j in range(window)]
        return sum(parts[1:], parts[0]) % PRIME

    places = F.transform("hashes", lambda _, i: i)
    last = F.size("hashes") - 1
    ends = F.filter(places, lambda i: (i == last) | (rolling(i) % average == 0))
    rows = rows.withColumn("ends", ends).drop("hashes")
    return rows.withColumn("chunks", F.transform("ends", lambda e, k: F.struct(k.alias("place"), (F.coalesce(F.get("ends", k - 1), F.lit(-1)) + 1).alias("first"), (e - F.coalesce(F.get("ends", k - 1), F.lit(-1))).alias("n")))).drop("ends")


def chunk_text(first: Column, n: Column) -> Column:
    return F.array_join(F.slice("lines", first + 1, n), "\n")


def chunk_hash(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def dedup_lines(spark: SparkSession, docs: DataFrame, window: int = WINDOW, average: int = AVERAGE, min_lines: int = MIN_LINES) -> DataFrame:
    """doc_id, n_lines, n_chunks, n_removed_chunks, n_removed_lines, kept (text): one row per document."""
    rows = chunked(docs, window, average)
    each = rows.select("doc_id", "dkey", "lines", F.explode(F.filter("chunks", lambda c: c["n"] >= min_lines)).alias("c"))
    here = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("dkey"), F.col("c.place").alias("place"))
    found = each.select("dkey", chunk_hash(chunk_text(F.col("c.first"), F.col("c.n"))).alias("key"), here.alias("here"))
    found = written(found.distinct(), "chunks")
    again = found.groupBy("key").agg(F.count(F.lit(1)).alias("times"), F.min("here").alias("original")).where("times > 1")
    hits = found.join(again, "key").select("dkey", F.struct(F.col("here.place").alias("place"), "key", (F.col("here") != F.col("original")).alias("drop")).alias("hit"))
    # a document's repeats: no more than its chunks
    per_doc = hits.groupBy("dkey").agg(F.collect_list("hit").alias("hits"))
    met = written(rows.join(per_doc, "dkey", "left").withColumn("hits", F.coalesce("hits", F.filter(F.array(F.struct(F.lit(0).alias("place"), F.lit("").alias("key"), F.lit(False).alias("drop"))), lambda x: F.lit(False)))), "met")
    # the byte comparison: least and greatest text of each repeated hash
    own = met.select("lines", "chunks", F.explode("hits").alias("h"))
    at = F.get("chunks", F.col("h.place"))
    text = chunk_text(at["first"], at["n"]).cast("binary")
    clash = written(own.select(F.col("h.key").alias("key"), text.alias("t")).groupBy("key").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).where("lo <> hi").select("key"), "clash")
    gone = met.withColumn("gone", F.transform(F.filter("hits", lambda h: h["drop"]), lambda h: h["place"]))
    if not clash.isEmpty():
        safe = met.select("dkey", F.explode("hits").alias("h")).where("h.drop").withColumn("key", F.col("h.key")).join(clash, "key", "left_anti")
        gone = met.join(safe.groupBy("dkey").agg(F.collect_set("h.place").alias("gone")), "dkey", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    stay = F.filter("chunks", lambda c: ~F.array_contains("gone", c["place"]))
    lost = F.filter("chunks", lambda c: F.array_contains("gone", c["place"]))
    kept = F.array_join(F.flatten(F.transform(stay, lambda c: F.slice("lines", c["first"] + 1, c["n"]))), "\n")
    return gone.select("doc_id", F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"), F.size("chunks").cast("long").alias("n_chunks"), F.size(lost).cast("long").alias("n_removed_chunks"),
                       F.aggregate(lost, F.lit(0).cast("long"), lambda s, c: s + c["n"]).alias("n_removed_lines"), F.when(F.col("lines").isNotNull(), kept).alias("kept"))


def passage_hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def passages(lines: Column, min_lines: int, long_words: int) -> Column:
    """The places (first, n) of every ``min_lines`` consecutive lines, then of every single long line."""
    words = lambda i: F.size(F.split(F.trim(F.translate(F.get(lines, i), SPACES, " " * len(SPACES))), " +"))
    places = F.transform(lines, lambda _, i: i)
    runs = F.transform(F.filter(places, lambda i: i + min_lines <= F.size(lines)), lambda i: F.struct(i.alias("first"), F.lit(min_lines).alias("n")))
    return F.concat(runs, F.transform(F.filter(places, lambda i: words(i) > long_words), lambda i: F.struct(i.alias("first"), F.lit(1).alias("n"))))


def dedup_passages(spark: SparkSession, docs: DataFrame, min_lines: int = MIN_LINES, long_words: int = LONG_WORDS) -> DataFrame:
    """doc_id, n_lines, n_removed_lines, kept (text): one row per document."""
    dkey = F.unhex(F.md5(F.concat_ws("|", F.coalesce(docs["doc_id"].cast("string"), F.lit("-")), F.coalesce(docs["text"], F.lit(""))).cast("binary")))
    rows = docs.select("doc_id", dkey.alias("dkey"), "text")
    split = rows.select("doc_id", "dkey", F.split("text", "\n", -1).alias("lines"))
    each = split.select("doc_id", "dkey", "lines", F.explode(passages(F.col("lines"), min_lines, long_words)).alias("c"))
    found = written(each.select("doc_id", "dkey", "c.first", "c.n", passage_hash(chunk_text(F.col("c.first"), F.col("c.n"))).alias("key")), "passages")
    again = found.groupBy("key").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("key")
    hits = written(found.join(again, "key"), "hits")
    # equal rows of one document are one place
    here = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("dkey"), F.col("first"))
    marked = hits.join(hits.groupBy("key").agg(F.min(here).alias("original")), "key").select("dkey", F.struct("first", "n", (here != F.col("original")).alias("drop")).alias("hit"))
    # a document's repeats: no more than twice its lines
    per_doc = marked.groupBy("dkey").agg(F.collect_set("hit").alias("hits"))
    met = written(rows.join(per_doc, "dkey", "left"), "met").withColumn("lines", F.split("text", "\n", -1))
    # the byte comparison: least and greatest text of each repeated hash
    own = met.select("dkey", "lines", F.explode("hits").alias("h"))
    text = chunk_text(F.col("h.first"), F.col("h.n")).cast("binary")
    clash = written(own.select(passage_hash(text).alias("key"), text.alias("t")).groupBy("key").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).where("lo <> hi").select("key"), "clash")
    gone = met.withColumn("gone", F.coalesce(F.filter("hits", lambda h: h["drop"]), F.array().cast("array<struct<first:int,n:int,drop:boolean>>")))
    if not clash.isEmpty():
        safe = own.where("h.drop").withColumn("key", passage_hash(text)).join(clash, "key", "left_anti").groupBy("dkey").agg(F.collect_set("h").alias("safe"))
        gone = gone.drop("gone").join(safe, "dkey", "left").withColumn("gone", F.coalesce("safe", F.array().cast("array<struct<first:int,n:int,drop:boolean>>")))
    lost = F.flatten(F.transform("gone", lambda h: F.sequence(h["first"], h["first"] + h["n"] - 1)))
    stay = gone.withColumn("stay", F.array_except(F.transform("lines", lambda _, i: i), lost))
    n, left = (F.when(F.col("lines").isNull(), 0).otherwise(F.size(c)).cast("long") for c in ("lines", "stay"))
    return stay.select("doc_id", n.alias("n_lines"), (n - left).alias("n_removed_lines"), F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n").alias("kept"))
