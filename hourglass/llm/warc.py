"""Writing WARC archives and reading them back by byte ranges.

Writing: pages with equal payloads (SHA-1, MD5 and length) of at least
MIN_REVISIT bytes share one response record, that of the largest page_id; the
others become revisit records that name it.  Each record is a gzip member of
its own.  A task writes files with names of its own and returns their names;
only those in the returned manifest count, so a retried task does no harm.

Reading: files are cut into byte ranges without regard to records.  A task
looks for the gzip magic in its range, decodes the header of the member that
may start there, and follows the chain of members.  A candidate is taken only
if every member of its chain is a whole record up to the first one that starts
beyond the range (or the end of the file), so bytes inside a payload that look
like a member are passed over.  A record belongs to the range in which it
starts, however far it reaches.

Defined results: a null html is an empty payload; a null url writes no target;
a null page_id is never the largest, and comes back as null; rows with equal
page_id and payload are all response or all revisit; an empty table writes no
file and gives an empty result; a file of which more or fewer records are read
than its manifest counts (a damaged member breaks the chain of its range; a
null count is not compared), a range at the start of a damaged file, or a
record whose payload doesn't match its digest, raises ValueError; other columns
are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import scratch, ship, written

MIN_REVISIT = 1000
#: Bytes after which a task starts another file, and bytes of a range.
FILE_BYTES, RANGE_BYTES = 256 << 20, 4 << 20
CHUNK = 1 << 16
MAGIC = b"\x1f\x8b\x08"
NAME = "urn:hourglass:page:"


def open_store(uri: str):
    """(file system, path) of a folder or file that all executors share."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


# --- records --------------------------------------------------------------------

def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member; with ``refers_to``, a revisit without payload."""
    digest = "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{NAME}{'' if page_id is None else page_id}>", "WARC-Date: 2000-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{NAME}{refers_to}>"]
    head += [f"WARC-Payload-Digest: {digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def parse(raw: bytes) -> dict | None:
    """Headers (lower case) and block of a whole record; None if it isn't one."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    if not sep or not head.startswith(b"WARC/1."):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    size = fields.get("content-length", "")
    if not size.isdigit() or len(rest) != int(size) + 4 or rest[-4:] != b"\r\n\r\n":
        return None
    return fields | {"block": rest[:-4]}


def _page(field: str | None) -> int | None:
    tail = (field or "").strip("<>").removeprefix(NAME)
    return int(tail) if tail.lstrip("-").isdigit() else None


def described(rec: dict) -> tuple:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload."""
    http, _, payload = rec["block"].partition(b"\r\n\r\n")
    kind = rec.get("warc-type", "")
    digest = base64.b32decode(rec["warc-payload-digest"].removeprefix("sha1:")).hex()
    if kind == "revisit":
        size, payload = int(re.search(rb"(?i)\ncontent-length:\s*(\d+)", http)[1]), None
    else:
        size = len(payload)
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {rec.get('warc-record-id')} doesn't match its digest")
    return (_page(rec.get("warc-record-id")), rec.get("warc-target-uri"), size, digest, kind, _page(rec.get("warc-refers-to")), payload)


# --- byte ranges ------------------------------------------------------------------

def member(f, at: int, size: int) -> tuple[dict, int] | None:
    """The record of the gzip member at an offset and the offset after it; None if there is no whole record."""
    z, parts, pos = zlib.decompressobj(31), [], at
    try:
        while not z.eof:
            data = f.read_at(min(CHUNK, size - pos), pos) if pos < size else b""
            if not data:
                return None
            parts.append(z.decompress(data))
            if len(parts) == 1 and not parts[0].startswith(b"WARC/1."[: max(1, len(parts[0]))]):
                return None  # the header decides most candidates
            pos += len(data)
    except zlib.error:
        return None
    rec = parse(b"".join(parts))
    return None if rec is None else (rec, pos - len(z.unused_data))


def records_in(f, start: int, end: int, size: int) -> list[dict]:
    """The records that start in [start, end)."""
    data = f.read_at(min(end + len(MAGIC) - 1, size) - start, start)
    at = data.find(MAGIC)
    while at >= 0:
        found, pos = [], start + at
        while pos < min(end, size):
            got = member(f, pos, size)
            if got is None:
                break
            found.append(got[0])
            pos = got[1]
        # the chain holds if it reaches the file's end, or beyond the range with another record there
        if found and (pos == size or pos >= end and member(f, pos, size) is not None):
            return found
        at = data.find(MAGIC, at + 1)
    if start == 0 and size:
        raise ValueError("no whole record at the start of the file")
    return []


# --- jobs -------------------------------------------------------------------------

def write_archives(spark: SparkSession, pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the pages' records below ``folder``; returns the manifest (path, bytes, records), written as a table."""
    ship(spark)
    payload = F.coalesce(pages["html"], F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "md5": F.md5("payload"), "bytes": F.octet_length("payload").cast("long")})
    shared = rows.where(F.col("bytes") >= min_revisit).groupBy("sha1", "md5", "bytes").agg(F.count(F.lit(1)).alias("copies"), F.max("page_id").alias("ref")).where("copies > 1").drop("copies")
    # copies of one payload may be a third of all rows: the join's skewed partitions are split at run time
    typed = rows.join(shared, ["sha1", "md5", "bytes"], "left").withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("ref")), F.col("ref")))

    def run(batches):
        fs, path = open_store(folder)
        out, name, size, n = None, "", 0, 0
        done = []
        for batch in batches:
            for page_id, url, payload, sha1, ref in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha1", "refers_to"))):
                if out is None:
                    fs.create_dir(path, recursive=True)
                    name, size, n = f"{path}/pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(name, compression=None)
                data = record(page_id, url, payload, sha1, ref)
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= file_bytes:
                    out.close()
                    done.append((name, size, n))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size, n))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())], names=["path", "bytes", "records"])

    return written(typed.select("page_id", "url", "payload", "sha1", "refers_to").mapInArrow(run, "path string, bytes long, records long"), "manifest")


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str, range_bytes: int = RANGE_BYTES, with_payload: bool = True) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to and, if asked for, payload (null for revisits).

    The records are written as a table, so that those of each file are counted before any is returned.
    """
    ship(spark)
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * with_payload
    ranges = manifest.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start"))

    def run(batches):
        fs, _ = open_store(folder)
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                with fs.open_input_file(path) as f:
                    rows = [described(r)[: len(names)] for r in records_in(f, start, min(start + range_bytes, size), size)]
                for lo in range(0, len(rows), 500):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[lo : lo + 500]), types)], names=names).append_column("path", pa.array([path] * len(rows[lo : lo + 500]), pa.string()))

    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload + ", path string"
    read = written(ranges.repartition(tasks).mapInArrow(run, schema), "records")
    counts = manifest.join(read.groupBy("path").agg(F.count(F.lit(1)).alias("found")), "path", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    if wrong := counts.where("records <> found").orderBy("path").head(5):
        raise ValueError("records are damaged or missing: " + "; ".join(f"{r['found']} of {r['records']} read from {r['path']}" for r in wrong))
    return read.drop("path")


def round_trip(spark: SparkSession, pages: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write the archives to the shared folder and read them back."""
    folder = scratch(spark, "warc")
    return read_archives(spark, write_archives(spark, pages, folder), folder, range_bytes, with_payload=False)
