import gzip
import hashlib
import io
import random

import pytest

from hourglass.llm import warc as W


class File:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at : at + n]


def rec(i, payload, ref=None):
    return W.record(i, f"http://x/{i} y", payload, hashlib.sha1(payload).hexdigest(), ref)


@pytest.mark.parametrize("step", [1, 7, 100, 5000, 10**9])
def test_every_record_is_read_once_whatever_the_ranges(step):
    r = random.Random(step)
    inner = rec(900, b"inner") + rec(901, r.randbytes(300))  # whole archives as payloads are stored nearly as they are
    payloads = [b"", b"x", r.randbytes(2000), inner, W.MAGIC * 50, b"<html>" * 500, inner * 3, b"\r\n\r\n", r.randbytes(5000) + inner]
    data = b"".join(rec(i, p) for i, p in enumerate(payloads)) + rec(50, payloads[5], 5)
    f = File(data)
    got = [W.described(x) for s in range(0, len(data), step) for x in W.records_in(f, s, min(s + step, len(data)), len(data))]
    assert [(g[0], g[6]) for g in got] == [*enumerate(payloads), (50, None)]
    assert got[-1][:6] == (50, "http://x/50%20y", 3000, hashlib.sha1(payloads[5]).hexdigest(), "revisit", 5)


def test_archives_are_plain_gzip():
    text = gzip.GzipFile(fileobj=io.BytesIO(rec(1, b"hello") + rec(2, b"you"))).read()
    assert text.count(b"WARC/1.1\r\n") == 2 and b"\r\n\r\nhello\r\n\r\n" in text


def test_damage_is_reported():
    data = rec(1, b"hello" * 100)
    with pytest.raises(ValueError):
        W.records_in(File(b"\0" + data[:-20]), 0, len(data), len(data) - 19)


def expected(pages):
    out = []
    for i, _, html in pages:
        body = (html or "").encode()
        same = [p for p, _, h in pages if (h or "") == (html or "") and p is not None]
        revisit = len(body) >= 1000 and any(p is not None for p in same) and i != max(same) and len([1 for p in pages if p[2] == html]) > 1
        out.append((str(i), len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", str(max(same) if revisit else None)))
    return sorted(out)


def test_round_trip(spark):
    big = "<p>é</p>" * 300
    pages = [(i, f"http://h/{i}", big if i % 3 else f"page {i} " * 200) for i in range(200)] + [(500, None, None), (501, "u\r\nX: y", ""), (None, "n", big), (None, None, None), (502, "z", "a" * 999), (503, "z", "a" * 999), (7, "again", big)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, sha1 string").repartition(3)
    out = W.round_trip(spark, df, range_bytes=700).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in out) == expected(pages)
    assert {r.url for r in out if r.page_id == 501} == {"u%0D%0AX:%20y"}
    assert W.round_trip(spark, df.limit(0)).count() == 0


def test_payloads_come_back(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    from hourglass.llm._shared import scratch
    folder = scratch(spark, "test")
    back = W.read_archives(spark, W.write_archives(spark, pages, folder, file_bytes=20_000), folder, 1000)
    html = {r.page_id: r.html for r in pages.collect()}
    rows = back.collect()
    payload = {r.page_id: r.payload for r in rows}
    assert len(rows) == len(html)
    for r in rows:
        assert bytes(payload[r.refers_to if r.record_type == "revisit" else r.page_id]).decode() == (html[r.page_id] or "")


def test_a_damaged_member_inside_a_file_is_reported(spark, tmp_path):
    members = [rec(i, random.Random(i).randbytes(500)) for i in range(20)]
    broken = bytearray(members[9])
    broken[len(broken) // 2] ^= 255
    for name, data in (("whole", b"".join(members)), ("broken", b"".join([*members[:9], bytes(broken), *members[10:]]))):
        (tmp_path / name).write_bytes(data)
    manifest = spark.createDataFrame([(str(tmp_path / n), (tmp_path / n).stat().st_size, 20) for n in ("whole", "broken")], "path string, bytes long, records long")
    for step in (700, 10**6):
        assert W.read_archives(spark, manifest.where("path LIKE '%whole'"), str(tmp_path), step).count() == 20
        with pytest.raises(ValueError, match="of 20 read from .*broken"):
            W.read_archives(spark, manifest, str(tmp_path), step).count()
