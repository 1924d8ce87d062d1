import hashlib
import io
import random
import struct
import zipfile

import pytest

from jobfacts.llm import warczip
from jobfacts.llm.common import fresh_path
from tests.llm.helpers import clashing, duck, rows_of, sorted_rows

PAGE = "page_id long, url string, html string"
BIG = "<p>" + "long payload é " * 100


def sample():
    rng = random.Random(1)
    bodies = [BIG + str(i) for i in range(6)] + ["short", "", "x" * 999, "x" * 1000]
    rows = [(i, f"https://e.example/{i}?q=ü: {i}", rng.choice(bodies)) for i in range(80)]
    return rows + [(100, None, None), (101, "http://a/b\r\nc", BIG), (102, "http://a", BIG)]


def test_round_trip_of_payloads(spark):
    data = sample()
    folder = fresh_path(spark, "warc-test")
    archives = warczip.write_archives(warczip.with_revisits(clashing(spark.createDataFrame(data, PAGE)).repartition(3)), folder, archive_bytes=2000)
    assert archives.count() > 3
    got = {r.page_id: r for r in warczip.read_archives(archives, folder).collect()}
    payloads = {i: (h or "").encode() for i, _, h in data}
    for i, url, _ in data:
        r = got[i]
        assert r.url == (url and url.replace("\r", "%0D").replace("\n", "%0A"))
        assert (r.payload_bytes, r.payload_digest) == (len(payloads[i]), hashlib.sha1(payloads[i]).hexdigest())
        best = max(j for j, p in payloads.items() if p == payloads[i])
        assert (r.record_type, r.refers_to) == (("revisit", best) if len(payloads[i]) >= 1000 and best != i else ("response", None))
        assert r.payload == (payloads[i] if r.record_type == "response" else None)


def test_sql_agrees(spark):
    sql = duck({"pages": sample()}, {"pages": "page_id BIGINT, url VARCHAR, html VARCHAR"}, warczip.oracle_sql())
    assert sorted_rows(rows_of(warczip.warc_query(spark, spark.createDataFrame(sample(), PAGE)))) == sorted_rows(sql)


def test_ties_null_ids_and_empty_table(spark):
    data = [(5, "u", BIG), (5, "u", BIG), (4, "v", BIG), (None, "w", BIG), (None, "w", BIG + "alone")]
    got = warczip.warc_query(spark, spark.createDataFrame(data, PAGE)).collect()
    assert sorted((repr(r.page_id), r.record_type, repr(r.refers_to)) for r in got) == [
        ("4", "revisit", "5"), ("5", "response", "None"), ("5", "response", "None"), ("None", "response", "None"), ("None", "revisit", "5")]
    assert warczip.warc_query(spark, spark.createDataFrame([], PAGE)).collect() == []


def archive_of(data: bytes) -> warczip.Archive:
    return warczip.Archive(lambda at, n: data[at:at + n], len(data))


def test_reads_what_the_library_writes():
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w") as z:
        z.writestr("a.txt", "alpha", zipfile.ZIP_STORED)
        z.writestr("b/ü.txt", "beta" * 50, zipfile.ZIP_DEFLATED)
        z.comment = b"a comment PK"
    archive = archive_of(sink.getvalue())
    at, n = archive.place("a.txt")
    assert sink.getvalue()[at:at + n] == b"alpha"
    with pytest.raises(ValueError):
        archive.place("b/ü.txt")
    with pytest.raises(ValueError):
        archive_of(b"no zip at all")


def test_zip64_directory():
    """The end record and an entry refer to their 64-bit values."""
    name, body = b"m", b"stored bytes"
    local = struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, 0) + name + body
    extra = struct.pack("<HHQQQ", 1, 24, len(body), len(body), 7)
    entry = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    start = 7 + len(local)
    wide = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(entry), start)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, start + len(entry), 1)
    end = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    data = b"padding" + local + entry + wide + locator + end
    at, n = archive_of(data).place("m")
    assert data[at:at + n] == body


def test_urls_that_look_like_the_index(spark):
    urls = [f"http://a/ {warczip.DATE} x", f'"}} {warczip.DATE} {{"offset": 5', "a\u2028b\u0085c", "", "\\\"", None]
    data = [(i, u, f"<p>{i}") for i, u in enumerate(urls)] + [(100, "http://long/" + "u" * 100000, "x" * 3_000_000)]
    folder = fresh_path(spark, "warc-urls")
    archives = warczip.write_archives(warczip.with_revisits(spark.createDataFrame(data, PAGE).repartition(2)), folder)
    got = {r.page_id: (r.url, bytes(r.payload).decode()) for r in warczip.read_archives(archives, folder).collect()}
    assert got == {i: (u, h) for i, u, h in data}


def test_one_archive_a_task(spark):
    from collections import Counter

    from pyspark.sql import functions as F
    data = [(i, "u", "y" * 1500 + str(i)) for i in range(60)]
    folder = fresh_path(spark, "warc-tasks")
    archives = warczip.write_archives(warczip.with_revisits(spark.createDataFrame(data, PAGE).repartition(3)), folder, archive_bytes=500)
    tasks = Counter(r.t for r in warczip.read_archives(archives, folder).select(F.spark_partition_id().alias("t")).collect())
    most = max(r.records for r in archives.collect())
    assert len(tasks) >= archives.count() - 1 and max(tasks.values()) <= 2 * most and sum(tasks.values()) == 60
