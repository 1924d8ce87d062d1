"""WARC records in ZIP-packaged archives, written and read by Spark tasks.

An archive holds ``archive/data.warc.gz`` (stored: one gzip member a record) and
``indexes/index.cdxj`` (a line a record: url, date, JSON with the record's offset, length,
digest and page).  The reader parses the end record, the ZIP64 records and the central
directory, locates both members by their local headers, and reads records by their byte
ranges; nothing is extracted.

Of records with equal payloads of ``MIN_REVISIT`` bytes or more, the one with the largest
page_id is a response, the others are revisits that refer to it.

Archives lie in the shared folder.  A task writes files of its own names and returns them;
the written list of these is the archive set, so files of lost or repeated tasks are never
read.  Folders are reached by pyarrow's file systems (local, HDFS, object stores).

Defined results: NULL html is an empty payload; a NULL url or page_id stays NULL; line breaks
in a url are percent-encoded; rows that
repeat the largest page_id of a payload are all responses; a NULL page_id is never the one
referred to, unless a payload has no other, and then all are responses; an empty table
writes no archive and reads none.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobfacts.llm.common import by_value, cut, fresh_path, salted_join

by_value(__name__)

MIN_REVISIT = 1000
#: an archive is closed when its records reach this size
ARCHIVE_BYTES = 256 << 20
READ_BYTES = 4 << 20
DATE = "1970-01-01T00:00:00Z"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Fixed value of the WARC standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to is NULL for responses."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.select("page_id", "url", "payload", F.sha1("payload").alias("digest"))
    repeated = cut(rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
                   .agg(F.count("*").alias("n"), F.max("page_id").alias("original")).where("n > 1").select("digest", "original"), "repeated")
    joined = salted_join(rows, repeated, ["digest"], "left")
    return joined.select("page_id", "url", "payload", "digest",
                         F.when(~F.col("page_id").eqNullSafe(F.col("original")), F.col("original")).alias("refers_to"))


def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>"


def _record(page: int | None, url: str | None, payload: bytes, digest: str, refers: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page, digest)}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page is not None:
        head.append(f"X-Page-Id: {page}")
    if refers is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(refers, digest)}", f"X-Refers-To-Page-Id: {refers}"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Writer:
    """One archive, streamed to a new file."""

    def __init__(self, folder: str):
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        self.name = f"part-{uuid.uuid4().hex}.wacz"
        self.sink = system.open_output_stream(f"{path}/{self.name}")
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.at, self.index = 0, []

    def add(self, page, url, payload, digest, refers) -> None:
        member = gzip.compress(_record(page, url, payload, digest, refers), 5, mtime=0)
        self.data.write(member)
        place = {"offset": self.at, "length": len(member), "digest": f"sha1:{digest}", "page": page}
        self.index.append(f"{json.dumps(url)} {DATE} {json.dumps(place)}\n")
        self.at += len(member)

    def close(self) -> tuple[str, int]:
        self.data.close()
        self.zip.writestr(INDEX, "".join(self.index))
        self.zip.close()
        self.sink.close()
        return self.name, len(self.index)


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes ``with_revisits``'s rows; returns the list of archives (name, records)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_one, done = None, []
        for batch in batches:
            for row in batch.to_pylist():
                open_one = open_one or _Writer(folder)
                open_one.add(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"])
                if open_one.at >= archive_bytes:
                    done.append(open_one.close())
                    open_one = None
        if open_one:
            done.append(open_one.close())
        yield pa.record_batch([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())], ["name", "records"])

    return cut(records.mapInArrow(run, "name string, records long"), "archives")


def _place(line: str) -> dict:
    """The place in an index line; its url is a JSON string and may hold anything."""
    _, end = json.JSONDecoder().raw_decode(line)
    return json.loads(line[end:].removeprefix(f" {DATE} "))


class Archive:
    """Random access to a ZIP file's members through ``read(offset, length)``."""

    def __init__(self, read, size: int):
        self.read = read
        tail_at = max(0, size - (1 << 16) - 22 - 20)
        tail = read(tail_at, size - tail_at)
        end = tail.rfind(b"PK\x05\x06")
        if end < 0:
            raise ValueError("no end of central directory")
        count, length, start = struct.unpack_from("<HII", tail, end + 10)
        if end >= 20 and tail[end - 20:end - 16] == b"PK\x06\x07":
            at = struct.unpack_from("<Q", tail, end - 12)[0]
            wide = read(at, 56)
            if wide[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end of central directory")
            count, length, start = struct.unpack_from("<QQQ", wide, 32)
        self.members: dict[str, tuple[int, int, int]] = {}  # name: method, packed size, local header
        directory, at = read(start, length), 0
        for _ in range(count):
            if directory[at:at + 4] != b"PK\x01\x02":
                raise ValueError("broken central directory")
            method, packed, unpacked = struct.unpack_from("<H8xII", directory, at + 10)
            names, extras, notes, local = struct.unpack_from("<HHH8xI", directory, at + 28)
            name = directory[at + 46:at + 46 + names].decode()
            extra = directory[at + 46 + names:at + 46 + names + extras]
            packed, local = self._wide(extra, unpacked, packed, local)
            self.members[name] = (method, packed, local)
            at += 46 + names + extras + notes

    @staticmethod
    def _wide(extra: bytes, unpacked: int, packed: int, local: int) -> tuple[int, int]:
        at = 0
        while at + 4 <= len(extra):
            kind, length = struct.unpack_from("<HH", extra, at)
            if kind == 1:  # the values that do not fit, in this order
                values = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
                if unpacked == 0xFFFFFFFF:
                    next(values)
                packed = next(values) if packed == 0xFFFFFFFF else packed
                local = next(values) if local == 0xFFFFFFFF else local
            at += 4 + length
        return packed, local

    def place(self, name: str) -> tuple[int, int]:
        """Offset and length of a stored member's bytes."""
        method, packed, local = self.members[name]
        if method != zipfile.ZIP_STORED:
            raise ValueError(f"{name} isn't stored")
        names, extras = struct.unpack_from("<HH", self.read(local, 30), 26)
        return local + 30 + names + extras, packed

    def records(self) -> Iterator[bytes]:
        """The WARC records in the index's order, neighbouring ranges read together."""
        at, length = self.place(INDEX)
        base, _ = self.place(DATA)
        places = [_place(line) for line in self.read(at, length).decode().splitlines()]
        i = 0
        while i < len(places):
            first, j = places[i]["offset"], i + 1
            while j < len(places) and places[j]["offset"] == places[j - 1]["offset"] + places[j - 1]["length"] and (
                    places[j]["offset"] + places[j]["length"] - first <= READ_BYTES):
                j += 1
            chunk = self.read(base + first, places[j - 1]["offset"] + places[j - 1]["length"] - first)
            for p in places[i:j]:
                own = p["offset"] - first
                yield zlib.decompress(chunk[own:own + p["length"]], 31)
            i = j


def _parsed(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't have its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return number("X-Page-Id"), fields.get("WARC-Target-URI"), size, digest, kind, number("X-Refers-To-Page-Id"), payload if kind == "response" else None


_RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_archives(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record of the listed archives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        names = [x.split()[0] for x in _RECORD.split(", ")]
        for batch in batches:
            for name in batch.column("name").to_pylist():
                with system.open_input_file(f"{path}/{name}") as f:
                    rows, held = [], 0
                    for record in Archive(lambda at, n, f=f: f.read_at(n, at), f.size()).records():
                        rows.append(_parsed(record) if payloads else (*_parsed(record)[:6], None))
                        held += len(record)
                        if held >= READ_BYTES:
                            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows, held = [], 0
                    if rows:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    parts = max(1, archives.count())
    # ranges of names, which are distinct: one archive a task (hashes would give some tasks several)
    return archives.repartitionByRange(parts, "name").mapInArrow(run, _RECORD)


def warc_query(spark: SparkSession, pages: DataFrame) -> DataFrame:
    folder = fresh_path(spark, "warc")
    archives = write_archives(with_revisits(pages), folder)
    return read_archives(archives, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def oracle_sql(source: str = "pages") -> str:
    return f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM {source}),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id <> original THEN original END AS refers_to FROM m"""
