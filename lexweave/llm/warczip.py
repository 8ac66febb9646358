"""Operator 8: WARC records in ZIP archives, read by ranges without extraction.

An archive holds one stored WARC member, whose records are gzip members of their
own, and a stored index with each record's place and size.  The reader finds the
central directory from the archive's end (with its ZIP64 forms), locates members by
their local headers, reads the index, and then reads only byte ranges of records.

Records of equal payloads of at least `least` bytes: the one of the smallest id is
the response, the others are revisits that refer to it and carry its digest and
length.  The smallest ids come from map-side combined minima of digests; only rows
of repeated digests have a partner in the join, which Spark may split where one
digest is hot.

Defined results: a null payload is the empty payload.  Rows that share the smallest
id and the payload are all responses.  A null id is never the smallest if there is
another; if there is none the rows are responses.  A damaged directory, member or
record raises BadArchive.  An empty table writes no archive and reads as no rows.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.llm.common import file_system, fresh_dir, put_file

# Signatures and sizes of the ZIP structures.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
STORED, DEFLATED = 0, 8

WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
#: Payload bytes from which equal payloads are written once.
LEAST_SHARED = 100
#: Payload bytes of an archive, about; and bytes that one range read spans at most.
ARCHIVE_BYTES, RANGE_BYTES = 32 << 20, 4 << 20


class BadArchive(ValueError):
    """The bytes are no archive or record that this module reads."""


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    crc: int
    packed: int
    size: int
    header: int


def pack_zip(members: list[tuple[str, bytes]], zip64: bool = False) -> bytes:
    """An archive of stored members; zip64 writes the 64-bit forms although nothing needs them."""
    out, central = bytearray(), bytearray()
    for name, data in members:
        raw, at, crc = name.encode(), len(out), zlib.crc32(data)
        wide = zip64 or max(len(data), at) >= FULL32
        version = 45 if wide else 20
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if wide else b""
        shown = FULL32 if wide else len(data)
        out += LOCAL + struct.pack("<HHHHHIIIHH", version, 0x800, STORED, 0, 0x21, crc, shown, shown, len(raw), len(extra)) + raw + extra + data
        extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at) if wide else b""
        central += CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", version, version, 0x800, STORED, 0, 0x21, crc, shown, shown, len(raw), len(extra), 0, 0, 0, 0, FULL32 if wide else at) + raw + extra
    at, n = len(out), len(members)
    out += central
    if zip64 or n >= FULL16 or at + len(central) >= FULL32:
        end = len(out)
        out += END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, len(central), at)
        out += LOCATOR64 + struct.pack("<IQI", 0, end, 1)
        out += END + struct.pack("<HHHHIIH", 0, 0, FULL16, FULL16, FULL32, FULL32, 0)
    else:
        out += END + struct.pack("<HHHHIIH", 0, 0, n, n, len(central), at, 0)
    return bytes(out)


class Zip:
    """An archive behind a seekable source; reads its directory, then ranges of members."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size
        self.members = {m.name: m for m in self._directory()}
        self._begin: dict[str, int] = {}

    def bytes_at(self, at: int, n: int) -> bytes:
        if at < 0 or n < 0 or at + n > self.size:
            raise BadArchive("a range lies outside the archive")
        self.source.seek(at)
        data = self.source.read(n)
        if len(data) != n:
            raise BadArchive("the archive is short")
        return data

    def _directory(self) -> Iterator[Member]:
        tail_at = max(0, self.size - 22 - FULL16)
        tail = self.bytes_at(tail_at, self.size - tail_at)
        at = tail.rfind(END)
        while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(END, 0, at)
        if at < 0:
            raise BadArchive("no end of a central directory")
        disk, _, _, n, size, first = struct.unpack_from("<HHHHII", tail, at + 4)
        end = tail_at + at
        if FULL16 in (disk, n) or FULL32 in (size, first):
            locator = self.bytes_at(end - 20, 20)
            if locator[:4] != LOCATOR64:
                raise BadArchive("no locator of the 64-bit end")
            end = struct.unpack_from("<Q", locator, 8)[0]
            record = self.bytes_at(end, 56)
            if record[:4] != END64:
                raise BadArchive("no 64-bit end of a central directory")
            n, size, first = struct.unpack_from("<QQQ", record, 32)
        shift = end - size - first  # bytes before the archive proper
        if shift < 0:
            raise BadArchive("the central directory lies outside the archive")
        data, place = self.bytes_at(first + shift, size), 0
        for _ in range(n):
            if data[place : place + 4] != CENTRAL or place + 46 > len(data):
                raise BadArchive("a damaged central directory")
            flags, method, _, _, crc, packed, size_, name, extra, comment = struct.unpack_from("<HHHHIIIHHH", data, place + 8)
            header = struct.unpack_from("<I", data, place + 42)[0]
            if flags & 1:
                raise BadArchive("an encrypted member")
            raw = data[place + 46 : place + 46 + name]
            more = data[place + 46 + name : place + 46 + name + extra]
            size_, packed, header = self._wide(more, [size_, packed, header])
            yield Member(raw.decode("utf-8" if flags & 0x800 else "cp437"), method, crc, packed, size_, header + shift)
            place += 46 + name + extra + comment

    @staticmethod
    def _wide(extra: bytes, values: list[int]) -> list[int]:
        """Takes the values that are all ones from the 64-bit extra field."""
        at = 0
        while at + 4 <= len(extra):
            kind, size = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                body, used, out = extra[at + 4 : at + 4 + size], 0, []
                for v in values:
                    if v == FULL32:
                        if used + 8 > len(body):
                            raise BadArchive("a short 64-bit field")
                        v = struct.unpack_from("<Q", body, used)[0]
                        used += 8
                    out.append(v)
                return out
            at += 4 + size
        return values

    def begin(self, name: str) -> int:
        """Where a member's data starts, by its local header."""
        if name not in self._begin:
            if name not in self.members:
                raise BadArchive(f"no member {name}")
            member = self.members[name]
            head = self.bytes_at(member.header, 30)
            if head[:4] != LOCAL:
                raise BadArchive("no local header")
            self._begin[name] = member.header + 30 + sum(struct.unpack_from("<HH", head, 26))
        return self._begin[name]

    def read_range(self, name: str, at: int, n: int) -> bytes:
        """Bytes of a stored member."""
        member = self.members.get(name)
        if member is None or member.method != STORED:
            raise BadArchive(f"{name} is not a stored member")
        if at < 0 or n < 0 or at + n > member.size:
            raise BadArchive("a range lies outside the member")
        return self.bytes_at(self.begin(name) + at, n)

    def read(self, name: str) -> bytes:
        """A whole member (for indexes), stored or deflated, with its checksum."""
        at, member = self.begin(name), self.members[name]
        data = self.bytes_at(at, member.packed)
        try:
            data = zlib.decompress(data, -15) if member.method == DEFLATED else data
        except zlib.error:
            raise BadArchive("a damaged member") from None
        if member.method not in (STORED, DEFLATED) or zlib.crc32(data) != member.crc:
            raise BadArchive("a damaged member")
        return data


def _line(value: object) -> str:
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in str(value))


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One response or revisit record, as a gzip member."""
    identity = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}/{digest}")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{identity}>", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {_line(url or 'about:blank')}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    head += [f"X-Page-Id: {page_id}"] if page_id is not None else []
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {refers_to}", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers_to}/{digest}')}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    payload: bytes


def parse_record(data: bytes) -> Record:
    """A gzip member back to headers and payload; lengths and digest are checked."""
    try:
        data = zlib.decompress(data, 31)
    except zlib.error:
        raise BadArchive("a damaged record") from None
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise BadArchive("no WARC record")
    headers = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
    size = int(headers.get("content-length", -1))
    if size < 0 or rest[size:] != b"\r\n\r\n":
        raise BadArchive("a record of another length")
    payload = rest[:size].partition(b"\r\n\r\n")[2]
    if headers["warc-type"] == "response" and headers.get("warc-payload-digest") != "sha256:" + hashlib.sha256(payload).hexdigest():
        raise BadArchive("a payload of another digest")
    return Record(headers, payload)


def pack_archive(rows: list[tuple], zip64: bool = False) -> bytes:
    """rows: (page_id, url, payload, digest, refers_to or None, revisit)."""
    warc, index = bytearray(), []
    for page_id, url, payload, digest, refers_to, revisit in rows:
        record = warc_record(page_id, url, payload, digest, refers_to, revisit)
        fields = {"url": url, "digest": f"sha256:{digest}", "mime": "warc/revisit" if revisit else "text/html", "filename": WARC_MEMBER.rsplit("/", 1)[1], "offset": len(warc), "length": len(record)}
        index.append(f"{_line(url or 'about:blank')} 19700101000000 {json.dumps(fields)}")
        warc += record
    return pack_zip([(WARC_MEMBER, bytes(warc)), (INDEX_MEMBER, ("\n".join(sorted(index)) + "\n").encode("utf-8", "surrogatepass"))], zip64)


def index_of(archive: Zip) -> list[tuple[int, int]]:
    """(offset, length) of every indexed record, in order of place."""
    lines = archive.read(INDEX_MEMBER).decode("utf-8", "surrogatepass").split("\n")
    fields = [json.loads(x.split(" ", 2)[2]) for x in lines if x]
    return sorted((f["offset"], f["length"]) for f in fields)


def read_records(archive: Zip, places: list[tuple[int, int]]) -> Iterator[Record]:
    """The records at these places (ascending), neighbours by one range read."""
    i = 0
    while i < len(places):
        j, first = i, places[i][0]
        while j + 1 < len(places) and sum(places[j + 1]) - first <= RANGE_BYTES:
            j += 1
        data = archive.read_range(WARC_MEMBER, first, max(sum(p) for p in places[i : j + 1]) - first)
        for at, n in places[i : j + 1]:
            yield parse_record(data[at - first : at - first + n])
        i = j + 1


def write(df: DataFrame, spark: SparkSession, page_id: str = "page_id", payload: str = "html", url: str = "url", folder: str | None = None, least: int = LEAST_SHARED, archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Writes the rows' records into archives of the folder; returns the folder.

    Archives have names of their own attempt, and only those of finished tasks are
    listed, so a lost or repeated task leaves no record twice.
    """
    folder = folder or fresh_dir(spark, "warc-archives")
    rows = df.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{payload}`"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    shared = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    marked = rows.join(shared, "digest", "left").select("page_id", "url", "payload", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for page, link, text, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                body = text.encode("utf-8", "surrogatepass")
                held.append((page, link, body, digest, first, first is not None))
                size += len(body) + 256
                if size > archive_bytes:
                    yield put(held)
                    held, size = [], 0
        if held:
            yield put(held)

    def put(held: list) -> pa.RecordBatch:
        name = f"records-{uuid.uuid4().hex}.zip"
        put_file(f"{folder}/{name}", pack_archive(held))
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(held)], pa.int64())], names=["name", "records"])

    marked.mapInArrow(run, "name string, records long").write.parquet(f"{folder}/archives")
    return folder


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row a record of the folder's archives: page_id, payload_bytes, payload_digest, record_type, refers_to, url."""
    names = spark.read.schema("name string, records long").parquet(f"{folder}/archives").select("name")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                system, path = file_system(f"{folder}/{name}")
                with system.open_input_file(path) as source:
                    archive = Zip(source, source.size())
                    rows = [row(r) for r in read_records(archive, index_of(archive))]
                yield pa.RecordBatch.from_pylist(rows, ARROW)

    def row(record: Record) -> dict:
        h = record.headers
        revisit = h["warc-type"] == "revisit"
        return {
            "page_id": int(h["x-page-id"]) if "x-page-id" in h else None,
            "payload_bytes": int(h["x-payload-length"]) if revisit else len(record.payload),
            "payload_digest": h["warc-payload-digest"].removeprefix("sha256:"),
            "record_type": h["warc-type"],
            "refers_to": int(h["x-refers-to-page"]) if revisit else None,
            "url": h["warc-target-uri"],
        }

    return names.repartition(spark.sparkContext.defaultParallelism * 2, "name").mapInArrow(run, schema)


ARROW = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])


def open_bytes(data: bytes) -> Zip:
    """An archive held in memory."""
    return Zip(io.BytesIO(data), len(data))
