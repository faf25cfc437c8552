"""WARC records in ZIP archives: written once, then read in ranges without extraction.

Each writing task puts its records, compressed one by one, into the stored member
``archive/data.warc.gz`` of a ZIP file and their places into the stored member
``indexes/index.cdxj``. The reader parses the central directory, or the ZIP64 one
where the sizes ask for it, finds every stored index and data member in the file and
reads the records that the indexes name, each in the member of its line, in ranges;
nothing is unpacked to disk. Archives of other writers may have several of both, and
compressed indexes.

Archives lie in the folder every executor can reach; file names are new for each
attempt, and only the names of successful tasks are handed on.

Defined cases: NULL html is an empty payload; NULL page ids are kept and come last
when the smallest id is sought; rows that repeat the smallest id of their payload
are responses too; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path, stage

#: An archive is closed when its records reach this size.
ARCHIVE_BYTES = 1 << 30
#: Records that follow each other are read together up to this size.
WINDOW_BYTES = 4 << 20
MIN_REVISIT = 0
ARCHIVE, INDEXES = "archive/", "indexes/"
DATA, INDEX = ARCHIVE + "data.warc.gz", INDEXES + "index.cdxj"

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _named(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has no block but names the response it equals."""
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _named(page),
        "WARC-Date": _DATE,
        "WARC-Target-URI": (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "X-Payload-Length": str(len(payload)),
    }
    block = b""
    if refers_to is None:
        block = _HTTP % len(payload) + payload
        head["Content-Type"] = "application/http; msgtype=response"
    else:
        head |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": _named(refers_to)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2] if headers["WARC-Type"] == "response" else b""


class _Archive:
    """A ZIP file being written in one pass."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"
        system, inner = _open(self.path)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self._sink = system.open_output_stream(inner)
        self._zip = zipfile.ZipFile(self._sink, "w", zipfile.ZIP_STORED, allowZip64=True)
        self._member = self._zip.open(DATA, "w", force_zip64=True)
        self._index, self.size, self.records = io.BytesIO(), 0, 0

    def add(self, url: str | None, raw: bytes) -> None:
        packed = gzip.compress(raw, 4, mtime=0)
        entry = {"url": url or "", "filename": DATA, "offset": str(self.size), "length": str(len(packed))}
        self._index.write(f"{self.records:012d} {json.dumps(entry)}\n".encode())
        self._member.write(packed)
        self.size += len(packed)
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self._member.close()
        with self._zip.open(INDEX, "w", force_zip64=True) as member:
            member.write(self._index.getvalue())
        self._zip.close()
        self._sink.close()
        return self.path, self.records, self.size


def revisits(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, refers_to``: equal payloads refer to their smallest page id."""
    given = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.encode(F.col("html"), "UTF-8"), F.lit(b"")).alias("payload"),
    ).withColumns({"sha": F.unhex(F.sha1("payload")), "bytes": F.length("payload").cast("bigint")})
    shared = (
        given.groupBy("sha", "bytes").agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & (F.col("bytes") >= MIN_REVISIT)).drop("n")
    )
    other = F.col("least").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("least"))
    return given.join(shared, ["sha", "bytes"], "left").select(
        "page_id", "url", "payload", F.when(other, F.col("least")).alias("refers_to")
    )


def write(records: DataFrame, folder: str) -> DataFrame:
    """``path, records, bytes`` of the archives; each task writes its own."""
    schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done = None, []
        for batch in batches:
            for page, url, payload, refers in zip(*(c.to_pylist() for c in batch.columns)):
                current = current or _Archive(folder)
                current.add(url, record(page, url, payload, refers))
                if current.size >= ARCHIVE_BYTES:
                    done.append(current.close())
                    current = None
        if current:
            done.append(current.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    return records.select("page_id", "url", "payload", "refers_to").mapInArrow(
        archive, "path string, records long, bytes long"
    )


def _at(file, offset: int, length: int) -> bytes:
    file.seek(offset)
    return file.read(length)


def directory(file, size: int) -> Iterator[tuple[str, int, int, int, int]]:
    """``name, method, header offset, packed size, size`` of every member."""
    tail_size = min(size, 65_557)
    tail = _at(file, size - tail_size, tail_size)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, offset = struct.unpack("<HII", tail[end + 10 : end + 20])
    if count == 0xFFFF or length == 0xFFFFFFFF or offset == 0xFFFFFFFF:
        locator = _at(file, size - tail_size + end - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        big = _at(file, struct.unpack("<Q", locator[8:16])[0], 56)
        if big[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, offset = struct.unpack("<QQQ", big[32:56])
    entries, at = _at(file, offset, length), 0
    for _ in range(count):
        if entries[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method = struct.unpack("<H", entries[at + 10 : at + 12])[0]
        packed, full, name_len, extra_len, note_len = struct.unpack("<IIHHH", entries[at + 20 : at + 34])
        header = struct.unpack("<I", entries[at + 42 : at + 46])[0]
        name = entries[at + 46 : at + 46 + name_len].decode()
        extra = entries[at + 46 + name_len : at + 46 + name_len + extra_len]
        full, packed, header = _zip64(extra, full, packed, header)
        yield name, method, header, packed, full
        at += 46 + name_len + extra_len + note_len


def _zip64(extra: bytes, *fields: int) -> list[int]:
    """Fields at their 32-bit limit are taken from the ZIP64 extra field, in order."""
    found, at = list(fields), 0
    while at + 4 <= len(extra):
        tag, length = struct.unpack("<HH", extra[at : at + 4])
        if tag == 1:
            wide = iter(struct.unpack(f"<{length // 8}Q", extra[at + 4 : at + 4 + length // 8 * 8]))
            found = [next(wide) if f == 0xFFFFFFFF else f for f in found]
        at += 4 + length
    return found


def stored_members(file, size: int) -> dict[str, tuple[int, int]]:
    """First byte and length of the content of every stored member; compressed ones are left out."""
    return {name: (header, packed) for name, method, header, packed, _ in directory(file, size) if method == 0}


def _content(file, header: int) -> int:
    """Where a member's content begins: its local header has a name and an extra field of its own."""
    local = _at(file, header, 30)
    name_len, extra_len = struct.unpack("<HH", local[26:30])
    return header + 30 + name_len + extra_len


def places(file, members: dict[str, tuple[int, int]]) -> dict[str, list[tuple[int, int]]]:
    """Sorted offsets and lengths of the records per data member, from all indexes of the archive."""
    found: dict[str, set[tuple[int, int]]] = defaultdict(set)
    for name, (header, length) in members.items():
        if not name.startswith(INDEXES) or not name.removesuffix(".gz").endswith((".cdxj", ".cdx")):
            continue
        index = _at(file, _content(file, header), length)
        for line in (gzip.decompress(index) if name.endswith(".gz") else index).splitlines():
            if b"{" in line and not line.startswith(b"!"):
                entry = json.loads(line[line.index(b"{") :])
                named = entry["filename"] if entry["filename"] in members else ARCHIVE + entry["filename"]
                found[named].add((int(entry["offset"]), int(entry["length"])))
    if not found:
        raise ValueError("no stored index with records")
    return {name: sorted(ranges) for name, ranges in found.items()}


def read_ranges(path: str) -> Iterator[bytes]:
    """The records of one archive by its indexes, in windows of neighbouring ranges."""
    system, inner = _open(path)
    size = system.get_file_info(inner).size
    with system.open_input_file(inner) as file:
        members = stored_members(file, size)
        for name, ranges in places(file, members).items():
            if name not in members:
                raise ValueError(f"{name} is named by an index but no stored member of {path}")
            data, at = _content(file, members[name][0]), 0
            while at < len(ranges):
                first, end, stop = ranges[at][0], ranges[at][0] + ranges[at][1], at + 1
                while stop < len(ranges) and ranges[stop][0] == end and end + ranges[stop][1] - first <= WINDOW_BYTES:
                    end += ranges[stop][1]
                    stop += 1
                window = _at(file, data + first, end - first)
                for offset, count in ranges[at:stop]:
                    record = window[offset - first : offset - first + count]
                    yield zlib.decompress(record, 31) if record[:2] == b"\x1f\x8b" else record
                at = stop


RECORD = pa.schema([
    ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
    ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
])
_RECORD_SQL = (
    "page_id long, record_type string, refers_to long, url string, payload binary, payload_bytes long, payload_digest string"
)


def _page(name: str | None) -> int | None:
    number = name[len("<urn:page:") : -1] if name else "none"
    return None if number == "none" else int(number)


def read(archives: DataFrame, parallel: int) -> DataFrame:
    """The records of archives named in ``path``; a response's digest is checked against its payload."""
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held, size = [], 0
                for raw in read_ranges(path):
                    head, payload = parse(raw)
                    named = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    length = int(head["X-Payload-Length"])
                    if head["WARC-Type"] == "response" and (digest(payload), len(payload)) != (named, length):
                        raise ValueError(f"{head['WARC-Record-ID']} in {path}: payload differs from its digest")
                    held.append((
                        _page(head["WARC-Record-ID"]), head["WARC-Type"], _page(head.get("WARC-Refers-To")),
                        head["WARC-Target-URI"], payload, length, named,
                    ))
                    size += len(payload)
                    if size > WINDOW_BYTES or len(held) >= 5_000:
                        yield _batch(held)
                        held, size = [], 0
                if held:
                    yield _batch(held)

    return archives.select("path").repartition(max(1, parallel)).mapInArrow(records, _RECORD_SQL)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORD)], schema=RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write a record per page, then read all archives back."""
    spark = pages.sparkSession
    archives, _ = stage(write(revisits(pages), scratch_path(spark, "warc")), "warc-archives")
    return read(archives, archives.count())


def report(pages: DataFrame) -> DataFrame:
    return round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH given AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), least AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_bytes, hex) AS first_id FROM given
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM least
"""
