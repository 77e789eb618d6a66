"""Web archives packaged in ZIP files: writer, and reader by ranges.

A package stores, without compression by ZIP, one archive of gzip members (a
WARC record each) and an index of their places. The reader parses the end of
the file, the ZIP64 and central directories and the members' local headers,
reads the index, and then reads and inflates just the ranges of records it is
asked for; nothing is extracted. A package without an index is walked member
by member.

Files are opened by URI through pyarrow (file, hdfs, s3, gs). Packages get a
name of their own per attempt; only those that a finished task reported are
in the list that the reader gets, so a lost executor leaves unread files at most.

Null html counts as an empty payload, a null url is left out of the record.
Rows that repeat a page_id are records of their own, of the same type.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm.common import cut, parallelism, table, written
from patronage.session import ensure_checkpoint_dir

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
#: A package is closed beyond this size; ranges next to each other are read together up to the other.
PACKAGE_BYTES, READ_BYTES = 256 << 20, 4 << 20


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    uri = re.sub(r"^file:/(?!/)", "file:///", uri)
    return fs.FileSystem.from_uri(uri)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# records


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:x-page:{'' if page_id is None else page_id}>"),
            ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:x-page:{refers_to}>")]
    head.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """page_id, url, payload (None for a revisit), payload_bytes, payload_digest, record_type, refers_to."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    named = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
    number = lambda v: int(m[1]) if v and (m := re.fullmatch(r"<urn:x-page:(-?\d+)>", v)) else None
    revisit = fields["warc-type"] == "revisit"
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if not revisit and payload_digest(payload) != digest:
        raise ValueError(f"record {fields['warc-record-id']}: the payload does not match its digest")
    return {"page_id": number(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "payload": None if revisit else payload,
            "payload_bytes": int(named[1]) if revisit else len(payload), "payload_digest": digest,
            "record_type": fields["warc-type"], "refers_to": number(fields.get("warc-refers-to"))}


# packages


class Package:
    """Writes one package; ``add`` takes whole records."""

    def __init__(self, folder: str):
        self.system, base = opened(folder)
        self.system.create_dir(base, recursive=True)
        self.uri = f"{folder}/part-{uuid.uuid4().hex}.zip"
        self.out = self.system.open_output_stream(f"{base}/{self.uri.rpartition('/')[2]}")
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(ARCHIVE, "w", force_zip64=True)
        self.size, self.index = 0, []

    def add(self, data: bytes, name: str) -> None:
        pack = zlib.compressobj(1, zlib.DEFLATED, 31)
        body = pack.compress(data) + pack.flush()
        self.member.write(body)
        self.index.append(f"{name} {self.size} {len(body)}\n")
        self.size += len(body)

    def close(self) -> tuple[str, int]:
        self.member.close()
        with self.zip.open(INDEX, "w", force_zip64=True) as f:
            for i in range(0, len(self.index), 10_000):
                f.write("".join(self.index[i:i + 10_000]).encode())
        self.zip.close()
        self.out.close()
        return self.uri, len(self.index)


def read_at(f, start: int, size: int) -> bytes:
    f.seek(start)
    data = f.read(size)
    if len(data) < size:
        raise ValueError("the file ends early")
    return data


def members(f, size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (start of the data, size, method) from the end of the file, its
    ZIP64 form where a field overflows, and the central directory."""
    tail = read_at(f, max(0, size - 66_000), min(size, 66_000))
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("not a ZIP file")
    count, length, start = struct.unpack("<10xHLL2x", tail[at:at + 22])
    if 0xFFFF == count or 0xFFFFFFFF in (length, start):
        place, = struct.unpack("<8xQ4x", read_at(f, size - len(tail) + at - 20, 20))
        count, length, start = struct.unpack("<32xQQQ", read_at(f, place, 56))
    directory, at, found = read_at(f, start, length), 0, {}
    for _ in range(count):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method, packed, full, n, m, k, local = struct.unpack("<4x4xHH8xLLHHH8xL", directory[at:at + 46])
        name = directory[at + 46:at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra, e = directory[at + 46 + n:at + 46 + n + m], 0
        while e + 4 <= len(extra):
            kind, width = struct.unpack("<HH", extra[e:e + 4])
            if kind == 1:  # the overflowed fields, in this order
                wide = list(struct.unpack(f"<{width // 8}Q", extra[e + 4:e + 4 + width // 8 * 8]))
                full = wide.pop(0) if full == 0xFFFFFFFF else full
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                local = wide.pop(0) if local == 0xFFFFFFFF else local
            e += 4 + width
        head = read_at(f, local, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"{name}: no local header")
        found[name] = local + 30 + sum(struct.unpack("<HH", head[26:30])), packed, method
        at += 46 + n + m + k
    return found


def walked(f, start: int, size: int) -> Iterator[tuple[int, int]]:
    """(place, length) of the gzip members of a stored archive without index."""
    at, end = start, start + size
    while at < end:
        inflate, used = zlib.decompressobj(31), 0
        while not inflate.eof:
            data = read_at(f, at + used, min(1 << 20, end - at - used))
            if not data:
                raise ValueError("a gzip member ends early")
            inflate.decompress(data)
            used += len(data) - len(inflate.unused_data)
        yield at, used
        at += used


def places(uri: str) -> list[tuple[int, int]]:
    """(place in the package, length) of every record."""
    system, path = opened(uri)
    with system.open_input_file(path) as f:
        inside = members(f, f.size())
        out = []
        for name, (start, size, method) in inside.items():
            if not name.startswith("archive/"):
                continue
            if method:
                raise ValueError(f"{uri}: {name} is not stored")
            if INDEX in inside:
                first, length, kind = inside[INDEX]
                text = read_at(f, first, length)
                if kind == 8:
                    text = zlib.decompress(text, -15)
                out += [(start + int(a), int(n)) for _, a, n in (x.rsplit(" ", 2) for x in text.decode().splitlines())]
            else:
                out += list(walked(f, start, size))
        return out


# Spark


def _digests(batches):
    for b in batches:
        payloads = [(t or "").encode() for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([
            b.column(0), b.column(2), pa.array(payloads, pa.binary()), pa.array([payload_digest(p) for p in payloads], pa.string()),
            pa.array([hashlib.sha256(p).digest() for p in payloads], pa.binary())], ["page_id", "url", "payload", "digest", "strong"])


def _write(folder: str):
    def run(batches):
        package = None
        done: list[tuple[str, int]] = []
        for b in batches:
            for page, url, payload, digest, first, revisit in zip(*(c.to_pylist() for c in b.columns), strict=True):
                package = package or Package(folder)
                package.add(record(page, url, payload, digest, first, revisit), str(page))
                if package.size >= PACKAGE_BYTES:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], ["uri", "records"])
    return run


def write_packages(pages: DataFrame, folder: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record per row and return (uri, records) of the packages. Of
    equal payloads of at least ``least_bytes``, the one with the smallest
    page_id is a response and the others revisit it."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html"), F.col(url_col).cast("string").alias("url"))
    rows = rows.mapInArrow(_digests, "page_id long, url string, payload binary, digest string, strong binary")
    firsts = cut(rows.groupBy("digest", "strong").agg(F.min("page_id").alias("first"))).withColumnsRenamed({"digest": "d2", "strong": "s2"})
    known = rows.join(firsts, F.expr("digest = d2 and strong = s2"))
    again = (F.octet_length("payload") >= least_bytes) & F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull())
    return written(known.select("page_id", "url", "payload", "digest", "first", again.alias("revisit")).mapInArrow(_write(folder), "uri string, records long"))


def _places(batches):
    for b in batches:
        for uri in b.column(0).to_pylist():
            found = places(uri)
            yield pa.RecordBatch.from_arrays([pa.array([uri] * len(found), pa.string()), pa.array([a for a, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())], ["uri", "start", "length"])


FIELDS = {"page_id": pa.int64(), "url": pa.string(), "payload": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}


def _read(batches):
    """Records at the given places, sorted by package and place."""
    name, f = None, None
    for b in batches:
        rows = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
        i = 0
        while i < len(rows):
            uri, start, length = rows[i]
            if uri != name:
                if f:
                    f.close()
                system, path = opened(uri)
                name, f = uri, system.open_input_file(path)
            j, end = i + 1, start + length
            while j < len(rows) and rows[j][:2] == (uri, end) and end - start < READ_BYTES:
                end += rows[j][2]
                j += 1
            data = read_at(f, start, end - start)
            found = [parsed(zlib.decompress(data[a - start:a - start + n], 31)) for _, a, n in rows[i:j]]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], t) for k, t in FIELDS.items()], list(FIELDS))
            i = j
    if f:
        f.close()


def read_packages(packages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type,
    refers_to of every record of the packages (column uri)."""
    n = parallelism(packages.sparkSession)
    at = packages.select("uri").repartition(n, "uri").mapInArrow(_places, "uri string, start long, length long")
    at = at.repartition(n, "uri", F.floor(F.col("start") / (2 * READ_BYTES))).sortWithinPartitions("uri", "start")
    return at.mapInArrow(_read, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    packages = write_packages(table(spark, sf_dir, "pages"), folder)
    return read_packages(packages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
