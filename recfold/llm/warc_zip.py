"""WARC records in ZIP packages: written by tasks, and read back by ranges without extraction.

A package holds one stored member with WARC records, each compressed by itself, and one stored
member that lists where each record begins. The reader parses the central directory (ZIP64
included), finds both members in the file, reads the list, and then only the ranges of records.
Files are reached through Arrow's file systems, so a package may lie in any store they know;
the folder is one that all executors share.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from recfold.llm.rows import map_batches, stored

# Layout of ZIP files and of WARC records.
_END, _END_64, _LOCATOR_64, _ENTRY, _LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
_NONE_16, _NONE_32 = 0xFFFF, 0xFFFFFFFF
RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PREFIX = "urn:page:"

PACKAGE_BYTES = 64 << 20
LEAST_REVISIT = 100
_TOGETHER = 1 << 20
_TASK_BYTES = 16 << 20


class Appended(io.RawIOBase):
    """An output stream that can only be appended to."""

    def __init__(self, stream):
        self.stream = stream

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.stream.write(bytes(data))
        return len(data)


@dataclass
class Member:
    """A member of a ZIP file; ``begin`` is where its bytes are."""

    name: str
    method: int
    begin: int
    size: int


def members(file: pa.NativeFile) -> dict[str, Member]:
    """Stored and other members by name, from the central directory and the local headers' lengths."""
    size = file.size()
    tail_at = max(0, size - 22 - _NONE_16)
    tail = file.read_at(size - tail_at, tail_at)
    at = tail.rfind(_END)
    while at >= 0 and (len(tail) < at + 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP file: no end of central directory")
    count, length, begin = struct.unpack_from("<10xHII", tail, at)
    if count == _NONE_16 or length == _NONE_32 or begin == _NONE_32:
        locator_at = tail_at + at - 20
        locator = file.read_at(20, locator_at) if locator_at >= 0 else b""
        if locator[:4] != _LOCATOR_64:
            raise ValueError("ZIP64 locator expected")
        record = file.read_at(56, struct.unpack_from("<8xQ", locator)[0])
        if record[:4] != _END_64:
            raise ValueError("ZIP64 end of central directory expected")
        count, length, begin = struct.unpack_from("<32xQQQ", record)
    directory = file.read_at(length, begin)
    found, at = {}, 0
    for _ in range(count):
        if directory[at: at + 4] != _ENTRY:
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<8xHH", directory, at)
        packed, plain, n_name, n_extra, n_comment, local = struct.unpack_from("<20xIIHHH8xI", directory, at)
        name = directory[at + 46: at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + n_name: at + 46 + n_name + n_extra]
        place = 0
        while place + 4 <= len(extra):
            kind, held = struct.unpack_from("<HH", extra, place)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{held // 8}Q", extra, place + 4))
                plain = next(wide) if plain == _NONE_32 else plain
                packed = next(wide) if packed == _NONE_32 else packed
                local = next(wide) if local == _NONE_32 else local
            place += 4 + held
        header = file.read_at(30, local)
        if header[:4] != _LOCAL:
            raise ValueError("damaged local header")
        data_at = local + 30 + sum(struct.unpack_from("<26xHH", header))
        found[name] = Member(name, method, data_at, packed)
        at += 46 + n_name + n_extra + n_comment
    return found


def _clean(value: str) -> str:
    """A header value without line ends and other controls."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record. A revisit keeps the HTTP head, with the payload's length, and no payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response")]
    if page_id is not None:
        head.append(("WARC-Record-ID", f"<{_PREFIX}{page_id}>"))
    if url is not None:
        head.append(("WARC-Target-URI", _clean(url)))
    head.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{_PREFIX}{refers_to}>")]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{name}: {value}\r\n" for name, value in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _headers(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _page(reference: str | None) -> int | None:
    return int(reference.strip("<>").removeprefix(_PREFIX)) if reference else None


def parsed(data: bytes) -> dict:
    """Fields of one record; a response's digest and length are those of the bytes that are there."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = warc["warc-payload-digest"].removeprefix("sha256:")
    size = int(_headers(http)["content-length"])
    if warc["warc-type"] == "response":
        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError("payload and digest of a record differ")
    else:
        payload = None
    return {
        "page_id": _page(warc.get("warc-record-id")), "url": warc.get("warc-target-uri"),
        "record_type": warc["warc-type"], "refers_to": _page(warc.get("warc-refers-to")),
        "payload_bytes": size, "payload_digest": digest, "payload": payload,
    }


class Package:
    """A ZIP file that is being written."""

    def __init__(self, stream: pa.NativeFile):
        self.stream = stream
        self.zip = zipfile.ZipFile(Appended(stream), "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(RECORDS), "w", force_zip64=True)
        self.size, self.index = 0, []

    def add(self, page_id: int | None, data: bytes) -> None:
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        packed = packer.compress(data) + packer.flush()
        self.member.write(packed)
        self.index.append(json.dumps({"page": page_id, "offset": self.size, "length": len(packed)}))
        self.size += len(packed)

    def close(self) -> int:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.index))
        self.zip.close()
        self.stream.close()
        return len(self.index)


def revisits(pages: DataFrame) -> DataFrame:
    """``page_id``, ``digest``, ``refers_to`` of pages whose payload a page of smaller id has.

    Payloads are counted per digest before anything else, so a payload that very many pages
    share is one row there; only digests that occur again are looked up.
    """
    slim = pages.select(
        F.col("page_id").cast("long").alias("page_id"), _digest().alias("digest"),
        F.octet_length(_html()).alias("bytes"),
    ).filter(f"page_id is not null and bytes >= {LEAST_REVISIT}")
    first = slim.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
    first = stored(first.filter("last > refers_to").drop("last"), "first_pages")
    return slim.join(first, "digest").filter("page_id > refers_to").select("page_id", "digest", "refers_to").distinct()


def _html():
    return F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")


def _digest():
    return F.sha2(_html(), 256)


def write_packages(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write every row of ``pages`` (``page_id``, ``url``, ``html``) as a record; returns the packages.

    The result (``package``, ``records``) is written below ``folder`` too, and lists the packages
    of tasks that ended well: a task that is run again writes files of other names. A package
    ends after ``package_bytes`` of records. Rows without an id, and rows that share the smallest
    id of a payload, are responses; NULL payloads are empty; an empty table gives no package.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files, path = pafs.FileSystem.from_uri(folder)
        files.create_dir(path, recursive=True)
        written, package, name = [], None, ""
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if package is None:
                    name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{len(written)}.wacz"
                    package = Package(files.open_output_stream(f"{path}/{name}"))
                package.add(page_id, record(page_id, url, html, digest, refers_to))
                if package.size >= package_bytes:
                    written.append((name, package.close()))
                    package = None
        if package is not None:
            written.append((name, package.close()))
        if written:
            names, counts = zip(*written, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{n}" for n in names]), pa.array(counts, pa.int64())], names=["package", "records"]
            )

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        _html().alias("html"), _digest().alias("digest"),
    )
    # Rows without an id match no revisit; keys of their own keep them from meeting in one task.
    left = rows.withColumn("key", F.coalesce("page_id", F.xxhash64("url", "digest")))
    right = revisits(pages).select(F.col("page_id").alias("key"), F.col("digest").alias("digest_"), "refers_to")
    same = (left["key"] == right["key"]) & (left["digest"] == right["digest_"]) & left["page_id"].isNotNull()
    marked = left.join(right, same, "left").select("page_id", "url", "html", "digest", "refers_to")
    packages = map_batches(marked, work, "package string, records long")
    path = f"{folder}/packages"
    packages.write.parquet(path)
    return packages.sparkSession.read.parquet(path)


def locate(packages: DataFrame) -> DataFrame:
    """``package``, ``begin``, ``size`` of each record, from the directory and the list in each package.

    A package that is listed twice gives its records twice; no packages, or empty ones, give none.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for package in batch.column("package").to_pylist():
                files, path = pafs.FileSystem.from_uri(package)
                with files.open_input_file(path) as file:
                    found = members(file)
                    records, index = found[RECORDS], found[INDEX]
                    if records.method or index.method:
                        raise ValueError("members are to be stored, not compressed")
                    lines = file.read_at(index.size, index.begin).decode().splitlines()
                places = [json.loads(line) for line in lines]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([package] * len(places)), pa.array([records.begin + p["offset"] for p in places], pa.int64()),
                     pa.array([p["length"] for p in places], pa.int64())],
                    names=["package", "begin", "size"],
                )

    return map_batches(packages.select("package"), work, "package string, begin long, size long")


_FIELDS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])


def read_records(places: DataFrame, payload: bool = True) -> DataFrame:
    """The records at ``places``: ranges that lie close together are read at once.

    Places are dealt by stretches of a package, so that one package may be read by many tasks, to
    as many tasks as the records' own bytes ask for: the places themselves are narrow.
    ``payload=False`` leaves the payloads out of the result; they are checked all the same. Equal
    places give a record each; without places there is no record. Columns have no NULL.
    """
    places = stored(places, "places")
    total = places.agg(F.sum("size")).first()[0] or 0
    fields = _FIELDS if payload else _FIELDS.remove(6)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = sorted(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            at = 0
            while at < len(rows):
                package, begin, size = rows[at]
                stop = at + 1
                while stop < len(rows) and rows[stop][0] == package and rows[stop][1] + rows[stop][2] - begin <= _TOGETHER:
                    stop += 1
                files, path = pafs.FileSystem.from_uri(package)
                with files.open_input_file(path) as file:
                    data = file.read_at(rows[stop - 1][1] + rows[stop - 1][2] - begin, begin)
                read = [parsed(gzip.decompress(data[b - begin: b - begin + n])) for _, b, n in rows[at:stop]]
                yield pa.RecordBatch.from_pylist(read, schema=fields)
                at = stop

    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
    stretch = F.floor(F.col("begin") / (16 * _TOGETHER))
    tasks = max(1, -(-total // _TASK_BYTES))
    dealt = places.repartition(tasks, "package", stretch).sortWithinPartitions("package", "begin")
    return map_batches(dealt, work, schema + ", payload binary" * payload)
