"""WARC records in ZIP packages: a writer, and a reader that range-reads records out of stored members.

A package holds archive/data.warc, a sequence of WARC/1.1 records, and indexes/index.cdxj, one line of JSON per record
with its offset and length. Both are stored without compression, so a record is a range of the package: the reader parses the end record, the
ZIP64 records where there are any, the central directory and the members' local headers, and then reads just the index and
the records.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, shared_dir

DATA, INDEX = "archive/data.warc", "indexes/index.cdxj"
#: Limits from which ZIP fields move to ZIP64 records.
MAX16, MAX32 = 0xFFFF, 0xFFFFFFFF
#: The text writer ends a file with this byte; it is the package's comment.
COMMENT = b"\n"
#: A list of so many shared payloads (some 100 bytes each) may be broadcast; a longer one is joined by shuffle.
BROADCAST_ROWS = 100_000


class ArchiveError(ValueError):
    pass


# ---------------------------------------------------------------- ZIP


def zip_store(members: list[tuple[str, bytes]], comment: bytes = b"", zip64: bool = False) -> bytes:
    """A ZIP archive of stored members; ZIP64 records where a field needs them, or everywhere with zip64."""
    out, directory, at = [], [], 0
    for name, data in members:
        raw, crc, big = name.encode(), zlib.crc32(data), zip64 or len(data) >= MAX32
        size = MAX32 if big else len(data)
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if big else b""
        head = struct.pack("<IHHHHHIIIHH", 0x04034B50, 45 if big else 20, 0x800, 0, 0, 0x21, crc, size, size, len(raw), len(extra))
        out += [head, raw, extra, data]
        far = zip64 or at >= MAX32
        more = (struct.pack("<QQ", len(data), len(data)) if big else b"") + (struct.pack("<Q", at) if far else b"")
        more = struct.pack("<HH", 1, len(more)) + more if more else b""
        directory += [struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45 if more else 20, 0x800, 0, 0, 0x21, crc, size, size, len(raw), len(more), 0, 0, 0, 0, MAX32 if far else at), raw, more]
        at += len(head) + len(raw) + len(extra) + len(data)
    listing = b"".join(directory)
    n, end = len(members), b""
    if zip64 or n >= MAX16 or at >= MAX32 or len(listing) >= MAX32:
        end = struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, len(listing), at)
        end += struct.pack("<IIQI", 0x07064B50, 0, at + len(listing), 1)
        n16, size32, at32 = MAX16, MAX32, MAX32
    else:
        n16, size32, at32 = n, len(listing), at
    end += struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, n16, n16, size32, at32, len(comment))
    return b"".join([*out, listing, end, comment])


@dataclass
class Member:
    name: str
    method: int
    size: int
    stored: int
    header: int


class ZipReader:
    """Members of a ZIP archive that is read by range: read(offset, length) gives bytes."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read, self.size = read, size
        tail_at = max(0, size - 22 - MAX16)
        tail = read(tail_at, size - tail_at)
        k = tail.rfind(b"PK\x05\x06")
        while k >= 0 and not (k + 22 <= len(tail) and k + 22 + struct.unpack_from("<H", tail, k + 20)[0] == len(tail)):
            k = tail.rfind(b"PK\x05\x06", 0, k)
        if k < 0:
            raise ArchiveError("no end of central directory")
        n, length, at = struct.unpack_from("<HII", tail, k + 10)
        end_at = tail_at + k
        if n == MAX16 or length == MAX32 or at == MAX32:
            if end_at < 20 or (locator := read(end_at - 20, 20))[:4] != b"PK\x06\x07":
                raise ArchiveError("no ZIP64 locator")
            end64 = read(struct.unpack_from("<Q", locator, 8)[0], 56)
            if end64[:4] != b"PK\x06\x06":
                raise ArchiveError("no ZIP64 end of central directory")
            n, length, at = struct.unpack_from("<QQQ", end64, 32)
        self.members = self._directory(read(at, length), n)

    @staticmethod
    def _directory(data: bytes, n: int) -> dict[str, Member]:
        found, at = {}, 0
        for _ in range(n):
            if data[at : at + 4] != b"PK\x01\x02":
                raise ArchiveError("broken central directory")
            flags, method = struct.unpack_from("<HH", data, at + 8)
            stored, size, names, extras, comments = struct.unpack_from("<IIHHH", data, at + 20)
            header = struct.unpack_from("<I", data, at + 42)[0]
            name = data[at + 46 : at + 46 + names].decode("utf-8" if flags & 0x800 else "cp437")
            extra = data[at + 46 + names : at + 46 + names + extras]
            while len(extra) >= 4:
                kind, length = struct.unpack_from("<HH", extra)
                if kind == 1:  # the 64-bit values of the fields that are full, in this order
                    wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, 4))
                    size = next(wide) if size == MAX32 else size
                    stored = next(wide) if stored == MAX32 else stored
                    header = next(wide) if header == MAX32 else header
                extra = extra[4 + length :]
            found[name] = Member(name, method, size, stored, header)
            at += 46 + names + extras + comments
        return found

    def data_at(self, name: str) -> int:
        """Where a stored member's bytes begin."""
        m = self.members[name]
        if m.method:
            raise ArchiveError(f"{name} is compressed; only stored members can be read by range")
        head = self.read(m.header, 30)
        if head[:4] != b"PK\x03\x04":
            raise ArchiveError(f"no local header of {name}")
        return m.header + 30 + sum(struct.unpack_from("<HH", head, 26))

    def range(self, name: str, offset: int, length: int) -> bytes:
        m = self.members[name]
        if offset < 0 or offset + length > m.size:
            raise ArchiveError(f"range beyond {name}")
        return self.read(self.data_at(name) + offset, length)


# ---------------------------------------------------------------- WARC


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_value(s: str) -> str:
    """A header holds one line; what would end it is percent-encoded, and a per cent sign with it."""
    return "".join(f"%{b:02X}" if (b < 0x20 or b in (0x25, 0x7F)) else chr(b) for b in s.encode()).encode("latin-1").decode() if any(c < " " or c in "%\x7f" for c in s) else s


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, refers_to: int | None) -> bytes:
    """A response record, or a revisit record that has the digest and the target but no payload of its own."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}|{digest}|{revisit}')}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", header_value(url or "")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
        ("X-Payload-Length", str(len(payload))),
    ]
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page-ID", "" if refers_to is None else str(refers_to))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, HTTP body)."""
    end = data.find(b"\r\n\r\n")
    first, *lines = data[:end].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ArchiveError("no WARC record here")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    length = int(headers["content-length"])
    block = data[end + 4 : end + 4 + length]
    if len(block) != length or data[end + 4 + length :] != b"\r\n\r\n":
        raise ArchiveError("record is cut off")
    return headers, block[block.find(b"\r\n\r\n") + 4 :]


def package(records: list[tuple[str, bytes]]) -> bytes:
    """A ZIP package of (key, record)s, without its comment: that is the line end which the text writer adds."""
    at, index = 0, []
    for key, data in records:
        index.append(f"{key} {json.dumps({'offset': at, 'length': len(data)})}\n")
        at += len(data)
    return zip_store([(DATA, b"".join(d for _, d in records)), (INDEX, "".join(index).encode())], COMMENT)[: -len(COMMENT)]


def read_package(read: Callable[[int, int], bytes], size: int) -> Iterator[tuple[dict[str, str], bytes]]:
    z = ZipReader(read, size)
    index = z.range(INDEX, 0, z.members[INDEX].size).decode()
    start, whole = z.data_at(DATA), z.members[DATA].size
    for line in index.splitlines():
        place = json.loads(line.partition(" ")[2])
        if place["offset"] + place["length"] > whole:
            raise ArchiveError("index points beyond the archive")
        yield parse_record(read(start + place["offset"], place["length"]))


# ---------------------------------------------------------------- Spark


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", revisit_bytes: int = 0, package_bytes: int = 4 << 20) -> None:
    """Writes a record per row of pages into packages of about package_bytes in folder, which must be new.

    The payload is the html in UTF-8; null is empty. Of rows with equal payloads of at least revisit_bytes bytes the one with the smallest
    id is a response and the others are revisits of it (ids that repeat: one of the rows; null ids come last); smaller payloads are all responses. The
    smallest id of a payload is found from digests and ids alone, combined before the shuffle; payloads move only where the list of
    shared ones is too long to broadcast. Any file system that Spark writes to will do: packages go through its text writer, as one row each.
    """
    base = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    base = base.withColumn("digest", F.when(F.length("payload") >= revisit_bytes, F.sha1("payload")))
    # payloads that occur more than once, with the smallest id and how often that id has the payload
    each = base.where("digest is not null").select("digest", "id").groupBy("digest", "id").agg(F.count("*").alias("n"))
    shared = each.groupBy("digest").agg(F.sum("n").alias("rows"), F.min("id").alias("least"), F.min(F.struct(F.col("id").isNull(), "id", "n"))["n"].alias("ties"))
    shared = cut(shared.where("rows > 1").select(F.col("digest").alias("d"), F.col("least").alias("low"), "ties"))
    n_shared = shared.count()
    known = F.broadcast(shared) if n_shared <= BROADCAST_ROWS else shared
    marked = base.join(known, F.col("digest") == F.col("d"), "left") if n_shared else base.select("*", F.lit(None).cast("string").alias("d"), F.lit(None).cast("long").alias("low"), F.lit(0).alias("ties"))
    smallest = F.col("id").eqNullSafe(F.col("low"))
    rows = marked.select("id", "url", "payload", (F.col("d").isNotNull() & ~smallest).alias("revisit"), "low")
    if shared.where("ties > 1").limit(1).count():  # rows that repeat the smallest id: the first by url among them alone
        from pyspark.sql import Window

        tied = F.col("d").isNotNull() & smallest & (F.col("ties") > 1)
        number = F.row_number().over(Window.partitionBy("digest").orderBy("url"))
        again = marked.where(tied).withColumn("k", number).select("id", "url", "payload", (F.col("k") > 1).alias("revisit"), "low")
        rows = marked.where(~tied).select("id", "url", "payload", (F.col("d").isNotNull() & ~smallest).alias("revisit"), "low").unionByName(again)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for page, url, payload, revisit, low_id in zip(*(batch.column(k) for k in range(5))):
                data = payload.as_py()
                key = f"{page.as_py() if page.is_valid else '-'}"
                held.append((key, record(page.as_py(), url.as_py(), data, payload_digest(data), revisit.as_py(), low_id.as_py() if revisit.as_py() else None)))
                size += len(held[-1][1])
                if size >= package_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([package(held)], pa.binary())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([package(held)], pa.binary())], ["value"])

    packages = rows.mapInArrow(build, "value binary")
    packages.select(F.col("value").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("lineSep", COMMENT.decode()).text(folder)


def file_reader(path: str) -> tuple[Callable[[int, int], bytes], int, Callable[[], None]]:
    fd = os.open(path, os.O_RDONLY)

    def read(offset: int, length: int) -> bytes:
        parts = []
        while length:
            x = os.pread(fd, length, offset)
            if not x:
                raise ArchiveError("file ends early")
            parts.append(x)
            offset, length = offset + len(x), length - len(x)
        return b"".join(parts)

    return read, os.fstat(fd).st_size, lambda: os.close(fd)


def store_reader(path: str) -> tuple[Callable[[int, int], bytes], int, Callable[[], None]]:
    """Reads ranges of a file in a store that Arrow knows."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    file = system.open_input_file(inner)
    size = file.size()

    def read(offset: int, length: int) -> bytes:
        data = file.read_at(length, offset)
        if len(data) != length:
            raise ArchiveError("file ends early")
        return data

    return read, size, file.close


def way_to_read(spark: SparkSession, folder: str) -> str:
    """How packages in folder are read: file (ranges of a shared file), store (ranges through Arrow) or whole (bytes fetched by Spark)."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if store.getUri().getScheme() == "file":
        return "file"
    from pyarrow import fs

    try:
        system, inner = fs.FileSystem.from_uri(store.makeQualified(at).toString())
        return "store" if system.get_file_info(inner).type == fs.FileType.Directory else "whole"
    except (pa.ArrowException, OSError):
        return "whole"


def read_archives(spark: SparkSession, folder: str, way: str | None = None) -> DataFrame:
    """One row per record in folder's packages: page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload (null for revisits).

    Packages in shared file: folders, and in stores that Arrow reaches from the driver, are read by range on the executors; from other stores
    Spark fetches a package's bytes, and the same reader takes ranges of these. way (file, store or whole) overrules that choice. A
    response whose payload doesn't match its digest or length, like any broken package, is an error.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    way = way or way_to_read(spark, folder)
    listed = listed.where("length > 0")  # a write task without rows may leave an empty file
    listed = listed.select("path", "content") if way == "whole" else listed.select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        number = lambda s: int(s) if s else None
        for batch in batches:
            for k in range(batch.num_rows):
                if way == "file":
                    from urllib.parse import unquote, urlparse

                    read, size, close = file_reader(unquote(urlparse(batch.column(0)[k].as_py()).path))
                elif way == "store":
                    read, size, close = store_reader(batch.column(0)[k].as_py())
                else:
                    data = batch.column(1)[k].as_buffer()
                    read, size, close = (lambda at, n, d=data: d.slice(at, n).to_pybytes()), len(data), (lambda: None)
                rows = []
                try:
                    for h, body in read_package(read, size):
                        revisit = h["warc-type"] == "revisit"
                        digest, length = h["warc-payload-digest"].removeprefix("sha1:"), int(h["x-payload-length"])
                        if not revisit and (len(body) != length or payload_digest(body) != digest):
                            raise ArchiveError("payload doesn't match its digest")
                        rows.append((number(h["x-page-id"]), h["warc-target-uri"], h["warc-type"], number(h.get("x-refers-to-page-id", "")), digest, length, None if revisit else body))
                finally:
                    close()
                for lo in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows[lo : lo + 256]], kinds[c]) for c in range(7)], names)

    return listed.mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary")


def archive_round_trip(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Writes the archives of pages and returns what is read back from them."""
    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder, **options)
    return read_archives(spark, folder)
