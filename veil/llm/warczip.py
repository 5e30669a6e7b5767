"""WARC records in ZIP packages: writing, and a reader that never extracts.

Writer: every task streams its rows into packages in a shared folder. A package holds
stored members ``archive/*.warc.gz`` (each record is a gzip member of its own) and one
stored ``indexes/index.cdxj`` with the place of every record. Records with a payload
that an earlier id has become ``revisit`` records without it. File names are unique per
attempt and only those of finished tasks are in the returned table, so a lost executor
leaves orphans but no doubles.

Reader: from the end of the file it finds the end-of-central-directory record, and the
ZIP64 one where sizes need it, reads the central directory, skips the local headers of
the stored members, reads the indexes, and then reads ranges of neighbouring records in
parallel. Memory of a task: one member (``MEMBER_BYTES``) to write, the directory and
index of one package (``PACKAGE_BYTES``) or one range (``RANGE_BYTES``) to read; one
record above these sizes is held alone.

Results: null html counts as empty; null urls are left out of the record. Of equal
payloads of ``REVISIT_FROM`` bytes or more the least id is the response (rows that repeat
this id too), null ids last. An empty table gives no package and an empty table. A member
that is not stored, or a broken directory, raises ValueError.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import urllib.parse
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veil.llm.common import shared_folder, stored

REVISIT_FROM = 100
MEMBER_BYTES, PACKAGE_BYTES, RANGE_BYTES = 8 << 20, 1 << 30, 4 << 20
#: Bytes of packages that a reading task is meant to have.
TASK_BYTES = 32 << 20
DATE = "1970-01-01T00:00:00Z"
INDEX = "indexes/index.cdxj"
#: Fixed values of the formats.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END, END64, LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
ENTRY, LOCAL = b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system of a path or URI; ``file:`` may come with one slash or three."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = path[5:]
    return fs.FileSystem.from_uri(path)


def _name(value: object) -> str:
    return "<urn:page:" + ("" if value is None else urllib.parse.quote(str(value), safe="")) + ">"


def _value(name: str) -> str | None:
    inner = urllib.parse.unquote(name[len("<urn:page:") : -1])
    return inner or None


def record(page_id: object, url: str | None, payload: bytes, digest: str, refers_to: object, revisit: bool) -> bytes:
    """One WARC record; a revisit has the HTTP header of its payload, but not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers and payload of one record; the digest is computed where there is a payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    field = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(field["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    told = field["warc-payload-digest"].removeprefix("sha256:")
    out = {"page_id": _value(field["warc-record-id"]), "url": field.get("warc-target-uri"),
           "record_type": field["warc-type"], "payload_bytes": length, "payload_digest": told, "refers_to": None, "payload": None}
    if field["warc-type"] == "revisit":
        return out | {"refers_to": _value(field["warc-refers-to"])}
    if len(payload) != length or hashlib.sha256(payload).hexdigest() != told:
        raise ValueError("a payload differs from its digest")
    return out | {"payload": payload}


class _Package:
    """A ZIP package being written, member by member."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.zip"
        system, path = opened(folder)
        system.create_dir(path, recursive=True)
        self.sink = system.open_output_stream(f"{path}/{self.path.rsplit('/', 1)[1]}")
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.index: list[str] = []
        self.members = self.size = 0
        self.buffer = io.BytesIO()

    def add(self, data: bytes) -> None:
        packed = gzip.compress(data, 1, mtime=0)
        self.index.append(json.dumps([self.members, self.buffer.tell(), len(packed)]))
        self.buffer.write(packed)
        self.size += len(packed)
        if self.buffer.tell() >= MEMBER_BYTES:
            self.end_member()

    def end_member(self) -> None:
        if self.buffer.tell():
            self.zip.writestr(f"archive/{self.members:06d}.warc.gz", self.buffer.getvalue())
            self.members += 1
            self.buffer = io.BytesIO()

    def close(self) -> tuple[str, int, int]:
        self.end_member()
        self.zip.writestr(INDEX, "\n".join(self.index))
        self.zip.close()
        self.sink.close()
        return self.path, len(self.index), self.size


def write_packages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all rows to packages below ``folder``; returns (path, records, bytes) of each package."""
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.encode(F.coalesce(F.col(html_col), F.lit("")), "utf-8").alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    firsts = (
        rows.select("page_id", "digest").where(F.octet_length("payload") >= REVISIT_FROM)
        .groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    )
    told = rows.join(firsts.withColumn("several", F.lit(True)), "digest", "left").select(
        "page_id", "url", "payload", "digest", "first",
        (F.coalesce("several", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                for row in batch.slice(k, 200).to_pylist():
                    package = package or _Package(folder)
                    package.add(record(row["page_id"], row["url"], row["payload"], row["digest"], row["first"], row["revisit"]))
                    if package.size >= PACKAGE_BYTES:
                        done.append(package.close())
                        package = None
        if package:
            done.append(package.close())
        if done:
            paths, records, sizes = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())], names=["path", "records", "bytes"])

    return stored(told.mapInArrow(run, "path string, records bigint, bytes bigint"), "warc-packages")


def read_directory(source: pa.NativeFile) -> list[tuple[str, int, int, int]]:
    """(name, method, offset of the data, size) of every member of a package."""
    size = source.size()

    def at(offset: int, length: int) -> bytes:
        data = source.read_at(length, offset)
        if len(data) != length:
            raise ValueError("the package ends too early")
        return data

    tail_from = max(0, size - 22 - FULL16)
    tail = at(tail_from, size - tail_from)
    place = tail.rfind(END)
    while place >= 0 and (place + 22 > len(tail) or place + 22 + struct.unpack_from("<H", tail, place + 20)[0] != len(tail)):
        place = tail.rfind(END, 0, place + 3)
    if place < 0:
        raise ValueError("no end of a central directory")
    count, length, start = struct.unpack_from("<HII", tail, place + 10)
    if count == FULL16 or FULL32 in (length, start):
        if place < 20 or tail[place - 20 : place - 16] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        end64 = at(struct.unpack_from("<Q", tail, place - 12)[0], 56)
        if end64[:4] != END64:
            raise ValueError("no ZIP64 end of a central directory")
        count, length, start = struct.unpack_from("<QQQ", end64, 32)
    entries, here, out = at(start, length), 0, []
    for _ in range(count):
        if entries[here : here + 4] != ENTRY:
            raise ValueError("a broken central directory")
        method, = struct.unpack_from("<H", entries, here + 10)
        packed, full, names, extras, comments = struct.unpack_from("<IIHHH", entries, here + 20)
        local, = struct.unpack_from("<I", entries, here + 42)
        name = entries[here + 46 : here + 46 + names].decode()
        extra = entries[here + 46 + names : here + 46 + names + extras]
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:  # ZIP64: only the fields that are full in the entry, in this order
                numbers = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                full = next(numbers) if full == FULL32 else full
                packed = next(numbers) if packed == FULL32 else packed
                local = next(numbers) if local == FULL32 else local
            extra = extra[4 + n :]
        header = at(local, 30)
        if header[:4] != LOCAL:
            raise ValueError("a broken local header")
        if method == 0 and packed != full:
            raise ValueError("a stored member of two sizes")
        out.append((name, method, local + 30 + sum(struct.unpack_from("<HH", header, 26)), packed))
        here += 46 + names + extras + comments
    return out


def ranges_of(path: str) -> Iterator[tuple[int, int, list[int]]]:
    """Ranges (offset, length, record lengths) of neighbouring records of a package, by its index."""
    system, name = opened(path)
    with system.open_input_file(name) as source:
        members = {}
        for member, method, offset, size in read_directory(source):
            if method != 0:
                raise ValueError(f"{member} is not stored")
            members[member] = (offset, size)
        if INDEX not in members:
            raise ValueError("the package has no index")
        offset, size = members[INDEX]
        lines = source.read_at(size, offset).decode().splitlines()
    start = length = 0
    sizes: list[int] = []
    for line in lines:
        member, within, size = json.loads(line)
        here = members[f"archive/{member:06d}.warc.gz"][0] + within
        if sizes and (here != start + length or length + size > RANGE_BYTES):
            yield start, length, sizes
            sizes = []
        if not sizes:
            start, length = here, 0
        sizes.append(size)
        length += size
    if sizes:
        yield start, length, sizes


def read_packages(packages: DataFrame, path_col: str = "path", tasks: int | None = None) -> DataFrame:
    """The records of all packages: page_id, url, record_type, payload_bytes, payload_digest, refers_to (ids as strings), payload.

    Rows of ranges are tiny and stand for megabytes each, so they are dealt to a stated number of
    tasks, which adaptive execution does not merge: ``tasks``, or one for every
    ``TASK_BYTES`` of the packages (column ``bytes``; 1 GB each without it) and one per core at least.
    """
    if tasks is None:
        size = F.sum("bytes") if "bytes" in packages.columns else F.count("*") * PACKAGE_BYTES
        total = packages.agg(size).first()[0] or 0
        tasks = max(packages.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                found = list(ranges_of(path))
                if found:
                    start, length, sizes = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * len(found)), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(sizes, pa.list_(pa.int64()))],
                        names=["path", "start", "length", "sizes"])

    kind = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                      ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                path, start, length, sizes = (batch.column(k)[i].as_py() for k in range(4))
                system, name = opened(path)
                with system.open_input_file(name) as source:
                    data = source.read_at(length, start)
                records, at = [], 0
                for size in sizes:
                    records.append(parse_record(zlib.decompress(data[at : at + size], 31)))
                    at += size
                    if len(records) == 100:
                        yield pa.RecordBatch.from_pylist(records, schema=kind)
                        records = []
                if records:
                    yield pa.RecordBatch.from_pylist(records, schema=kind)

    places = packages.select(path_col).repartition(tasks, path_col).mapInArrow(locate, "path string, start bigint, length bigint, sizes array<bigint>")
    return places.repartition(tasks, "path", "start").mapInArrow(
        fetch, "page_id string, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to string, payload binary")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write ``pages`` to packages in the shared folder and read all records back, ids in their own type."""
    kind = pages.schema[id_col].dataType
    packages = write_packages(pages, shared_folder(pages.sparkSession, "warc"), id_col, url_col, html_col)
    read = read_packages(packages)
    return read.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})
