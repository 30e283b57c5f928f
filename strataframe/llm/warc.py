"""WARC archives as a Python data source, read and written by Spark.

``spark.read.format("warc")`` plans one partition for each group of archive
files, parses a record's headers before anything else, and steps over the block
of every record that the pushed-down predicates rule out: those on record type,
record id, target, date, digest and reference are decided from the headers.
With ``payload`` set to false the payloads of the other records are stepped over
as well.  Archives are plain, or gzip members, a member for each record; a member
is inflated as far as its headers, and where it says its length (as the writer's
do) the rest of an unwanted one is stepped over unread.  ``df.write.format("warc")`` writes each task's records to files of its
own name and size; the driver lists the files of successful tasks in a manifest,
and only these are read, so what a lost or repeated task left behind never
counts.

Paths may be of any file system that Arrow's ``FileSystem.from_uri`` knows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, WriterCommitMessage

from strataframe.session import scratch_path

from .common import materialize, small_side

SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, payload_digest string, refers_to string, "
    "payload_bytes long, payload binary"
)
#: The header behind each column that is known before a payload.
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}
VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_manifest"
#: Bytes of a file after which a task begins the next one, of the files that
#: make up a partition, and of the payloads handed over at once.
FILE_BYTES, PARTITION_BYTES, BATCH_BYTES = 64 << 20, 64 << 20, 8 << 20
BATCH_ROWS = 4096


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A header value: line breaks would end it."""
    return " ".join(value.split("\r")).replace("\n", " ")


def record_bytes(record_type: str, record_id: str, target: str, date: str, digest: str, refers_to: str | None, length: int, payload: bytes | None) -> bytes:
    """One record.  Its block is an HTTP response, of which a revisit keeps the
    header only; the length in that header is the payload's in either case."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length + (payload or b"")
    head = [
        ("WARC-Type", record_type),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Target-URI", target),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if record_type == "revisit":
        head += [("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", REVISIT)]
    head.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {_clean(v)}\r\n" for k, v in head)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


class Headers:
    """Reads records from an open file: headers first, blocks on demand."""

    def __init__(self, stream, name: str):
        self.stream, self.name = stream, name

    def __iter__(self):
        """Yields each record's headers (names in lower case) and its block's
        offset and length.  The block must not be read past its end."""
        while True:
            line = self.stream.readline()
            while line in (b"\r\n", b"\n"):
                line = self.stream.readline()
            if not line:
                return
            if not line.startswith(b"WARC/"):
                raise ValueError(f"{self.name}: a record was expected at byte {self.stream.tell() - len(line)}")
            headers: dict[str, str] = {}
            last = None
            while (line := self.stream.readline()) not in (b"\r\n", b"\n"):
                if not line:
                    raise ValueError(f"{self.name}: ends inside a record's headers")
                if line[:1] in b" \t" and last:
                    headers[last] += " " + line.decode("utf-8", "replace").strip()
                    continue
                key, _, value = line.decode("utf-8", "replace").partition(":")
                last = key.strip().lower()
                headers[last] = value.strip()
            start, length = self.stream.tell(), int(headers["content-length"])
            yield headers, start, length
            if self.stream.ends_by(start + length + len(b"\r\n\r\n")):
                return
            self.stream.seek(start + length)


def column_values(headers: dict[str, str]) -> dict[str, str | None]:
    """The columns that headers decide."""
    out = {}
    for column, header in HEADERS.items():
        value = headers.get(header)
        if value is not None and column in ("record_id", "refers_to"):
            value = value.strip("<>")
        if value is not None and column == "payload_digest":
            value = value.partition(":")[2] or value
        out[column] = value
    return out


def http_parts(stream, start: int, length: int) -> tuple[int, int]:
    """Of a block with an HTTP message: the length of its header, and the
    payload's length as that header gives it (-1 if it doesn't)."""
    stream.seek(start)
    at, said = start, -1
    while at < start + length:
        line = stream.readline()
        at += len(line)
        if line in (b"\r\n", b"\n") or not line:
            break
        key, _, value = line.partition(b":")
        if key.strip().lower() == b"content-length":
            said = int(value)
    return min(at, start + length) - start, said


@dataclass
class ArchiveFiles(InputPartition):
    """The files of one partition."""

    files: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters):
        for f in filters:
            attribute = getattr(f, "attribute", ())
            column = attribute[0] if len(attribute) == 1 else None
            if column in HEADERS and isinstance(f, EqualTo):
                self._want(column, {f.value})
            elif column in HEADERS and isinstance(f, In):
                self._want(column, set(f.value))
            elif column in HEADERS and isinstance(f, IsNotNull):
                self._want(column, None)
            else:
                yield f

    def _want(self, column: str, values: set | None) -> None:
        """Adds a condition; None stands for any value but null."""
        known = self.wanted.get(column)
        self.wanted[column] = known if values is None else values if known is None else known & values

    def _passes(self, row: dict) -> bool:
        return all(row[c] is not None and (v is None or row[c] in v) for c, v in self.wanted.items())

    def partitions(self):
        system, root = open_fs(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=False)) if system.get_file_info(root).type == fs.FileType.Directory else [system.get_file_info(root)]
        names = {f.base_name: f for f in found if f.type == fs.FileType.File}
        if MANIFEST in names:
            with system.open_input_stream(names[MANIFEST].path) as s:
                listed = json.loads(s.read())
            gone = [n for n in listed if n not in names]
            if gone:
                raise FileNotFoundError(f"{self.path}: files of the manifest are missing: {gone[:5]}")
            files = [names[n] for n in listed]
        else:
            files = [f for n, f in sorted(names.items()) if not n.startswith(("_", "."))]
        groups, size = [[]], 0
        for f in files:
            if groups[-1] and size + f.size > self.partition_bytes:
                groups.append([])
                size = 0
            groups[-1].append(f.path)
            size += f.size
        return [ArchiveFiles(g) for g in groups]

    def read(self, partition):
        system, _ = open_fs(self.path)
        rows, size = [], 0
        for name in partition.files:
            with system.open_input_file(name) as file:
                for stream, headers, start, length in records(file, name):
                    row = column_values(headers)
                    if not self._passes(row):
                        continue
                    row |= self._block(stream, headers, row, start, length, name)
                    rows.append(row)
                    size += len(row["payload"] or b"")
                    if size > BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)

    def _block(self, stream, headers, row, start, length, name) -> dict:
        """The payload's length, and the payload itself if it is asked for."""
        begin, said = 0, length
        if headers.get("content-type", "").startswith("application/http"):
            begin, said = http_parts(stream, start, length)
        whole = row["record_type"] != "revisit"
        count = length - begin if whole else said if said >= 0 else None
        payload = None
        if whole and (self.payload or self.verify):
            stream.seek(start + begin)
            payload = stream.read(length - begin)
            if len(payload) < length - begin:
                raise ValueError(f"{name}: ends inside the record {row['record_id']}")
            if self.verify and row["payload_digest"] != digest_of(payload):
                raise ValueError(f"{name}: the payload of {row['record_id']} doesn't have its digest")
        return {"payload_bytes": count, "payload": payload if self.payload else None}


GZIP = b"\x1f\x8b\x08"
#: The extra field of a member that says how long it is, as archives write it:
#: "sl" (skip lengths), the lengths of the compressed and of the plain member.
SKIP = b"sl"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """``data`` as one gzip member that says its lengths, so that a reader can
    step over it (beyond 4 GiB they can't be said)."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = deflate.compress(data) + deflate.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    whole = 10 + 2 + 4 + 8 + len(body) + len(tail)
    if max(whole, len(data)) >= 1 << 32:
        return GZIP + struct.pack("<BIBB", 0, 0, 0, 255) + body + tail
    extra = SKIP + struct.pack("<HII", 8, whole, len(data))
    return GZIP + struct.pack("<BIBBH", 4, 0, 0, 255, len(extra)) + extra + body + tail


class _Member:
    """Lines, reads and seeks over one gzip member, which is inflated as far as
    it is read and no further.  Seeks go forward, or back to what the buffer
    still holds: the record last begun."""

    def __init__(self, file, at: int, name: str, chunk: int = 1 << 14):
        self.file, self.name, self.chunk = file, name, chunk
        file.seek(at)
        head = file.read(10)
        if head[:3] != GZIP or len(head) < 10:
            raise ValueError(f"{name}: a gzip member was expected at byte {at}")
        self.start, self.ends_at, self.after = at + 10, None, None
        flags = head[3]
        if flags & 4:
            (size,) = struct.unpack("<H", file.read(2))
            extra, self.start = file.read(size), self.start + 2 + size
            while len(extra) >= 4:
                (own,) = struct.unpack("<H", extra[2:4])
                if extra[:2] == SKIP and own == 8:
                    whole, self.ends_at = struct.unpack("<II", extra[4:12])
                    self.after = at + whole
                extra = extra[4 + own :]
        for flag in (8, 16):  # a file name, a comment
            if flags & flag:
                while file.read(1) not in (b"\0", b""):
                    self.start += 1
                self.start += 1
        self.start += 2 if flags & 2 else 0
        self.packed, self.inflater = self.start, zlib.decompressobj(-zlib.MAX_WBITS)
        self.base, self.at, self.buffer, self.inflated, self.checksum = 0, 0, b"", 0, 0

    def _more(self) -> bool:
        while not self.inflater.eof:
            self.file.seek(self.packed)
            packed = self.file.read(self.chunk)
            if not packed:
                raise ValueError(f"{self.name}: ends inside a gzip member")
            self.packed += len(packed)
            new = self.inflater.decompress(packed)
            if self.inflater.eof:
                self.packed -= len(self.inflater.unused_data)
            if new:
                self.checksum = zlib.crc32(new, self.checksum)
                self.buffer += new
                self.inflated += len(new)
                return True
        return False

    def tell(self) -> int:
        return self.base + self.at

    def seek(self, to: int) -> None:
        while to > self.base + len(self.buffer):
            self.base, self.buffer = self.base + len(self.buffer), b""
            if not self._more():
                break
        self.at = min(to - self.base, len(self.buffer))
        if self.at > 4 * self.chunk:  # nothing before a place that was sought is read again
            self.base, self.buffer, self.at = self.base + self.at, self.buffer[self.at :], 0

    def readline(self) -> bytes:
        while (stop := self.buffer.find(b"\n", self.at)) < 0 and self._more():
            pass
        stop = len(self.buffer) if stop < 0 else stop + 1
        line, self.at = self.buffer[self.at : stop], stop
        return line

    def read(self, n: int) -> bytes:
        while len(self.buffer) - self.at < n and self._more():
            pass
        data = self.buffer[self.at : self.at + n]
        self.at += len(data)
        return data

    def ends_by(self, place: int) -> bool:
        """Whether the member is known to end there."""
        return self.ends_at is not None and place >= self.ends_at

    def next(self) -> int:
        """Where the next member begins: said by this one, or found by
        inflating it whole, when its checksum is compared too."""
        if self.after is not None:
            return self.after
        while self._more():
            self.base, self.buffer, self.at = self.base + len(self.buffer), b"", 0
        self.file.seek(self.packed)
        tail = self.file.read(8)
        if len(tail) < 8 or struct.unpack("<I", tail[:4])[0] != self.checksum:
            raise ValueError(f"{self.name}: a gzip member ending at byte {self.packed} is damaged")
        return self.packed + 8


def records(file, name: str):
    """``(stream, headers, start, length)`` of each record of an open archive,
    plain or of gzip members (one for each record, or for many)."""
    if file.read(3) != GZIP:
        stream = _Buffered(file)
        for found in Headers(stream, name):
            yield stream, *found
        return
    at, size = 0, file.size()
    while at < size:
        member = _Member(file, at, name)
        for found in Headers(member, name):
            yield member, *found
        at = member.next()


class _Buffered:
    """Lines, reads and seeks over an Arrow file through one small buffer, so
    that stepping over a block costs no read of it."""

    def __init__(self, file, size: int = 1 << 16):
        self.file, self.size, self.base, self.at, self.buffer = file, size, 0, 0, b""

    def ends_by(self, place: int) -> bool:
        return False

    def tell(self) -> int:
        return self.base + self.at

    def seek(self, to: int) -> None:
        if self.base <= to <= self.base + len(self.buffer):
            self.at = to - self.base
        else:
            self.base, self.at, self.buffer = to, 0, b""

    def _more(self) -> bool:
        end = self.base + len(self.buffer)
        self.file.seek(end)
        new = self.file.read(self.size)
        self.base, self.at, self.buffer = self.base + self.at, 0, self.buffer[self.at :] + new
        return bool(new)

    def readline(self) -> bytes:
        while (stop := self.buffer.find(b"\n", self.at)) < 0:
            if not self._more():
                stop = len(self.buffer) - 1
                break
        line = self.buffer[self.at : stop + 1]
        self.at = stop + 1
        return line

    def read(self, n: int) -> bytes:
        have = self.buffer[self.at : self.at + n]
        self.at += len(have)
        if len(have) == n:
            return have
        start = self.tell()
        self.file.seek(start)
        rest = self.file.read(n - len(have))
        self.base, self.at, self.buffer = start + len(rest), 0, b""
        return have + rest


_ARROW = pa.schema(
    [(n, pa.string()) for n in HEADERS] + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW)


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    """Writes rows with the source's columns (payload null for revisits)."""

    def __init__(self, options, overwrite: bool):
        self.path = options["path"]
        self.file_bytes = int(options.get("fileBytes", FILE_BYTES))
        self.compression = options.get("compression", "gzip")
        if self.compression not in ("gzip", "none"):
            raise ValueError(f"compression is gzip or none, not {self.compression!r}")
        system, root = open_fs(self.path)
        if system.get_file_info(f"{root}/{MANIFEST}").type != fs.FileType.NotFound and not overwrite:
            raise FileExistsError(f"{self.path} holds archives; write to another path or overwrite")
        system.create_dir(root, recursive=True)

    def write(self, iterator):
        system, root = open_fs(self.path)
        files, out, size, own = [], None, 0, uuid.uuid4().hex
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None or size > self.file_bytes:
                        if out is not None:
                            out.close()
                        ending = ".warc.gz" if self.compression == "gzip" else ".warc"
                        files.append(f"part-{own}-{len(files):05d}{ending}")
                        out, size = system.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                    data = record_bytes(
                        row["record_type"], row["record_id"] or "", row["target_uri"] or "", row["date"] or "", row["payload_digest"] or "",
                        row["refers_to"], row["payload_bytes"] or 0, row["payload"],
                    )
                    data = gzip_member(data) if self.compression == "gzip" else data
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages):
        system, root = open_fs(self.path)
        listed = sorted(f for m in messages if m is not None for f in m.files)
        with system.open_output_stream(f"{root}/{MANIFEST}") as s:
            s.write(json.dumps(listed).encode())

    def abort(self, messages):
        system, root = open_fs(self.path)
        for f in [f for m in messages if m is not None for f in m.files]:
            if system.get_file_info(f"{root}/{f}").type == fs.FileType.File:
                system.delete_file(f"{root}/{f}")


class WarcDataSource(DataSource):
    """Options: ``path``; for reading ``payload`` (default true), ``verify``
    (recompute digests, default false) and ``partitionBytes``; for writing
    ``fileBytes`` and ``compression`` (gzip, a member for each record, or none)."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, with predicates pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def records_of(pages: DataFrame, min_revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """``pages(page_id, url, html)`` as records of the source's columns.

    Of pages with equal payloads of at least ``min_revisit_bytes`` bytes, those
    with the largest page_id are responses and the others revisit it; smaller
    payloads are all responses.  A null html is an empty payload, a null url an
    empty target.  A null page_id is smaller than any other."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").alias("page"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), payload.alias("body"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("body")))
    # only payloads that occur more than once need to meet; their digests are
    # few beside the payloads, which stay where they are unless these digests
    # outgrow a broadcast
    counts = rows.groupBy("sha").agg(F.max("page").alias("first_page"), F.count(F.lit(1)).alias("n"))
    repeated = materialize(counts.where("n > 1").select(F.col("sha").alias("repeated"), "first_page"), "warc-repeated")
    joined = rows.join(small_side(repeated, "repeated"), F.col("sha") == F.col("repeated"), "left")
    whole = F.col("repeated").isNull() | F.col("page").eqNullSafe(F.col("first_page")) | (F.octet_length("body") < min_revisit_bytes)

    @F.pandas_udf("string")
    def base32(shas):
        return shas.map(lambda x: base64.b32encode(x).decode())

    def urn(column):
        return F.concat(F.lit("urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")))

    return joined.select(
        F.when(whole, "response").otherwise("revisit").alias("record_type"),
        urn("page").alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        base32("sha").alias("payload_digest"),
        F.when(~whole, urn("first_page")).alias("refers_to"),
        F.octet_length("body").cast("long").alias("payload_bytes"),
        F.when(whole, F.col("body")).alias("payload"),
    )


def page_of(urn: str):
    return F.expr(f"nullif(substring({urn}, {len('urn:page:') + 1}), '')")


def round_trip(pages: DataFrame, path: str | None = None, min_revisit_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` as archives under ``path`` (default: a new folder in the
    shared one), reads them back with all digests verified and returns one row
    per page: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Equal pages (same id and payload) are all responses; an empty table gives an
    empty archive and no rows; further columns of ``pages`` are not used."""
    spark = pages.sparkSession
    register(spark)
    path = path or scratch_path(spark, "warc")
    records_of(pages, min_revisit_bytes).write.format("warc").mode("append").save(path)
    back = spark.read.format("warc").option("payload", "false").option("verify", "true").load(path)
    kind = pages.schema["page_id"].dataType
    return back.select(
        page_of("record_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").cast(kind).alias("refers_to")
    )
