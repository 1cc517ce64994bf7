"""WARC archives as a Spark data source.

Reading plans whole files into partitions of about equal bytes, takes over predicates on the
record type and the other header fields, parses a record's headers first, and passes over the
payload of a record that no predicate keeps: a plain record by its length, a gzip member by the
length in its extra field, without inflating it. Members of other writers, which lack the field,
are inflated and dropped.

Writing gives each task its own files. They count only once the driver has committed the job, by
a manifest that names them; what lost or repeated attempts leave behind is in no manifest.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

SCHEMA = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
# Names and marks of the format.
_HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "content_type": "Content-Type",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
_VERSION = b"WARC/1.1"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "application/http;msgtype=response"
_END = b"\r\n\r\n"
_GZIP = b"\x1f\x8b\x08"

#: Subfield of a gzip member's extra field with the member's own length.
_LENGTH_FIELD = b"sl"
MANIFEST = "_manifest"
PARTITION_BYTES = 64 * 1024 * 1024
FILE_BYTES = 1024 * 1024 * 1024
BATCH_BYTES = 8 * 1024 * 1024
HEAD_BYTES = 2048


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- records ----------------------------------------------------------------------------------


def _line(value: str) -> str:
    """A header value on one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(row: dict) -> bytes:
    """A response with its payload, or a revisit with the HTTP header of what it repeats."""
    payload = row["payload"] or b""
    digest = row["payload_digest"] or f"sha1:{sha1_base32(payload)}"
    length = len(payload) if row["payload_bytes"] is None else row["payload_bytes"]
    http = (
        "HTTP/1.1 200 OK\r\n"
        f"Content-Type: {_line(row['content_type'] or 'application/octet-stream')}\r\n"
        f"Content-Length: {length}\r\n\r\n"
    ).encode()
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", row["record_id"]),
        ("WARC-Date", row["date"]),
        ("WARC-Target-URI", row["target_uri"]),
        ("WARC-Payload-Digest", digest),
        ("WARC-Refers-To", row["refers_to"]),
        ("WARC-Profile", _REVISIT if revisit else None),
        ("Content-Type", _HTTP),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{k}: {_line(v)}\r\n" for k, v in fields if v is not None)
    return b"".join([_VERSION, b"\r\n", head.encode(), b"\r\n", block, _END])


def gzip_member(data: bytes, level: int) -> bytes:
    """A gzip member that says in its extra field how long it is."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = packer.compress(data) + packer.flush()
    extra = len(_LENGTH_FIELD) + 2 + 8
    total = 12 + extra + len(body) + 8
    field = _LENGTH_FIELD + struct.pack("<HQ", 8, total)
    head = _GZIP + struct.pack("<BIBBH", 4, 0, 0, 255, extra) + field
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _fields(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name; the last of a name counts."""
    out = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            out[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode(
                "utf-8", "replace"
            )
    return out


class _Source:
    """Bytes of one record: all of the file's for a plain one, a member's inflated ones else."""

    def __init__(self, file):
        self.file = file
        self.at = file.tell()
        start = file.read(12)
        self.gzip = start[:3] == _GZIP
        self.empty = not start
        self.member = None
        self.buffer = b""
        if self.gzip:
            extra = b""
            if start[3] & 4:
                extra = file.read(struct.unpack("<H", start[10:12])[0])
            self.member = self._length(extra)
            self.inflate = zlib.decompressobj(zlib.MAX_WBITS | 16)
        file.seek(self.at)

    @staticmethod
    def _length(extra: bytes) -> int | None:
        at = 0
        while at + 4 <= len(extra):
            (size,) = struct.unpack("<H", extra[at + 2 : at + 4])
            if extra[at : at + 2] == _LENGTH_FIELD and size == 8:
                return struct.unpack("<Q", extra[at + 4 : at + 12])[0]
            at += 4 + size
        return None

    def _more(self, want: int) -> bool:
        """Reads on; False at the end of the member or the file."""
        if not self.gzip:
            data = self.file.read(max(want, HEAD_BYTES))
            self.buffer += data
            return bool(data)
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self.file.read(max(want // 4, HEAD_BYTES))
        if not data:
            raise ValueError(f"a record at byte {self.at} is cut off")
        self.buffer += self.inflate.decompress(data, max(want, HEAD_BYTES))
        return True

    def until(self, mark: bytes) -> bytes:
        """What stands before the mark, which is passed."""
        while (found := self.buffer.find(mark)) < 0:
            if not self._more(HEAD_BYTES):
                raise ValueError(f"a record at byte {self.at} is cut off")
        out, self.buffer = self.buffer[:found], self.buffer[found + len(mark) :]
        return out

    def take(self, size: int) -> bytes:
        parts, have = [self.buffer], len(self.buffer)
        self.buffer = b""
        while have < size:
            if not self._more(size - have):
                raise ValueError(f"a record at byte {self.at} is cut off")
            parts.append(self.buffer)
            have += len(self.buffer)
            self.buffer = b""
        data = b"".join(parts)
        self.buffer = data[size:]
        return data[:size]

    def leave(self, block: int, taken: int) -> None:
        """Moves the file behind the record, of whose block `taken` bytes were taken."""
        if not self.gzip:
            end = self.file.tell() - len(self.buffer) + (block - taken) + len(_END)
            self.file.seek(end)
        elif self.member is not None:
            self.file.seek(self.at + self.member)
        else:
            while not self.inflate.eof:
                self.buffer = b""
                self._more(1 << 16)
            self.file.seek(self.file.tell() - len(self.inflate.unused_data))


def records(file, keep=lambda row: True, payload: str = "read") -> Iterator[dict]:
    """The records of an open archive that `keep` accepts by their header fields.

    `payload` is "read", "verify" (read and held against digest and length, then dropped), or
    "skip". Records of other types than responses have no payload here.
    """
    while True:
        source = _Source(file)
        if source.empty:
            return
        head = source.until(_END)
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {source.at}")
        fields = _fields(head)
        block, taken = int(fields.get("content-length", 0)), 0
        row = {name: fields.get(field.lower()) for name, field in _HEADERS.items()}
        for name in ("record_id", "refers_to"):
            if row[name]:
                row[name] = row[name].removeprefix("<").removesuffix(">")
        if keep(row):
            row["payload_bytes"] = row["payload"] = None
            if row["content_type"] and row["content_type"].startswith("application/http"):
                http = source.until(_END)
                taken = len(http) + len(_END)
                inner = _fields(http)
                row["content_type"] = inner.get("content-type")
                length = inner.get("content-length")
                row["payload_bytes"] = int(length) if length else None
            if row["record_type"] == "response" and payload != "skip":
                data = source.take(block - taken)
                taken = block
                if payload == "verify":
                    _verify(row, data)
                else:
                    row["payload"] = data
                row["payload_bytes"] = len(data)
            yield row
        source.leave(block, taken)


def _verify(row: dict, data: bytes) -> None:
    digest = row["payload_digest"]
    if digest and digest.startswith("sha1:") and digest[5:] != sha1_base32(data):
        raise ValueError(f"the payload of {row['record_id']} does not have its digest")
    if row["payload_bytes"] not in (None, len(data)):
        raise ValueError(f"the payload of {row['record_id']} does not have its length")


# ---- data source ------------------------------------------------------------------------------


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    plain = "://" not in uri and not uri.startswith("file:")
    return fs.FileSystem.from_uri(f"file://{uri}" if plain else uri)


def _files(uri: str) -> list[tuple[str, int]]:
    """Files and sizes: those of the manifests, or in a folder without any, all archives."""
    store, root = _open(uri)
    if store.get_file_info(root).type == fs.FileType.File:
        return [(root, store.get_file_info(root).size)]
    listed = store.get_file_info(fs.FileSelector(root, recursive=True))
    manifests = [i for i in listed if i.base_name.startswith(MANIFEST)]
    if not manifests:
        names = (".warc", ".warc.gz")
        return sorted((i.path, i.size) for i in listed if i.is_file and i.path.endswith(names))
    found: list[tuple[str, int]] = []
    for info in manifests:
        with store.open_input_stream(info.path) as file:
            found += [(f"{root}/{name}", size) for name, size in json.loads(file.read())]
    return sorted(found)


def _matches(name: str, test: Filter):
    """A check of one header field, or None if the filter is of another kind."""
    kind, value = type(test), getattr(test, "value", None)
    checks = {
        EqualTo: lambda v: v is not None and v == value,
        EqualNullSafe: lambda v: v == value,
        In: lambda v: v is not None and v in value,
        IsNotNull: lambda v: v is not None,
        IsNull: lambda v: v is None,
        StringStartsWith: lambda v: v is not None and v.startswith(value),
        StringEndsWith: lambda v: v is not None and v.endswith(value),
        StringContains: lambda v: v is not None and value in v,
    }
    check = checks.get(kind)
    return None if check is None else (name, check)


@dataclass
class _Files(InputPartition):
    files: list[tuple[str, int]]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.uri = options["path"]
        self.payload = options.get("payload", "read")
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        # The content type of a row is that of the payload, which stands behind the header.
        own = set(_HEADERS) - {"content_type"}
        for test in filters:
            name = test.attribute[0] if len(getattr(test, "attribute", ())) == 1 else None
            if name in own and _matches(name, test):
                self.filters.append(test)
            else:
                yield test

    def partitions(self) -> list[InputPartition]:
        """Files are dealt out by size, the largest first, each to the emptiest partition."""
        files = _files(self.uri)
        total = sum(size for _, size in files)
        count = max(1, min(len(files), -(-total // self.partition_bytes)))
        bins: list[list] = [[0, k, []] for k in range(count)]
        for path, size in sorted(files, key=lambda f: (-f[1], f[0])):
            least = heapq.heappop(bins)
            least[0] += size
            least[2].append((path, size))
            heapq.heappush(bins, least)
        return [_Files(files) for _, _, files in bins if files]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        tests = [_matches(f.attribute[0], f) for f in self.filters]

        def keep(row: dict) -> bool:
            return all(check(row[name]) for name, check in tests)

        store, _ = _open(self.uri)
        rows: list[dict] = []
        filled = 0
        for path, _ in partition.files if partition else ():
            with io.BufferedReader(_Raw(store.open_input_file(path)), 1 << 20) as file:
                for row in records(file, keep, self.payload):
                    rows.append(row)
                    filled += 200 + len(row["payload"] or b"")
                    if filled >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, filled = [], 0
        if rows:
            yield _batch(rows)


class _Raw(io.RawIOBase):
    """An Arrow file for io.BufferedReader, so that seeks inside its buffer read nothing."""

    def __init__(self, file):
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)

    def seek(self, offset: int, whence: int = 0) -> int:
        self.file.seek(offset, whence)
        return self.file.tell()

    def tell(self) -> int:
        return self.file.tell()

    def close(self) -> None:
        if not self.closed:
            self.file.close()
        super().close()


_KINDS = {"payload_bytes": pa.int64(), "payload": pa.binary()}
_ARROW = pa.schema([(f.name, _KINDS.get(f.name, pa.string())) for f in SCHEMA.fields])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _ARROW)


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.uri = options["path"]
        self.level = int(options.get("level", 3))
        self.file_bytes = int(options.get("filebytes", FILE_BYTES))
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        store, root = _open(self.uri)
        store.create_dir(root, recursive=True)
        files: list[tuple[str, int]] = []
        out, name, size = None, "", 0
        suffix = ".warc.gz" if self.level else ".warc"
        for batch in iterator:
            for start in range(0, batch.num_rows, 256):
                for row in batch.slice(start, 256).to_pylist():
                    if out is None:
                        name, size = f"part-{uuid.uuid4().hex}{suffix}", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    data = record_bytes(row)
                    data = gzip_member(data, self.level) if self.level else data
                    out.write(data)
                    size += len(data)
                    if size >= self.file_bytes:
                        out.close()
                        files.append((name, size))
                        out = None
        if out is not None:
            out.close()
            files.append((name, size))
        return _Written(files)

    def commit(self, messages: list[_Written]) -> None:
        store, root = _open(self.uri)
        store.create_dir(root, recursive=True)
        old = []
        if self.overwrite:
            listed = store.get_file_info(fs.FileSelector(root))
            old = [i.path for i in listed if i.base_name.startswith(MANIFEST)]
        files = [f for m in messages if m is not None for f in m.files]
        with store.open_output_stream(f"{root}/{MANIFEST}-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())
        for path in old:
            store.delete_file(path)

    def abort(self, messages: list[_Written]) -> None:
        store, root = _open(self.uri)
        for message in messages:
            for name, _ in message.files if message else ():
                store.delete_file(f"{root}/{name}")


class WarcSource(DataSource):
    """spark.read.format("warc"): options `path`, `payload` (read, verify or skip) and
    `partitionBytes`; for writing `path`, `level` (gzip, 0 for plain) and `fileBytes`."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format known, and lets predicates reach it."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, path: str, **options: str) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def write(records_: DataFrame, path: str, mode: str = "append", **options: str) -> None:
    """Writes rows of SCHEMA; a null digest or length is taken from the payload."""
    register(records_.sparkSession)
    records_.select(*SCHEMA.names).write.format("warc").mode(mode).options(**options).save(path)


# ---- pages ------------------------------------------------------------------------------------

PAGE = "urn:x-page:"


def page_records(
    pages: DataFrame,
    date: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """A record per page: of equal payloads of at least `least_bytes`, that of the largest id is
    the response, the others revisit it without their payload; smaller ones are all responses.

    A null html is an empty payload, a null url an absent header. Pages without an id are
    responses only among themselves; rows that repeat the response's id are responses, too. The
    payload moves once, to the partition of its hash; adaptive execution cuts that of a payload
    with many copies.
    """
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("target_uri"),
        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("body"),
    ).withColumn("hash", F.sha2("body", 256))
    shared = F.octet_length("body") >= least_bytes
    first = rows.filter(shared).groupBy("hash").agg(F.max("id").alias("first"))
    joined = rows.join(first, "hash", "left")
    revisit = shared & F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    digest = F.sha1("body")
    return joined.select(
        _page("id").alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.lit(date).alias("date"),
        F.lit("text/html; charset=utf-8").alias("content_type"),
        F.when(revisit, F.concat(F.lit("sha1:"), _base32(digest))).alias("payload_digest"),
        F.when(revisit, _page("first")).alias("refers_to"),
        F.octet_length("body").cast("long").alias("payload_bytes"),
        F.when(~revisit, F.col("body")).alias("payload"),
    )


def _page(column: str) -> Column:
    number = F.coalesce(F.col(column).cast("string"), F.lit("none"))
    return F.concat(F.lit(f"<{PAGE}"), number, F.lit(">"))


def _base32(hex_: Column) -> Column:
    """The upper-case base32 of 40 hexadecimal digits: each five of them are four of 32."""
    digits = F.transform(
        F.sequence(F.lit(0), F.lit(7)),
        lambda k: F.upper(F.lpad(F.conv(F.substring(hex_, k * 5 + 1, F.lit(5)), 16, 32), 4, "0")),
    )
    ours, theirs = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return F.translate(F.array_join(digits, ""), ours, theirs)


def page_ids(column: str) -> Column:
    """The id in a page's record name, null if it has none."""
    number = F.regexp_extract(column, rf"^{PAGE}(-?\d+)$", 1)
    return F.when(number != "", number.cast("long"))
