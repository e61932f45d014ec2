"""WARC archives as a Spark data source, written and read in parallel.

``spark.read.format("warc")`` plans one partition for each archive file and reads record headers first. Predicates on the
record type and on other header fields are pushed down: the payload of a record that fails them, or that no requested column
needs, is neither decompressed nor decoded, but skipped. ``df.write.format("warc")`` writes one gzip member for each record, whose
extra field "sl" holds the member's length, so that skipping is a seek; archives of other writers, without it or without
compression, are read as well.

Files of failed or repeated tasks do no harm: a task writes under names of its own, and the manifest, written when all tasks have
ended, names the files that count.
"""

from __future__ import annotations

import json
import posixpath
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from reelstat.llm.storage import materialise, shared_path

MANIFEST = "_MANIFEST"
#: Size at which a task begins a further archive, bytes decompressed at once, and payload bytes in a batch of rows.
ARCHIVE_BYTES = 256 << 20
PIECE = 1 << 16
BATCH_BYTES = 8 << 20
#: Columns known from the header alone, and all columns.
HEADER = "warc_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string"
SCHEMA = f"{HEADER}, payload_bytes long, payload binary, file string"

# Fixed names of the WARC format.
FIELDS = {
    "warc_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}
HTTP_TYPE = "application/http;msgtype=response"


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return pafs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]*:/", path) else (pafs.LocalFileSystem(), posixpath.abspath(path))


# --- writing


def _record(row: dict) -> bytes:
    """One record as text, in the order of the format: fields, blank line, block, two line ends."""
    payload = row["payload"] or b""
    size = row["payload_bytes"] if row["payload_bytes"] is not None else len(payload)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    if row["warc_type"] != "revisit":
        block += payload
    named = [(f, row[c]) for c, f in FIELDS.items() if row[c] is not None]
    if row["warc_type"] == "revisit":
        named.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    lines = [f"{f}: {re.sub(r'[\r\n]+', ' ', v)}" for f, v in [*named, ("Content-Type", HTTP_TYPE), ("Content-Length", str(len(block)))]]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n\r\n"


def _member(record: bytes, level: int) -> bytes:
    """A gzip member with its own and the record's length in the extra field "sl"."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = deflate.compress(record) + deflate.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total, len(record) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


class _Committed(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.level = int(options.get("level", "1"))
        self.zipped = options.get("compression", "gzip") == "gzip"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Committed:
        fs, root = _filesystem(self.path)
        fs.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    files.append(f"part-{uuid.uuid4().hex}.warc{'.gz' if self.zipped else ''}")
                    out, size = fs.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                record = _record(row)
                data = _member(record, self.level) if self.zipped else record
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
        return _Committed(files)

    def commit(self, messages: list) -> None:
        fs, root = _filesystem(self.path)
        fs.create_dir(root, recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        if not self.overwrite:
            files = (_listed(fs, root) or []) + files
        with fs.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list) -> None:
        fs, root = _filesystem(self.path)
        for f in (f for m in messages if m is not None for f in m.files):
            fs.delete_file(f"{root}/{f}")


def _listed(fs: pafs.FileSystem, root: str) -> list[str] | None:
    """The files a manifest names; None without one."""
    if fs.get_file_info(f"{root}/{MANIFEST}").type == pafs.FileType.NotFound:
        return None
    with fs.open_input_stream(f"{root}/{MANIFEST}") as found:
        return json.loads(found.read())


# --- reading


class _Archive(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)


class _Block:
    """Bytes of one record on demand: ``upto`` gives all up to and with a mark, ``take`` the next n."""

    def __init__(self, more: Callable[[], bytes]):
        self.more, self.held = more, b""

    def upto(self, mark: bytes) -> bytes:
        start = 0
        while (at := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark))
            piece = self.more()
            if not piece:
                return b""
            self.held += piece
        found, self.held = self.held[: at + len(mark)], self.held[at + len(mark) :]
        return found

    def take(self, n: int) -> bytes:
        pieces = [self.held]
        have = len(self.held)
        while have < n and (piece := self.more()):
            pieces.append(piece)
            have += len(piece)
        data = b"".join(pieces)
        self.held = data[n:]
        return data[:n]


def _zipped(file) -> Iterator[tuple[_Block, Callable[[int, int], None] | None]]:
    """The members of a gzip archive, one record each."""
    at = 0
    while True:
        file.seek(at)
        head = file.read(PIECE // 16)
        if not head:
            return
        length = None
        if len(head) >= 12 and head[3] & 4:
            (extra,) = struct.unpack_from("<H", head, 10)
            if head[12:14] == b"sl" and extra >= 12:
                (length,) = struct.unpack_from("<I", head, 16)
        inflate = zlib.decompressobj(zlib.MAX_WBITS | 16)
        state = {"read": len(head), "next": head}

        def more() -> bytes:
            while not inflate.eof:  # noqa: B023
                data, state["next"] = state["next"] or file.read(PIECE), b""  # noqa: B023
                if not data:
                    return b""
                state["read"] = file.tell() - at  # noqa: B023
                if piece := inflate.decompress(data):  # noqa: B023
                    return piece
            return b""

        yield _Block(more), None
        if length is None:  # decompress what was left, to find the end
            while more():
                pass
            length = state["read"] - len(inflate.unused_data)
        at += length


def _plain(file) -> Iterator[tuple[_Block, Callable[[int, int], None] | None]]:
    """The records of an uncompressed archive; the caller tells each block's length with the second value."""
    at = 0
    while True:
        file.seek(at)
        state = {"size": None, "head": 0}
        block = _Block(lambda: file.read(PIECE))

        def known(size: int, head: int) -> None:
            state["size"], state["head"] = size, head  # noqa: B023

        yield block, known
        if state["size"] is None:
            return
        at += state["head"] + state["size"] + 4


def _header(text: bytes) -> dict[str, str]:
    fields = {}
    for line in text.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    return fields


def _holds(kind: str, value, wanted) -> bool:
    """A pushed predicate on a header column; as in SQL, a comparison with an absent value does not hold."""
    if kind in ("null", "given"):
        return (value is None) == (kind == "null")
    if value is None:
        return False
    tests = {
        "in": lambda: value in wanted,
        "starts": lambda: value.startswith(wanted),
        "ends": lambda: value.endswith(wanted),
        "contains": lambda: wanted in value,
        "gt": lambda: value > wanted,
        "ge": lambda: value >= wanted,
        "lt": lambda: value < wanted,
        "le": lambda: value <= wanted,
    }
    return tests[kind]()


_PUSHED = {StringStartsWith: "starts", StringEndsWith: "ends", StringContains: "contains", GreaterThan: "gt", GreaterThanOrEqual: "ge", LessThan: "lt", LessThanOrEqual: "le"}


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.schema, self.tests = options["path"], schema, []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else None
            if column not in FIELDS:
                yield f
            elif isinstance(f, (EqualTo, In)):
                self.tests.append((column, "in", tuple(f.value) if isinstance(f, In) else (f.value,)))
            elif isinstance(f, (IsNull, IsNotNull)):
                self.tests.append((column, "null" if isinstance(f, IsNull) else "given", None))
            elif type(f) in _PUSHED:
                self.tests.append((column, _PUSHED[type(f)], f.value))
            else:
                yield f

    def partitions(self) -> list[_Archive]:
        fs, root = _filesystem(self.path)
        info = fs.get_file_info(root)
        if info.type == pafs.FileType.File:
            return [_Archive(self.path)]
        files = _listed(fs, root)
        if files is None:
            found = fs.get_file_info(pafs.FileSelector(root))
            files = [f.base_name for f in found if f.type == pafs.FileType.File and re.search(r"\.warc(\.gz)?$", f.base_name)]
        return [_Archive(f"{self.path.rstrip('/')}/{f}") for f in files] or [_Archive("")]

    def read(self, partition: _Archive) -> Iterator[pa.RecordBatch]:
        if not partition.value:
            return
        columns = self.schema.fieldNames()
        types = {"payload": pa.binary(), "payload_bytes": pa.int64()}
        schema = pa.schema([(c, types.get(c, pa.string())) for c in columns])
        rows, size = [], 0
        for row in self._records(partition.value, set(columns)):
            rows.append({c: row.get(c) for c in columns})
            size += 200 + len(row.get("payload") or b"")
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    def _records(self, path: str, columns: set[str]) -> Iterator[dict]:
        fs, name = _filesystem(path)
        with fs.open_input_file(name) as file:
            zipped = file.read(2) == b"\x1f\x8b"
            for block, known in (_zipped if zipped else _plain)(file):
                head = block.upto(b"\r\n\r\n")
                fields = _header(head)
                if not fields:
                    continue
                length = int(fields.get("content-length", "0"))
                if not zipped:
                    known(length, len(head))
                row = {c: fields.get(f.lower()) for c, f in FIELDS.items()}
                if not all(_holds(kind, row[c], wanted) for c, kind, wanted in self.tests):
                    continue
                row["file"] = path
                if columns & {"payload", "payload_bytes"}:
                    http = b""
                    if fields.get("content-type", "").replace(" ", "").lower() == HTTP_TYPE:
                        http = block.upto(b"\r\n\r\n")
                    stated = _header(http).get("content-length", "")
                    row["payload_bytes"] = int(stated) if stated.isdigit() else length - len(http)
                    if "payload" in columns:
                        row["payload"] = block.take(length - len(http))
                yield row


class WarcSource(DataSource):
    """Options: ``path`` (an archive, or a folder of them), for writing also ``compression`` (gzip or none) and ``level``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make the source known to a session, and let Spark offer it predicates."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# --- pages


def page_records(pages: DataFrame, least: int = 1000) -> DataFrame:
    """A record for each row of ``pages`` (page_id, url, html), ready to be written.

    The payload is the html in UTF-8 (null: empty). Of records with equal payloads of ``least`` bytes or more the one with the
    largest page_id is a response and the others revisit it, without a block of their own; all smaller ones are responses. Rows
    equal to that response in page_id are responses too, and rows with a null page_id revisit it if there is one.

    The choice is made on digests; the html is shuffled once, to meet it.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    digests = pages.select("page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("size"))
    digests = materialise(digests, "digests")
    original = digests.where(F.col("size") >= least).groupBy("digest", "size").agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
    again = digests.join(original.where("n > 1 and original is not null"), ["digest", "size"])
    again = again.where("page_id is null or page_id <> original").select("digest", "size", "original").distinct()
    digest, size = F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("size")
    joined = pages.select("*", digest, size).join(again, ["digest", "size"], "left")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    urn = lambda c: F.concat(F.lit("urn:x-page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")))
    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("warc_type"),
        F.concat(F.lit("<"), urn("page_id"), F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit("1970-01-01T00:00:00Z").alias("date"),
        F.when(revisit, F.concat(F.lit("<"), urn("original"), F.lit(">"))).alias("refers_to"),
        F.concat(F.lit("sha1:"), _base32("digest")).alias("payload_digest"),
        F.col("size").alias("payload_bytes"),
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.lit(None).cast("string").alias("file"),
    )


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # the alphabet of RFC 4648


def _base32(digest: str):
    """A hexadecimal digest in base 32, five bytes at a time."""
    parts = []
    for i in range(0, 40, 10):
        number = F.conv(F.substring(digest, i + 1, 10), 16, 32)
        parts.append(F.lpad(F.upper(number), 8, "0"))
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def hex_digest(column: str):
    """The hexadecimal form of a ``sha1:`` digest in base 32."""
    text = F.translate(F.substring(column, 6, 32), _BASE32, "0123456789ABCDEFGHIJKLMNOPQRSTUV")
    return F.lower(F.concat(*(F.lpad(F.conv(F.substring(text, i + 1, 8), 32, 16), 10, "0") for i in range(0, 32, 8))))


def archived(pages: DataFrame, least: int = 1000, path: str | None = None) -> DataFrame:
    """Write the pages to archives and read all records back: page_id, payload_bytes, payload_digest (hexadecimal SHA-1), record_type,
    refers_to. Size and digest of a response are those of the payload read; a revisit has them in its headers.

    An empty table gives empty archives and an empty result.
    """
    spark = pages.sparkSession
    register(spark)
    path = path or shared_path(spark, "warc")
    page_records(pages, least).write.format("warc").mode("append").save(path)
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, 'urn:x-page:(-?[0-9]+)', 1) as bigint)")
    whole = spark.read.format("warc").load(path).where("warc_type = 'response'")
    responses = whole.select(
        page("record_id").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"),
    )
    headers = spark.read.format("warc").schema(f"{HEADER}, payload_bytes long").load(path).where("warc_type = 'revisit'")
    revisits = headers.select(
        page("record_id").alias("page_id"), "payload_bytes", hex_digest("payload_digest"), "warc_type", page("refers_to").alias("refers_to")
    )
    return responses.union(revisits)
