"""WARC archives as a Spark data source.

``df.write.format("warc")`` writes one gzip member per record, with the
member's size in the gzip header's ``sl`` field, and a list of the files once
all tasks are done.  ``spark.read.format("warc")`` plans groups of files as
partitions, takes over predicates on record type and other header columns,
and inflates a record's headers first: a record that a predicate drops, or
whose payload is not in the schema, is skipped by its size without inflating
its payload.

Archives of other writers (plain, one gzip member per record, or members of
many records) have no such sizes.  They are read block by block in one pass
per file, in time linear in its size: gzip must be inflated to find the next
record, but unwanted payloads are dropped as they come.  Such a file is one
task, since only its start is known to begin a record.
"""

from __future__ import annotations

import itertools
import json
import operator
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, IsNull, LessThan, LessThanOrEqual, StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from pulsemart.llm.common import files, write_file

SCHEMA = (
    "page_id long, url string, record_type string, payload_digest string, refers_to long, payload_bytes long, payload binary"
)
#: Payloads under this size are never written as revisits.
REVISIT_BYTES = 100
#: A writer begins another file beyond this size; a read partition holds files up to it.
FILE_BYTES = 64 << 20
#: Archives of other writers are read in blocks of this size, and inflated in pieces of at most ``PIECE_BYTES``.
BLOCK_BYTES, PIECE_BYTES = 16 << 10, 1 << 20
#: Headers of a record end within so many bytes, or the file is refused.
HEADER_BYTES = 1 << 20
_ID = "<urn:page:{}>"
_BLANK = b"\r\n\r\n"
#: What a header column is compared with; a missing value passes none of these.
_TESTS = {
    EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt,
    LessThanOrEqual: operator.le, In: lambda value, listed: value in listed, StringStartsWith: str.startswith,
}


def _record(row: dict) -> bytes:
    """One record as a gzip member."""
    payload = row["payload"] if row["record_type"] == "response" else None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % row["payload_bytes"]
    page = "" if row["page_id"] is None else row["page_id"]
    block = http + (payload or b"")
    headers = [
        ("WARC-Type", row["record_type"]), ("WARC-Record-ID", _ID.format(page)), ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", None if row["url"] is None else quote(row["url"], safe="".join(map(chr, range(33, 127))))),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
        ("WARC-Refers-To", None if row["refers_to"] is None else _ID.format(row["refers_to"])),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if payload is None else None),
        ("X-Payload-Length", row["payload_bytes"]), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block)),
    ]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None) + "\r\n"
    plain = text.encode() + block + b"\r\n\r\n"
    deflate = zlib.compressobj(4, zlib.DEFLATED, -15)
    body = deflate.compress(plain) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size, len(plain) & 0xFFFFFFFF)
    return (
        b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", len(extra)) + extra + body
        + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)
    )


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str) -> None:
        self.folder = folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        task, names, records = TaskContext.get().partitionId(), [], []

        def close() -> None:
            names.append(f"{task:05d}-{len(names):04d}.warc.gz")
            write_file(self.folder, names[-1], records)
            records.clear()

        held = 0
        for batch in iterator:
            columns = [batch.column(n) for n in batch.schema.names]
            for i in range(batch.num_rows):  # a row at a time: payloads are not copied into a list
                records.append(_record({n: c[i].as_py() for n, c in zip(batch.schema.names, columns, strict=True)}))
                held += len(records[-1])
                if held >= FILE_BYTES:
                    close()
                    held = 0
        if records:
            close()
        return _Written(names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        names = sorted(n for m in messages if m for n in m.names)
        fs, path = files(self.folder)
        fs.create_dir(path, recursive=True)
        write_file(self.folder, "files.json", [json.dumps(names).encode()])


@dataclass
class _Group(InputPartition):
    names: list[str]

    def __init__(self, names: list[str]) -> None:
        self.names = names


class _Reader(DataSourceReader):
    def __init__(self, folder: str, schema: StructType) -> None:
        self.folder, self.columns, self.filters = folder, schema.names, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """Take over what headers can answer; the rest stays with Spark."""
        for f in filters:
            if type(f) in (*_TESTS, IsNull, IsNotNull) and f.attribute != ("payload",):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, path = files(self.folder)
        found = [i for i in fs.get_file_info(pyarrow.fs.FileSelector(path)) if i.base_name.endswith((".warc.gz", ".warc"))]
        listed = [i for i in fs.get_file_info([f"{path}/files.json"]) if i.type == pyarrow.fs.FileType.File]
        if listed:  # files of attempts that were not committed are not listed
            with fs.open_input_stream(listed[0].path) as source:
                names = set(json.loads(source.read()))
            found = [i for i in found if i.base_name in names]
        groups, size = [_Group([])], 0
        for info in sorted(found, key=lambda i: i.base_name):
            if groups[-1].names and size + info.size > FILE_BYTES:
                groups.append(_Group([]))
                size = 0
            groups[-1].names.append(info.base_name)
            size += info.size
        return groups

    def read(self, partition: _Group) -> Iterator[pa.RecordBatch]:
        fs, path = files(self.folder)
        kinds = pa.schema([
            ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
            ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
        ])
        kinds = pa.schema([kinds.field(c) for c in self.columns])
        rows, held = [], 0
        for name in partition.names:
            with fs.open_input_file(f"{path}/{name}") as source:
                for headers, payload in self._records(source):
                    rows.append({**headers, "payload": payload})
                    held += len(payload or b"") + 200
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    def _records(self, source: pa.NativeFile) -> Iterator[tuple[dict, bytes | None]]:
        with_payload = "payload" in self.columns
        start = source.read(HEADER_START)
        if _member(memoryview(start), 0)[1] is not None:  # of our writer, which bounds its files
            source.seek(0)
            return records(memoryview(source.read_buffer()), self._wanted, with_payload)
        rest = iter(lambda: source.read(BLOCK_BYTES), b"")
        return streamed(itertools.chain([start], rest), self._wanted, with_payload)

    def _wanted(self, headers: dict) -> bool:
        for f in self.filters:
            value = headers[f.attribute[0]]
            if isinstance(f, IsNull):
                passes = value is None
            elif isinstance(f, IsNotNull):
                passes = value is not None
            else:
                passes = value is not None and _TESTS[type(f)](value, f.value)
            if not passes:
                return False
        return True


def _page(value: str | None) -> int | None:
    digits = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits.lstrip("-").isdigit() else None


def _described(head: bytes) -> tuple[dict, int]:
    """Header columns of a record, and the length of its block.

    Names of fields count in any case.  What a header lacks is null.
    """
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, colon, v in (line.partition(":") for line in lines) if colon}
    size = fields.get("x-payload-length")
    return {
        "page_id": _page(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"), "record_type": fields.get("warc-type"),
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
        "refers_to": _page(fields.get("warc-refers-to")), "payload_bytes": int(size) if size else None,
    }, int(fields.get("content-length", 0))


def _payload(block: bytes) -> bytes:
    """The block without the HTTP headers before it."""
    return block.partition(_BLANK)[2]


#: The size field of our writer lies within so many bytes of a member's start.
HEADER_START = 24


def _member(data: memoryview, at: int) -> tuple[int, int | None]:
    """Where the compressed bytes of a gzip member of our writer begin, and its size; no size for anything else."""
    if bytes(data[at:at + 4]) != b"\x1f\x8b\x08\x04" or bytes(data[at + 12:at + 14]) != b"sl":
        return at, None
    length, = struct.unpack_from("<H", data, at + 10)
    return at + 12 + length, struct.unpack_from("<I", data, at + 16)[0]


def records(data: memoryview, wanted, with_payload: bool) -> Iterator[tuple[dict, bytes | None]]:
    """Headers and payload of the records of one file for which ``wanted(headers)`` holds.

    From the first member without the size field on, the rest is read as ``streamed`` does.  Revisits have no payload.
    """
    at = 0
    while at < len(data):
        body, size = _member(data, at)
        if size is None:
            blocks = (bytes(data[i:i + BLOCK_BYTES]) for i in range(at, len(data), BLOCK_BYTES))
            yield from streamed(blocks, wanted, with_payload)
            return
        inflate = zlib.decompressobj(-15)
        plain, fed, end = b"", body, at + size
        while _BLANK not in plain and fed < end:
            step = min(end, fed + 1024)
            plain += inflate.decompress(data[fed:step])
            fed = step
        head, _, block = plain.partition(_BLANK)
        headers, length = _described(head)
        if wanted(headers):
            whole = with_payload and headers["record_type"] == "response"
            yield headers, _payload((block + inflate.decompress(data[fed:end]))[:length]) if whole else None
        at = end


def _inflated(blocks: Iterable[bytes]) -> Iterator[bytes]:
    """The plain bytes of a file, in pieces: gzip members one after the other, or a file that is not compressed."""
    blocks, start = iter(blocks), b""
    while len(start) < 2 and (block := next(blocks, None)) is not None:
        start += block
    compressed, inflate = start.startswith(b"\x1f\x8b"), None
    for block in itertools.chain([start], blocks):
        if not compressed:
            yield block
            continue
        while block:
            if inflate is None:
                block = block.lstrip(b"\0")  # padding between members
                if not block:
                    break
                inflate = zlib.decompressobj(31)
            yield inflate.decompress(block, PIECE_BYTES)
            block = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
            if inflate.eof:
                inflate = None
    if inflate is not None:
        while piece := inflate.decompress(inflate.unconsumed_tail, PIECE_BYTES):
            yield piece
        if not inflate.eof:
            raise ValueError("the archive ends inside a gzip member")


def streamed(blocks: Iterable[bytes], wanted, with_payload: bool) -> Iterator[tuple[dict, bytes | None]]:
    """Records of an archive of any writer, from its blocks in order; no more than one wanted payload is held.

    A file that holds something other than records, or ends within one, is refused with a ``ValueError``.
    """
    pieces, held = _inflated(blocks), bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        held.extend(piece or b"")
        return piece is not None

    while True:
        while held[:1] in (b"\r", b"\n") or (not held and more()):
            del held[:held[:1] in (b"\r", b"\n")]
        if not held:
            return
        seen = 0
        while (stop := held.find(_BLANK, max(seen - 3, 0))) < 0:
            seen = len(held)
            if seen > HEADER_BYTES or not more():
                raise ValueError("no end of a record's headers")
        if not held.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers, left = _described(bytes(held[:stop]))
        del held[:stop + len(_BLANK)]
        take = wanted(headers)
        keep = take and with_payload and headers["record_type"] == "response"
        block = bytearray()
        while left:
            if not held and not more():
                raise ValueError("the archive ends inside a record")
            part = min(left, len(held))
            if keep:
                block += held[:part]
            del held[:part]
            left -= part
        if take:
            yield headers, _payload(bytes(block)) if keep else None


class WarcSource(DataSource):
    """The ``warc`` format; options: ``path``.  A schema with fewer columns is a projection."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def write_pages(pages: DataFrame, folder: str) -> None:
    """Archive pages (``page_id``, ``url``, ``html``; a missing html is empty).

    Of equal payloads of at least ``REVISIT_BYTES``, the record with the smallest id is the response and the others
    revisit it.  Rows that share this smallest id are all responses, as is every payload whose ids are all missing; a
    row with a missing id revisits.  An empty table makes an archive without files.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")
    ).withColumns({"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    firsts = (  # narrow: copies are counted before they are shuffled
        rows.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    (
        rows.join(firsts, "payload_digest", "left")
        .select(
            "page_id", "url", F.when(revisit, "revisit").otherwise("response").alias("record_type"), "payload_digest",
            F.when(revisit, F.col("first")).alias("refers_to"), "payload_bytes", F.when(~revisit, F.col("payload")).alias("payload"),
        )
        .write.format("warc").mode("append").save(folder)
    )


def read_archive(spark: SparkSession, folder: str, columns: str = SCHEMA) -> DataFrame:
    """Records of an archive; only the given columns are decoded."""
    return spark.read.format("warc").schema(columns).load(folder)
