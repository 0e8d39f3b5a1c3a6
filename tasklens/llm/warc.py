"""WARC archives: a writer of one gzip member per record, and a sequential reader (dealt operator 5).

The reader knows nothing about a file beyond the bytes that it has met: it inflates a member a block at a time, frames the
record by its Content-Length, hashes the payload as it passes, and goes on with the next member.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasklens.llm.storage import stored
from tasklens.session import new_folder

ARCHIVE_BYTES = 64 * 1024 * 1024
READ_BYTES = 1 << 18
RECORD_URN = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP = 31
# A record whose headers run on for longer than this is no WARC record.
HEADER_BYTES = 1 << 20


class BadRecord(ValueError):
    """A record that is cut short, not framed as announced, or whose digest does not fit."""


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    status: str
    http_headers: dict[str, str]
    payload: bytes

    @property
    def record_id(self) -> str:
        return self.headers["warc-record-id"].strip("<>")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A value that cannot break out of its header line."""
    return "".join(c for c in value if c >= " " and c != "\x7f")


def record_bytes(kind: str, record_id: str, uri: str, payload: bytes, refers_to: str | None = None) -> bytes:
    """One record, uncompressed. A revisit carries the HTTP headers of its payload, the payload's length among them, alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {_clean(uri)}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
    return deflate.compress(data) + deflate.flush()


class _Member:
    """The bytes of one gzip member, inflated as they are asked for. ``rest`` is what was read beyond its end."""

    def __init__(self, file: BinaryIO, held: bytes):
        self._file, self._raw, self._plain = file, held, bytearray()
        self._inflate = zlib.decompressobj(_GZIP)

    @property
    def rest(self) -> bytes:
        return self._inflate.unused_data

    def _more(self) -> bool:
        if self._inflate.eof:
            return False
        raw = self._raw or self._file.read(READ_BYTES)
        if not raw:
            raise BadRecord("a gzip member is cut short")
        try:
            self._plain += self._inflate.decompress(raw, READ_BYTES)
        except zlib.error as error:
            raise BadRecord(str(error)) from error
        self._raw = self._inflate.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        searched = 0
        while (at := self._plain.find(mark, max(0, searched - len(mark)))) < 0:
            searched = len(self._plain)
            if searched > HEADER_BYTES or not self._more():
                raise BadRecord("headers without an end")
        out = bytes(self._plain[:at])
        del self._plain[: at + len(mark)]
        return out

    def take(self, size: int) -> Iterator[bytes]:
        while size > 0:
            if not self._plain and not self._more():
                raise BadRecord("a block shorter than its Content-Length")
            part = bytes(self._plain[:size])
            del self._plain[: len(part)]
            size -= len(part)
            if part:
                yield part

    def end(self) -> None:
        while self._more():
            pass
        if bytes(self._plain) != b"\r\n\r\n":
            raise BadRecord("a record that does not end where its Content-Length says")


def _headers(block: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = block.decode("utf-8", "replace").split("\r\n")
    pairs = (line.partition(":") for line in lines)
    return first, {name.strip().lower(): value.strip() for name, _, value in pairs}


def read_records(file: BinaryIO) -> Iterator[Record]:
    """The records of an archive, one after the other; ``BadRecord`` where one is damaged or a digest does not fit."""
    held = file.read(READ_BYTES)
    while held:
        member = _Member(file, held)
        version, headers = _headers(member.until(b"\r\n\r\n"))
        length = headers.get("content-length", "")
        if not version.startswith("WARC/") or not length.isdigit():
            raise BadRecord("no WARC record")
        block = hashlib.sha1()
        parts = []
        for part in member.take(int(length)):
            block.update(part)
            parts.append(part)
        member.end()
        body = b"".join(parts)
        _expect(headers.get("warc-block-digest"), base64.b32encode(block.digest()).decode())
        http, mark, payload = body.partition(b"\r\n\r\n")
        if not mark:
            raise BadRecord("a block without HTTP headers")
        status, http_headers = _headers(http)
        if headers.get("warc-type") == "response":
            _expect(headers.get("warc-payload-digest"), digest(payload))
        yield Record(headers, status, http_headers, payload)
        held = member.rest or file.read(READ_BYTES)


def _expect(stated: str | None, found: str) -> None:
    if stated is not None and stated != f"sha1:{found}":
        raise BadRecord(f"digest {found} where {stated} is stated")


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)


def plan_records(pages: DataFrame, id_col: str, body_col: str, least_bytes: int) -> DataFrame:
    """Add ``_digest`` and ``_refers_to``: the largest id with the same payload, where the row is not that one itself.

    Equal payloads are found by SHA-256; counts are combined before the shuffle, and a payload that many rows share is a
    skewed join that Spark splits. Rows without an id, and payloads under ``least_bytes``, refer to nothing.
    """
    body = F.coalesce(F.col(body_col), F.lit(""))
    known = pages.withColumns({"_body": body, "_digest": F.sha2(body.cast("binary"), 256)})
    eligible = (F.octet_length("_body") >= least_bytes) & F.col(id_col).isNotNull()
    kept = pages.withColumn("_body", body).filter(eligible).select(
        F.sha2(F.col("_body").cast("binary"), 256).alias("_same"), F.col(id_col).alias("_id")
    )
    largest = kept.groupBy("_same").agg(F.max("_id").alias("_largest"), F.count("*").alias("_n")).filter("_n > 1")
    joined = known.join(largest, F.col("_digest") == F.col("_same"), "left")
    refers = F.when(eligible & (F.col("_largest") != F.col(id_col)), F.col("_largest"))
    return joined.select(F.col(id_col).alias("page_id"), "_body", refers.alias("refers_to"), *_uri(pages))


def _uri(pages: DataFrame) -> list:
    return [(F.coalesce("url", F.lit("")) if "url" in pages.columns else F.lit("")).alias("url")]


def write_archives(
    pages: DataFrame, folder: str | None = None, id_col: str = "page_id", body_col: str = "html", least_bytes: int = 0
) -> DataFrame:
    """Write a record per row into gzipped archives; a table of the ``path`` and ``records`` of each.

    Of rows with equal payloads of at least ``least_bytes``, the one with the largest id is a response and the others
    revisit it; ``url`` is the target where ``pages`` has it. A null payload is empty. Of rows that share an id each is
    a record; rows without an id are responses without a number. Attempts write files of their own, and only the files
    of attempts that succeeded are listed, so a lost executor leaves no record twice. ``folder`` is any URI that Arrow
    can write; without it a new one in the cluster's shared folder. An empty table gives no archives.
    """
    folder = (folder or new_folder(pages.sparkSession, "warc")).rstrip("/")
    rows = plan_records(pages, id_col, body_col, least_bytes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        done, out, size, count, path = [], None, 0, 0, None
        for batch in batches:
            for page, body, refers, url in zip(*(batch.column(i) for i in range(4)), strict=True):
                if out is None:
                    system.create_dir(base, recursive=True)
                    path, size, count = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{base}/{path.rsplit('/', 1)[1]}", compression=None)
                page, refers = page.as_py(), refers.as_py()
                kind = "response" if refers is None else "revisit"
                name = f"{RECORD_URN}{page if page is not None else ''}"
                data = _member(record_bytes(kind, name, url.as_py(), body.as_py().encode(), f"{RECORD_URN}{refers}"))
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((path, count))
                    out = None
        if out is not None:
            out.close()
            done.append((path, count))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["path", "records"]
        )

    return stored(rows.mapInArrow(write, "path string, records long"), "warc-files")


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the archives named by ``path``: ``page_id``, ``url``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to`` and, if wanted, ``payload``.

    Archives are read side by side, each in sequence and a block at a time. Lengths and digests are those of the full
    payload: counted and verified for responses, as stated for revisits. A record without a number has a null
    ``page_id``. A damaged record is an error that names its archive.
    """
    fields = [
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ]
    fields = fields if with_payload else fields[:-1]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, base = _open(path)
                rows, held = [], 0
                with system.open_input_stream(base, compression=None) as file:
                    try:
                        for record in read_records(file):
                            rows.append(_row(record)[: len(fields)])
                            held += len(record.payload) if with_payload else 100
                            if held > READ_BYTES * 16:
                                yield _batch(rows, fields)
                                rows, held = [], 0
                    except BadRecord as error:
                        raise BadRecord(f"{path}: {error}") from error
                yield _batch(rows, fields)

    ddl = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    # One archive a task: they are of a bounded size, and there are as many as the data asks for.
    many = max(1, archives.count())
    return archives.select("path").repartition(many, "path").mapInArrow(read, ddl + (", payload binary" if with_payload else ""))


def _number(name: str) -> int | None:
    text = name.strip("<>").removeprefix(RECORD_URN)
    return int(text) if text.lstrip("-").isdigit() else None


def _row(record: Record) -> tuple:
    kind = record.headers["warc-type"]
    revisit = kind == "revisit"
    length = int(record.http_headers["content-length"]) if revisit else len(record.payload)
    stated = record.headers["warc-payload-digest"].removeprefix("sha1:")
    refers = _number(record.headers.get("warc-refers-to", "")) if revisit else None
    return (
        _number(record.record_id), record.headers.get("warc-target-uri"), length, stated, kind, refers, record.payload
    )


def _batch(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )
