"""WARC archives through a chunked record table.

A payload travels as rows (record, chunk number, bytes), each with the bytes and the SHA-1 of everything up to it, so
that neither the writer nor the reader ever holds a record whole. Writing: digests are taken chunk by chunk beside the
rows, equal payloads meet in one aggregate of digests, chunk rows stream into ``.warc.gz`` files (one gzip member for
each record). Reading: each archive is one task that inflates a block at a time and gives chunk rows again; a payload
whose digest differs from its header's raises an error.

Files are named after their task's attempt and moved into place when complete; only those that the manifest names are
read, so retried tasks and lost executors do no harm. The folder must be shared, of a kind that pyarrow can open.

Defined results: null payloads are empty. Of records with equal payloads of at least ``min_bytes`` bytes all rows that
carry the largest id are responses and the others refer to it; shorter ones are all responses. Rows without an id are
responses if no equal payload has one, otherwise revisits. Repeated rows give a record each. No rows: no archives.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from kerbside.llm.common import annotate, ship, slices, utf8
from kerbside.session import broadcast_if_small, scratch_path, stored

CHUNK_BYTES = 1 << 16
ARCHIVE_BYTES = 1 << 30  # an archive is closed once it has so many payload bytes
READ_TASKS = 100_000
DATE = "1970-01-01T00:00:00Z"

CHUNKS = (
    "record_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "chunk_no long, data binary, bytes_so_far long, digest_so_far string, last boolean"
)
_CHUNK_SCHEMA = pa.schema(
    [
        ("record_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("chunk_no", pa.int64()), ("data", pa.binary()),
        ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()), ("last", pa.bool_()),
    ]
)
_BATCH_BYTES = 4 << 20


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _decided(pages: DataFrame, id: str, url: str, payload: str, min_bytes: int, chunk_bytes: int) -> DataFrame:
    """Records with digest, type and the record that they refer to."""

    def make():
        def digests(values):
            sizes, out = [], []
            for value in values:
                sha, view = hashlib.sha1(), memoryview(value)
                for at in range(0, len(view), chunk_bytes):
                    sha.update(view[at : at + chunk_bytes])
                sizes.append(len(view))
                out.append(base32(sha.digest()))
            return sizes, out

        return digests

    rows = pages.select(
        F.col(f"`{id}`").cast("long").alias("record_id"), F.col(f"`{url}`").cast("string").alias("url"),
        utf8(payload).alias("payload"),
    )
    keyed = annotate(rows, F.col("payload"), make, "payload_bytes long, payload_digest string")
    # Usually far fewer than the pages: stored once, and joined without moving payloads while their size is proven small.
    firsts = broadcast_if_small(
        annotate(rows.drop("url"), F.col("payload"), make, "payload_bytes long, payload_digest string")
        .drop("payload")
        .where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("record_id").alias("kept_id"), F.count("*").alias("copies"))
        .where("copies > 1 AND kept_id IS NOT NULL")
        .select("payload_digest", "payload_bytes", "kept_id"),
        store="warc-copies",
    )
    revisit = F.col("kept_id").isNotNull() & ~F.col("kept_id").eqNullSafe(F.col("record_id"))
    return keyed.join(firsts, ["payload_digest", "payload_bytes"], "left").select(
        "record_id", "url", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("kept_id")).alias("refers_to"), "payload_bytes", "payload_digest", "payload",
    )


def _chunk_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in _CHUNK_SCHEMA]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CHUNK_SCHEMA)], schema=_CHUNK_SCHEMA)


def _bounded(rows):
    """Chunk rows in batches of about _BATCH_BYTES."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[7]) + 200
        if size >= _BATCH_BYTES:
            yield _chunk_rows(held)
            held, size = [], 0
    if held:
        yield _chunk_rows(held)


def record_chunks(
    pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """The chunked record table of ``pages``: chunks of a record stand together and in order. Revisits have no bytes."""

    def cut(batches):
        def rows():
            for part in (part for batch in batches for part in slices(batch, 6)):
                for record, link, kind, refers, size, digest, data in zip(*(c.to_pylist() for c in part.columns)):
                    sha, view = hashlib.sha1(), memoryview(data if kind == "response" else b"")
                    for number, at in enumerate(range(0, max(len(view), 1), chunk_bytes)):
                        piece = bytes(view[at : at + chunk_bytes])
                        sha.update(piece)
                        end = at + len(piece)
                        yield record, link, kind, refers, size, digest, number, piece, end, base32(sha.digest()), end == len(view)

        return _bounded(rows())

    return _decided(pages, id, url, payload, min_bytes, chunk_bytes).mapInArrow(cut, CHUNKS)


def _head(record, link, kind, refers, size, digest) -> tuple[bytes, bytes]:
    """WARC header and HTTP header of a record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:record:{'' if record is None else record}>", f"WARC-Date: {DATE}"]
    if link is not None:
        lines.append("WARC-Target-URI: " + link.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        lines.append(f"WARC-Refers-To: <urn:record:{refers}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += [
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (size if kind == 'response' else 0)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n", http


def _qualified(spark, path: str) -> str:
    """The path as a URI of the file system that Spark takes it for."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file:///") else uri


def write_archives(chunks: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a chunked record table as archives; returns the stored manifest (path, records, payload_bytes)."""
    spark = chunks.sparkSession
    ship(spark)
    folder = _qualified(spark, folder or scratch_path(spark, "warc"))

    def write(batches):
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        made, out = [], None
        packer = None

        def close():
            out.close()
            store.move(f"{name}.open", name)

        for batch in batches:
            for record, link, kind, refers, size, digest, number, data, _, _, last in zip(*(c.to_pylist() for c in batch.columns)):
                if number == 0:
                    if out is None or made[-1][2] >= archive_bytes:
                        if out is not None:
                            close()
                        name = f"{base}/{uuid.uuid4().hex}.warc.gz"
                        out = store.open_output_stream(f"{name}.open", compression=None)
                        made.append([f"{folder}/{name.rpartition('/')[2]}", 0, 0])
                    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
                    for part in _head(record, link, kind, refers, size, digest):
                        out.write(packer.compress(part))
                out.write(packer.compress(data))
                made[-1][2] += len(data)
                if last:
                    out.write(packer.compress(b"\r\n\r\n") + packer.flush())
                    made[-1][1] += 1
        if out is not None:
            close()
        columns = list(zip(*made)) if made else [[], [], []]
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "records", "payload_bytes"])

    return stored(chunks.mapInArrow(write, "path string, records long, payload_bytes long"), "warc-manifest")


class _Inflated:
    """Reads an archive of gzip members a block at a time."""

    def __init__(self, file, block: int):
        self.file, self.block, self.raw, self.buffer = file, block, b"", bytearray()
        self.member = zlib.decompressobj(31)

    def fill(self) -> bool:
        if self.member.eof:
            self.raw, self.member = self.member.unused_data, zlib.decompressobj(31)
        raw = self.raw or self.member.unconsumed_tail or self.file.read(self.block)
        self.raw = b""
        if not raw:
            return False
        self.buffer += self.member.decompress(raw, self.block)
        return True

    def line(self) -> bytes | None:
        """The next line without its end; None after the last."""
        while (end := self.buffer.find(b"\r\n")) < 0:
            if not self.fill():
                return None
        line = bytes(self.buffer[:end])
        del self.buffer[: end + 2]
        return line

    def take(self, most: int) -> bytes:
        while len(self.buffer) < most and self.fill():
            pass
        part = bytes(self.buffer[:most])
        del self.buffer[:most]
        return part


def _fields(source: _Inflated) -> tuple[dict[str, str], int]:
    """Header fields up to the empty line, and the bytes that they took."""
    fields, size = {}, 2
    while line := source.line():
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
        size += len(line) + 2
    return fields, size


def _record(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:record:").removesuffix(">")
    return int(number) if number else None


def _archive_chunks(path: str, chunk_bytes: int):
    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_stream(name, compression=None) as file:
        source = _Inflated(file, chunk_bytes)
        while (version := source.line()) is not None:
            if not version.startswith(b"WARC/"):
                raise ValueError(f"{path}: a record begins with {version[:40]!r}")
            head, _ = _fields(source)
            source.line()  # the status line
            http, http_size = _fields(source)
            status = len(b"HTTP/1.1 200 OK\r\n")
            left = int(head["content-length"]) - http_size - status
            kind, digest, size = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"])
            record, refers = _record(head["warc-record-id"]), _record(head.get("warc-refers-to"))
            sha, number, done = hashlib.sha1(), 0, 0
            while left or number == 0:
                part = source.take(min(left, chunk_bytes))
                if len(part) < min(left, chunk_bytes):
                    raise ValueError(f"{path}: record {record} ends early")
                sha.update(part)
                left, done = left - len(part), done + len(part)
                so_far = base32(sha.digest())
                if not left and kind == "response" and (so_far != digest or done != size):
                    raise ValueError(f"{path}: the payload of record {record} doesn't have its digest")
                yield record, head.get("warc-target-uri"), kind, refers, size, digest, number, part, done, so_far, not left
                number += 1
            source.line(), source.line()


def read_archives(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES, most_tasks: int = READ_TASKS) -> DataFrame:
    """The chunked record table of the archives that a manifest names, read by as many tasks as there are archives.

    Archives are dealt in turn; only beyond ``most_tasks`` does a task read several, one after the other.
    """
    spark = manifest.sparkSession
    ship(spark)

    def read(batches):
        return _bounded(row for batch in batches for path in batch.column(0).to_pylist() for row in _archive_chunks(path, chunk_bytes))

    paths = manifest.select("path")
    tasks = max(1, min(paths.count(), most_tasks))
    # The manifest has a row per archive only, so that numbering it is no work.
    turn = (F.row_number().over(Window.orderBy("path")) % tasks).cast("int")
    return paths.withColumn("turn", turn).repartitionById(tasks, "turn").select("path").mapInArrow(read, CHUNKS)
