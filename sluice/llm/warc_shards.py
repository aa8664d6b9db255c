"""Sharded WARC archives, written by range-sorted tasks, and their reader.

Records are sorted by (page id, payload digest) with a range partitioning; each task writes one shard
and starts a new file when the compressed size passes ``ROLL_BYTES``. Each record is a gzip member of
its own. Headers, lengths and digests are made anew from the payload; nothing in a file depends on
the clock or the machine, so a task that runs again writes the same bytes.

A task writes below ``_temporary`` under a name of its own attempt and returns a manifest row per
file. Spark stores the manifest of the attempts that counted; then the files named there are moved
to their final names. Files of lost attempts stay below ``_temporary``, which no reader looks at.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

ROLL_BYTES = 32_000_000  # compressed size from which the next file is begun
LEAST_REVISIT = 100  # payload bytes from which an equal payload is a revisit
DATE = "2000-01-01T00:00:00Z"
_CHUNK = 16_384  # compressed bytes that the reader takes at a time

# Fixed values of the format.
_VERSION = b"WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

_MANIFEST = "shard int, file int, temporary string, final string, records long, bytes long, sha256 string"


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _record_id(page, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page}/{digest}')}>"


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record: ``headers`` after the type, then length and digest of its block."""
    lines = [("WARC-Type", kind), *headers, ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Length", str(len(block)))]
    return b"\r\n".join([_VERSION, *(f"{k}: {v}".encode() for k, v in lines), b"", block, b"", b""])


def page_record(page, url: str | None, payload: bytes, digest: str, first) -> bytes:
    """A response, or with ``first`` (the page that has the payload) a revisit without the payload."""
    headers = [("WARC-Record-ID", _record_id(page, digest)), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if page is not None:
        headers.append(("Page-ID", str(page)))
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="".join(map(chr, range(33, 127))))))
    headers.append(("Content-Type", "application/http;msgtype=response"))
    if first is not None:
        headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id(first, digest)), ("Refers-To-Page-ID", str(first))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return record("revisit" if first is not None else "response", headers, http + (payload if first is None else b""))


class _Files:
    """The files of one shard; a finished one is a manifest row."""

    def __init__(self, root: str, shard: int, roll: int) -> None:
        self.root, self.shard, self.roll = root, shard, roll
        self.store, self.base = _filesystem(root)
        self.attempt = uuid.uuid4().hex
        self.number, self.out, self.rows = 0, None, []

    def add(self, data: bytes) -> None:
        if self.out is None:
            name = f"part-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.names = f"_temporary/{self.attempt}/{name}", name
            self.store.create_dir(f"{self.base}/_temporary/{self.attempt}")
            self.out = self.store.open_output_stream(f"{self.base}/{self.names[0]}", compression=None)
            self.size, self.records, self.digest = 0, 0, hashlib.sha256()
            self._member(record("warcinfo", [("WARC-Record-ID", _record_id(name, "")), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self._member(data)
        self.records += 1
        if self.size >= self.roll:
            self.close()

    def _member(self, data: bytes) -> None:
        member = gzip.compress(data, 6, mtime=0)
        self.out.write(member)
        self.digest.update(member)
        self.size += len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.rows.append((self.shard, self.number, *self.names, self.records, self.size, self.digest.hexdigest()))
            self.out, self.number = None, self.number + 1


def _manifest(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[c.split()[0] for c in _MANIFEST.split(", ")])


def _writer(root: str, roll: int):
    """Rows by (page, digest); the row that names the first page of a payload comes before its pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(root, TaskContext.get().partitionId(), roll)
        key, first, written = None, None, False
        for batch in batches:
            for page, digest, verdict, first_page, url, html in zip(*(batch.column(i).to_pylist() for i in range(5)), batch.column(5)):
                if (page, digest) != key:
                    key, first, written = (page, digest), None, False
                if verdict:
                    first = first_page
                    continue
                # Of equal rows of the first page one is the response.
                refers = first if first is not None and (page != first or written) else None
                written = True
                files.add(page_record(page, url, (html.as_py() or "").encode(), digest, refers))
        files.close()
        if files.rows:
            yield _manifest(files.rows)

    return run


def _commit(root: str):
    """Move the files of the manifest to their final names; one that is there already stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _filesystem(root)
        for batch in batches:
            for row in batch.to_pylist():
                final = f"{base}/{row['final']}"
                if store.get_file_info(final).type == fs.FileType.NotFound:
                    store.move(f"{base}/{row['temporary']}", final)
                if store.get_file_info(final).size != row["bytes"]:
                    raise OSError(f"{final} has not the size of its manifest row")
            yield batch

    return run


def write_archives(
    pages: DataFrame, root: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least_revisit: int = LEAST_REVISIT, roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Write a record per row of ``pages`` to a new folder ``root`` and return the manifest.

    Of the rows with equal payloads of at least ``least_revisit`` bytes the one with the smallest id is
    a response and the others revisit it; of equal rows with that id one is the response. A null payload
    is empty, a null url is left out. Rows with a null id revisit a row with one, and are responses if
    there is none. An empty table gives an empty manifest and no file.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    small = rows.filter(F.octet_length("html") >= least_revisit).select("page", "digest")
    repeated = small.groupBy("digest").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND first IS NOT NULL")
    verdicts = small.join(repeated, "digest").select("page", "digest", F.lit(True).alias("verdict"), "first").distinct()
    texts = [F.lit(None).cast("string").alias(c) for c in ("url", "html")]
    together = rows.select("page", "digest", F.lit(False).alias("verdict"), F.lit(None).cast("long").alias("first"), "url", "html").unionAll(
        verdicts.select("*", *texts)
    )
    order = ["page", "digest"]
    placed = together.repartitionByRange(*order).sortWithinPartitions(*order, F.desc("verdict"))
    manifest = f"{root}/_manifest"
    placed.mapInArrow(_writer(root, roll_bytes), _MANIFEST).write.parquet(manifest)
    stored = spark.read.schema(_MANIFEST).parquet(manifest)
    stored.mapInArrow(_commit(root), _MANIFEST).write.format("noop").mode("overwrite").save()
    return stored


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a gzipped WARC file; names of headers in lower case."""
    view, at = memoryview(data), 0
    while at < len(view):
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            # A chunk at a time: what lies behind the end of a member is copied.
            if at >= len(view):
                raise ValueError("a record is cut off")
            parts.append(member.decompress(view[at : at + _CHUNK]))
            at += _CHUNK
        at -= len(member.unused_data) + max(0, at - len(view))
        whole = b"".join(parts)
        stream = io.BytesIO(whole)
        while (line := stream.readline()).strip() == b"" and line:
            pass
        if line.strip() != _VERSION:
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline().strip()):
            name, _, value = line.partition(b":")
            headers[name.decode().lower()] = value.strip().decode()
        yield headers, stream.read(int(headers["content-length"]))


_RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = [c.split()[0] for c in _RECORD.split(", ")]
    for batch in batches:
        for data in batch.column(0):
            out, held = [], 0
            for headers, block in records(data.as_py()):
                if headers["warc-type"] not in ("response", "revisit"):
                    continue
                if headers["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
                    raise ValueError(f"digest of {headers['warc-record-id']} differs")
                head, _, payload = block.partition(b"\r\n\r\n")
                size = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                digest, response = headers["warc-payload-digest"].removeprefix("sha256:"), headers["warc-type"] == "response"
                if response and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                    raise ValueError(f"payload of {headers['warc-record-id']} differs")
                number = lambda name: int(headers[name]) if name in headers else None
                out.append((
                    number("page-id"), headers.get("warc-target-uri"), size, digest, headers["warc-type"], number("refers-to-page-id"),
                    payload if response else None,
                ))
                held += len(payload)
                if held > 8_000_000 or len(out) >= 5_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def read_archives(spark: SparkSession, root: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of each page record.

    Block and payload digests are checked. A revisit has the size and digest of the full payload and no
    payload of its own.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(root)
    return files.select("content").mapInArrow(_parse, _RECORD)
