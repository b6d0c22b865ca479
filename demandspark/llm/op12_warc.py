"""WARC archives as a chunked record table.

Writing. Payloads are hashed once; equal ones (size, SHA-1 and a 64-bit hash) are one group, whose largest page_id is
the response and whose other rows become revisits without a payload. Rows to write are chunks: (record, number,
bytes), cut from the binary value by position, so Python never sees a whole payload. Each task streams its chunks into
one archive, a gzip member per record, under a name of its own; only names that successful tasks return count, so
a task that is lost or run twice leaves a file that nobody reads.

Reading. A task streams an archive through a decompressor with bounded output and returns the record table: one
row per chunk with its number, its place, the bytes and the SHA-1 of the payload up to its end, which is carried from
chunk to chunk. The last chunk's digest is the payload's and is compared with the header's; a difference is an error.

Records are WARC 1.1: ``response`` with an HTTP head before the payload, ``revisit`` of the profile
identical-payload-digest. ``Page-Id``, ``Page-Url``, ``Refers-To-Page-Id`` and ``Payload-Length`` are extension headers.

Defined cases: a null html is empty and a payload like any other; payloads smaller than ``least`` bytes are always
responses; of repeated rows of one page_id one is the response and the others revisit it; a null page_id is the
smallest one and stays null; a null url leaves out its header; blanks and control characters of a url are
percent-encoded, and the url itself is kept in base64 beside it; no pages give no archive; other columns are ignored. A payload is one value of the input table
and must fit there (2 GB); chunks are ``CHUNK`` bytes at most.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import table
from demandspark.sources import scratch

#: Bytes of a chunk, and bytes read from an archive at a time.
CHUNK, READ = 1 << 18, 1 << 18
#: Rows of a batch that is sent back from a task, by their bytes.
BATCH = 1 << 22
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_MANIFEST = "path string, n_records long, n_bytes long"
_TABLE = (
    "record_id string, record_type string, page_id long, url string, refers_to long, payload_bytes long, chunk long, start long, "
    "last boolean, digest string"
)
_SCHEMA = pa.schema(
    [("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("refers_to", pa.int64()),
     ("payload_bytes", pa.int64()), ("chunk", pa.int64()), ("start", pa.int64()), ("last", pa.bool_()), ("digest", pa.string()),
     ("data", pa.binary())]
)


def records(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, bytes, digest, copy, refers_to, response_url, kind): what to write for every row of ``pages``, without payloads."""
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.octet_length(body).cast("long").alias("bytes"),
                        F.unhex(F.sha1(body)).alias("digest"), F.xxhash64(body).alias("other"))
    same = rows.groupBy("bytes", "digest", "other", "page_id", "url").agg(F.count("*").alias("rows"))
    same = scratch.materialize(same, "payloads")  # narrow: the payloads are hashed once
    response = same.groupBy("bytes", "digest", "other").agg(F.max(F.struct("page_id", "url")).alias("r"))
    found = same.join(response, ["bytes", "digest", "other"])
    found = found.withColumn("copy", F.explode(F.expr("sequence(1L, rows)")))
    first = "copy = 1 and page_id <=> r.page_id and url <=> r.url"
    return found.select(
        "page_id", "url", "bytes", "digest", "other", "copy",
        F.expr(f"if(bytes < {least} or ({first}), 'response', 'revisit')").alias("kind"),
        F.col("r.page_id").alias("refers_to"), F.col("r.url").alias("response_url"),
    )


def chunked(pages: DataFrame, planned: DataFrame, size: int = CHUNK) -> DataFrame:
    """The record table to write: one row per chunk of a response (at least one) and one per revisit.

    The chunks of a record follow each other in one partition.
    """
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("body")
    # Both sides are dealt by the same two hashes of a row, so payloads are shuffled once; repeated rows become one.
    payloads = pages.select(F.xxhash64(F.col("page_id").cast("long"), F.col("url").cast("string")).alias("row"), body)
    payloads = payloads.select("row", F.xxhash64("body").alias("other"), "body").dropDuplicates(["row", "other"])
    one = planned.where("kind = 'response'").withColumn("row", F.xxhash64("page_id", "url"))
    met = payloads.join(one, ["row", "other"])
    number = F.explode(F.expr(f"sequence(0L, greatest(0L, (bytes - 1) div {size}))")).alias("chunk")
    head = ["page_id", "url", "bytes", "digest", "copy", "kind", "refers_to", "response_url"]
    cut = met.select(*head, "body", number).select(*head, "chunk", F.expr(f"substring(body, int(chunk * {size} + 1), {size})").alias("data"))
    rest = planned.where("kind = 'revisit'").select(*head, F.lit(0).cast("long").alias("chunk"), F.lit(b"").alias("data"))
    return cut.unionByName(rest)


def identity(page_id: int | None, url: str | None, copy: int, digest: bytes) -> str:
    """The record's URN, the same whenever it is written."""
    return f"urn:uuid:{uuid.UUID(bytes=hashlib.sha256(repr((page_id, url, copy, digest)).encode()).digest()[:16], version=4)}"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def header(row: dict) -> bytes:
    """Header lines of a record, and of a response the head of its block."""
    page, url, digest = row["page_id"], row["url"], row["digest"]
    lines = ["WARC/1.1", f"WARC-Type: {row['kind']}", f"WARC-Record-ID: <{identity(page, url, row['copy'], digest)}>", f"WARC-Date: {DATE}"]
    if url is not None:
        quoted = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        lines += [f"WARC-Target-URI: {quoted}"] + [f"Page-Url: {base64.b64encode(url.encode()).decode()}"] * (quoted != url)
    lines += [f"WARC-Payload-Digest: sha1:{base32(digest)}", f"Payload-Length: {row['bytes']}"]
    lines += [] if page is None else [f"Page-Id: {page}"]
    block = b""
    if row["kind"] == "response":
        block = _HTTP % row["bytes"]
        lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block) + row['bytes']}"]
    else:
        lines += [f"WARC-Refers-To: <{identity(row['refers_to'], row['response_url'], 1, digest)}>", f"WARC-Profile: {PROFILE}"]
        lines += [] if row["refers_to"] is None else [f"Refers-To-Page-Id: {row['refers_to']}"]
        lines += ["Content-Length: 0"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def _opened(path: str, mode: str):
    """A file of any store that Arrow knows, for streaming."""
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    if mode == "read":
        return store.open_input_stream(inner, compression=None)
    store.create_dir(posixpath.dirname(inner), recursive=True)
    return store.open_output_stream(inner, compression=None)


def write(chunks: DataFrame, folder: str, level: int = 1) -> DataFrame:
    """Write the chunk rows as archives below ``folder``; (path, n_records, n_bytes) of each, itself written."""

    def run(batches):
        name = f"{folder}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        out, member, made, size = None, None, 0, 0
        for batch in batches:
            heads = batch.drop_columns(["data"]).to_pylist()
            for k, row in enumerate(heads):
                if row["chunk"] == 0:
                    out = out or _opened(name, "write")
                    if member:
                        size += out.write(member.compress(b"\r\n\r\n") + member.flush())
                    member, made = zlib.compressobj(level, zlib.DEFLATED, 31), made + 1
                    size += out.write(member.compress(header(row)))
                size += out.write(member.compress(batch.column("data")[k].as_buffer()))
        if out:
            size += out.write(member.compress(b"\r\n\r\n") + member.flush())
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": name, "n_records": made, "n_bytes": size}])

    return scratch.materialize(chunks.mapInArrow(run, _MANIFEST), "archives")


class Stream:
    """Bytes of a file of gzip members, decompressed a bounded piece at a time."""

    def __init__(self, file):
        self.file, self.raw, self.held = file, b"", bytearray()
        self.member = zlib.decompressobj(31)

    def more(self) -> bool:
        while True:
            if self.member.eof:
                self.raw, self.member = self.member.unused_data or self.raw, zlib.decompressobj(31)
            self.raw = self.raw or self.file.read(READ)
            if not self.raw:
                return False
            got = self.member.decompress(self.raw, READ)
            self.raw = self.member.unconsumed_tail
            if self.member.eof:
                self.raw, self.member = self.member.unused_data, zlib.decompressobj(31)
            if got:
                self.held += got
                return True

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes | None:
        """What stands before the mark, or None at the end of the file."""
        while (at := self.held.find(mark)) < 0:
            if len(self.held) > most:
                raise ValueError("a header is too long")
            if not self.more():
                if self.held.strip():
                    raise ValueError("the archive ends inside a record")
                return None
        found = bytes(self.held[:at])
        del self.held[: at + len(mark)]
        return found

    def take(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes in chunks of ``CHUNK``, the last one shorter; one empty chunk for none."""
        first = True
        while size or first:
            want, first = min(size, CHUNK), False
            while len(self.held) < want:
                if not self.more():
                    raise ValueError("the archive ends inside a record")
            yield bytes(self.held[:want])
            del self.held[:want]
            size -= want


def parsed(stream: Stream) -> Iterator[tuple]:
    """Rows of the record table of one archive."""
    while (lines := stream.until(b"\r\n\r\n")) is not None:
        version, *fields = lines.decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record begins with {version[:40]!r}")
        values = {k.lower(): v.strip() for k, v in (f.split(":", 1) for f in fields)}
        length, kind = int(values["content-length"]), values["warc-type"]
        if kind == "response" and values.get("content-type", "").startswith("application/http"):
            http = stream.until(b"\r\n\r\n")
            length -= len(http) + 4
        page, refers = values.get("page-id"), values.get("refers-to-page-id")
        url = base64.b64decode(values["page-url"]).decode() if "page-url" in values else values.get("warc-target-uri")
        common = (values["warc-record-id"].strip("<>"), kind, page and int(page), url, refers and int(refers))
        named = values.get("warc-payload-digest", "").removeprefix("sha1:")
        size = length if kind != "revisit" else int(values.get("payload-length", length))
        if kind == "revisit":
            for _ in stream.take(length):
                pass
            yield (*common, size, 0, 0, True, named, b"")
        else:
            digest, start = hashlib.sha1(), 0
            for number, data in enumerate(stream.take(length)):
                digest.update(data)
                last = start + len(data) == length
                yield (*common, size, number, start, last, base32(digest.digest()), data)
                start += len(data)
            if named and named != base32(digest.digest()):
                raise ValueError(f"the payload of {common[0]} has another digest than its header")
        if stream.until(b"\r\n\r\n") != b"":
            raise ValueError("a record is longer than its header says")


def read(archives: DataFrame, data: bool = True) -> DataFrame:
    """The chunked record table of the archives named in column ``path``; without ``data`` only each record's last chunk."""
    count = max(1, archives.count())

    def run(batches):
        names = _SCHEMA.names if data else _SCHEMA.names[:-1]
        rows, held = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with _opened(path, "read") as file:
                    for row in parsed(Stream(file)):
                        if data or row[8]:
                            rows.append(row if data else row[:-1])
                            held += len(row[-1]) * data + 200
                        if held >= BATCH:
                            yield _rows(rows, names)
                            rows, held = [], 0
        if rows:
            yield _rows(rows, names)

    # One archive per task.
    paths = archives.select("path").distinct().repartitionByRange(count, "path")
    return paths.mapInArrow(run, _TABLE + (", data binary" if data else ""))


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, _SCHEMA.field(n).type) for c, n in zip(zip(*rows), names)], names)


def archived(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write ``pages`` as archives below ``folder``; the table of archives."""
    return write(chunked(pages, records(pages, least)), folder)


def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as it is read back from the archives."""
    pages = table(spark, folder, "pages", "page_id", "url", "html")
    found = read(archived(pages, scratch.scratch_path(spark, "warc")), data=False)
    return found.select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )
