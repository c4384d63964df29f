"""WARC archives of web pages: writer and splittable reader.

Each record is a gzip member of its own.  A reader task gets a byte range: it
looks for the gzip magic, takes a candidate for a member only if its decoded bytes
begin like a record header, and owns the records whose members start inside its
range, reading past the range's end for the last one.  So archives are cut at any
byte, and no index is needed.

A page whose payload equals an earlier one (smallest page id) of at least
``least_bytes`` bytes is a revisit record without payload, which names the
response by its record id and carries digest and size of the full payload.
"""
from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import fresh_dir, prepare
from .files import listed, open_fs, written

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
LEAST_BYTES = 100
CHUNK = 1 << 18
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    tail = (name or "").strip("<>").rpartition(":")[2]
    return int(tail) if tail.lstrip("-").isdigit() else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, digest: str) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = (url or "about:blank").replace("\r", "%0D").replace("\n", "%0A")
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", "WARC-Date: 2024-01-01T00:00:00Z",
            f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    raw = VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    gz = zlib.compressobj(3, zlib.DEFLATED, 31)
    return gz.compress(raw) + gz.flush()


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.lower()] = value.strip()
    return fields, rest[:int(fields["content-length"])]


def members(source, size: int, first: int, last: int) -> Iterator[tuple[int, bytes]]:
    """(start, decoded bytes) of the record members that start in [first, last)."""
    buffer, at = b"", first  # buffer holds the bytes from ``at`` on

    def more() -> bool:
        nonlocal buffer
        got = source.read_at(min(CHUNK, size - at - len(buffer)), at + len(buffer)) if at + len(buffer) < size else b""
        buffer += got
        return bool(got)

    def decoded(limit: int | None) -> tuple[bytes, int] | None:
        """Decodes at the buffer's start: up to ``limit`` bytes, or the whole member and its length; None if it isn't one."""
        d, out, fed = zlib.decompressobj(31), [], 0
        try:
            while not d.eof:
                if fed == len(buffer) and not more():
                    return None
                out.append(d.decompress(buffer[fed:], limit or 0))
                fed = len(buffer)
                if limit and sum(map(len, out)) >= limit:
                    return b"".join(out), 0
        except zlib.error:
            return None
        return b"".join(out), len(buffer) - len(d.unused_data)

    while at < last and at < size:
        if not buffer and not more():
            return
        k = buffer.find(MAGIC)
        if k < 0:
            # the magic may begin in the last two bytes
            at, buffer = at + max(0, len(buffer) - 2), buffer[-2:]
            if not more():
                return
            continue
        at, buffer = at + k, buffer[k:]
        if at >= last:
            return
        start = decoded(len(VERSION))
        whole = decoded(None) if start and start[0].startswith(b"WARC/1.") else None
        if whole is None:
            at, buffer = at + 1, buffer[1:]
            continue
        yield at, whole[0]
        at, buffer = at + whole[1], buffer[whole[1]:]


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Writes the archives of ``pages`` (page_id, url, html); returns (name, bytes, records) of each."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    hashed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("html"), F.sha2(payload, 256).alias("digest"))
    firsts = (hashed.where(F.octet_length("html") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
              .where("n > 1 and first is not null").select("digest", "first"))
    marked = hashed.join(firsts, "digest", "left")

    def write(batches):
        part, n, size = TaskContext.get().partitionId(), 0, 0
        name = f"part-{part:06d}.warc.gz"
        out = None
        with written(f"{path}/{name}") as out:
            for b in batches:
                for page, url, html, digest, first in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "first"))):
                    got = record(page, url, html.encode(), first, first is not None and page != first, digest)
                    out.write(got)
                    n, size = n + 1, size + len(got)
        yield pa.RecordBatch.from_pydict({"name": [name], "bytes": [size], "records": [n]})

    return marked.select("page_id", "url", "html", "digest", "first").mapInArrow(write, "name string, bytes long, records long")


def read_archives(spark: SparkSession, path: str, split_bytes: int = 8 << 20, names: DataFrame | None = None, payloads: bool = False) -> DataFrame:
    """Records of the archives below ``path`` (those of ``names``, or all): page_id,
    payload_bytes, payload_digest, record_type, refers_to, url, archive, offset, and
    with ``payloads`` the payload of responses.

    A response's size and digest are of the payload read, which must agree with its
    header; a revisit's come from its header.
    """
    prepare(spark)
    found = listed(path, ".warc.gz") if names is None else sorted((r["name"], r["bytes"]) for r in names.select("name", "bytes").collect())  # one row a file
    splits = [(name, size, at, min(size, at + split_bytes)) for name, size in found for at in range(0, size, split_bytes)]
    kinds = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
             ("url", pa.string()), ("archive", pa.string()), ("offset", pa.int64())] + [("payload", pa.binary())] * payloads
    schema = pa.schema(kinds)

    def read(batches):
        store, folder = open_fs(path)
        for b in batches:
            for name, size, first, last in zip(*(b.column(c).to_pylist() for c in ("name", "size", "first", "last"))):
                with store.open_input_file(f"{folder}/{name}") as source:
                    source_rows = []
                    for at, raw in members(_At(source), size, first, last):
                        fields, block = parse(raw)
                        digest, n = fields["warc-payload-digest"].partition(":")[2], int(fields["x-payload-length"])
                        revisit = fields["warc-type"] == "revisit"
                        payload = block.partition(b"\r\n\r\n")[2]
                        if not revisit and (len(payload) != n or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"{name} at {at}: payload doesn't agree with its header")
                        row = (page_of(fields["warc-record-id"]), n, digest, fields["warc-type"], page_of(fields.get("warc-refers-to")), fields["warc-target-uri"], name, at)
                        source_rows.append(row + (((None if revisit else payload),) if payloads else ()))
                        if len(source_rows) >= 500:
                            yield _batch(source_rows, schema)
                            source_rows = []
                    if source_rows:
                        yield _batch(source_rows, schema)

    columns = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, archive string, offset long" + (", payload binary" if payloads else "")
    rows = spark.createDataFrame(splits, "name string, size long, first long, last long")
    return rows.repartition(max(1, len(splits)), "name", "first").mapInArrow(read, columns)


class _At:
    """Reads of a random-access file by place."""

    def __init__(self, source):
        self.source = source

    def read_at(self, n: int, at: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def warc_round_trip(pages: DataFrame, path: str | None = None, least_bytes: int = LEAST_BYTES, split_bytes: int = 8 << 20) -> DataFrame:
    """Writes ``pages`` as archives and returns the records read back.

    A null html is an empty payload and a null url "about:blank".  A null page_id
    is written as "null" and read as null; it is never the response that others
    refer to.  Rows with equal id and payload: all with the smallest id are
    responses.  An empty table gives empty archives and no rows.
    """
    spark = pages.sparkSession
    prepare(spark)
    path = path or fresh_dir(spark, "warc")
    files = [tuple(r) for r in write_archives(pages, path, least_bytes).collect()]  # one row a file
    return read_archives(spark, path, split_bytes, spark.createDataFrame(files, "name string, bytes long, records long"))
