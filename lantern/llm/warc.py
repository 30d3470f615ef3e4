"""WARC archives as a chunked record table.

A record's bytes (WARC header, HTTP header, payload, trailer) are rows (key, chunk_no, data) of bounded size, key a number
of the record's own; rows in order are the archive, byte for byte. Writing and reading stream chunks and carry the
payload's SHA-1 along: a chunk holds the digest up to its end, and the reader compares its own after each chunk, so
neither allocates a whole record and a damaged chunk is found where it is. Of equal payloads of at least min_bytes, the
record with the largest id is a response and the others are revisits that refer to it; smaller payloads are all
responses. Copies of one payload meet their response in many tasks.

Defined results: null html counts as empty; a null url leaves the target out; a null id stays null and is less than any
other, so of a null id and another with the same payload the null one is the revisit; rows that share the id of a
response (a null one too, where no row of the payload has an id) and its payload are responses too; line ends in urls
are escaped; other columns are ignored; an empty table gives an empty archive. A record whose payload doesn't fit its
digests, or that lacks chunks, raises ValueError.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lantern.llm.common import n_partitions, written

CHUNK = 64 << 10
#: Tasks that the copies of one payload are dealt to.
SALTS = 32
DATE = "2024-01-01T00:00:00Z"
#: "key" tells records apart that share an id; "running" is the bare base32 SHA-1 of the payload up to the chunk's end.
TABLE = "key long, record long, chunk_no int, n_chunks int, data binary, running string"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(sha) -> str:
    return base64.b32encode(sha.digest()).decode()


def _urn(record) -> str:
    return f"<urn:page:{'' if record is None else record}>"


def _id(urn: str) -> int | None:
    digits = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def record_head(record, url: str | None, payload_bytes: int, digest: str, refers_to, revisit: bool, date: str = DATE) -> bytes:
    """WARC and HTTP header of a record; the payload of a response follows."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n"
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(record)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if set("\r\n") & set(url) else "WARC-Target-URI: " + url)
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + (0 if revisit else payload_bytes)}"]
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode("utf-8", "surrogatepass")


def chunks(head: bytes, payload: memoryview, chunk: int = CHUNK) -> Iterator[tuple[bytes, str]]:
    """(data, running digest) of a record's rows: the head with the first of the payload, then the rest, then the trailer."""
    sha, at, parts = hashlib.sha1(), 0, head
    while True:
        take = payload[at : at + max(1, chunk - len(parts))]
        sha.update(take)
        at += len(take)
        end = at >= len(payload)
        yield b"".join((parts, take, b"\r\n\r\n" if end else b"")), base32(sha)
        if end:
            return
        parts = b""


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """The chunk table of one record for each page."""
    d = pages.select(F.col(id_col).cast("long").alias("record"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    d = d.withColumn("sha", F.unhex(F.sha1(F.col("html").cast("binary"))))
    copies = d.filter(F.octet_length("html") >= min_bytes).groupBy("sha").agg(F.max("record").alias("response"), F.count(F.lit(1)).alias("n"))
    copies = copies.filter("n > 1").select("sha", "response", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    # pages without copies find nothing here
    met = d.withColumn("salt", F.pmod(F.xxhash64("record", "url"), F.lit(SALTS)).cast("int")).join(copies, ["sha", "salt"], "left")
    revisit = F.col("response").isNotNull() & ~F.col("record").eqNullSafe(F.col("response"))
    decided = met.select("record", "url", "response", F.when(~revisit, F.col("html")).alias("body"), F.octet_length("html").alias("n"), "sha")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("record", pa.int64()), ("chunk_no", pa.int32()), ("n_chunks", pa.int32()), ("data", pa.binary()), ("running", pa.string())])
        rows, held, key = [], 0, TaskContext.get().partitionId() << 33
        for batch in batches:
            for record, url, response, body, n, sha in zip(*(batch.column(i) for i in range(6)), strict=True):
                record, response, digest = record.as_py(), response.as_py(), base64.b32encode(sha.as_py()).decode()
                revisit = not body.is_valid
                head = record_head(record, url.as_py(), n.as_py(), digest, response, revisit)
                payload = memoryview(b"" if revisit else body.as_buffer())
                total = 1 + max(0, -(-(len(payload) - max(1, chunk - len(head))) // chunk))
                for k, (data, running) in enumerate(chunks(head, payload, chunk)):
                    rows.append((key, record, k, total, data, running))
                    held += len(data)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, held = [], 0
                key += 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return decided.mapInArrow(run, TABLE)


class _Reader:
    """Takes a record's chunks in order; keeps its headers and the running digest, which it holds against each chunk's."""

    def __init__(self, record):
        self.record, self.next, self.head, self.fields = record, 0, b"", None
        self.sha, self.left = hashlib.sha1(), 0

    def feed(self, k: int, data: memoryview, running: str) -> None:
        if k != self.next:
            raise ValueError(f"record {self.record}: chunk {self.next} is missing")
        self.next += 1
        if self.fields is None:
            self.head += bytes(data)
            warc = self.head.find(b"\r\n\r\n")
            http = self.head.find(b"\r\n\r\n", warc + 4) if warc >= 0 else -1
            if http < 0:
                return
            lines = self.head[:http].decode("utf-8", "surrogatepass").split("\r\n")
            cut = lines.index("")
            self.fields = dict(x.split(": ", 1) for x in lines[1:cut])
            self.http = dict(x.split(": ", 1) for x in lines[cut + 2 :])
            self.left = int(self.fields["Content-Length"]) - (http + 4 - warc - 4)
            data, self.head = memoryview(self.head)[http + 4 :], b""
        self.sha.update(data[: self.left])
        self.left -= min(self.left, len(data))
        if base32(self.sha) != running:
            raise ValueError(f"record {self.record}: chunk {k} doesn't fit its running digest")

    def row(self) -> tuple:
        if self.fields is None or self.left:
            raise ValueError(f"record {self.record} ends early")
        kind, digest = self.fields["WARC-Type"], self.fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response" and base32(self.sha) != digest:
            raise ValueError(f"record {self.record}: the payload doesn't fit its digest")
        refers = self.fields.get("WARC-Refers-To")
        return _id(self.fields["WARC-Record-ID"]), self.fields.get("WARC-Target-URI"), int(self.http["Content-Length"]), digest, kind, _id(refers) if refers else None


def read_archive(table: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of each record; digests are checked.

    Records of one chunk are read where they lie; only chunks of longer ones are brought together, in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
        reader: _Reader | None = None
        for batch in batches:
            rows = []
            for record, k, total, data, running in zip(*(batch.column(i) for i in range(1, 6)), strict=True):
                k = k.as_py()
                if k == 0:
                    if reader is not None:
                        raise ValueError(f"record {reader.record} ends early")
                    reader = _Reader(record.as_py())
                if reader is None:
                    raise ValueError(f"record {record}: chunk 0 is missing")
                reader.feed(k, memoryview(data.as_buffer()), running.as_py())
                if k + 1 == total.as_py():
                    rows.append(reader.row())
                    reader = None
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        if reader is not None:
            raise ValueError(f"record {reader.record} ends early")

    result = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    t = table.select("key", "record", "chunk_no", "n_chunks", "data", "running")
    long = t.filter("n_chunks > 1").repartition(n_partitions(table.sparkSession), "key").sortWithinPartitions("key", "chunk_no")
    return t.filter("n_chunks = 1").mapInArrow(run, result).unionByName(long.mapInArrow(run, result))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Writes the archive to the shared folder and reads it back."""
    return read_archive(written(archive(pages, id_col, url_col, html_col, min_bytes, chunk), "warc"))


def export(rows: Iterator, out: BinaryIO) -> int:
    """Writes rows of a chunk table, in order of key and chunk_no, as one .warc stream; returns its bytes."""
    return sum(out.write(row["data"]) for row in rows)


def read_stream(f: BinaryIO, chunk: int = CHUNK) -> Iterator[tuple[int | None, int, bytes]]:
    """(record, chunk_no, data) of an uncompressed .warc stream of such records, a chunk at a time."""
    while True:
        line = f.readline()
        if not line:
            return
        head = line
        while line != b"\r\n":
            line = f.readline()
            if not line:
                raise ValueError("the stream ends in a header")
            head += line
        fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:] if x)
        record, left, k, data = _id(fields["WARC-Record-ID"]), int(fields["Content-Length"]) + 4, 0, head
        while left:
            more = f.read(min(left, max(1, chunk - len(data))))
            if not more:
                raise ValueError(f"record {record} ends early")
            left -= len(more)
            yield record, k, data + more
            k, data = k + 1, b""
