"""Operator 10: WARC archives as a chunked record table.

A record is a run of rows (record, chunk, data): chunk 0 holds the header block, an HTTP head and the
first bytes of the payload, later chunks the next `chunk_bytes` each, the last one the record's
trailer. The data of all chunks of an archive, in order, is a WARC/1.1 file. Payload slices are views
of the input buffer: no whole record is copied or joined. Every row carries the SHA-1 of the payload so
far (`running`), so a reader checks a chunk against its predecessor's state, and the last one is the
digest of the whole payload.

Of payloads that are equal and have at least `revisit_from` bytes, the record with the largest id is a
response; the others are revisits that name it. Groups of copies are never gathered: digests are
aggregated to (digest, largest id), and only the narrow (id, digest) rows meet them in a join.

Defined results: a null payload is empty; a null url is left out; rows that tie on the largest id are
all responses; a row without an id is a response unless an equal payload has an id; empty tables give
empty archives; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm._common import bounded_batches, in_blocks, materialise

CHUNK_SCHEMA = "archive int, record long, chunk int, last boolean, running binary, data binary"
SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def decide(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """(p, target) for each row that revisits `target`; narrow rows only.

    p is the row's id; `target` is the largest id of an equal payload.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("p"), F.sha1(payload).alias("digest"), F.length(payload).alias("n"))
    rows = rows.where(F.col("n") >= revisit_from)
    groups = rows.groupBy("digest").agg(F.max("p").alias("target"), F.count("*").alias("rows")).where("rows > 1").select("digest", "target")
    return rows.join(groups, "digest").where("not p <=> target and target is not null").select("p", "digest", "target").distinct()


def write_archives(pages: DataFrame, chunk_bytes: int = 1 << 20, revisit_from: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row; returns the chunk table as read back from the shared folder."""
    revisits = decide(pages, revisit_from)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary")))
    joined = rows.alias("r").join(revisits.alias("v"), F.expr("r.page_id <=> v.p and r.digest = v.digest"), "left")
    joined = joined.select("r.page_id", "r.url", "r.html", "v.target")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, out, held = 0, [], 0
        names = [x.split()[0] for x in CHUNK_SCHEMA.split(", ")]
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()]

        def take() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        for batch in in_blocks(batches, "html", 8 << 20):
            archive = batch.column("archive")[0].as_py()  # the same in all rows
            html = batch.column("html").cast(pa.binary())
            for i, (page, url, target) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "target")))):
                value = html[i].as_buffer() if html[i].is_valid else None
                payload = memoryview(value) if value is not None else memoryview(b"")
                for row in record_chunks(page, url, payload, target, chunk_bytes, date):
                    out.append((archive, record, *row))
                    held += len(row[-1])
                    if held >= 8 << 20 or len(out) >= 20_000:
                        yield take()
                        out, held = [], 0
                record += 1
        if out:
            yield take()

    bounded_batches(pages.sparkSession)
    chunks = joined.withColumn("archive", F.spark_partition_id()).mapInArrow(run, CHUNK_SCHEMA)
    return materialise(chunks, "warc-chunks")


def record_chunks(page: int | None, url: str | None, payload: memoryview, target: int | None, chunk_bytes: int, date: str) -> Iterator[tuple[int, bool, bytes, bytes]]:
    """(chunk, last, running digest, data) of one record, in order."""
    whole = hashlib.sha1(payload)
    block = hashlib.sha1(_HTTP)
    body = payload if target is None else payload[:0]
    block.update(body)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if target is None else 'revisit'}",
        f"WARC-Record-ID: {_name(page)}",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(_HTTP) + len(body)}",
        f"WARC-Block-Digest: sha1:{_base32(block.digest())}",
        f"WARC-Payload-Digest: sha1:{_base32(whole.digest())}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        # a target URI is one line of printable characters
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if target is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_name(target)}")
    head = "\r\n".join(lines).encode() + b"\r\n\r\n" + _HTTP
    running = hashlib.sha1()
    n = max(1, -(-len(body) // chunk_bytes))
    for k in range(n):
        part = body[k * chunk_bytes : (k + 1) * chunk_bytes]
        running.update(part)
        last = k == n - 1
        yield k, last, running.digest(), b"".join((head if k == 0 else b"", part, b"\r\n\r\n" if last else b""))


class _Reader:
    """Folds a record's chunks, one at a time; holds the header and the digest, not the payload."""

    def __init__(self):
        self.key, self.open = None, False

    def end(self) -> None:
        if self.open:
            raise ValueError(f"record {self.key}: chunks are missing, the last one is wrong")

    def feed(self, key: tuple[int, int], chunk: int, last: bool, running: bytes, data: bytes) -> tuple | None:
        view = memoryview(data)
        if chunk == 0:
            self.end()
            self.open = True
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            if lines[0] != "WARC/1.1":
                raise ValueError(f"record {key}: not a WARC record")
            self.key, self.next = key, 0
            self.fields = dict(x.split(": ", 1) for x in lines[1:])
            self.left, self.sha, self.size = int(self.fields["Content-Length"]), hashlib.sha1(), 0
            self.block = hashlib.sha1()
            at = len(head) + 4
            http = data.index(b"\r\n\r\n", at) + 4
            self.block.update(view[at:http])
            self.left -= http - at
            view = view[http:]
        if key != self.key or chunk != self.next:
            raise ValueError(f"record {key}: chunk {chunk} is out of place")
        self.next += 1
        body = view[: self.left] if last else view
        self.left -= len(body)
        self.size += len(body)
        self.sha.update(body)
        self.block.update(body)
        if self.sha.digest() != running:
            raise ValueError(f"record {key}: chunk {chunk} does not match its running digest")
        if not last:
            return None
        self.open = False
        kind, named = self.fields["WARC-Type"], self.fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if self.left or bytes(view[len(body) :]) != b"\r\n\r\n" or _base32(self.block.digest()) != self.fields["WARC-Block-Digest"].removeprefix("sha1:"):
            raise ValueError(f"record {key}: length or block digest is wrong")
        size = int(self.fields["X-Payload-Length"])
        if kind == "response" and (_base32(self.sha.digest()) != named or self.size != size):
            raise ValueError(f"record {key}: payload digest or length is wrong")
        number = lambda name: int(x) if (x := self.fields[name][12:-1]) else None
        return number("WARC-Record-ID"), size, named, kind, number("WARC-Refers-To") if kind == "revisit" else None


def read_archives(chunks: DataFrame) -> DataFrame:
    """One row per record, parsed and checked from its chunks.

    Records of one chunk are read where they lie; only the chunks of larger ones are brought together
    by record, and folded one by one in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("archive", "record", "chunk", "last", "running")]
            data, rows = batch.column("data"), []
            for i, (archive, record, chunk, last, running) in enumerate(zip(*columns)):
                row = reader.feed((archive, record), chunk, last, running, data[i].as_py())
                if row:
                    rows.append(row)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds)], names=names)
        reader.end()

    single = chunks.where("chunk = 0 and last").mapInArrow(run, SCHEMA)
    large = chunks.where("not (chunk = 0 and last)").repartition("archive", "record")
    return single.unionAll(large.sortWithinPartitions("archive", "record", "chunk").mapInArrow(run, SCHEMA))


def export_files(chunks: DataFrame, folder: str) -> None:
    """Write each archive as a plain ``archive.warc`` into a folder that the executors see."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        attempt, now, out = TaskContext.get().taskAttemptId(), None, None

        def close():
            out.close()
            store.move(f"{base}/{now:06d}.warc.{attempt}", f"{base}/{now:06d}.warc")

        for batch in batches:
            for archive, data in zip(batch.column("archive").to_pylist(), batch.column("data")):
                if archive != now:
                    if out:
                        close()
                    now, out = archive, store.open_output_stream(f"{base}/{archive:06d}.warc.{attempt}")
                out.write(data.as_buffer())
        if out:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([1], pa.int64())], names=["n"])

    chunks.repartition("archive").sortWithinPartitions("archive", "record", "chunk").mapInArrow(run, "n long").agg(F.sum("n")).collect()
