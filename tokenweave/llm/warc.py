"""WARC writing and reading over a chunked record table.

An archive is a run of rows ``(archive, record_no, chunk_no, last, data, digest)``: the record's bytes in
order are the concatenation of its chunks, and ``digest`` is the SHA-1 of the payload bytes up to the end of
the chunk.  A record longer than ``chunk_bytes`` is streamed as several rows, never joined in memory; the
rows of one archive, in (record_no, chunk_no) order, are a valid WARC/1.1 file (``export_archives``).

The table is written by Spark's committer into a shared folder, so a task that is lost is run again and
leaves nothing behind.  Records of one chunk are read where they lie; only chunks of oversized records
are shuffled, by record, and hashed one after the other.

Defined cases: a null payload is empty; a null url is left out; a null page id is never a revisit and reads
back null; rows that repeat the largest page id of a group are all responses; an empty table gives an empty
archive table and no records; other input columns are ignored, so names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenweave.functions.common import ship_by_value
from tokenweave.llm.common import column

ship_by_value(__name__)

CHUNK_SCHEMA = ("oversized boolean, archive int, record_no bigint, record_id string, chunk_no int, "
                "last boolean, data binary, digest string")
RECORD_SCHEMA = ("archive int, record_no bigint, page string, url string, record_type string, refers_to string, "
                 "payload_bytes bigint, payload_digest string")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BATCH_BYTES = 4 << 20


def record_kinds(pages: DataFrame, min_bytes: int, id_col: str, payload_col: str, url_col: str) -> DataFrame:
    """Pages with ``refers_to``: the page that holds the same payload, or null for a response."""
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    keyed = rows.select("page", "digest", F.octet_length("payload").alias("n")).where(F.col("n") >= min_bytes)
    # payloads are compared by SHA-1 and length, as the archive format does
    groups = (keyed.groupBy("digest", "n").agg(F.max("page").alias("refers_to"), F.count("*").alias("k"))
              .where("k > 1").drop("k"))
    revisits = (keyed.join(groups, ["digest", "n"]).where(F.col("page") < F.col("refers_to"))
                .groupBy("page", "digest").agg(F.max("refers_to").alias("refers_to")))
    return rows.join(revisits, ["page", "digest"], "left")


def _record_id(page) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def _head(page, url, refers_to, digest: str, n: int) -> tuple[bytes, bytes]:
    """WARC header and HTTP header of a record whose payload has ``n`` bytes."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {_record_id(page)}"]
    if url is not None:
        safe = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
        lines.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    length = len(http) + (n if refers_to is None else 0)
    lines += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
              "Content-Type: application/http;msgtype=response", f"Content-Length: {length}", "", ""]
    return "\r\n".join(lines).encode(), http


def _chunks(head: bytes, body: memoryview, size: int) -> Iterator[tuple[bytes, str]]:
    """Chunks of head, body and the two line ends, each with the body's digest so far."""
    sha, at, tail = hashlib.sha1(), 0, b"\r\n\r\n"
    total = len(head) + len(body) + len(tail)
    while at < total:
        end, parts = min(total, at + size), []
        for start, part in ((0, head), (len(head), body), (len(head) + len(body), tail)):
            cut = part[max(0, at - start):max(0, end - start)]
            if part is body:
                sha.update(cut)
            parts.append(cut)
        yield b"".join(parts), sha.hexdigest()
        at = end


def _chunk_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        archive, record_no = TaskContext.get().partitionId(), 0
        schema = pa.schema([("oversized", pa.bool_()), ("archive", pa.int32()), ("record_no", pa.int64()),
                            ("record_id", pa.string()), ("chunk_no", pa.int32()), ("last", pa.bool_()),
                            ("data", pa.binary()), ("digest", pa.string())])
        rows, held = [], 0
        for batch in batches:
            cols = [column(batch, c) for c in ("page", "url", "refers_to", "digest", "payload")]
            for i in range(batch.num_rows):
                page, url, refers_to, digest = (c[i].as_py() for c in cols[:4])
                payload = memoryview(cols[4][i].as_buffer() or b"")  # a view on the batch
                warc, http = _head(page, url, refers_to, digest, len(payload))
                body = payload if refers_to is None else payload[:0]
                big = len(warc) + len(http) + len(body) + 4 > size
                end = -(-(len(warc) + len(http) + len(body) + 4) // size) - 1
                for k, (data, so_far) in enumerate(_chunks(warc + http, body, size)):
                    rows.append((big, archive, record_no, _record_id(page), k, k == end, data, so_far))
                    held += len(data)
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, held = [], 0
                record_no += 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    return run


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", payload_col: str = "html",
                   url_col: str = "url", min_bytes: int = 1000, chunk_bytes: int = 32 << 10) -> None:
    """Write one record per page into the chunked record table at ``path``.

    Of records with equal payloads of ``min_bytes`` or more, the one with the largest page id is a
    response and the others are revisits of it.
    """
    kinds = record_kinds(pages, min_bytes, id_col, payload_col, url_col)
    kinds = kinds.withColumn("page", F.col("page").cast("string")).withColumn("refers_to", F.col("refers_to").cast("string"))
    (kinds.select("page", "url", "refers_to", "digest", "payload")
     .mapInArrow(_chunk_rows(chunk_bytes), CHUNK_SCHEMA)
     .write.partitionBy("oversized").parquet(path))


class _Record:
    """A record read chunk by chunk: headers are kept, the payload is only hashed and counted."""

    def __init__(self) -> None:
        self.head, self.open, self.sha, self.n, self.skip = b"", True, hashlib.sha1(), 0, 0

    def feed(self, data: bytes, digest: str | None) -> None:
        if self.open:
            self.head += data
            first = self.head.find(b"\r\n\r\n")
            second = self.head.find(b"\r\n\r\n", first + 4) if first >= 0 else -1
            if second < 0:
                return
            data, self.head, self.open = memoryview(self.head)[second + 4:], self.head[:second], False
            warc, _, http = self.head.partition(b"\r\n\r\n")
            pair = lambda x: {k.lower(): v for k, v in (y.split(": ", 1) for y in x.decode().split("\r\n")[1:])}
            self.warc, self.http = pair(warc), pair(http)
            self.left = int(self.warc["content-length"]) - len(http) - 4
        own = data[:self.left]
        self.left -= len(own)
        self.sha.update(own)
        self.n += len(own)
        if digest is not None and self.sha.hexdigest() != digest:
            raise ValueError(f"damaged record {self.warc['warc-record-id']}: digest differs after {self.n} bytes")

    def row(self) -> tuple:
        if self.open or self.left:
            raise ValueError(f"record cut short: {self.head[:200]!r}")
        page = lambda x: x[len("<urn:page:"):-1] or None
        kind = self.warc["warc-type"]
        declared = self.warc["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response" and declared != self.sha.hexdigest():
            raise ValueError(f"damaged record {self.warc['warc-record-id']}: payload digest differs")
        refers = self.warc.get("warc-refers-to")
        return (page(self.warc["warc-record-id"]), self.warc.get("warc-target-uri"), kind,
                page(refers) if refers else None, int(self.http["content-length"]), declared)


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("archive", pa.int32()), ("record_no", pa.int64()), ("page", pa.string()), ("url", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string())])
    record = None
    for batch in batches:
        rows, data = [], column(batch, "data")
        meta = zip(*(column(batch, c).to_pylist() for c in ("archive", "record_no", "chunk_no", "last", "digest")))
        for i, (archive, no, chunk, last, digest) in enumerate(meta):
            if chunk == 0:
                record, due = _Record(), 0
            if record is None or chunk != due:
                raise ValueError(f"archive {archive}, record {no}: chunk {chunk} out of order")
            record.feed(data[i].as_py(), digest)
            due += 1
            if last:
                rows.append((archive, no, *record.row()))
                record = None
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives at ``path``; payloads are hashed again and checked."""
    table = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    cols = ["archive", "record_no", "chunk_no", "last", "data", "digest"]
    whole = table.where("not oversized").select(*cols).mapInArrow(_read_rows, RECORD_SCHEMA)
    long_ = (table.where("oversized").select(*cols).repartition("archive", "record_no")
             .sortWithinPartitions("archive", "record_no", "chunk_no").mapInArrow(_read_rows, RECORD_SCHEMA))
    return whole.unionByName(long_)


def _export(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(uri)
        store.create_dir(base)
        at, out, done = None, None, []

        def close() -> None:
            out.close()
            store.move(f"{base}/.{at:06d}.part", f"{base}/{at:06d}.warc")
            done.append(at)

        for batch in batches:
            for archive, data in zip(column(batch, "archive").to_pylist(), column(batch, "data").to_pylist()):
                if archive != at:
                    if out is not None:
                        close()
                    at, out = archive, store.open_output_stream(f"{base}/.{archive:06d}.part")
                out.write(data)
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_pydict({"archive": pa.array(done, pa.int32())})
    return run


def export_archives(spark: SparkSession, path: str, uri: str) -> DataFrame:
    """Write each archive of the table as ``uri/NNNNNN.warc``, streaming its chunks in order."""
    table = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    return (table.select("archive", "record_no", "chunk_no", "data").repartition("archive")
            .sortWithinPartitions("archive", "record_no", "chunk_no").mapInArrow(_export(uri), "archive int"))
