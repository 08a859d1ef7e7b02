"""WARC archives, index first.

Writing gives one index row per record (file, offset, length, URL, payload digest); reading
starts from any selection of index rows, sorts them by file and offset, and fetches neighbouring
records in one byte range each, so no archive is scanned.

Each record is a gzip member of its own. Payloads that several pages share are written once: of
equal payloads of at least ``REVISIT_BYTES`` bytes, the page with the largest id is the response
and the others are revisit records that name it. Groups of equal payloads are found with a
combinable ``max`` per digest, so thousands of copies of one page are no hot group. Shared digests
are counted and, if few, broadcast: then no html is shuffled or sorted, and pages of any size stream
through the tasks that read them.

A task writes files under names of its own, and the index is written to the shared folder before
it is used: a task that runs twice leaves an unused file, never a wrong row. Files are reached
through ``pyarrow.fs``, so the folder can be any store that it supports.

Null or empty html is a record without payload, a null URL an empty one. Repeated page ids give
repeated rows. A page whose id is null can only revisit, or respond if its payload is its own.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.llm.common import mapped, partitions, small_batches, text_slices, written
from martlens.session import scratch_path

REVISIT_BYTES = 1000
FILE_BYTES = 1 << 30
RANGE_BYTES = 4 << 20
GAP_BYTES = 64 << 10
SLICE_BYTES = 4 << 20
#: Shared digests up to which they are broadcast; with more, pages are joined with them.
SHARED_ROWS = 100_000
INDEX = "page_id long, url string, file string, offset long, length long, digest string, payload_bytes long, record_type string, refers_to long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def record(page: int | None, url: str, kind: str, refers: int | None, digest: str, payload: bytes, size: int) -> bytes:
    """One WARC/1.1 record as a gzip member; a revisit has no payload but tells digest and size."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
            f"WARC-Target-URI: {url}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
            f"WARC-Payload-Length: {size}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers}>"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 1, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields and payload of a record written by :func:`record`."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) to ``folder``; returns the index."""
    rows = pages.select(F.col("page_id").cast("long"), F.coalesce(F.regexp_replace("url", "[\r\n]", ""), F.lit("")).alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    shared = (rows.filter(F.octet_length("html") >= REVISIT_BYTES).groupBy("digest")
              .agg(F.max("page_id").alias("response"), F.count("*").alias("n")).filter("n > 1 AND response IS NOT NULL").drop("n"))
    shared = written(shared, "warc-shared")
    few = shared.limit(SHARED_ROWS + 1).count() <= SHARED_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = filesystem(folder)
        out, name = None, ""
        try:
            for batch in text_slices(batches, "html", SLICE_BYTES):
                index = []
                for page, url, html, digest, response in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None or out.tell() >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name = f"pages-{uuid.uuid4().hex}.warc.gz"
                        out = store.open_output_stream(f"{at}/{name}", compression=None)
                    payload = html.encode()
                    kind = "response" if response is None or response == page else "revisit"
                    refers = response if kind == "revisit" else None
                    member = record(page, url, kind, refers, digest, payload, len(payload))
                    index.append((page, url, f"{folder}/{name}", out.tell(), len(member), digest, len(payload), kind, refers))
                    out.write(member)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*index), schema.types)], schema=schema)
        finally:
            if out is not None:
                out.close()

    schema = pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in (f.split() for f in INDEX.split(", "))])
    joined = rows.join(F.broadcast(shared) if few else shared, "digest", "left").select("page_id", "url", "html", "digest", "response")
    filesystem_made(folder)
    with small_batches(pages.sparkSession):
        return written(mapped(joined, run, INDEX), "warc-index")


def filesystem_made(folder: str) -> None:
    store, at = filesystem(folder)
    store.create_dir(at, recursive=True)


def read_records(index: DataFrame) -> DataFrame:
    """The records that the rows of ``index`` point to, each checked against its digest.

    A range ends where its records, or the payloads that they unpack to, reach ``RANGE_BYTES``, so
    a task holds a few MB (one record at least), however well the pages are packed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fetched(rows: list[tuple]) -> pa.RecordBatch:
            """Records of one coalesced range."""
            file, start, end = rows[0][0], rows[0][1], max(r[1] + r[2] for r in rows)
            if opened.get("file") != file:
                if opened:
                    opened["in"].close()
                store, at = filesystem(file)
                opened.update({"file": file, "in": store.open_input_file(at)})
            data = opened["in"].read_at(end - start, start)
            out = []
            for _, offset, length, _ in rows:
                fields, payload = parse(data[offset - start : offset - start + length])
                kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"][5:]
                if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"digest mismatch at {file}:{offset}")
                page, refers = fields["WARC-Record-ID"][10:-1], fields.get("WARC-Refers-To", "<urn:page:>")[10:-1]
                out.append((int(page) if page else None, fields["WARC-Target-URI"], kind, int(refers) if refers else None, digest,
                            int(fields["WARC-Payload-Length"]), payload if kind == "response" else None))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

        opened: dict = {}
        held: list[tuple] = []
        unpacked = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (row[0] != held[0][0] or row[1] - held[-1][1] - held[-1][2] > GAP_BYTES or row[1] + row[2] - held[0][1] > RANGE_BYTES
                             or unpacked + row[3] > RANGE_BYTES):
                    yield fetched(held)
                    held, unpacked = [], 0
                held.append(row)
                unpacked += row[3]
        if held:
            yield fetched(held)
        if opened:
            opened["in"].close()

    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, types[t]) for n, t in (f.split() for f in RECORD.split(", "))])
    payload = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(0)
    wanted = index.select("file", "offset", "length", payload.alias("unpacked")).repartitionByRange(partitions(index.sparkSession), "file", "offset")
    return mapped(wanted.sortWithinPartitions("file", "offset"), run, RECORD)


def archive_folder(spark) -> str:
    return scratch_path(spark, "llm", f"warc-{uuid.uuid4().hex}")
