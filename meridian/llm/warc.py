"""WARC archives with an index first: write, find in the index, and read sorted byte ranges.

Each task writes its rows as gzip members, one for each record, and returns an index row (file, offset, length, url,
digest) for each. A reader takes index rows, sorts them by file and offset, and joins ranges that lie close together
into one read, so a selection of records costs few requests.

Of records with equal payloads the one with the smallest page_id is the response and the others are revisits that
name it. The payloads that occur more than once are found from (digest, page_id) alone; they are broadcast if their
counted number is at most BROADCAST_ROWS and joined by digest otherwise, where skewed partitions can be split.

A null html is an empty payload, a null url an empty one. Rows that repeat the smallest page_id of their payload are
responses each. Null page_ids are responses only where no other row has the payload's bytes with a page_id.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import filesystem, fresh_dir, prepare, written

BROADCAST_ROWS = 100_000
#: Ranges with at most this gap are one read; a read takes at most so many bytes, or one record.
GAP, RANGE = 64 << 10, 8 << 20
#: Bytes after which a task begins another file.
FILE_BYTES = 256 << 20
#: Archive bytes that a task reads, where there are more of them than cores can share.
TASK_BYTES = 64 << 20
DATE = "2000-01-01T00:00:00Z"
INDEX = "page_id long, url string, digest string, file string, offset long, length long, record_type string"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def base32(hexdigest: str) -> str:
    return base64.b32encode(bytes.fromhex(hexdigest)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record, uncompressed."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + body
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {re.sub(r'[\x00-\x20]', lambda m: f'%{ord(m[0]):02X}', url or '')}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """A record's headers, its HTTP headers and its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    block = rest[: int(warc["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def write(pages: DataFrame, folder: str, level: int = 4) -> DataFrame:
    """Writes the archives under ``folder`` (a URI that all executors share); returns the index, a written table."""
    spark = prepare(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    firsts = rows.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("sha", "first")
    firsts = written(firsts, "warc-repeats")
    few = firsts.count() <= BROADCAST_ROWS
    joined = rows.join(F.broadcast(firsts) if few else firsts, "sha", "left").select("page_id", "url", "html", "sha", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        name, sink, at = "", None, 0
        for batch in batches:
            out: list[tuple] = []
            for page_id, url, html, sha, first in zip(*(c.to_pylist() for c in batch.columns)):
                if sink is None:
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    sink = fs.open_output_stream(f"{root}/{name}", compression=None)
                digest = base32(sha)
                refers = first if first is not None and first != page_id else None
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                raw = packer.compress(record(page_id, url, html.encode(), digest, refers)) + packer.flush()
                sink.write(raw)
                out.append((page_id, url, digest, name, at, len(raw), "response" if refers is None else "revisit"))
                at += len(raw)
                if at >= FILE_BYTES:
                    sink.close()
                    sink = None
            if out:
                types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["page_id", "url", "digest", "file", "offset", "length", "record_type"])
        if sink is not None:
            sink.close()

    return written(joined.mapInArrow(run, INDEX), "warc-index")


def read(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that the index rows name; revisits have no payload. Each payload is held against its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        open_name, file = None, None
        for batch in batches:
            rows = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("file", "offset", "length"))))
            i = 0
            while i < len(rows):
                name, first, end, j = rows[i][0], rows[i][1], rows[i][1] + rows[i][2], i + 1
                while j < len(rows) and rows[j][0] == name and rows[j][1] - end <= GAP and rows[j][1] + rows[j][2] - first <= RANGE:
                    end = max(end, rows[j][1] + rows[j][2])
                    j += 1
                if name != open_name:
                    if file is not None:
                        file.close()
                    open_name, file = name, fs.open_input_file(f"{root}/{name}")
                data = file.read_at(end - first, first)
                out = []
                for _, offset, length in rows[i:j]:
                    warc, http, payload = parse(gzip.decompress(data[offset - first : offset - first + length]))
                    kind, digest = warc["WARC-Type"], warc["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and base32(hashlib.sha1(payload).hexdigest()) != digest:
                        raise RuntimeError(f"{name}: the payload at {offset} does not have its digest")
                    size = len(payload) if kind == "response" else int(http["Content-Length"])
                    out.append((_page(warc["WARC-Record-ID"]), size, digest, kind, _page(warc.get("WARC-Refers-To")), warc["WARC-Target-URI"], payload if payloads and kind == "response" else None))
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"])
                i = j
        if file is not None:
            file.close()

    spark = prepare(index.sparkSession)
    ranges = index.select("file", "offset", "length", F.floor(F.col("offset") / RANGE).alias("chunk"))
    # a task's work is the archive bytes that it reads, of which the small index rows tell nothing to the planner
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // TASK_BYTES), min(spark.sparkContext.defaultParallelism, -(-total // RANGE)))
    return ranges.repartition(tasks, "file", "chunk").sortWithinPartitions("file", "offset").mapInArrow(run, RECORD)


def write_and_read(pages: DataFrame) -> DataFrame:
    folder = fresh_dir(pages.sparkSession, "warc")
    return read(write(pages, folder), folder, payloads=False)
