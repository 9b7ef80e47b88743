"""What the operators share: the shared folder, written tables, packing, and blocks of documents."""

from __future__ import annotations

import os
import pickle
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Python workers use one core each and give freed memory back.
WORKER = {"TOKENIZERS_PARALLELISM": "false", "ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_TRIM_THRESHOLD_": str(32 << 20)}
ROOT = str(Path(__file__).resolve().parents[2])
#: Most bytes that an operator may broadcast (vocabulary files, models).
MAX_BROADCAST = 64 << 20
#: Text bytes of a block of documents; a longer document is a block of its own.
BLOCK_BYTES = 8 << 20
#: Bytes of a batch that goes to a Python worker; a longer row is a batch of its own.
BATCH_BYTES = 32 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package and keeps their batches small enough for long texts: by rows and by bytes."""
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, path) if x)
    for key, value in WORKER.items():
        spark.sparkContext.environment.setdefault(key, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where that is unset a local session (tests) gets a folder
    of its own; on a cluster it must be set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        found = _own.get(app) or _own.setdefault(app, "file://" + tempfile.mkdtemp(prefix="meridian-"))
    return found.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage and outlives executors."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables that ``written`` made and nothing reads any more: whatever came from them is written itself."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def filesystem(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it; Spark's names of S3 are understood."""
    scheme, colon, rest = uri.partition("://")
    return pa.fs.FileSystem.from_uri(f"s3://{rest}" if colon and scheme in ("s3a", "s3n") else uri)


def free_name(df: DataFrame, name: str) -> str:
    """name, lengthened until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def broadcast_bytes(spark: SparkSession, data: bytes):
    if len(data) > MAX_BROADCAST:
        raise ValueError(f"{len(data)} bytes are too many to broadcast; the limit is {MAX_BROADCAST}")
    return spark.sparkContext.broadcast(data)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_of_id(column: str = "doc_id"):
    """crc32 of an id's decimal text, unsigned."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


_OUT = zstandard.ZstdCompressor(level=1)
_IN = zstandard.ZstdDecompressor()


def pack(*values) -> bytes:
    """Arrays or bytes as one compressed blob."""
    return _OUT.compress(pickle.dumps(values, protocol=5))


def unpack(blob: bytes) -> tuple:
    return pickle.loads(_IN.decompress(blob))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null is empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[tuple[str, pa.Table]]:
    """Consecutive rows in blocks of at most ``limit`` text bytes (one row at least), with an id.

    The id names the partition, the place in it and the block's content, so two scans of the same table give
    the same blocks; a scan that deals rows otherwise gives other ids, which ``sole`` reports.
    """
    pid, number = TaskContext.get().partitionId(), 0
    held: list[pa.RecordBatch] = []
    size = 0

    def close() -> tuple[str, pa.Table]:
        nonlocal number, size
        out = pa.Table.from_batches(held).combine_chunks()
        digest = xxhash.xxh3_64()
        for name in out.schema.names:
            for chunk in out.column(name).chunks:
                for value in chunk.to_pylist():
                    if value is not None:
                        digest.update(value.encode() if isinstance(value, str) else str(value).encode())
                    digest.update(b"\x00" if value is None else b"\x01")
        held.clear()
        number, size = number + 1, 0
        return f"{pid}-{number}-{digest.hexdigest()}", out

    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index("text"))), 0).to_pylist()
        first = 0
        for i, length in enumerate(lengths):
            if size and size + length > limit:
                if i > first:
                    held.append(batch.slice(first, i - first))
                yield close()
                first = i
            size += length + 1
        if first < batch.num_rows:
            held.append(batch.slice(first))
    if held:
        yield close()


def sole(found: list, block: str):
    """The one row that a block must have."""
    if len(found) != 1:
        raise RuntimeError(f"block {block} has {len(found)} rows: the input gave other rows when it was read again; write it as a table first")
    return found[0]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices starts[i] .. starts[i] + lengths[i] - 1 for all i, one after the other."""
    if not len(lengths):
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths, dtype=np.int64)
    most = max(int(ends[-1]), int(starts.max()) + int(lengths.max()))
    kind = np.int32 if most < 1 << 31 else np.int64  # half the memory where it does
    out = np.repeat((starts.astype(np.int64) - (ends - lengths)).astype(kind), lengths)
    out += np.arange(len(out), dtype=kind)
    return out
