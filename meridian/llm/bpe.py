"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Each block of documents explodes its distinct pre-tokens with their place in the block's word list; the words meet
in one shuffle, where each distinct word is encoded once; the ids go back to their blocks and are put at the words'
positions. Positions never leave the block that can compute them again from its own text, so what is shuffled is the
vocabulary of each block and one packed number for each word of text. Decoding joins the token-byte table, which has
a proven bound (the vocabulary file).

Null and empty texts give no ids. Repeated rows and repeated or null keys are encoded row by row.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from meridian.llm.common import BLOCK_BYTES, blocks, broadcast_bytes, pack, partitions, prepare, ragged, sole, unpack
from meridian.llm.pretoken import distinct


#: Text bytes for which there is a bucket of words at least.
BUCKET_BYTES = 256 << 20


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


@functools.lru_cache(1)
def _encoding(data: bytes):
    """One for a Python worker, which runs many tasks."""
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(data), special_tokens={})


@functools.lru_cache(1)
def _token_bytes(data: bytes) -> list[bytes]:
    found = read_ranks(data)
    table = [b""] * (max(found.values()) + 1)
    for token, rank in found.items():
        table[rank] = token
    return table


def _explode(buckets: int, size: int):
    """A block's distinct words, dealt out by word: their places in the block's list, lengths and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in blocks(batches, size):
            words = [w.encode() for w in distinct([t or "" for t in rows.column("text").to_pylist()])[0]]
            to = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % buckets
            order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
            order = order[np.argsort(to[order], kind="stable")]
            cuts = np.concatenate([[0], np.cumsum(np.bincount(to, minlength=buckets))])
            full = [b for b in range(buckets) if cuts[b + 1] > cuts[b]]
            blobs = []
            for b in full:
                idx = order[cuts[b] : cuts[b + 1]]
                part = [words[i] for i in idx.tolist()]
                blobs.append(pack(idx.astype(np.uint32), np.fromiter(map(len, part), np.uint32, len(part)), b"".join(part)))
            yield pa.RecordBatch.from_pydict({"block": pa.array([block] * len(full), pa.string()), "bucket": pa.array(full, pa.int32()), "words": pa.array(blobs, pa.binary())})

    return run


def _layout(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in blocks(batches, size):
            _, flat, counts = distinct([t or "" for t in rows.column("text").to_pylist()])
            keys = rows.select([x for x in rows.schema.names if x != "text"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, keys.schema) as writer:
                writer.write_table(keys)
            yield pa.RecordBatch.from_pydict({"block": pa.array([block]), "layout": pa.array([pack(counts.astype(np.uint32), _planes(flat), sink.getvalue().to_pybytes())], pa.binary())})

    return run


def _encoder(ranks_file):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _encoding(ranks_file.value)
        known: dict[bytes, bytes] = {}  # a word's rows all meet here: each distinct word is encoded once
        for rows in batches:  # the bucket streams; what is held are its distinct words
            for block, blob in zip(rows.column("block").to_pylist(), rows.column("words").to_pylist()):
                idx, lengths, data = unpack(blob)
                order = np.argsort(idx)
                ends = np.cumsum(lengths, dtype=np.int64)
                ids = []
                for a, b in zip((ends - lengths)[order].tolist(), ends[order].tolist()):
                    word = data[a:b]
                    got = known.get(word)
                    if got is None:
                        got = known[word] = np.array(made.encode_ordinary(word.decode()), "<u4").tobytes()
                    ids.append(got)
                counts = np.fromiter(map(len, ids), np.uint32, len(ids)) // 4
                out = pack(np.diff(idx[order], prepend=np.uint32(0)), counts, _planes(np.frombuffer(b"".join(ids), "<u4")))
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([out], pa.binary())], names=["block", "ids"])

    return encode


def _planes(x: np.ndarray) -> np.ndarray:
    """The bytes of 32-bit numbers, all lowest ones first: they compress better."""
    return x.view(np.uint8).reshape(-1, 4).T.copy()


def _from_planes(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.T).reshape(-1).view("<u4") if x.size else np.zeros(0, "<u4")


def _joined(table: list[bytes], ids: np.ndarray) -> bytes:
    """The token-byte table joined to ids."""
    return b"".join([table[i] for i in ids.tolist()])


def _reassembler(schema: pa.Schema, ranks_file, decoded: bool):
    def reassemble(key, layout: pa.Table, found: pa.Table) -> pa.Table:
        lengths, planes, keys = unpack(sole(layout.column("layout").to_pylist(), str(key[0])))
        words = _from_planes(planes)
        parts = [unpack(x) for x in found.column("ids").to_pylist()]
        idx = np.concatenate([np.zeros(0, np.int64), *(np.cumsum(p[0], dtype=np.int64) for p in parts)])
        if len(idx) != (int(words.max()) + 1 if len(words) else 0):
            raise RuntimeError(f"block {key[0]}: {len(idx)} words came back")
        counts = np.concatenate([np.zeros(0, np.int64), *(p[1].astype(np.int64) for p in parts)])
        ids = np.concatenate([np.zeros(0, "<u4"), *(_from_planes(p[2]) for p in parts)])
        sizes, firsts = np.zeros(len(idx), np.int64), np.zeros(len(idx), np.int64)
        sizes[idx], firsts[idx] = counts, np.cumsum(counts) - counts
        flat = ids[ragged(firsts[words], sizes[words])] if len(words) else ids[:0]
        ends = np.concatenate([[0], np.cumsum(sizes[words])])[np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])]
        data = flat.astype("<u4").tobytes()
        values = pa.array([data[4 * a : 4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary())
        made = [values]
        if decoded:
            table = _token_bytes(ranks_file.value)
            made.append(pa.array([_joined(table, flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary()))
        rows = pa.ipc.open_stream(keys).read_all()
        return pa.Table.from_arrays([*rows.columns, *made], schema=schema)

    return reassemble


def encode(docs: DataFrame, ranks_path: str, keep: tuple[str, ...] = ("doc_id",), block_bytes: int = BLOCK_BYTES, decoded: str | None = None) -> DataFrame:
    """``keep`` columns and ``ids``: the ids of the whole text as little-endian unsigned 32-bit integers.

    decoded: a column with the bytes that the ids decode to, as ``decode`` makes it, without another pass of the ids
    through a second worker.

    docs must give the same rows in the same order each time it is read (a table does; ``written`` makes one);
    otherwise the query fails rather than mixing blocks up. Columns other than text and ``keep`` are not read.
    """
    spark = prepare(docs.sparkSession)
    with open(ranks_path, "rb") as f:
        ranks = broadcast_bytes(spark, f.read())
    rows = docs.select(*keep, F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, 2 * partitions(spark), -(-size // BUCKET_BYTES))
    words = rows.mapInArrow(_explode(buckets, block_bytes), "block string, bucket int, words binary")
    back = words.groupBy("bucket").applyInArrow(_encoder(ranks), "block string, ids binary")
    layout = rows.mapInArrow(_layout(block_bytes), "block string, layout binary")
    made = ["ids", *([decoded] if decoded else [])]
    if set(made) & set(keep):
        raise ValueError("keep names a column that is made here")
    out = T.StructType([*rows.select(*keep).schema.fields, *(T.StructField(c, T.BinaryType()) for c in made)])
    schema = to_arrow_schema(out)
    return layout.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_reassembler(schema, ranks, bool(decoded)), out)


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes of the ids by the token-byte table."""
    with open(ranks_path, "rb") as f:
        ranks = broadcast_bytes(prepare(encoded.sparkSession), f.read())

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _token_bytes(ranks.value)
        for batch in batches:
            data = [None if x is None else _joined(table, np.frombuffer(x, "<u4")) for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], names=[*batch.schema.names, out])

    if out in encoded.columns:
        raise ValueError(f"{out} is a column already")
    return encoded.mapInArrow(join, T.StructType([*encoded.schema.fields, T.StructField(out, T.BinaryType())]))


def unpacked(encoded: DataFrame, ids: str = "ids") -> DataFrame:
    """The ids as array<long> instead of packed bytes."""

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            lists = pa.array([None if x is None else np.frombuffer(x, "<u4").astype(np.int64) for x in batch.column(at).to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([lists if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

    columns = [f"`{f.name}` {'array<bigint>' if f.name == ids else f.dataType.simpleString()}" for f in encoded.schema]
    return encoded.mapInArrow(widen, ", ".join(columns))
