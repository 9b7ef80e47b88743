"""Token ids as Arrow stream files of fixed-size lists.

Documents are dealt out in ranges of doc_id, encoded, and written as one stream after the other of equal-length
sequences: each file is an Arrow IPC stream whose batches hold ``input_ids`` (fixed-size list of unsigned 16 or 32 bit
numbers) and ``mask`` (fixed-size list of booleans; false where the last sequence is filled up). Every batch has the
same number of sequences, so sequence i of a file is found by arithmetic and read without a copy from mapped memory.
A second stream for each file tells where its documents start.

A task writes under a name of its own and renames at the end; the rows it returns name the files that count, so a task
that is lost or run twice leaves no harm. Null and empty texts have the end id only. Tokens that the tokenizer's file
adds to its vocabulary are recognised in texts, as the library does. Repeated rows are written each; equal doc_ids are
ordered by xxhash64 of the text, then by the text; null doc_ids come first.
"""

from __future__ import annotations

import functools
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridian.llm.common import broadcast_bytes, filesystem, fresh_dir, partitions, prepare, ragged, written
from meridian.llm.pretoken import distinct

#: Ids in a sequence, sequences in a batch.
LENGTH, BATCH = 1024, 256
#: Distinct words whose ids a task remembers.
MEMORY = 1_000_000


def file_schema(wide: bool, length: int) -> pa.Schema:
    kind = pa.uint32() if wide else pa.uint16()
    return pa.schema([pa.field("input_ids", pa.list_(kind, length)), pa.field("mask", pa.list_(pa.bool_(), length))])


class Words:
    """Ids of texts: the distinct pre-tokens of a batch go through the tokenizer, and MEMORY of them are remembered."""

    def __init__(self, data: bytes, kind: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(data)
        self.kind = kind
        self.known: dict[str, bytes] = {}
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: i for i, t in added.items()}
        #: Tokens that take blanks or whole words only, or that stand in normalized text, are left to the library.
        self.plain = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values())
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts and how many each has. Texts are cut at added tokens before their words are told apart."""
        if self.cut is None or not any(map(self.cut.search, texts)):
            return self._encode(texts)
        if not self.plain:
            found = [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found))
        parts = [self.cut.split(t) for t in texts]
        ids, sizes = self._encode([x for p in parts for x in p[::2]])
        follows = np.array([self.added[x] if x is not None else -1 for p in parts for x in (*p[1::2], None)], np.int64)
        after = follows >= 0
        ids = np.insert(ids, np.cumsum(sizes)[after], follows[after].astype(self.kind))
        begins = np.cumsum([0, *(len(p[::2]) for p in parts[:-1])])
        return ids, np.add.reduceat(sizes + after, begins)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words, numbers, pieces = distinct(texts)
        known, fresh = self.known, {}
        new = [w for w in words if w not in known]
        for i in range(0, len(new), 5000):
            part = new[i : i + 5000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                fresh[w] = np.array(e.ids, self.kind).tobytes()
        found = [known[w] if w in known else fresh[w] for w in words]
        if len(known) < MEMORY:
            known.update(fresh)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // np.dtype(self.kind).itemsize
        ids = np.frombuffer(b"".join(found), self.kind)
        begins = np.cumsum(sizes) - sizes
        each = sizes[numbers]
        ends = np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(pieces)])]
        return ids[ragged(begins[numbers], each)], np.diff(ends)


@functools.lru_cache(1)
def _words(data: bytes, kind: str) -> Words:
    """One for a Python worker, which may run many tasks."""
    return Words(data, kind)


class SequenceWriter:
    def __init__(self, sink, schema: pa.Schema, length: int, batch: int):
        self.out, self.schema, self.length, self.batch = pa.ipc.new_stream(sink, schema), schema, length, batch
        self.kind = schema.field("input_ids").type.value_type.to_pandas_dtype()
        self.held: list[np.ndarray] = []
        self.size = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.size += len(ids)
        self.total += len(ids)
        whole = self.length * self.batch
        if self.size >= whole:
            flat = np.concatenate(self.held)
            for i in range(0, len(flat) - whole + 1, whole):
                self._write(flat[i : i + whole], whole)
            rest = flat[len(flat) // whole * whole :]
            self.held, self.size = [rest], len(rest)

    def _write(self, flat: np.ndarray, used: int) -> None:
        mask = np.arange(len(flat)) < used
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (flat, mask)]
        self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.size:
            flat = np.concatenate(self.held)
            padded = np.zeros(-(-len(flat) // self.length) * self.length, self.kind)
            padded[: len(flat)] = flat
            self._write(padded, len(flat))
        self.out.close()


def write(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 0, length: int = LENGTH, batch: int = BATCH) -> DataFrame:
    """Writes the files under ``folder`` (a URI that all executors share) and returns the manifest, a written table:
    file, part (its place in doc_id order), documents, ids, bytes of the stream, wide."""
    from tokenizers import Tokenizer

    spark = prepare(docs.sparkSession)
    with open(tokenizer_path, "rb") as f:
        data = f.read()
    wide = Tokenizer.from_buffer(data).get_vocab_size() > 1 << 16
    shared = broadcast_bytes(spark, data)
    schema, kind = file_schema(wide, length), "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        part = TaskContext.get().partitionId()
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        name, own = f"part-{part:06d}", uuid.uuid4().hex
        words, end = _words(shared.value, kind), np.array([end_id], kind)
        ids, sizes = [], []
        with fs.open_output_stream(f"{root}/.{name}-{own}.arrows") as sink:
            out = SequenceWriter(sink, schema, length, batch)
            for rows in (b for bs in ([first], batches) for b in bs):
                for i in range(0, rows.num_rows, 2000):
                    some = rows.slice(i, 2000)
                    flat, sizes_ = words.encode([x or "" for x in some.column(1).to_pylist()])
                    ends = np.cumsum(sizes_)
                    out.add(np.insert(flat, ends, end))
                    ids += some.column(0).to_pylist()
                    sizes += (sizes_ + 1).tolist()
            out.close()
        counts = np.array(sizes, np.int64)
        index = pa.table({"doc_id": pa.array(ids, pa.int64()), "start": np.cumsum(counts) - counts, "n_tokens": counts})
        with fs.open_output_stream(f"{root}/.{name}-{own}.index") as sink, pa.ipc.new_stream(sink, index.schema) as w:
            w.write_table(index)
        for suffix in ("arrows", "index"):
            fs.move(f"{root}/.{name}-{own}.{suffix}", f"{root}/{name}-{own}.{suffix}")
        yield pa.RecordBatch.from_pydict({"file": pa.array([f"{name}-{own}"]), "part": pa.array([part], pa.int32()), "documents": pa.array([len(ids)], pa.int64()), "ids": pa.array([int(counts.sum())], pa.int64()), "wide": pa.array([wide])})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = rows.repartitionByRange(partitions(spark), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return written(dealt.mapInArrow(run, "file string, part int, documents long, ids long, wide boolean"), "tokens-manifest")


def sequences(path: str, length: int = LENGTH, batch: int = BATCH):
    """A local file's sequences by number, without a copy: ``sequences(path)[i]`` is (ids, mask) of sequence i."""

    class Random:
        def __init__(self):
            self.batches = list(pa.ipc.open_stream(pa.memory_map(path)))

        def __len__(self) -> int:
            return sum(b.num_rows for b in self.batches)

        def __getitem__(self, i: int) -> tuple[np.ndarray, pa.Array]:
            b = self.batches[i // batch]
            at = i % batch
            values = b.column(0).flatten() if b.column(0).offset else b.column(0).values
            return values.to_numpy(zero_copy_only=True)[at * length : (at + 1) * length], b.column(1)[at].values

    return Random()


def read(manifest: DataFrame, folder: str, length: int = LENGTH) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document, from the files."""
    spark = prepare(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for rows in batches:
            for name, before in zip(*(c.to_pylist() for c in rows.columns)):
                with fs.open_input_file(f"{root}/{name}.index") as f:
                    index = pa.ipc.open_stream(f).read_all()
                sizes = index.column("n_tokens").to_numpy()
                with fs.open_input_file(f"{root}/{name}.arrows") as f:
                    stream = pa.ipc.open_stream(f)
                    crcs, doc, left, crc = [], 0, int(sizes[0]) if len(sizes) else 0, 0
                    for b in stream:
                        flat = b.column(0).flatten().to_numpy()
                        used = b.column(1).flatten().to_numpy(zero_copy_only=False)
                        flat = flat[used]
                        at = 0
                        while at < len(flat) and doc < len(sizes):
                            take = min(left, len(flat) - at)
                            crc = zlib.crc32(flat[at : at + take].astype("<u4").tobytes(), crc)
                            at, left = at + take, left - take
                            if not left:
                                crcs.append(crc)
                                doc, crc = doc + 1, 0
                                left = int(sizes[doc]) if doc < len(sizes) else 0
                if len(crcs) != len(sizes):
                    raise RuntimeError(f"{name} holds {len(crcs)} of {len(sizes)} documents")
                starts = index.column("start").to_numpy() + before
                for i in range(0, len(sizes), 10_000):
                    yield pa.RecordBatch.from_arrays([index.column("doc_id").combine_chunks()[i : i + 10_000], pa.array(starts[i : i + 10_000]), pa.array(sizes[i : i + 10_000]), pa.array(crcs[i : i + 10_000], pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # one row for each file: a window over so few is no burden
    total = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("file", F.coalesce(total, F.lit(0)).cast("long").alias("before"))
    return files.repartition(max(partitions(spark), 1), "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    folder = fresh_dir(docs.sparkSession, "tokens")
    return read(write(docs, tokenizer_path, folder, end_id), folder)
