"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in a normal form: lower case, ASCII signs and white space as single blanks. An item of n bytes may
be met with up to k = rate * n edits. Of k + 1 pieces of the item one at least stands unedited in any such passage, so
every exact piece hit, found by one hash pass over the text, gives a place to look; there Myers' bit-parallel
algorithm finds the least edit distance of the whole item. Nothing within the budget is missed.

The items are written to the shared folder in blocks of bounded size by the executors. A task matches its rows against
one block after the other, and holds one block and a bounded part of its rows at a time.

Null and empty texts have no hits; null, empty and sign-only items are never hit. Repeated items and rows are
answered each for itself. An item of so few bytes that rate * n is below one is met only whole and unedited.
"""

from __future__ import annotations

import functools
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from meridian.llm.common import filesystem, free_name, fresh_dir, pack, prepare, quoted, unpack
from meridian.llm.suffix import Prefix, mix

#: Edits allowed for each byte of an item.
RATE = 0.08
#: Bytes of a piece that are looked up by hash, and of a piece that is shorter than that.
SEED_BYTES, SHORT_SEED_BYTES = 12, 8
#: Bytes of items that are matched at once, and of texts that a task holds while it goes through several blocks.
ITEM_BLOCK, HELD_BYTES = 4 << 20, 32 << 20
_CHUNK = 1 << 20


def _table() -> np.ndarray:
    out = np.full(256, 32, np.uint8)
    for a, b in ((48, 58), (97, 123), (128, 256)):
        out[a:b] = np.arange(a, b)
    out[0] = 0
    return out


_TABLE = _table()


def normal(parts: list[str]) -> np.ndarray:
    """The normal forms of texts, each followed by a zero byte."""
    data = np.frombuffer("\0".join([p.lower().replace("\0", " ") for p in parts] + [""]).encode(), np.uint8)
    data = _TABLE[data]
    blank = data == 32
    blank[1:] &= blank[:-1].copy()
    if len(blank):
        blank[0] = False
    return data[~blank]


def distance(pattern: bytes, text: bytes, most: int) -> tuple[int, int] | None:
    """The least edit distance of pattern to a substring of text and that substring's end, if at most ``most`` (Myers 1999)."""
    m = len(pattern)
    peq: dict[int, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        peq[c] |= 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = (ph << 1) & full
        pv = ((mh << 1) | (full & ~(xv | ph))) & full
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return (best, end) if best <= most else None


def pieces(item: bytes, rate: float) -> list[tuple[int, bytes]]:
    """An item's pieces with their places: one more than its error budget, as equal as they can be."""
    k = budget(item, rate)
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def budget(item: bytes, rate: float) -> int:
    if not 0 <= rate < 1:
        raise ValueError(f"rate {rate} is not in [0, 1)")
    return int(rate * len(item) + 1e-9)


def seed_bytes(piece: bytes) -> int:
    """The bytes of a piece that are looked up; few sizes, as each is a pass over the text."""
    return next((n for n in (SEED_BYTES, SHORT_SEED_BYTES) if len(piece) >= n), len(piece))


class Matcher:
    def __init__(self, items: list[tuple[int, bytes]], rate: float):
        self.items, self.rate = items, rate
        self.by_size = []
        groups = defaultdict(list)
        for i, (_, item) in enumerate(items):
            for at, piece in pieces(item, rate):
                groups[seed_bytes(piece)].append((piece, i, at))
        for size, found in groups.items():
            seeds = np.frombuffer(b"".join(p[:size] for p, _, _ in found), np.uint8)
            starts = np.arange(len(found)) * size
            keys = mix(Prefix(seeds)(starts, starts + size))
            order = np.argsort(keys, kind="stable")
            maybe = np.zeros(1 << 22, bool)
            maybe[(keys >> np.uint64(42)).astype(np.int64)] = True
            self.by_size.append((size, keys[order], [found[i] for i in order.tolist()], maybe))

    def hits(self, data: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(place, item, place of the piece in the item) of every whole piece in data."""
        raw = data.tobytes()
        for size, keys, found, maybe in self.by_size:
            for first in range(0, max(0, len(data) - size + 1), _CHUNK):
                h = mix(Prefix(data[first : first + _CHUNK + size - 1]).grams(size))
                at = np.flatnonzero(maybe[(h >> np.uint64(42)).astype(np.int64)])
                low, high = np.searchsorted(keys, h[at], "left"), np.searchsorted(keys, h[at], "right")
                for p, a, b in zip((at + first)[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist()):
                    for piece, item, offset in found[a:b]:
                        if raw.startswith(piece, p):
                            yield p, item, offset

    def match(self, parts: list[str]) -> list[list[tuple[int, int]]]:
        """For each text the items it holds and their least distances."""
        out: list[list[tuple[int, int]]] = [[] for _ in parts]
        data = normal(parts)
        ends = np.flatnonzero(data == 0)
        begins = np.concatenate([[0], ends[:-1] + 1])
        looked = defaultdict(list)
        for p, item, offset in self.hits(data):
            looked[int(np.searchsorted(ends, p)), item].append(p - offset)
        for (doc, i), places in looked.items():
            name, item = self.items[i]
            k = budget(item, self.rate)
            a, b = int(begins[doc]), int(ends[doc])
            text = data[a:b].tobytes()
            if item in text:
                out[doc].append((name, 0))
                continue
            best, low, high = None, None, None
            for p in [*sorted(set(places)), None]:
                if p is not None and low is not None and p - a - k <= high:
                    high = p - a + len(item) + k
                    continue
                if low is not None and (found := distance(item, text[max(0, low) : high], k)) and (best is None or found[0] < best):
                    best = found[0]
                if p is not None:
                    low, high = p - a - k, p - a + len(item) + k
            if best is not None:
                out[doc].append((name, best))
        return out


def _item_blocks(items: DataFrame, folder: str) -> list[str]:
    """Writes the items' normal forms in blocks under ``folder`` and returns the blocks' names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        held, size, names = [], 0, []

        def close() -> None:
            nonlocal held, size
            names.append(f"{uuid.uuid4().hex}.items")
            with fs.open_output_stream(f"{root}/{names[-1]}") as sink:
                sink.write(pack(held))
            held, size = [], 0

        for batch in batches:
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                item = normal([text or ""])[:-1].tobytes().strip(b" ")
                if not item:
                    continue
                if held and size + len(item) > block_bytes:
                    close()
                held.append((item_id, item))
                size += len(item)
        if held:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["name"])

    block_bytes = ITEM_BLOCK
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    # as many tasks as blocks, however the table is dealt over files: every block is a pass over the documents
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return sorted(r.name for r in rows.coalesce(max(1, -(-size // block_bytes))).mapInArrow(run, "name string").collect())


@functools.lru_cache(1)
def _matcher(folder: str, name: str, rate: float) -> Matcher:
    """One for a Python worker, which runs many tasks."""
    fs, root = filesystem(folder)
    with fs.open_input_file(f"{root}/{name}") as f:
        return Matcher(unpack(f.read())[0], rate)


def flag(docs: DataFrame, items: DataFrame, rate: float = RATE, out: str = "leaks") -> DataFrame:
    """docs with ``out``: an array of (item_id, distance), empty for clean rows; a column of that name is replaced."""
    spark = prepare(docs.sparkSession)
    folder = fresh_dir(spark, "items")
    names = _item_blocks(items, folder)
    others = [c for c in docs.columns if c != "text" and c.lower() != out.lower()]
    carried = F.struct(*[F.col(quoted(c)) for c in others]) if others else F.lit(None).cast("int")
    df = docs.select(carried.alias("others"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([*df.schema.fields, T.StructField("found", T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType())])))])
    arrow = to_arrow_schema(schema).field("found").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def matched(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            texts = [[x or "" for x in b.column(1).to_pylist()] for b in held]
            found: list[list[list]] = [[[] for _ in ts] for ts in texts]
            for name in names:
                matcher = _matcher(folder, name, rate)
                for mine, ts in zip(found, texts):
                    for start in range(0, len(ts), 256):
                        for k, hits in enumerate(matcher.match(ts[start : start + 256])):
                            mine[start + k] += hits
            for b, mine in zip(held, found):
                rows = [[{"item_id": i, "distance": d} for i, d in sorted(hits, key=str)] for hits in mine]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows, arrow)], names=["others", "text", "found"])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column(1).nbytes
            if len(names) == 1 or size >= HELD_BYTES:  # many blocks are worth a lot of text at once
                yield from matched(held)
                held, size = [], 0
        if held:
            yield from matched(held)

    text = F.col("text").cast(docs.schema["text"].dataType)
    return df.mapInArrow(run, schema).select(*[(text if c == "text" else F.col("others")[c]).alias(c) for c in docs.columns if c.lower() != out.lower()], F.col("found").alias(out))


def clean(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of docs that hold no item, with all their columns."""
    name = free_name(docs, "__leaks")
    return flag(docs, items, rate, name).filter(F.size(name) == 0).drop(name)
