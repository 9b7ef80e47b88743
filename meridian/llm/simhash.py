"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position gets a non-zero vector of radius + 1 bits; every non-zero vector v of that length makes a mask of
the positions whose vectors have an odd product with v. Any ``radius`` positions leave some v at right angles to all
their vectors, so two fingerprints that differ there agree under v's mask: every pair within the radius meets in one
of the 2^(radius + 1) - 1 tables, for certain.

Exact copies are one fingerprint before anything is compared. A table's bucket gives a spanning forest of its links,
not its pairs. A bucket of more than ``bucket_limit`` different fingerprints is cut by a second family of masks, in whose
tables its pairs meet for certain too; what is too large even then is dealt out in pairs of blocks, so that no task holds
more than two blocks and no link is lost.

Null and empty texts have the fingerprint zero and are linked like any other. Rows with a null doc_id take part; their
component_id is the smallest doc_id that is not null, null if there is none.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from meridian.llm.common import discard, prepare, texts, written

WORDS, RADIUS, SEED = 4, 4, 42
BUCKET_LIMIT = 8192


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """The hashes of the text's word shingles, repeats included; A-Z are lower-cased, words end at ASCII white space."""
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, "<u8")
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - words + 1)
    one, pairs = xxhash.xxh64_intdigest, zip(begins[:n].tolist(), ends[min(words, len(found)) - 1 :].tolist())
    return np.array([one(joined[a:b], SEED) for a, b in pairs], "<u8")


def majority(hashes: np.ndarray) -> int:
    """64 bits: those set in over half the hashes; none without hashes."""
    n, counts = len(hashes), np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        counts += np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprint(text: str, words: int = WORDS) -> int:
    """The bits set in over half the hashes of the word shingles."""
    return majority(shingle_hashes(text, words))


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([signed(fingerprint(t, words)) for t in texts(batch)], pa.int64())], names=["doc_id", "fp"])

    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def masks(radius: int = RADIUS, family: int = 0) -> list[int]:
    """The tables' masks; families deal the vectors to the positions in ways of their own, and each covers the radius."""
    size = (1 << (radius + 1)) - 1
    vectors = [1 + (i * (7 + 4 * family) + family * (3 + 5 * (i // size))) % size for i in range(64)]
    return [sum(1 << i for i, u in enumerate(vectors) if (u & v).bit_count() & 1) for v in range(1, size + 1)]


def forest(values: np.ndarray, radius: int) -> list[tuple[int, np.ndarray]]:
    """Links that connect whatever the pairs within the radius connect: (one, those linked to it)."""
    out = []
    while len(values) > 1:
        near, values = [values[0]], values[1:]
        while near and len(values):
            x = near.pop()
            hit = np.bitwise_count(values ^ x) <= radius
            if hit.any():
                y = values[hit]
                out.append((x, y))
                near.extend(y)
                values = values[~hit]
    return out


def _bucket_links(radius: int, limit: int):
    """Of rows sorted by (table, key): links as (a, b), members of too large buckets as (a, null, table, key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        large: tuple[int, int] | None = None

        def links(rows: np.ndarray) -> tuple[list, list]:
            """rows: (table, key, fp) of whole buckets."""
            k, key, fp = rows
            first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (key[1:] != key[:-1])]))
            size = np.diff(np.append(first, len(k)))
            fp = fp.view(np.uint64)
            a, b = [], []
            two = first[size == 2]
            two = two[(np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius)]
            a.append(fp[two])
            b.append(fp[two + 1])
            for i, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
                for x, y in forest(fp[i : i + n], radius):
                    a.append(np.full(len(y), x, np.uint64))
                    b.append(y)
            return np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)

        def linked(rows: np.ndarray) -> pa.RecordBatch:
            a, b = links(rows)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.int64())], names=["a", "b", "k", "key"])

        def members(rows: np.ndarray) -> pa.RecordBatch:
            n = rows.shape[1]
            return pa.RecordBatch.from_arrays([pa.array(rows[2]), pa.nulls(n, pa.int64()), pa.array(rows[0].astype(np.int32)), pa.array(rows[1])], names=["a", "b", "k", "key"])

        for batch in batches:
            rows = np.stack([batch.column(0).to_numpy().astype(np.int64), batch.column(1).to_numpy(), batch.column(2).to_numpy()])
            if not rows.shape[1]:
                continue
            if held:
                rows = np.concatenate([*held, rows], axis=1)
                held = []
            if large is not None:
                same = (rows[0] == large[0]) & (rows[1] == large[1])
                n = int(same.sum())
                if n:
                    yield members(rows[:, :n])
                rows = rows[:, n:]
                if not rows.shape[1]:
                    continue
                large = None
            last = np.flatnonzero((rows[0] != rows[0, -1]) | (rows[1] != rows[1, -1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield linked(rows[:, :cut])
            rest = rows[:, cut:]
            if rest.shape[1] > limit:
                large = (int(rest[0, 0]), int(rest[1, 0]))
                yield members(rest)
            else:
                held = [rest]
        if held:
            yield linked(held[0])

    return run


def links(prints: DataFrame, radius: int = RADIUS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a > b) between the different fingerprints ``fp`` of prints that connect all pairs within the radius."""

    def tables(family: int) -> Column:
        return F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for k, m in enumerate(masks(radius, family))]))

    def met(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Links within buckets (k, key), and the members of those that are too large; the write tells if there are any."""
        seen = Observation(f"links-{uuid.uuid4().hex}")
        out = rows.repartition("k", "key").sortWithinPartitions("k", "key").mapInArrow(_bucket_links(radius, bucket_limit), "a long, b long, k int, key long")
        out = written(out.observe(seen, F.count("k").alias("n")), "simhash-links")
        large = out.filter(F.col("k").isNotNull()).select("k", "key", F.col("a").alias("fp")) if seen.get["n"] else None
        return out.filter(F.col("k").isNull()).select("a", "b"), large

    every, large = met(prints.select(tables(0).alias("t"), "fp").select("t.k", "t.key", "fp"))
    if large is not None:
        # every pair of a large bucket meets again in a table of another family: 31 rows a member, however large it is
        again = large.select(tables(1).alias("t"), "k", "key", "fp").select((F.col("k") * len(masks(radius)) + F.col("t.k")).cast("int").alias("k"), F.xxhash64("key", "t.key").alias("key"), "fp")
        more, large = met(again)
        every = every.unionByName(more)
    if large is not None:
        every = every.unionByName(_in_blocks(large, radius, bucket_limit))
    return every.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _in_blocks(large: DataFrame, radius: int, bucket_limit: int) -> DataFrame:
    """Links (a, b) of buckets that stay too large, by pairs of blocks of their members."""
    blocks = large.groupBy("k", "key").agg(F.ceil(F.count("*") / F.lit(bucket_limit)).cast("int").alias("blocks"))
    dealt = large.join(blocks, ["k", "key"]).withColumn("i", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("k", "key", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "fp")

    def pair(table: pa.Table) -> pa.Table:
        a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for x, y in forest(table.column("fp").to_numpy().view(np.uint64), radius):
            a.append(np.full(len(y), x, np.uint64))
            b.append(y)
        return pa.Table.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"])

    return dealt.groupBy("k", "key", "i", "j").applyInArrow(pair, "a long, b long")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node of the edges (a > b): root is its component's smallest node.

    Alternates large-star and small-star steps; each keeps the components and shortens the paths. A node that very
    many edges share is met by a join on which skewed partitions are split, never gathered.
    """
    edges = written(edges, "components")
    state = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(smallest.select("a", F.col("m").alias("b")))
        small = small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        # the edges' number and hash come with the write
        seen = Observation(f"components-{uuid.uuid4().hex}")
        found = written(small.observe(seen, F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")), "components")
        discard(edges)
        edges, now = found, seen.get
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id of the row's component) of each row."""
    prints = written(fingerprints(docs, words), "simhash-prints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    roots = components(links(classes.select("fp"), radius, bucket_limit))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "simhash-rooted")
    discard(classes)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
