"""Near copies by similarity: rows whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, and what
these connect.

Candidates come from two sides, and every one is decided on the whole sets:

* SimHash: the fingerprints of the sets meet in the covering tables of ``simhash``, which join all pairs within RADIUS
  bits. At a similarity of 0.8 fingerprints differ in 9.7 of 64 bits on average, and masks that cover 17 bits (which 99
  pairs of 100 keep to) would be 262,143 tables, so the pairs beyond RADIUS need another way:
* Bands: each set has BANDS keys, each over ROWS of its least hashes; sets that share a key meet. A pair at similarity s
  fails to meet with probability (1 - s ** ROWS) ** BANDS: 3e-5 at 0.8, 6e-10 at 0.9.

Equal sets are one class (by 64 bits of hash) before anything is compared. Buckets of the same members are checked
once, pairs that meet in several ways too. A bucket of more than two gives a spanning forest of its links; one of more
than ``bucket_limit`` members is dealt out in pairs of blocks, so that no task holds more than two blocks and no link is
lost.

Null, empty and blank texts have the empty set and are one class. A-Z are lower-cased, words end at ASCII white space;
a text of fewer words than a shingle is one shingle. Rows with a null doc_id take part. Rows that repeat doc_id and text
have one key and are one row of the result's each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.llm import simhash
from meridian.llm.common import discard, prepare, texts, written

WORDS, SIMILARITY, SEED, RADIUS = 5, 0.8, 42, 4
BANDS, ROWS = 20, 4
BUCKET_LIMIT = 512

_XOR, _TIMES = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * ROWS), np.uint64)
_TIMES = _TIMES << np.uint64(1) | np.uint64(1)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The sorted different hashes of the text's word shingles."""
    return np.unique(simhash.shingle_hashes(text, words))


def bands(hashes: np.ndarray) -> np.ndarray:
    """The set's keys, one for each band (hashed with its number); none for the empty set."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 2048):
        least = np.minimum(least, ((hashes[i : i + 2048, None] ^ _XOR) * _TIMES).min(axis=0))
    return np.array([xxhash.xxh64_intdigest(x.tobytes(), SEED + i) for i, x in enumerate(least.reshape(BANDS, ROWS))], np.uint64).view(np.int64)


def row_key() -> Column:
    """Names a row by doc_id and text; only rows that repeat both share it."""
    text = F.when(F.col("text").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("text").cast("string")))
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text))


def forest(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links between places in sets that connect whatever the pairs of at least this similarity connect."""
    sizes = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    begins = np.cumsum(sizes) - sizes
    holds = np.zeros(int(flat.max()) + 1, bool)
    left, out = np.ones(len(sets), bool), []
    while left.any():
        first = int(np.argmax(left))
        left[first] = False
        near = [first]
        while near and left.any():
            x = near.pop()
            mine = flat[begins[x] : begins[x] + sizes[x]]
            holds[mine] = True
            shared = np.add.reduceat(holds[flat], begins, dtype=np.int64)
            holds[mine] = False
            hit = np.flatnonzero(left & alike(shared, sizes, sizes[x], similarity)).tolist()
            left[hit] = False
            out += [(x, y) for y in hit]
            near += hit
    return out


def alike(shared, one, two, similarity: float):
    """Whether sets of these sizes with so many common members are similar enough."""
    return shared >= similarity * (one + two - shared) - 1e-9


def _prints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, words) for t in texts(batch)]
            classes = np.array([xxhash.xxh3_64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            prints = pa.array([simhash.signed(simhash.majority(s)) for s in sets], pa.int64())
            keys = pa.array([bands(s) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(classes), prints, keys], names=["row", "doc_id", "cls", "fp", "keys"])

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(t, words).tobytes() for t in texts(batch)], pa.binary())], names=["cls", "hashes"])

    return run


def _similar(similarity: float):
    """Of pairs with their sets those that are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate([x, y]))
                ok.append(bool(alike(int((both[1:] == both[:-1]).sum()), len(x), len(y), similarity)))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def within_radius(classes: DataFrame, radius: int) -> DataFrame:
    """Candidates (a > b) whose fingerprints link in the covering tables; of classes with one fingerprint each with the least."""
    leads = written(classes.groupBy("fp").agg(F.min("cls").alias("lead")), "near-leads")
    same = classes.join(leads, "fp").filter("cls > lead").select(F.col("cls").alias("a"), F.col("lead").alias("b"))
    found = simhash.links(leads.select("fp"), radius)
    of = lambda fp, name: leads.select(F.col("fp").alias(fp), F.col("lead").alias(name))
    apart = found.select(F.col("a").alias("x"), F.col("b").alias("y")).join(of("x", "one"), "x").join(of("y", "two"), "y")
    return same.unionByName(apart.select(F.greatest("one", "two").alias("a"), F.least("one", "two").alias("b")))


def links(rows: DataFrame, classes: DataFrame, words: int, similarity: float, bucket_limit: int, radius: int) -> DataFrame:
    """Links (a > b) between the classes (cls, fp, keys, first) that connect all pairs of at least the similarity that meet."""
    keys = classes.select("cls", F.explode("keys").alias("key"))
    # buckets of the same members, by two hashes of the set of them, are one
    found = (F.count("*").alias("n"), F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64("cls", F.lit("again"))).alias("y"), F.max("cls").alias("a"), F.min("cls").alias("b"))
    buckets = keys.groupBy("key").agg(*found).filter("n > 1")
    sole = written(buckets.groupBy("x", "y", "n").agg(F.min(F.struct("key", "a", "b")).alias("at")).select("at.*", "n"), "near-buckets")
    pairs = sole.filter("n = 2").select("a", "b").unionByName(within_radius(classes.select("cls", "fp"), radius)).distinct()
    pairs = written(pairs, "near-pairs")
    members = written(keys.join(sole.filter("n > 2").select("key", "n"), "key").select("key", "n", "cls"), "near-members")
    named = members.select("cls").unionByName(pairs.select(F.col("a").alias("cls"))).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    asked = classes.join(named, "cls", "left_semi").select("cls", F.col("first.row").alias("row"))
    # the one row of a class that is read again: rows that repeat it are equal to it
    wanted = rows.select("row", "text").join(asked, "row").dropDuplicates(["cls"]).select("cls", "text").mapInArrow(_sets(words), "cls long, hashes binary")
    sets = written(wanted, "near-sets")
    of = lambda name, own: sets.select(F.col("cls").alias(name), F.col("hashes").alias(own))
    two = pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(_similar(similarity), "a long, b long")
    blocks = F.ceil(F.col("n") / F.lit(bucket_limit)).cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn("i", F.pmod(F.xxhash64("cls", F.lit("block")), F.col("blocks")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "cls").join(sets, "cls")

    def checked(table: pa.Table) -> pa.Table:
        cls = table.column("cls").to_numpy()
        found = forest([np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()], similarity)
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        return pa.Table.from_arrays([pa.array(np.maximum(cls[a], cls[b])), pa.array(np.minimum(cls[a], cls[b]))], names=["a", "b"])

    return dealt.groupBy("key", "i", "j").applyInArrow(checked, "a long, b long").unionByName(two).distinct()


def near_copies(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, bucket_limit: int = BUCKET_LIMIT, radius: int = RADIUS) -> DataFrame:
    """row (row_key), doc_id and component_id (the smallest doc_id of the row's component, null if it has none), and
    first: the component's row with the smallest doc_id, null last; of those with one doc_id the one of the smallest key."""
    prepare(docs.sparkSession)
    rows = docs.select(row_key().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = written(rows.mapInArrow(_prints(words), "row string, doc_id long, cls long, fp long, keys array<long>"), "near-prints")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    classes = written(prints.groupBy("cls").agg(F.min(order).alias("first"), F.first("fp").alias("fp"), F.first("keys").alias("keys")), "near-classes")
    roots = simhash.components(links(rows, classes, words, similarity, bucket_limit, radius))
    rooted = classes.join(roots, classes.cls == roots.node, "left").select("cls", "first", F.coalesce("root", "cls").alias("root"))
    rooted = written(rooted, "near-rooted")
    discard(classes)
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    named = rooted.join(least, "root").select("cls", F.col("least.doc_id").alias("component_id"), F.col("least.row").alias("first"))
    return prints.select("row", "doc_id", "cls").join(named, "cls").select("row", "doc_id", "component_id", "first")
