"""Quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded from its bytes (shares of kinds of signs, repeated and new
words, hashed letter pairs); gated attention, learned from the documents' labels alone, weighs the passages, and a
logistic unit scores the weighted sum of their representations.

Statistics come out of array operations over a whole batch of texts: prefix sums of kinds of signs, cut at the
passages' ends. Training takes SAMPLE labelled documents at most, with all their passages; scoring reads every passage
of every text.

Null and empty texts are one empty passage and are scored like any other. Of rows that repeat a labelled doc_id the one
with the least text is learned from, of labels that repeat it the greatest. Without training rows, or with rows of one
label only, every score is the label's share (0.5 without rows). ``keep`` may not name a column made here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.llm.common import broadcast_bytes, pack, prepare, unpack
from meridian.llm.suffix import mix

SAMPLE = 5000
PASSAGE = 512
PAIRS = 32
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY = 40, 256, 0.01, 1e-4
#: Text bytes that are encoded at once.
PIECE = 1 << 20


def _kinds() -> np.ndarray:
    """Of every byte: 0 lower case, 1 capital, 2 digit, 3 blank, 4 line end, 5 . and ,, 6 ! and ?, 7 other ASCII sign, 8 other."""
    out = np.full(256, 7, np.uint8)
    for chars, kind in ((range(97, 123), 0), (range(65, 91), 1), (range(48, 58), 2), (b" \t\v\f\r", 3), (b"\n", 4), (b".,", 5), (b"!?", 6), (range(128, 256), 8)):
        for c in chars:
            out[c] = kind
    return out


_KIND = _kinds()
N_KINDS = 9
WIDTH = N_KINDS + 5 + PAIRS


def passages(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The passages' encodings (passages x WIDTH) and how many each text has."""
    sizes = np.array([len(p) for p in parts], np.int64)
    counts = np.maximum(1, (sizes + PASSAGE // 2) // PASSAGE)  # a short rest joins the last passage
    data = np.frombuffer(b"".join(parts) + b" ", np.uint8)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    doc = np.repeat(np.arange(len(parts)), counts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = bounds[doc] + nth * PASSAGE
    end = np.where(nth + 1 == counts[doc], bounds[doc + 1], begin + PASSAGE)
    length = np.maximum(end - begin, 1).astype(float)
    kind = _KIND[data]
    out = np.zeros((len(doc), WIDTH))

    def within(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[end] - sums[begin]

    for k in range(N_KINDS):
        out[:, k] = within(kind == k) / length
    # words: their hashes by prefix sums of letter codes times powers of their place in the word
    blank = (kind == 3) | (kind == 4)
    first = ~blank
    first[1:] &= blank[:-1]
    inner = bounds[1:-1]
    first[inner[inner < len(data)]] = ~blank[inner[inner < len(data)]]
    starts = np.flatnonzero(first)
    if len(starts):
        place = np.arange(len(data)) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(data)]])))
        codes = (data.astype(np.uint64) + np.uint64(1)) * mix(np.arange(64, dtype=np.uint64) + np.uint64(77))[place & 63]
        codes[blank] = 0
        words = mix(np.add.reduceat(codes, starts))
        owner = np.searchsorted(begin, starts, side="right") - 1
        n = np.maximum(np.bincount(owner, minlength=len(doc)), 1)
        same = np.zeros(len(words), bool)
        same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
        out[:, N_KINDS] = np.bincount(owner, weights=same, minlength=len(doc)) / n
        order = np.lexsort((words, owner))
        fresh = np.ones(len(words), bool)
        fresh[1:] = (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        out[:, N_KINDS + 1] = np.bincount(owner[order], weights=fresh, minlength=len(doc)) / n
    else:
        n = np.ones(len(doc))
    out[:, N_KINDS + 2] = length / n / 10
    out[:, N_KINDS + 3] = np.log1p(length) / 6
    out[:, N_KINDS + 4] = np.log1p(sizes[doc]) / 8
    pair = (((data[:-1].astype(np.uint32) * 31 + data[1:]) * 2654435761) >> 27).astype(np.int64) % PAIRS
    owner = np.repeat(np.arange(len(doc)), end - begin)
    apart = bounds[1:]
    pair[apart[apart > 0] - 1] = PAIRS  # the pair across two documents counts for neither
    found = np.bincount(owner * (PAIRS + 1) + pair, minlength=len(doc) * (PAIRS + 1)).reshape(len(doc), PAIRS + 1)[:, :PAIRS]
    out[:, N_KINDS + 5 :] = found / length[:, None] * 8
    return out, counts


def batches_of(parts: list[bytes], limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes, one text at least."""
    a, size = 0, 0
    for i, p in enumerate(parts):
        if size and size + len(p) > limit:
            yield a, i
            a, size = i, 0
        size += len(p)
    if a < len(parts):
        yield a, len(parts)


class Attention:
    """tanh encoding, gated attention over a bag, logistic score; gradients by hand, Adam."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, share: float = 0.5):
        self.share = share
        self.w = weights or {}

    def start(self, x: np.ndarray, rng: np.random.Generator) -> None:
        mean, dev = x.mean(axis=0), x.std(axis=0)
        init = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.w = {"mean": mean, "dev": np.where(dev > 1e-6, dev, 1.0), "A": init(WIDTH, HIDDEN), "a": np.zeros(HIDDEN), "V": init(HIDDEN, GATE), "U": init(HIDDEN, GATE), "q": init(GATE), "c": np.zeros(HIDDEN), "b": np.array([np.log(self.share / (1 - self.share))])}

    def forward(self, x: np.ndarray, counts: np.ndarray) -> tuple:
        w = self.w
        firsts = np.cumsum(counts) - counts
        doc = np.repeat(np.arange(len(counts)), counts)
        x = np.clip((x - w["mean"]) / w["dev"], -6, 6)
        e = np.tanh(x @ w["A"] + w["a"])
        v, u = np.tanh(e @ w["V"]), 1 / (1 + np.exp(-(e @ w["U"])))
        s = (v * u) @ w["q"]
        s = np.exp(s - np.maximum.reduceat(s, firsts)[doc])
        alpha = s / np.add.reduceat(s, firsts)[doc]
        z = np.add.reduceat(alpha[:, None] * e, firsts, axis=0)
        p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["b"][0], -30, 30)))
        return x, doc, firsts, e, v, u, alpha, z, p

    def score(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.forward(x, counts)[-1] if self.w else np.full(len(counts), self.share)

    def gradients(self, x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        x, doc, firsts, e, v, u, alpha, z, p = self.forward(x, counts)
        d = (p - y) / len(y)
        dz = d[:, None] * w["c"]
        da = (dz[doc] * e).sum(axis=1)
        ds = alpha * (da - np.add.reduceat(alpha * da, firsts)[doc])
        dvu = ds[:, None] * w["q"]
        dv, du = dvu * u * (1 - v * v), dvu * v * u * (1 - u)
        de = (alpha[:, None] * dz[doc] + dv @ w["V"].T + du @ w["U"].T) * (1 - e * e)
        return {"A": x.T @ de, "a": de.sum(axis=0), "V": e.T @ dv, "U": e.T @ du, "q": (v * u).T @ ds, "c": z.T @ d, "b": np.array([d.sum()])}

    def fit(self, bags: list[np.ndarray], y: np.ndarray, seed: int = 7) -> Attention:
        if not len(y) or y.min() == y.max():
            self.share = float(y.mean()) if len(y) else 0.5
            return self
        self.share = float(y.mean())
        rng = np.random.default_rng(seed)
        self.start(np.concatenate(bags), rng)
        m = {k: np.zeros_like(x) for k, x in self.w.items()}
        s = {k: np.zeros_like(x) for k, x in self.w.items()}
        t = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(y))
            rate = RATE * (1 - epoch / EPOCHS) + RATE / 20
            for i in range(0, len(order), BATCH):
                pick = order[i : i + BATCH]
                g = self.gradients(np.concatenate([bags[j] for j in pick]), np.array([len(bags[j]) for j in pick]), y[pick])
                t += 1
                for k, x in g.items():
                    x = x + DECAY * self.w[k]
                    m[k] = 0.9 * m[k] + 0.1 * x
                    s[k] = 0.999 * s[k] + 0.001 * x * x
                    self.w[k] = self.w[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
        return self


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Attention:
    """labels: (doc_id, label) of the documents that may be learned from; those whose ids hash lowest are."""
    prepare(docs.sparkSession)
    chosen = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("double").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.max("y").alias("y"), F.min("text").alias("text")).select(F.xxhash64("doc_id").alias("h"), "y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(2).to_pylist():
                out.append(passages([text.encode()])[0].astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["h", "y", "bag"])

    found = rows.mapInArrow(run, "h long, y double, bag binary").collect()
    found.sort(key=lambda r: (r.h, bytes(r.bag)))
    bags = [np.frombuffer(r.bag, np.float32).reshape(-1, WIDTH).astype(float) for r in found]
    return Attention().fit(bags, np.array([r.y for r in found]))


def score(docs: DataFrame, model: Attention, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and score, the probability of label 1, of each row's whole text."""
    spark = prepare(docs.sparkSession)
    if {"score", "text"} & {c.lower() for c in keep}:
        raise ValueError("keep names a column that is made here")
    shared = broadcast_bytes(spark, pack(model.w, model.share))
    rows = docs.select(*keep, F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Attention(*unpack(shared.value))
        for batch in batches:
            parts = [(x or "").encode() for x in batch.column(len(keep)).to_pylist()]
            found = [own.score(*passages(parts[a:b])) for a, b in batches_of(parts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(np.concatenate(found) if found else np.zeros(0))], names=[*keep, "score"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], T.StructField("score", T.DoubleType())]))
