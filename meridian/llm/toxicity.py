"""Toxicity by a chain of linear classifiers.

The categories have an order. The first model sees a document's words and word beginnings; each later one also sees the
log-odds that the earlier ones gave, which for training come out of folds: a document's earlier probabilities are from
models that were not fitted to it. The last category is the verdict. Where only the verdict is labelled, weak categories
can go before it, which are learned too: the positive documents with the word that tells the verdict most clearly, those
of the others with the word that then does, and so on (``anchors``).

Models are logistic regressions over the FEATURES words and word beginnings that tell a category from the rest most
clearly, chosen anew for each fit. Training takes SAMPLE labelled documents at most; scoring reads whole texts.

Null and empty texts have no words and get the models' intercepts. Rows are scored each for itself. Of rows that repeat
a labelled doc_id the one with the least text is learned from, of labels that repeat it the greatest. Without labelled
documents all probabilities are 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.llm.common import broadcast_bytes, pack, prepare, quoted, ragged, unpack

SAMPLE, FEATURES, FOLDS = 6000, 3000, 3
STARTS = (4, 5, 6, 7)
#: Documents that a word must be in to become a feature.
LEAST_DOCS = 4
PENALTY, STEPS, RATE = 2.0, 150, 0.3
#: Words whose features a task remembers.
MEMORY = 300_000
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def word_features(word: str) -> list[str]:
    return [f"={word}", *(word[:n] for n in STARTS if len(word) > n)]


@dataclass
class Corpus:
    """Training documents as numbers of their word features, all in one array."""

    names: list[str]
    cols: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, documents: list[list[str]]) -> Corpus:
        """documents: the different words of each, sorted."""
        ids: dict[str, int] = {}
        parts = []
        for found in documents:
            own = dict.fromkeys(f for w in found for f in word_features(w))
            parts.append(np.fromiter((ids.setdefault(f, len(ids)) for f in own), np.int32, len(own)))
        return cls(list(ids), np.concatenate(parts) if parts else np.zeros(0, np.int32), np.array([len(x) for x in parts], np.int64))

    def of_documents(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document (its place in which) and feature of each entry."""
        starts = np.cumsum(self.counts) - self.counts
        return np.repeat(np.arange(len(which)), self.counts[which]), self.cols[ragged(starts[which], self.counts[which])]


@dataclass
class Linear:
    """A logistic regression: word features, their weights, weights of the earlier log-odds, intercept."""

    features: np.ndarray
    weights: np.ndarray
    chain: np.ndarray
    intercept: float

    def logits(self, corpus: Corpus, which: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        dense = np.zeros(len(corpus.names))
        dense[self.features] = self.weights
        rows, cols = corpus.of_documents(which)
        return np.bincount(rows, weights=dense[cols], minlength=len(which)) + earlier @ self.chain + self.intercept


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(corpus: Corpus, which: np.ndarray, earlier: np.ndarray, target: np.ndarray) -> Linear:
    """Fits to the documents ``which``, whose log-odds of the earlier categories and targets are given."""
    positive, negative = target.sum(), len(target) - target.sum()
    prior = float(np.log((positive + 0.5) / (negative + 0.5)))
    if not positive or not negative:
        return Linear(np.zeros(0, np.int64), np.zeros(0), np.zeros(earlier.shape[1]), prior)
    size = len(corpus.names)
    rows, cols = corpus.of_documents(which)
    inside = np.bincount(cols, weights=target[rows], minlength=size)
    seen = np.bincount(cols, minlength=size)
    a, b = (inside + 0.5) / (positive + 1), (seen - inside + 0.5) / (negative + 1)
    worth = np.where(seen >= LEAST_DOCS, np.abs(a - b) * np.abs(np.log(a / b)), 0)
    chosen = np.argsort(-worth, kind="stable")[:FEATURES]
    chosen = chosen[worth[chosen] > 0]
    to = np.full(size, -1)
    to[chosen] = np.arange(len(chosen))
    keep = to[cols] >= 0
    rows, cols = rows[keep], to[cols[keep]]
    w, c, bias = np.zeros(len(chosen)), np.zeros(earlier.shape[1]), prior
    sums = [np.zeros_like(w), np.zeros_like(c), 0.0]  # AdaGrad
    balance = np.where(target > 0, 0.5 * len(target) / positive, 0.5 * len(target) / negative) ** 0.5
    for _ in range(STEPS):
        p = _sigmoid(np.bincount(rows, weights=w[cols], minlength=len(which)) + earlier @ c + bias)
        r = (p - target) * balance / len(target)
        g = [np.bincount(cols, weights=r[rows], minlength=len(w)) + PENALTY * w / len(target), earlier.T @ r + PENALTY * c / len(target), r.sum()]
        for i, x in enumerate(g):
            sums[i] = sums[i] + x * x
        w -= RATE * g[0] / (np.sqrt(sums[0]) + 1e-6)
        c -= RATE * g[1] / (np.sqrt(sums[1]) + 1e-6)
        bias -= RATE * g[2] / (np.sqrt(sums[2]) + 1e-6)
    return Linear(chosen, w, c, float(bias))


def anchors(corpus: Corpus, verdict: np.ndarray, n: int) -> np.ndarray:
    """Weak categories (documents x n) of the positive documents: the first is which hold the word that tells the verdict
    most clearly, the second which of the others hold the word that then does, and so on. A document is in one at most."""
    out = np.zeros((len(verdict), n), bool)
    whole = np.array([f.startswith("=") for f in corpus.names], bool)
    rows, cols = corpus.of_documents(np.arange(len(verdict)))
    left = verdict.astype(bool).copy()
    for k in range(n):
        if not left.any() or left.all():
            break
        inside = np.bincount(cols, weights=left[rows], minlength=len(whole))
        outside = np.bincount(cols, weights=~verdict[rows].astype(bool), minlength=len(whole))
        worth = np.where(whole & (inside >= LEAST_DOCS), inside / left.sum() - outside / (~verdict.astype(bool)).sum(), -1)
        if not len(worth) or worth.max() <= 0:
            break
        out[rows[cols == worth.argmax()], k] = True
        out[:, k] &= left
        left &= ~out[:, k]
    return out


def fit_chain(documents: list[list[str]], targets: np.ndarray, folds: int = FOLDS, weak: int = 0) -> list[tuple]:
    """One model for each column of targets (documents x categories), in order: names, weights, chain, intercept;
    before them one for each of the ``weak`` categories of the last column."""
    corpus = Corpus.of(documents)
    if weak:
        targets = np.column_stack([anchors(corpus, targets[:, -1], weak), targets])
    every = np.arange(len(documents))
    earlier, out = np.zeros((len(documents), 0)), []
    fold = every % folds
    for k in range(targets.shape[1]):
        y = targets[:, k].astype(float)
        held = np.zeros(len(documents))
        for f in range(folds if k + 1 < targets.shape[1] else 0):  # nothing comes after the last
            inside, outside = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            held[outside] = fit(corpus, inside, earlier[inside], y[inside]).logits(corpus, outside, earlier[outside])
        m = fit(corpus, every, earlier, y)
        out.append(([corpus.names[i] for i in m.features.tolist()], m.weights, m.chain, m.intercept))
        earlier = np.column_stack([earlier, np.clip(held, -8, 8)])
    return out


class Chain:
    """The models put together for scoring: a word is looked up once and remembered."""

    def __init__(self, models: list[tuple]):
        self.models = models
        names: dict[str, int] = {}
        for own, _, _, _ in models:
            for n in own:
                names.setdefault(n, len(names))
        self.table = np.zeros((len(names), len(models)))
        for k, (own, weights, _, _) in enumerate(models):
            for n, w in zip(own, weights):
                self.table[names[n], k] = w
        self.names, self.known = names, {}

    def __call__(self, text: str) -> list[float]:
        hits: set[int] = set()
        known = self.known
        if len(known) > MEMORY:
            known.clear()
        for w in words(text):
            found = known.get(w)
            if found is None:
                found = known[w] = tuple(self.names[f] for f in word_features(w) if f in self.names)
            if found:
                hits.update(found)
        own = self.table[sorted(hits)].sum(axis=0) if hits else np.zeros(len(self.models))
        logits: list[float] = []
        for k, (_, _, chain, intercept) in enumerate(self.models):
            x = own[k] + intercept + sum(c * min(8.0, max(-8.0, v)) for c, v in zip(chain.tolist(), logits))
            logits.append(float(x))
        return _sigmoid(np.array(logits)).tolist()


def train(docs: DataFrame, labels: DataFrame, categories: list[str], weak: int = 0, sample: int = SAMPLE) -> list[tuple]:
    """A chain for ``categories``: columns of labels in order, true or not 0 where the category holds, null where not.
    What reaches the driver are the different words of the sampled documents."""
    prepare(docs.sparkSession)
    flags = [F.coalesce(F.col(quoted(c)).cast("boolean"), F.lit(False)).alias(f"_{k}") for k, c in enumerate(categories)]
    told = F.max(F.struct(*[f"_{k}" for k in range(len(flags))])).alias("told")
    chosen = labels.filter(F.col("doc_id").isNotNull()).select("doc_id", *flags).groupBy("doc_id").agg(told).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.max("told").alias("told"), F.min("text").alias("text"))
    rows = rows.select(F.xxhash64("doc_id").alias("h"), F.array(*[f"told._{k}" for k in range(len(flags))]).alias("targets"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([" ".join(sorted(words(t))) for t in batch.column(2).to_pylist()])], names=["h", "targets", "words"])

    found = rows.mapInArrow(run, "h long, targets array<boolean>, words string").collect()
    if not found:
        return []
    found.sort(key=lambda r: (r.h, r.words))
    return fit_chain([r.words.split(" ") if r.words else [] for r in found], np.array([r.targets for r in found]), weak=weak)


def score(docs: DataFrame, models: list[tuple], names: list[str], threshold: float = 0.5) -> DataFrame:
    """doc_id, p_<category> for each category, and toxic: whether the last one reaches the threshold."""
    spark = prepare(docs.sparkSession)
    model = broadcast_bytes(spark, pack(models))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(f"p_{n}", T.DoubleType()) for n in names), T.StructField("toxic", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = Chain(unpack(model.value)[0])
        for batch in batches:
            found = [chain(t or "") if chain.models else [0.0] * len(names) for t in batch.column(1).to_pylist()]
            columns = [pa.array([f[k] for f in found], pa.float64()) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array([f[-1] >= threshold for f in found], pa.bool_())], names=schema.names)

    return rows.mapInArrow(run, schema)
