"""Toxicity by a classifier chain: each category's linear model sees the probabilities of the categories before it."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.llm.linear import Features, Rows, fit_logistic, scorer, sigmoid

CATEGORIES = ("poor", "toxic")


@dataclass(frozen=True)
class Fit:
    """How the chain is fitted.

    ``rows`` bounds the labelled rows that are used, those with the smallest hash of their doc_id; each comes to the
    driver as at most 2^``bits`` features. Features of fewer than ``least`` rows are not used. A category's threshold is
    the lowest at which ``precision`` of the out-of-fold predictions above it are right.
    """

    rows: int = 6000
    bits: int = 18
    least: int = 3
    folds: int = 5
    steps: int = 80
    precision: float = 0.98


@dataclass(frozen=True)
class Chain:
    """A fitted chain: a weight column for each category, its weights for earlier probabilities, bias and threshold."""

    categories: tuple[str, ...]
    bits: int
    weights: np.ndarray
    earlier: tuple[np.ndarray, ...]
    bias: np.ndarray
    thresholds: np.ndarray
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def probabilities(self, linear: np.ndarray) -> np.ndarray:
        """From the products of rows with the weight columns (n x categories), category after category."""
        out = np.zeros_like(linear)
        for j in range(linear.shape[1]):
            out[:, j] = sigmoid(linear[:, j] + out[:, :j] @ self.earlier[j] + self.bias[j])
        return out


def marks(labels: DataFrame) -> DataFrame:
    """The labelled table as ``doc_id`` and one 0/1 column for each category, in the order of the chain."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("poor"), F.col("toxic").alias("toxic"))


def sample(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...], fit: Fit) -> tuple[np.ndarray, Rows]:
    """Labels (n x categories) and features of the bounded sample, in order of doc_id.

    Labels with a NULL are left out; of several labels for a doc_id the highest count, of several texts the smallest.
    """
    known = labels.where(" and ".join(f"{c} is not null" for c in ("doc_id", *categories)))
    known = known.groupBy("doc_id").agg(*[F.max(c).cast("double").alias(c) for c in categories])
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit.rows)
    text: Column = F.min(F.coalesce("text", F.lit(""))).alias("text")
    held = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("doc_id", *categories).agg(text)
    bits = fit.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(bits)
        for batch in batches:
            got = [features.of_text(x) for x in batch.column("text").to_pylist()]
            index = pa.array([i.astype(np.int32) for i, _ in got], pa.list_(pa.int32()))
            weight = pa.array([w.astype(np.float32) for _, w in got], pa.list_(pa.float32()))
            fields = [batch.column(c) for c in ("doc_id", *categories)]
            yield pa.RecordBatch.from_arrays([*fields, index, weight], ["doc_id", *categories, "i", "w"])

    schema = "doc_id long, " + ", ".join(f"{c} double" for c in categories) + ", i array<int>, w array<float>"
    held = held.withColumn("doc_id", F.col("doc_id").cast("long"))
    got = held.mapInArrow(run, schema).toArrow().sort_by("doc_id").combine_chunks()
    if not got.num_rows:
        return np.zeros((0, len(categories))), Rows.of([], 1 << bits)
    y = np.stack([got.column(c).to_numpy() for c in categories], axis=1)
    index, weight = got.column("i").chunk(0), got.column("w").chunk(0)
    start = np.concatenate([[0], np.cumsum(index.value_lengths().to_numpy())])
    return y, Rows(index.flatten().to_numpy(), weight.flatten().to_numpy(), start, 1 << bits)


def fit_chain(y: np.ndarray, rows: Rows, categories: tuple[str, ...], fit: Fit) -> Chain:
    """Fit the chain; later categories learn from out-of-fold probabilities of earlier ones, as they will meet them."""
    rows = rows.only(np.bincount(rows.index, minlength=rows.size) >= fit.least)
    n, k = y.shape
    fold = np.arange(n) % fit.folds
    out, weights, earlier, bias, thresholds = np.zeros((n, k)), np.zeros((rows.size, k)), [], np.zeros(k), np.ones(k) * 2
    for j in range(k):
        seen = out[:, :j]
        for f in range(fit.folds if n >= fit.folds else 0):
            inside, outside = fold == f, fold != f
            w = fit_logistic(rows, seen, y[:, j], fit.steps, used=outside)
            out[inside, j] = sigmoid(rows.times(w[: rows.size]) + seen @ w[rows.size : -1] + w[-1])[inside]
        w = fit_logistic(rows, seen, y[:, j], fit.steps)
        weights[:, j], bias[j] = w[: rows.size], w[-1]
        earlier.append(w[rows.size : -1])
        thresholds[j] = _threshold(out[:, j], y[:, j], fit.precision)
    return Chain(categories, int(np.log2(rows.size)), weights, tuple(earlier), bias, thresholds)


def _threshold(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """Half way, on the logit scale, below the lowest prediction at which enough are right; 2 (never) if there is none."""
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(p) + 1)
    good = np.flatnonzero((right >= precision) & (y[order] > 0))
    if not len(good):
        return 2.0
    last = good[-1]
    low = p[order[last + 1]] if last + 1 < len(p) else 0.0
    logit = lambda x: np.log(max(x, 1e-9) / max(1 - x, 1e-9))
    return float(sigmoid(np.array((logit(p[order[last]]) + logit(low)) / 2)))


def learn(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES, fit: Fit = Fit()) -> Chain:
    y, rows = sample(docs, labels, categories, fit)
    return fit_chain(y, rows, categories, fit)


def _predict(texts: list[str | None], chain: Chain) -> np.ndarray:
    products, _ = scorer(chain.name, chain.bits, chain.weights).of_texts([x or "" for x in texts])
    return chain.probabilities(products)


def predict(docs: DataFrame, chain: Chain) -> DataFrame:
    """One row for each document: ``doc_id``, ``p_<category>`` and the verdict ``<category>`` for each category.

    NULL text counts as empty and is judged by the bias alone. Repeated rows get the same verdict. Without labels, or
    without one of either class, a category's probability is its smoothed rate and its verdict is false. Only
    ``doc_id`` and ``text`` are read; nothing is shuffled, and whole texts are read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(chain)  # 2^bits weights for each category
    names = ["doc_id", *[f"p_{c}" for c in chain.categories], *chain.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = sent.value
        for batch in batches:
            p = _predict(batch.column("text").to_pylist(), chain)
            columns = [pa.array(p[:, j]) for j in range(p.shape[1])]
            columns += [pa.array(p[:, j] >= chain.thresholds[j]) for j in range(p.shape[1])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    schema = "doc_id long, " + ", ".join(f"p_{c} double" for c in chain.categories)
    schema += "".join(f", {c} boolean" for c in chain.categories)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def without_toxic(docs: DataFrame, chain: Chain, category: str = "toxic") -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose verdict for the category is false."""
    sent, j = docs.sparkSession.sparkContext.broadcast(chain), chain.categories.index(category)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = sent.value
        for batch in batches:
            p = _predict(batch.column(at).to_pylist(), chain)
            yield batch.filter(pa.array(p[:, j] < chain.thresholds[j]))

    return docs.mapInArrow(run, docs.schema)


def op10_toxicity(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    return predict(docs, learn(docs, marks(labels), CATEGORIES, fit))
