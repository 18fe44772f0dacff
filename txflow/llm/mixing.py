"""Mixing sources to target weights: domain posteriors from a classifier, then document rates by projected gradient.

Documents belong to domains softly. A rate is how often a document is to be seen; rates are nonnegative, and fitted so
that the expected tokens of each domain, sum(rate * tokens * posterior), meet its target.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txflow.llm.common import written
from txflow.llm.linear import fit_logistic, scorer
from txflow.llm.toxicity import Fit, sample

DOMAINS = ("en", "de", "fr", "es", "junk")
# Target shares of tokens; parameters of the query, in the order of the domains.
SHARES = (0.52, 0.18, 0.18, 0.11, 0.01)
FIT = Fit(rows=6000, bits=17, steps=60)


@dataclass(frozen=True)
class Domains:
    """A fitted classifier: a weight column and a bias for each domain."""

    names: tuple[str, ...]
    bits: int
    weights: np.ndarray
    bias: np.ndarray
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def posteriors(self, linear: np.ndarray) -> np.ndarray:
        z = linear + self.bias
        e = np.exp(z - z.max(1, keepdims=True)) if len(z) else z
        return e / e.sum(1, keepdims=True)


@dataclass(frozen=True)
class Steps:
    """The steps of the projected gradient, one row of domain prices for each: they are all that a rate depends on."""

    prices: np.ndarray

    def rates(self, posteriors: np.ndarray) -> np.ndarray:
        """The rates of documents, by taking each step again from rate 1."""
        x = np.ones(len(posteriors))
        for g in self.prices:
            x = np.maximum(0.0, x - posteriors @ g)
        return x


def domain_marks(docs: DataFrame, labels: DataFrame, names: tuple[str, ...] = DOMAINS) -> DataFrame:
    """The labelled table as ``doc_id`` and one 0/1 column ``d<k>`` for each domain.

    A labelled document of quality 0 is junk, any other belongs to its language; other languages are left out.
    """
    named = labels.select("doc_id", "quality").join(docs.select("doc_id", "lang"), "doc_id")
    name = F.when(F.col("quality") == 0, "junk").otherwise(F.col("lang"))
    known = named.where(name.isin(*names))
    return known.select("doc_id", *[(name == n).cast("int").alias(f"d{k}") for k, n in enumerate(names)])


def learn(docs: DataFrame, labels: DataFrame, names: tuple[str, ...] = DOMAINS, fit: Fit = FIT) -> Domains:
    """The classifier, from a bounded sample (see :class:`Fit`); without labels all domains are equally likely."""
    y, rows = sample(docs, domain_marks(docs, labels, names), tuple(f"d{k}" for k in range(len(names))), fit)
    rows = rows.only(np.bincount(rows.index, minlength=rows.size) >= fit.least)
    none = np.zeros((rows.n, 0))
    fits = [fit_logistic(rows, none, y[:, k], fit.steps) for k in range(len(names))]
    return Domains(names, fit.bits, np.stack([w[:-1] for w in fits], 1), np.array([w[-1] for w in fits]))


def _judge(texts: list[str | None], model: Domains) -> tuple[np.ndarray, np.ndarray]:
    """Tokens (words) and posteriors of texts."""
    products, tokens = scorer(model.name, model.bits, model.weights).of_texts([x or "" for x in texts])
    return tokens, model.posteriors(products)


def memberships(docs: DataFrame, model: Domains) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the posteriors ``p_<domain>`` of every row; NULL text counts as empty."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "n_tokens", *[f"p_{d}" for d in model.names]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            tokens, p = _judge(batch.column("text").to_pylist(), model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(tokens), *map(pa.array, p.T)], names)

    schema = "doc_id long, n_tokens long, " + ", ".join(f"p_{d} double" for d in model.names)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def _totals(members: DataFrame, names: tuple[str, ...], steps: Steps) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens of each domain at the rates so far, and the Gram matrix of documents whose rate is positive.

    One row of sums leaves each task, and one row comes to the driver.
    """
    k = len(names)
    prices = steps.prices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for batch in batches:
            t = batch.column("n_tokens").to_numpy().astype(float)
            p = np.stack([batch.column(f"p_{d}").to_numpy() for d in names], 1)
            x = Steps(prices).rates(p)
            total[:k] += (x * t) @ p
            total[k:] += ((p * (t * (x > 0))[:, None]).T @ p).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total], [f"s{i}" for i in range(k + k * k)])

    columns = [f"s{i}" for i in range(k + k * k)]
    sums = members.mapInArrow(run, ", ".join(f"{c} double" for c in columns)).agg(*[F.sum(c) for c in columns]).first()
    got = np.array([v or 0.0 for v in sums])
    return got[:k], got[k:].reshape(k, k)


def tempered(totals: np.ndarray, names: tuple[str, ...], power: float = 0.8, still: tuple[str, ...] = ("junk",)) -> np.ndarray:
    """Targets that raise small domains toward the largest, by share ** power, and lower none; ``still`` ones stay."""
    moved = np.array([n not in still for n in names]) & (totals > 0)
    most = totals[moved].max() if moved.any() else 0.0
    out = totals.copy()
    out[moved] = most * (totals[moved] / most) ** power
    return np.maximum(out, totals)


def fit_rates(members: DataFrame, names: tuple[str, ...], targets, most_steps: int = 40, tolerance: float = 1e-7) -> Steps:
    """Projected-gradient least squares of expected domain tokens against targets, from rate 1 for every document.

    ``targets`` is an array of tokens, or a function of the totals at rate 1. The gradient for a document is its
    posteriors times the domains' misses (in the metric of its tokens); the misses are first multiplied by the inverse
    Gram matrix of documents whose rate is positive, and rates that would be negative become 0. A step that does not
    lower the squared miss is halved. Each step is one job over the membership table; the state is the list of prices.
    """
    steps = Steps(np.zeros((0, len(names))))
    now, gram = _totals(members, names, steps)
    goal = targets(now) if callable(targets) else np.asarray(targets, float)
    scale = max(goal.sum(), 1.0)
    size = 1.0
    for _ in range(most_steps):
        miss = now - goal
        if np.abs(miss).max() <= tolerance * scale or size < 1e-6:
            break
        price = size * np.linalg.lstsq(gram + 1e-9 * np.trace(gram) * np.eye(len(names)), miss, rcond=None)[0]
        tried = Steps(np.vstack([steps.prices, price]))
        then, hessian = _totals(members, names, tried)
        if np.square(then - goal).sum() < np.square(miss).sum() * (1 - 1e-9):
            steps, now, gram, size = tried, then, hessian, min(1.0, 2 * size)
        else:
            size /= 2
    return steps


def copies(doc_ids: list, texts: list, rates: np.ndarray) -> np.ndarray:
    """Whole numbers of copies with the rates as means: the fraction is drawn by a hash of the row, not at random."""
    key = [xxhash.xxh64_intdigest(f"{i}:{t or ''}", 7) / 2**64 for i, t in zip(doc_ids, texts, strict=True)]
    whole = np.floor(rates + 1e-6)
    return (whole + (np.array(key) < rates - whole - 1e-6)).astype(np.int64) if len(rates) else np.zeros(0, np.int64)


def mixed(docs: DataFrame, model: Domains, steps: Steps, least: int = 0) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says, but ``least`` times at least; all columns unchanged."""
    sent = docs.sparkSession.sparkContext.broadcast((model, steps))
    at, key = docs.columns.index("text"), docs.columns.index("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, steps = sent.value
        for batch in batches:
            texts = batch.column(at).to_pylist()
            _, p = _judge(texts, model)
            n = np.maximum(least, copies(batch.column(key).to_pylist(), texts, steps.rates(p)))
            while n.any():  # one batch for each round of copies, so that no batch is larger than the one that came
                yield batch.filter(pa.array(n > 0))
                n = np.maximum(0, n - 1)

    return docs.mapInArrow(run, docs.schema)


def rates(docs: DataFrame, labels: DataFrame, shares: Mapping[str, float], fit: Fit = FIT) -> DataFrame:
    """One row for each document: ``doc_id``, ``n_tokens``, ``p_<domain>``, ``rate``.

    The targets are ``shares`` of all tokens. Documents of no words get the rate that their posteriors give; they add
    no tokens. Repeated rows count as often as they occur and get the same rate. An empty table gives no rows. Targets
    for domains in which no document has a posterior cannot be met; the least-squares fit leaves that miss.
    """
    names = tuple(shares)
    model = learn(docs, labels, names, fit)
    members = written(memberships(docs, model), "memberships")
    share = np.array([shares[d] for d in names]) / sum(shares.values())
    steps = fit_rates(members, names, lambda totals: share * totals.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.stack([batch.column(f"p_{d}").to_numpy() for d in names], 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.round(steps.rates(p), 9))], [*batch.schema.names, "rate"])

    schema = ", ".join(f"{c} {t}" for c, t in members.dtypes) + ", rate double"
    return members.mapInArrow(run, schema)


def op5_mixing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return rates(docs, labels, dict(zip(DOMAINS, SHARES, strict=True)))


def mix_up(docs: DataFrame, labels: DataFrame, fit: Fit = FIT) -> DataFrame:
    """Rows of ``docs`` mixed to tempered targets, which raise small languages and lower nothing: every row stays."""
    model = learn(docs, labels, DOMAINS, fit)
    members = written(memberships(docs, model), "memberships")
    return mixed(docs, model, fit_rates(members, DOMAINS, lambda totals: tempered(totals, DOMAINS)), least=1)
