"""Text features and small linear models in numpy, for classifiers fitted on a bounded sample of labelled rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import islice

import numpy as np
from pandas.util import hash_array

from txflow.llm.common import of_worker

PREFIXES = (4, 5, 6, 7)
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
CACHE = 3 << 18
RUN = 1 << 15
BLOCK = 2048


class Features:
    """Hashed features of a text, each with weight count / sqrt(words): words without marks at their ends, prefixes of
    words, marks that end a word, words in capitals, and the share of distinct words in tenths (weight 1)."""

    def __init__(self, bits: int):
        self.size = 1 << bits

    def hashed(self, kind: str, names: list[str]) -> np.ndarray:
        """Features of a kind; names are hashed together."""
        if not names:
            return np.zeros(0, np.int64)
        held = np.array(names, object)
        return (hash_array(held, hash_key=f"{kind:0>16}", categorize=False) % np.uint64(self.size)).astype(np.int64)

    def of_words(self, words: list[str]) -> np.ndarray:
        """A row of features for each word; ``size`` stands where a word lacks one."""
        out = np.full((len(words), len(PREFIXES) + 3), self.size)
        inner = [w.strip(MARKS) for w in words]
        bare = [x.lower() for x in inner]
        long, within, whole = (np.fromiter(map(len, x), np.int64, len(words)) for x in (bare, inner, words))
        out[:, 0] = self.hashed("word", bare)
        for k, n in enumerate(PREFIXES, 1):
            has = np.flatnonzero(long > n)
            out[has, k] = self.hashed(f"first{n}", [bare[i][:n] for i in has])
        marked = [(i, m) for i in np.flatnonzero((whole - within > 1) & (within > 0)) if len(m := words[i][len(words[i].rstrip(MARKS)) :]) > 1]
        out[[i for i, _ in marked], -2] = self.hashed("marks", [m[-2:] for _, m in marked])
        loud = [i for i in np.flatnonzero((whole > 2) & (within > 0)) if words[i].isupper()]
        out[loud, -1] = self.hashed("capitals", [""])[0]
        bald = np.flatnonzero(within == 0)
        out[bald, 0] = self.hashed("sign", [words[i][:2] for i in bald])
        return out

    def of_share(self, distinct: int, n: int) -> int:
        return self.shares[10 * distinct // max(n, 1)]

    @cached_property
    def shares(self) -> list[int]:
        return self.hashed("share", [str(k) for k in range(11)]).tolist()

    def of_text(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct features in order, and their weights."""
        words = Counter(text.split())
        n = sum(words.values())
        each = self.of_words(list(words))
        times = np.repeat(np.fromiter(words.values(), np.float64, len(words)), each.shape[1]) / np.sqrt(max(n, 1))
        index, place = np.unique(np.append(each.ravel(), self.of_share(len(words), n)), return_inverse=True)
        weight = np.bincount(place, np.append(times, 1.0))
        there = index < self.size
        return index[there], weight[there]


class _Numbered(dict):
    """Words by the order in which they were met."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class Scorer:
    """Products of texts' features with the columns of a weight matrix; the sums for a word are remembered."""

    def __init__(self, features: Features, weights: np.ndarray):
        self.features = features
        self.weights = np.vstack([weights, np.zeros((1, weights.shape[1]))])  # the last row is for features that lack
        self.known = _Numbered()
        self.table = np.zeros((CACHE, weights.shape[1]))

    def _sums(self, words: list[str]) -> np.ndarray:
        """The weights of each word's features, summed; words not met before are worked out together."""
        if len(self.known) + len(words) > CACHE:
            self.known.clear()
        found = len(self.known)
        rows = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if len(self.known) > found:
            fresh = list(islice(self.known, found, None))
            self.table[found : len(self.known)] = self.weights[self.features.of_words(fresh)].sum(1)
        return self.table[rows]

    def of_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One row of products for each text, and its number of words; words are worked on in runs of bounded length."""
        total = np.zeros((len(texts), self.weights.shape[1]))
        counts = np.zeros(len(texts), np.int64)
        share = np.zeros(len(texts), np.int64)
        held: list[str] = []
        starts: list[tuple[int, int]] = []

        def flush() -> None:
            if held:
                sums = np.add.reduceat(self._sums(held), [s for _, s in starts], axis=0)
                total[[i for i, _ in starts]] += sums
                held.clear()
                starts.clear()

        for i, text in enumerate(texts):
            words = text.split()
            counts[i] = len(words)
            share[i] = self.features.of_share(len(set(words)), len(words))
            for at in range(0, len(words), RUN):
                starts.append((i, len(held)))
                held += words[at : at + RUN]
                if len(held) >= RUN:
                    flush()
        flush()
        return total / np.sqrt(np.maximum(counts, 1))[:, None] + self.weights[share], counts


def scorer(name: str, bits: int, weights: np.ndarray) -> Scorer:
    """The scorer of this Python worker for the model of that name; its memory of words outlives a task."""
    return of_worker(name, lambda: Scorer(Features(bits), weights))


class Rows:
    """Sparse rows, one after the other: features and weights of all entries, and where each row begins.

    Work is done on blocks of rows, so what it needs beside the rows is small.
    """

    def __init__(self, index: np.ndarray, weight: np.ndarray, start: np.ndarray, size: int):
        self.index, self.weight, self.start = index.astype(np.int64), weight.astype(np.float64), start
        self.n, self.size = len(start) - 1, size

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]], size: int) -> Rows:
        """Rows from pairs of features and weights."""
        start = np.cumsum([0, *(len(i) for i, _ in rows)])
        index, weight = (np.concatenate([r[k] for r in rows] or [np.zeros(0)]) for k in (0, 1))
        return cls(index, weight, start, size)

    def _blocks(self) -> Iterator[tuple[slice, slice, np.ndarray]]:
        """For each block: its rows, their entries and the number of entries of each row."""
        for a in range(0, self.n, BLOCK):
            b = min(a + BLOCK, self.n)
            yield slice(a, b), slice(self.start[a], self.start[b]), np.diff(self.start[a : b + 1])

    def _by_row(self, each: Callable[[slice], np.ndarray]) -> np.ndarray:
        """The sum over each row of a value of its entries."""
        out = np.zeros(self.n)
        for rows, entries, sizes in self._blocks():
            full = np.flatnonzero(sizes)
            if len(full):
                at = self.start[rows][full] - entries.start
                out[rows.start + full] = np.add.reduceat(each(entries), at)
        return out

    def _by_feature(self, values: np.ndarray, weight: np.ndarray | None) -> np.ndarray:
        """For each feature, the sum over the rows that have it of a value, times the entry's weight if there is one."""
        out = np.zeros(self.size)
        for rows, entries, sizes in self._blocks():
            each = np.repeat(values[rows], sizes)
            out += np.bincount(self.index[entries], each if weight is None else each * weight[entries], self.size)
        return out

    def times(self, vector: np.ndarray) -> np.ndarray:
        return self._by_row(lambda at: self.weight[at] * vector[self.index[at]])

    def squares(self, vector: np.ndarray) -> np.ndarray:
        """The squared length of each row whose features are scaled by a vector."""
        return self._by_row(lambda at: np.square(self.weight[at] * vector[self.index[at]]))

    def gathered(self, values: np.ndarray) -> np.ndarray:
        return self._by_feature(values, self.weight)

    def counted(self, values: np.ndarray) -> np.ndarray:
        """For each feature, the sum of a value over the rows that have it."""
        return self._by_feature(values, None)

    def only(self, features: np.ndarray) -> Rows:
        """The same rows with the features of a boolean choice alone."""
        held = features[self.index]
        start = np.concatenate([[0], np.cumsum(held)])[self.start]
        return Rows(self.index[held], self.weight[held], start, self.size)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def log_odds(rows: Rows, y: np.ndarray, used: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Log ratio of each feature's document frequency in the positive and the negative rows that are used."""
    pos, neg = rows.counted(y * used), rows.counted((1 - y) * used)
    n_pos, n_neg = max((y * used).sum(), 1), max(((1 - y) * used).sum(), 1)
    return np.log((pos + smooth) / (n_pos + 2 * smooth)) - np.log((neg + smooth) / (n_neg + 2 * smooth))


def fit_logistic(
    rows: Rows, extra: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1e-4, used: np.ndarray | None = None
) -> np.ndarray:
    """Weights of features, then of the dense columns ``extra``, then the bias; ``used`` chooses rows, by default all.

    Features are scaled by their log odds before the fit, so that informative ones move first; full gradient steps with
    momentum, without randomness. A class that is empty gives weights of zero and a bias at the smoothed rate.
    """
    used = np.ones(rows.n) if used is None else used.astype(float)
    n, k, hits = used.sum(), extra.shape[1], (y * used).sum()
    w = np.zeros(rows.size + k + 1)
    rate = (hits + 0.5) / (n + 1)
    w[-1] = np.log(rate / (1 - rate))
    if not 0 < hits < n:
        return w
    scale = log_odds(rows, y, used)
    norm = rows.squares(scale) + (extra**2).sum(1) + 1
    step, u, v = 4 / ((norm * used).sum() / n), np.zeros_like(w), np.zeros_like(w)
    u[-1] = w[-1]
    for _ in range(steps):
        ahead = u + 0.9 * v
        miss = (sigmoid(rows.times(scale * ahead[: rows.size]) + extra @ ahead[rows.size : -1] + ahead[-1]) - y) * used
        grad = np.concatenate([scale * rows.gathered(miss), extra.T @ miss, [miss.sum()]]) / n
        grad[:-1] += ridge * ahead[:-1]
        v = 0.9 * v - step * grad
        u = u + v
    u[: rows.size] *= scale
    return u
