"""LM scoring: a log-bilinear model trained in numpy with noise-contrastive estimation, on all training documents.

The model predicts outcomes: the most frequent words one by one, classes of all other words by their ends, and the end
of the text. A word of a class then has its smoothed share of the class, from exact counts of every training word. All
three levels are normalised, so a text's score is its log probability.

Two outcomes of context make (R1[a] + R2[b]) . Q[y] + B[y]. There are few contexts, so their normalisers are a table
that batched matrix products fill once; a token then costs four look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.llm.common import written

SEED = 42
SLOTS = 10
FLUSH = 400_000
CACHE = 1 << 18


@dataclass(frozen=True)
class Shape:
    """Sizes of the model, which bound what is broadcast, and of its training.

    Training goes in ``SLOTS`` rounds, which together take every training document once. A round deals its documents by
    a hash to shards of about ``shard`` tokens, however Spark has partitioned them; every shard goes on from the same
    weights and sums of squared gradients, and both are averaged by the shards' tokens. So a shard's steps do not
    become fewer as the corpus grows or is cut into more tasks; there are only more of them to average.
    """

    words: int = 1000
    classes: int = 63
    suffix: int = 3
    width: int = 24
    noise: int = 48
    batch: int = 1024
    rate: float = 0.05
    shard: int = 1 << 19

    @property
    def outcomes(self) -> int:
        return self.words + self.classes + 1


@dataclass(frozen=True)
class Vocabulary:
    """Frequent words in order with their counts, and for each class of other words its tokens and distinct words."""

    shape: Shape
    words: tuple[bytes, ...]
    counts: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    documents: int

    @property
    def tokens(self) -> int:
        return int(self.counts.sum() + self.class_tokens.sum() + self.documents)

    @property
    def distinct(self) -> int:
        return len(self.words) + int(self.class_words.sum()) + (self.documents > 0)

    @property
    def base(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)

    def unigram(self) -> np.ndarray:
        """Smoothed probabilities of the outcomes."""
        c = np.zeros(self.shape.outcomes)
        c[: len(self.counts)] = self.counts
        c[self.shape.words : -1] = self.class_tokens
        c[-1] = self.documents
        return (c + 0.5) / (c + 0.5).sum()


def class_of(word: bytes, shape: Shape) -> int:
    return xxhash.xxh64_intdigest(word[-shape.suffix :], SEED) % shape.classes


class Tokens:
    """Outcome and hash of each word of a text, remembered for recent words; frequent words stay in the first slots."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.shape = vocabulary, vocabulary.shape
        self.frequent = {w: i for i, w in enumerate(vocabulary.words)}
        self.outcome = np.zeros(CACHE, np.int32)
        self.hash = np.zeros(CACHE, np.int64)
        self._reset()

    def _reset(self) -> None:
        self.known = dict(self.frequent)
        n = len(self.frequent)
        self.outcome[:n] = np.arange(n)

    def _slot(self, word: bytes) -> int:
        k = self.known[word] = len(self.known)
        self.outcome[k] = self.shape.words + class_of(word, self.shape)
        h = xxhash.xxh64_intdigest(word, SEED)
        self.hash[k] = h - (1 << 64) if h >> 63 else h
        return k

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Outcomes of words, and hashes of those among them that are not frequent, in order."""
        outs, hashes = [], []
        for at in range(0, len(words), 1 << 16):
            part = words[at : at + (1 << 16)]
            if len(self.known) + len(part) > CACHE:
                self._reset()
            get = self.known.get
            slots = np.array([k if (k := get(w)) is not None else self._slot(w) for w in part], np.int64)
            y = self.outcome[slots]
            outs.append(y)
            hashes.append(self.hash[slots[y >= self.shape.words]])
        if not outs:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return np.concatenate(outs), np.concatenate(hashes)


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()  # bytes: A-Z and ASCII white space alone


def _prepared(docs: DataFrame) -> DataFrame:
    """Row number, doc_id, whether it is held out, its slot among the rounds, and the text in UTF-8."""
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (crc % 5 == 1).alias("held_out"),
        (F.floor(crc / 5) % SLOTS).cast("int").alias("slot"),
        F.col("text").cast("binary").alias("text"),
    )


def count_words(rows: DataFrame, shape: Shape) -> DataFrame:
    """``word``, ``class`` and count ``c`` of every training word; summed in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            words = list(counts)
            columns = [pa.array(words, pa.binary()), pa.array([class_of(w, shape) for w in words], pa.int32()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "class", "c"])

        for batch in batches:
            for text in batch.column("text").to_pylist():
                words = _words(text)
                for at in range(0, len(words), FLUSH):
                    for w in words[at : at + FLUSH]:
                        counts[w] = counts.get(w, 0) + 1
                    if len(counts) >= FLUSH:
                        yield flush()
        if counts:
            yield flush()

    kept = rows.where(~F.col("held_out")).select("text")
    return kept.mapInArrow(run, "word binary, class int, c long").groupBy("word", "class").agg(F.sum("c").alias("c"))


def vocabulary(rows: DataFrame, counts: DataFrame, shape: Shape) -> Vocabulary:
    """The bounded part of the counts: frequent words, ties by the word, and sums for each class of the others."""
    top = counts.orderBy(F.desc("c"), "word").limit(shape.words).collect()
    words = tuple(bytes(r["word"]) for r in top)
    per = counts.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()
    tokens, distinct = np.zeros(shape.classes, np.int64), np.zeros(shape.classes, np.int64)
    for r in per:
        tokens[r["class"]], distinct[r["class"]] = r["c"], r["n"]
    for r in top:
        tokens[r["class"]] -= r["c"]
        distinct[r["class"]] -= 1
    documents = rows.where(~F.col("held_out")).count()
    return Vocabulary(shape, words, np.array([r["c"] for r in top], np.int64), tokens, distinct, documents)


@dataclass
class Weights:
    """R1 and R2 (context outcomes and a start), Q and B (outcomes)."""

    r1: np.ndarray
    r2: np.ndarray
    q: np.ndarray
    b: np.ndarray

    @classmethod
    def initial(cls, v: Vocabulary) -> Weights:
        """Small vectors, the same on every machine, around the unigram distribution."""
        draw = np.random.default_rng(SEED)
        n, d = v.shape.outcomes, v.shape.width
        small = lambda k: draw.normal(0, 0.1, (k, d)).astype(np.float32)
        return cls(small(n + 1), small(n + 1), small(n), np.log(v.unigram()).astype(np.float32))

    def stacked(self) -> np.ndarray:
        d = self.q.shape[1]
        wide = np.zeros((len(self.r1) * 2 + len(self.q), d + 1), np.float64)
        wide[:, :d] = np.concatenate([self.r1, self.r2, self.q])
        wide[-len(self.q) :, d] = self.b
        return wide

    @classmethod
    def from_stacked(cls, wide: np.ndarray, n: int) -> Weights:
        wide = wide.astype(np.float32)
        return cls(wide[: n + 1, :-1], wide[n + 1 : 2 * n + 2, :-1], wide[2 * n + 2 :, :-1], wide[2 * n + 2 :, -1].copy())


def _add_rows(size: int, index: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of rows of equal index."""
    out = np.zeros((size, values.shape[1]), np.float32)
    order = np.argsort(index, kind="stable")
    index = index[order]
    starts = np.flatnonzero(np.r_[True, index[1:] != index[:-1]])
    out[index[starts]] = np.add.reduceat(values[order], starts, axis=0)
    return out


class Trainer:
    """Noise-contrastive estimation with noise words shared by a minibatch, and Adagrad steps."""

    def __init__(self, v: Vocabulary, start: Weights, sums: np.ndarray | None = None, seed: tuple[int, ...] = ()):
        self.shape, self.noise = v.shape, v.unigram()
        self.log_noise = np.log(self.shape.noise * self.noise).astype(np.float32)
        self.cdf = np.cumsum(self.noise)
        self.w = Weights(*(x.copy() for x in (start.r1, start.r2, start.q, start.b)))
        self.sums = [np.full(x.shape, 1e-7, np.float32) for x in (self.w.r1, self.w.r2, self.w.q, self.w.b)]
        if sums is not None:
            held = Weights.from_stacked(sums, v.shape.outcomes)
            self.sums = [held.r1.copy(), held.r2.copy(), held.q.copy(), held.b]
        self.draw, self.tokens = np.random.default_rng([SEED, *seed]), 0

    def step(self, a: np.ndarray, b: np.ndarray, y: np.ndarray) -> None:
        w, k, n = self.w, self.shape.noise, len(y)
        drawn = np.minimum(np.searchsorted(self.cdf, self.draw.random(k)), len(self.cdf) - 1)
        r = w.r1[a] + w.r2[b]
        qy, qn = w.q[y], w.q[drawn]
        good = 1 / (1 + np.exp(np.clip((r * qy).sum(1) + w.b[y] - self.log_noise[y], -30, 30)))  # 1 - probability of data
        bad = 1 / (1 + np.exp(np.clip(self.log_noise[drawn] - w.b[drawn] - r @ qn.T, -30, 30)))
        miss = (-good / n).astype(np.float32)
        bad = (bad / n).astype(np.float32)
        dr = miss[:, None] * qy + bad @ qn
        dq = _add_rows(len(w.q), np.concatenate([y, drawn]), np.concatenate([miss[:, None] * r, bad.T @ r]))
        db = np.bincount(y, miss, len(w.b)) + np.bincount(drawn, bad.sum(0), len(w.b))
        grads = (_add_rows(len(w.r1), a, dr), _add_rows(len(w.r2), b, dr), dq, db.astype(np.float32))
        for x, g, s in zip((w.r1, w.r2, w.q, w.b), grads, self.sums, strict=True):
            s += g * g
            x -= self.shape.rate * g / np.sqrt(s)
        self.tokens += n

    def epoch(self, a: np.ndarray, b: np.ndarray, y: np.ndarray) -> None:
        order = self.draw.permutation(len(y))
        for at in range(0, len(y), self.shape.batch):
            part = order[at : at + self.shape.batch]
            self.step(a[part], b[part], y[part])


def _contexts(y: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The outcomes one and two places before, ``start`` before the first word."""
    return np.concatenate([[start], y[:-1]]), np.concatenate([[start, start], y[:-2]])[: len(y)]


def outcomes(rows: DataFrame, v: Vocabulary) -> DataFrame:
    """The training documents as outcomes: ``slot``, a hash ``h``, their number ``n`` and ``y``, 16 bits each; stored."""
    sent = rows.sparkSession.sparkContext.broadcast(v)
    assert v.shape.outcomes < 1 << 15

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = Tokens(sent.value), sent.value.shape.outcomes - 1
        for batch in batches:
            ys = [np.append(tokens.of(_words(t))[0], end).astype("<i2") for t in batch.column("text").to_pylist()]
            arrays = [batch.column("slot"), batch.column("h"), pa.array([len(y) for y in ys], pa.int64()), pa.array([y.tobytes() for y in ys], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["slot", "h", "n", "y"])

    kept = rows.where(~F.col("held_out")).select("slot", F.xxhash64("doc_id", "text").alias("h"), "text")
    return written(kept.mapInArrow(run, "slot int, h long, n long, y binary"), "lm-outcomes")


def train(rows: DataFrame, v: Vocabulary) -> Weights:
    """Train shard by shard and average round by round; a bounded table of sums comes to the driver."""
    spark, shape = rows.sparkSession, v.shape
    weights, sums, n, width = Weights.initial(v), None, shape.outcomes, shape.width + 1
    stored = outcomes(rows, v)
    sizes = {r["slot"]: r["n"] for r in stored.groupBy("slot").agg(F.sum("n").alias("n")).collect()}
    columns = [f"x{i}" for i in range(2 * width)]
    for slot in sorted(sizes):
        shards = max(1, round(sizes[slot] / shape.shard))
        part = stored.where(F.col("slot") == slot).select(F.pmod("h", F.lit(shards)).cast("int").alias("shard"), "h", "y")
        dealt = part.repartitionById(shards, "shard").sortWithinPartitions("shard", "h", "y")
        sent = spark.sparkContext.broadcast((v, weights, sums))

        def run(batches: Iterator[pa.RecordBatch], sent=sent, slot=slot) -> Iterator[pa.RecordBatch]:
            v, weights, sums = sent.value
            trainer, number, end, size, held = None, None, v.shape.outcomes - 1, 0, []

            def learn() -> None:
                if held:
                    trainer.epoch(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held.clear()

            def result() -> pa.RecordBatch:
                learn()
                states = trainer.w, Weights(*trainer.sums)
                wide = np.concatenate([x.stacked() for x in states], 1) * trainer.tokens
                arrays = [pa.array(np.arange(len(wide))), pa.array(np.full(len(wide), trainer.tokens)), *map(pa.array, wide.T)]
                return pa.RecordBatch.from_arrays(arrays, ["row", "n", *columns])

            for batch in batches:
                for shard, data in zip(batch.column("shard").to_pylist(), batch.column("y").to_pylist(), strict=True):
                    if shard != number:
                        if trainer is not None:
                            yield result()
                        trainer, number, size = Trainer(v, weights, sums, (slot, shard)), shard, 0
                    y = np.frombuffer(data, "<i2").astype(np.int32)
                    held.append((*_contexts(y, end + 1), y))
                    size += len(y)
                    if size >= 1 << 18:
                        learn()
                        size = 0
            if trainer is not None:
                yield result()

        schema = "row long, n long, " + ", ".join(f"{c} double" for c in columns)
        means = dealt.mapInArrow(run, schema).groupBy("row").agg(*[(F.sum(c) / F.sum("n")).alias(c) for c in columns])
        got = means.toArrow()
        wide = np.stack([got.column(c).to_numpy() for c in columns], 1)[np.argsort(got.column("row").to_numpy())]
        weights, sums = Weights.from_stacked(wide[:, :width], n), np.maximum(wide[:, width:], 1e-7)
    return weights


@dataclass(frozen=True)
class Scores:
    """Tables of a trained model: products of each context place with each outcome, biases, and log normalisers."""

    t1: np.ndarray
    t2: np.ndarray
    b: np.ndarray
    z: np.ndarray

    def log10(self, a: np.ndarray, b: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (self.t1[a, y] + self.t2[b, y] + self.b[y] - self.z[a, b]) / np.log(10)


def log_z(t1_row: np.ndarray, t2: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log normalisers of one first context with every second."""
    s = t2 + (t1_row + b)
    top = s.max(1)
    return top + np.log(np.exp(s - top[:, None]).sum(1))


def tables(spark: SparkSession, w: Weights) -> Scores:
    """Fill the table of normalisers, first contexts dealt over the tasks; its size is fixed by the model's shape."""
    t1, t2 = w.r1 @ w.q.T, w.r2 @ w.q.T
    sent, n = spark.sparkContext.broadcast((t1, t2, w.b)), len(t1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t1, t2, b = sent.value
        for batch in batches:
            ids = batch.column("id").to_pylist()
            z = [log_z(t1[i], t2, b).astype(np.float32) for i in ids]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(z, pa.list_(pa.float32()))], ["id", "z"])

    got = spark.range(n).mapInArrow(run, "id long, z array<float>").toArrow().sort_by("id")
    return Scores(t1, t2, w.b, np.stack([np.asarray(x.values) for x in got.column("z")]))


def score(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """One row for each document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score``.

    Held out are documents whose crc32(doc_id as text) mod 5 is 1; a NULL doc_id counts as the empty text, which is not.
    NULL text counts as empty: one token, the end. Repeated rows each count in training and each get a row. Without
    training documents every count is 0. Only ``doc_id`` and ``text`` are read.

    Counts of all training words stay in Spark. What is broadcast is bounded by ``shape``. Words outside the frequent
    ones meet their counts in a shuffle by word hash, once for each document that has them. Texts may be very long: they
    are taken whole, and a task holds one batch of them.
    """
    spark = docs.sparkSession
    rows = _prepared(docs)
    counts = written(count_words(rows, shape), "word-counts")
    v = vocabulary(rows, counts, shape)
    scores = tables(spark, train(rows, v))
    sent = spark.sparkContext.broadcast((v, scores))
    fields = "rid long, doc_id long, held_out boolean, n_tokens long, known long, base double, model double, tail array<long>, times array<int>"
    names = [x.split(" ")[0] for x in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, scores = sent.value
        tokens, end, m = Tokens(v), v.shape.outcomes - 1, v.shape.words
        plain = np.zeros(v.shape.outcomes)  # log10 of the count in the base, for outcomes that are one token
        plain[: len(v.counts)] = np.log10(v.counts + 0.5)
        plain[end] = np.log10(v.documents + 0.5)
        inside = np.log10(v.class_tokens + 0.5 * (v.class_words + 1))
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                y, tail = tokens.of(_words(text))
                y = np.append(y, end)
                rare = (y >= m) & (y < end)
                model = scores.log10(*_contexts(y, end + 1), y).sum(dtype=np.float64) - inside[y[rare] - m].sum()
                base = plain[y].sum() - len(y) * np.log10(v.base)
                known = len(y) - len(tail) - (0 if v.documents else 1)
                out.append((len(y), known, base, model, *np.unique(tail, return_counts=True)))
            columns = [batch.column(c) for c in names[:3]]
            columns += [pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
            columns += [pa.array([x[4] for x in out], pa.list_(pa.int64())), pa.array([x[5] for x in out], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names)

    judged = rows.select("rid", "doc_id", "held_out", "text").mapInArrow(run, fields)
    own = ["doc_id", "held_out", "n_tokens", "known", "base", "model"]
    spread = judged.select("rid", *own, F.posexplode_outer(F.arrays_zip("tail", "times")).alias("i", "word"))
    spread = spread.select("rid", *own, "i", F.col("word.tail").alias("h"), F.col("word.times").alias("times"))
    first = F.coalesce(F.col("i"), F.lit(0)) == 0
    spread = spread.select(
        "rid",
        *[F.when(first, F.col(c)).alias(c) for c in own],
        F.col("h").isNotNull().alias("has"),
        "times",
        F.coalesce("h", F.xxhash64("rid")).alias("h"),  # rows without such words are dealt out, not sent to one task
    )
    table = counts.select(F.xxhash64("word").alias("h"), "c").hint("shuffle_hash")
    met = spread.join(table, "h", "left").withColumn("c", F.when(F.col("has"), F.coalesce("c", F.lit(0))))
    each = [F.max(c).alias(c) for c in own]
    log_c = F.coalesce(F.sum(F.col("times") * F.log10(F.col("c") + 0.5)), F.lit(0.0))
    done = met.groupBy("rid").agg(*each, log_c.alias("log_c"), F.coalesce(F.sum(F.when(F.col("c") > 0, F.col("times"))), F.lit(0)).alias("more"))
    return done.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.col("more")).alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("log_c")).alias("base_score"),
        (F.col("model") + F.col("log_c")).alias("score"),
    )
