"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, then the Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.llm.common import written
from txflow.llm.components import connected

SHINGLE, DISTANCE, SEED = 4, 4, 42
RUN = 1 << 16
HOT = 2000


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a UTF-8 text: A-Z in lower case, word shingles with repeats, XXH64; 0 without words."""
    words = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    hashed, join = xxhash.xxh64_intdigest, b" ".join
    for k in range(0, n, RUN):
        run = words[k : k + RUN + shingle - 1]
        parts = zip(*(run[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [run]
        h = np.fromiter((hashed(join(p), SEED) for p in parts), np.uint64)
        counts += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``th`` (hash of the text) and ``fp`` (as a signed number) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            fp = np.array([fingerprint(x or b"", shingle) for x in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(fp)], ["doc_id", "th", "fp"])

    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("text"))
    return some.mapInArrow(run, "doc_id long, th long, fp long")


def block_masks(n: int, distance: int = DISTANCE) -> list[int]:
    """Masks of which any two fingerprints within the distance share at least one whole.

    With b blocks and at most d differing bits, b - d blocks are equal: one mask for each choice of these. More blocks
    mean more copies of each fingerprint and fewer chance partners; b is chosen for the least of both at n fingerprints.
    """
    cost = lambda b: comb(b, distance) * (1 + n / 2 ** (64 * (b - distance) // b))
    b = min(range(distance + 1, distance + 9), key=cost)
    edges = [round(64 * i / b) for i in range(b + 1)]
    blocks = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(b)]
    return [sum(blocks[i] for i in chosen) for chosen in combinations(range(b), b - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _far(x: Column, distance: int) -> Column:
    return F.bit_count(x) > distance


def links(prints: DataFrame, n: int, distance: int = DISTANCE, hot: int = HOT) -> DataFrame:
    """Links ``a`` < ``b`` between different fingerprints (column ``fp``, distinct) that connect all close pairs.

    Buckets are (mask, fingerprint & mask). In a bucket of at most ``hot`` fingerprints all pairs are compared and a
    close pair is a link, given once, under its first common mask. In a larger bucket two fingerprints are close
    exactly if a number within half the distance of each exists, so each is filed under all such numbers that keep
    the bucket's bits, and linked to the smallest in each file: work in proportion to the bucket, same components.
    """
    masks = [_signed(m) for m in block_masks(n, distance)]
    slots = F.array(*[F.struct(F.lit(c).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for c, m in enumerate(masks)])
    keyed = prints.select("fp", F.inline(slots).alias("c", "key"))
    many = keyed.groupBy("c", "key").count().where("count > 1")
    near = written(keyed.join(many, ["c", "key"]), "buckets")
    cool = near.where(F.col("count") <= hot).select("c", "key", "fp")
    x = F.col("a").bitwiseXOR(F.col("b"))
    first = F.lit(True)
    for c, m in enumerate(masks[:-1]):
        first = first & ((F.col("c") <= c) | (x.bitwiseAND(F.lit(m)) != 0))
    left, right = cool.withColumnRenamed("fp", "a"), cool.select(F.col("c").alias("c2"), F.col("key").alias("k2"), F.col("fp").alias("b"))
    on = (F.col("c") == F.col("c2")) & (F.col("key") == F.col("k2")) & (F.col("a") < F.col("b")) & ~_far(x, distance) & first
    pairs = left.join(right, on).select("a", "b")
    half = [sum(1 << i for i in chosen) for r in range(distance // 2 + 1) for chosen in combinations(range(64), r)]
    if distance % 2:
        raise ValueError("the distance must be even")
    steps = F.split(F.lit(",".join(str(_signed(d)) for d in half)), ",").cast("array<bigint>")
    mask = F.element_at(F.split(F.lit(",".join(map(str, masks))), ",").cast("array<bigint>"), F.col("c") + 1)
    warm = near.where(F.col("count") > hot).withColumn("mask", mask)
    free = F.filter(steps, lambda d: d.bitwiseAND(F.col("mask")) == 0)
    filed = warm.select("c", "fp", F.explode(F.transform(free, lambda d: F.col("fp").bitwiseXOR(d))).alias("mid"))
    stars = filed.join(filed.groupBy("c", "mid").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a < z"), ["c", "mid"])
    stars = stars.where("fp > a").select("a", F.col("fp").alias("b")).distinct()
    return pairs.unionByName(stars)


def groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """The fingerprint of every row (see :func:`fingerprints`), and for each fingerprint ``fp`` its component.

    The second table has ``fp``, ``component_id`` (smallest doc_id of any member; NULL if all are NULL) and ``keep_th``
    (text hash of the member that represents the component). Equal fingerprints are one node, so copies make no links.
    """
    rows = written(fingerprints(docs, shingle), "fingerprints")
    seat = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "th")
    nodes = written(rows.groupBy("fp").agg(F.min(seat).alias("seat")), "nodes")
    roots = connected(links(nodes.select("fp"), nodes.count(), distance, hot), "a", "b")
    placed = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "seat", F.coalesce("root", "fp").alias("root"))
    placed = written(placed, "placed")
    best = placed.groupBy("root").agg(F.min("seat").alias("best"))
    out = placed.join(best, "root").select("fp", F.col("best.doc_id").alias("component_id"), F.col("best.th").alias("keep_th"))
    return rows, out


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, hot: int = HOT) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    Fingerprints that differ in at most ``distance`` bits are linked, and ``component_id`` is the smallest doc_id
    reachable. NULL and blank texts have fingerprint zero and are linked like any other. A NULL doc_id never names a
    component unless the component has no other. Repeated rows are kept and share their component. Only ``doc_id`` and
    ``text`` are read. A fingerprint that a third of all rows share is one node and, in the last join, one row on
    the small side; Spark splits the large side.
    """
    rows, component = groups(docs, shingle, distance, hot)
    out = rows.join(component, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that represent their component: the smallest doc_id (NULL last), one row for each."""
    _, component = groups(docs, shingle, distance)
    kept = component.select(F.struct("component_id", "keep_th").alias("kept")).distinct()
    kept = kept.select(F.coalesce("kept.component_id", F.lit(0)).alias("id"), F.col("kept.component_id").isNull().alias("no"), F.col("kept.keep_th").alias("th"))
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.col("doc_id").isNull().alias("no"),
        F.xxhash64("text").alias("th"),
    )
    keys = ["id", "no", "th"]
    return packed.join(kept, keys, "left_semi").dropDuplicates(keys).select("row.*")
