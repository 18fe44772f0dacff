"""Order-free digests of parts of a frame, so that equal parts need no join to be known as equal.

A leaf is a part of the rows, by day and bucket of the key for instance. Its digest is a count, a sum and an exclusive or
of row hashes: each can be worked out in map tasks and put together in any order, and repeated rows do not cancel out.
Two frames are compared leaf by leaf; rows are joined by key only within leaves that differ.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.functions import columns as fx
from txflow.operators import dml
from txflow.operators.quality import QualityGateError

DIGEST = ["row_count", "hash_sum", "hash_xor"]


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """A bucket of the key that SQL can repeat; NULL keys share one."""
    return fx.digest_draw(buckets, fx.digest(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])).cast("int")


def row_hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two independent hashes of a row. NULLs are hashed by their place, as Spark's hash skips them."""
    values = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(1), *values), F.xxhash64(F.lit(2), *values)


def leaves(df: DataFrame, place: Mapping[str, Column], columns: Sequence[str] | None = None) -> DataFrame:
    """The digest of each leaf; ``place`` names the columns that say which leaf a row belongs to."""
    first, second = row_hashes(columns or df.columns)
    placed = df.select(*[c.alias(n) for n, c in place.items()], first.alias("_a"), second.alias("_b"))
    return placed.groupBy(*place).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("_a").cast("decimal(20,0)")).alias("hash_sum"),
        F.bit_xor("_b").alias("hash_xor"),
    )


def differing(a: DataFrame, b: DataFrame, place: Sequence[str]) -> DataFrame:
    """The leaves that one side lacks or holds with another digest; a row for each, NULL places included."""
    stacked = a.select(*place, *DIGEST).unionByName(b.select(*place, *DIGEST))
    met = stacked.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"), F.count_distinct(F.struct(*DIGEST)).alias("_kinds"))
    return met.filter((F.col("_n") < 2) | (F.col("_kinds") > 1)).select(*place)


def within(df: DataFrame, found: Sequence, place: Mapping[str, Column]) -> DataFrame:
    """The rows of some leaves, by a filter that a scan can use to skip partitions."""
    if not found:
        return df.filter(F.lit(False))
    first, *rest = place
    per: dict = {}
    for row in found:
        per.setdefault(row[first], []).append(tuple(row[r] for r in rest))
    hits = F.lit(False)
    for value, others in per.items():
        own = place[first].eqNullSafe(F.lit(value))
        inner = F.lit(not rest)
        for combination in others if rest else []:
            each = F.lit(True)
            for name, x in zip(rest, combination, strict=True):
                each = each & place[name].eqNullSafe(F.lit(x))
            inner = inner | each
        hits = hits | (own & inner)
    return df.filter(hits)


def diff(before: DataFrame, after: DataFrame, keys: Sequence[str], place: Mapping[str, Column], most: int = 1000) -> DataFrame:
    """What :func:`~txflow.operators.dml.diff_keyed` finds, from the rows of differing leaves alone.

    A key whose row moves to another leaf changes both, so no change is missed. With more than ``most`` differing leaves
    a filter by name would be as long as a table, and they are joined instead.
    """
    changed = differing(leaves(before, place), leaves(after, place), list(place))
    found = changed.limit(most + 1).collect()
    if len(found) <= most:
        before, after = within(before, found, place), within(after, found, place)
    else:
        names = [f"_{n}" for n in place]
        marks = changed.select(*[F.col(n).alias(f"_{n}") for n in place])
        on = [place[n].eqNullSafe(F.col(m)) for n, m in zip(place, names, strict=True)]
        before, after = (x.join(marks, on, "left_semi") for x in (before, after))
    return dml.diff_keyed(before, after, keys)


def assert_equal(batch: DataFrame, table: DataFrame, place: Mapping[str, Column]) -> int:
    """Raise unless both hold the same rows, by digests alone; returns their number of rows."""
    own = leaves(batch, place).persist()
    try:
        for row in differing(own, leaves(table.select(*batch.columns), place), list(place)).take(1):
            raise QualityGateError(f"rows differ at {row.asDict()}")
        return own.agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0]
    finally:
        own.unpersist()
