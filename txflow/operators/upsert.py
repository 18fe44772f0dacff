"""Keyed last-write-wins upserts as pure functions on frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collapse_batch(batch: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """The last row per key in the order of ``sequence``; rows equal there fall to the greatest values."""
    keys = list(keys)
    rest = [c for c in batch.columns if c not in keys and c not in sequence]
    order = [c for c in sequence if c not in keys]
    last = batch.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_row"))
    return last.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in batch.columns])


def apply_upsert(
    table: DataFrame, batch: DataFrame, keys: Sequence[str], deletes: DataFrame | None = None
) -> DataFrame:
    """``batch`` plus the table's rows under other keys; keys are unique on each side."""
    replaced = batch.select(*keys)
    if deletes is not None:
        replaced = replaced.unionByName(deletes.select(*keys))
    return table.join(replaced, list(keys), "left_anti").unionByName(batch.select(*table.columns))
