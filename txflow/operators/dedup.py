"""One row per key, with a survivor that does not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRATEGIES = ("struct", "window", "any")


def dedupe(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    *,
    latest: bool = False,
    strategy: str = "struct",
) -> DataFrame:
    """Keep the first row per key in the order of ``order_by``, or the last with ``latest``.

    ``struct`` (default) is one grouped minimum: copies of a hot key collapse inside each
    map task before the only shuffle. Columns outside ``order_by`` follow as tie breakers,
    so the order is total. ``window`` gives the same rows through a row number, and takes maps, which
    cannot be compared and break ties by their sorted entries; all copies of a key meet in one
    task, so it is not for keys that hold a large part of the rows. ``any`` is the native operator
    and is right only where the copies of a key are equal in every column.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    keys = list(keys)
    if strategy == "any":
        return df.dropDuplicates(keys)
    first = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in first]
    if not first + rest:
        return df.distinct()
    if strategy == "window":
        direction = "desc" if latest else "asc"
        ties = [F.to_json(F.array_sort(F.map_entries(c))) if _is_map(df, c) else F.col(c) for c in rest]
        order = [getattr(c, direction)() for c in (*map(F.col, first), *ties)]
        ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        return ranked.filter("_rank = 1").drop("_rank")
    pick = F.max if latest else F.min
    survivors = df.groupBy(*keys).agg(pick(F.struct(*first, *rest)).alias("_row"))
    return survivors.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def _is_map(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.MapType)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
