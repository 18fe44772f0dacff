"""UPDATE, DELETE, MERGE and DIFF as pure functions on frames; nothing here runs a job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def keys_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def is_true(condition: Column) -> Column:
    """A condition that is NULL selects nothing."""
    return F.coalesce(condition, F.lit(False))


def apply_update(df: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """Set columns where the condition is true; each value is cast to the column's own type."""
    unknown = sorted(set(assignments) - set(df.columns))
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    hit = is_true(condition)
    columns = []
    for field in df.schema:
        value = F.col(field.name)
        if field.name in assignments:
            value = F.when(hit, assignments[field.name].cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def apply_delete(df: DataFrame, condition: Column) -> DataFrame:
    """Drop the rows where the condition is true; rows where it is NULL stay."""
    return df.filter(~is_true(condition))


def cast_like(df: DataFrame, target: DataFrame) -> DataFrame:
    """The target's columns, cast to the target's types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema])


def _replace_matched(joined: DataFrame, columns: Sequence[str], in_source: Column) -> DataFrame:
    """Per row, the source's columns where there is a source row, else the target's."""
    return joined.select(
        *[F.when(in_source, F.col(f"_src.{c}")).otherwise(F.col(f"_tgt.{c}")).alias(c) for c in columns]
    )


def apply_merge(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched target rows take the source row; unmatched source rows are inserted.

    ``source`` holds each non-NULL key once; ``target`` may repeat keys, and every copy is replaced. NULL keys match
    nothing and are not joined. The target stands on the left of a left join, which AQE can split where a key is
    frequent, and its distinct keys, counted partially in the map tasks, decide which source rows are new. Whether a
    side is broadcast is left to Spark's own threshold and measured sizes.
    """
    keys = list(keys)
    columns = target.columns
    source = cast_like(source, target)
    present = target.filter(keys_present(keys))
    flagged = source.filter(keys_present(keys)).withColumn("_in_source", F.lit(True)).alias("_src")
    on = [F.col(f"_tgt.{k}") == F.col(f"_src.{k}") for k in keys]
    joined = present.alias("_tgt").join(flagged, on, "left")
    updated = _replace_matched(joined, columns, F.col("_in_source").isNotNull())
    fresh = source.join(present.select(*keys).distinct(), keys, "left_anti").select(*columns)
    return updated.unionByName(target.filter(~keys_present(keys))).unionByName(fresh)


def merge_change_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows a merge would update and insert, from key counts alone (one row per key after partial sums)."""
    keys = list(keys)
    both = (
        target.select(*keys, F.lit(1).alias("_t"), F.lit(0).alias("_s"))
        .unionByName(source.select(*keys, F.lit(0).alias("_t"), F.lit(1).alias("_s")))
        .groupBy(*keys)
        .agg(F.sum("_t").alias("_t"), F.sum("_s").alias("_s"))
    )
    matched = keys_present(keys) & (F.col("_s") > 0) & (F.col("_t") > 0)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return both.agg(
        total(F.when(matched, F.col("_t"))).alias("rows_updated"),
        total(F.when(~matched, F.col("_s"))).alias("rows_inserted"),
    )


def diff_keyed(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Added, removed and changed keys with both rows; a key that repeats on one side raises.

    Both sides are stacked and grouped by key, so a repeated key collapses into counters
    instead of producing pairs. Rows with a NULL key have no identity: they are compared as
    whole rows and can only be added or removed.
    """
    keys = list(keys)
    loose = diff_rows(before.filter(~keys_present(keys)), after.filter(~keys_present(keys)))
    before, after = before.filter(keys_present(keys)), after.filter(keys_present(keys))
    values = [c for c in before.columns if c not in keys]
    stacked = before.select(*keys, F.struct(*values).alias("_old"), F.lit(None).alias("_new")).unionByName(
        after.select(*keys, F.lit(None).alias("_old"), F.struct(*values).alias("_new"))
    )
    grouped = stacked.groupBy(*keys).agg(
        F.count("_old").alias("_n_old"),
        F.count("_new").alias("_n_new"),
        F.min("_old").alias("_old"),
        F.min("_new").alias("_new"),
    )
    repeated = (F.col("_n_old") > 1) | (F.col("_n_new") > 1)
    change = (
        F.when(repeated, F.raise_error(F.lit(f"diff needs unique keys {keys}; use diff_rows")))
        .when(F.col("_n_old") == 0, "added")
        .when(F.col("_n_new") == 0, "removed")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    )
    found = grouped.withColumn("change", change).filter("change is not null")
    found = found.select(
        *keys,
        "change",
        *[F.col("_old")[c].alias(f"old_{c}") for c in values],
        *[F.col("_new")[c].alias(f"new_{c}") for c in values],
    )
    each = loose.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
    nameless = each.select(
        *keys,
        "change",
        *[F.when(F.col("change") == "removed", F.col(c)).alias(f"old_{c}") for c in values],
        *[F.when(F.col("change") == "added", F.col(c)).alias(f"new_{c}") for c in values],
    )
    return found.unionByName(nameless)


def diff_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Whole rows with more or fewer copies after than before, as ``change`` and ``copies``.

    For tables with repeated keys. One shuffle of partially summed rows; a row with many
    copies stays one row with a number.
    """
    stacked = before.withColumn("_d", F.lit(-1)).unionByName(after.withColumn("_d", F.lit(1)))
    net = stacked.groupBy(*before.columns).agg(F.sum("_d").alias("_d")).filter("_d <> 0")
    return net.select(
        *before.columns,
        F.when(F.col("_d") > 0, "added").otherwise("removed").alias("change"),
        F.abs("_d").alias("copies"),
    )
