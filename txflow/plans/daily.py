"""The daily transform as one plan: dedup, validate, derive the date, total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txflow.operators import cleanse, rollup
from txflow.operators.dedup import dedupe
from txflow.schemas import MONEY

# Total order of the copies of one transaction; the total needs no further columns.
SURVIVOR_ORDER = ["timestamp", "customer_id", "amount"]


def keep_first(df: DataFrame) -> DataFrame:
    """The earliest copy of each transaction; rows without keys take no part."""
    return dedupe(df.filter(cleanse.has_keys()), ["transaction_id"], SURVIVOR_ORDER)


def transform(raw: DataFrame, *, validate_first: bool = False) -> DataFrame:
    """Daily totals per customer from raw transactions, in two shuffles.

    Dedup runs before the amount is judged, so a transaction whose earliest copy is
    invalid is dropped; ``validate_first`` lets a later valid copy take its place.
    """
    needed = raw.select("transaction_id", *SURVIVOR_ORDER)
    if validate_first:
        valid = keep_first(cleanse.valid_rows(needed))
    else:
        valid = cleanse.valid_rows(keep_first(needed))
    return rollup.daily_totals(cleanse.with_transaction_date(valid))


def rollup_with_counts(raw: DataFrame, *, validate_first: bool = False) -> DataFrame:
    """Daily totals that also carry how many rows each stage saw, so one pass gives both.

    Per key: ``raw_rows`` (all copies), ``quarantined_rows`` (copies without customer, time or
    id), ``deduplicated_rows`` and ``transaction_count`` (valid ones). Keys without a valid
    transaction have no total; ``totals_of`` leaves them out. Unlike accumulators, sums over
    the written result stay exact when tasks are repeated.
    """
    needed = raw.select("transaction_id", *SURVIVOR_ORDER)
    usable = cleanse.has_keys()
    candidate = usable & F.coalesce(cleanse.is_positive(needed), F.lit(False)) if validate_first else usable
    survivors = needed.groupBy("transaction_id").agg(
        F.min(F.when(candidate, F.struct(*SURVIVOR_ORDER))).alias("_row"),
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(~usable).alias("quarantined_rows"),
    )
    survivors = survivors.select(
        F.col("_row.customer_id").alias("customer_id"),
        F.col("_row.timestamp").alias("timestamp"),
        F.col("_row.amount").alias("amount"),
        (F.col("raw_rows") > F.col("quarantined_rows")).cast("bigint").alias("kept"),
        "raw_rows",
        "quarantined_rows",
    )
    valid = F.col("_row_valid")
    return (
        cleanse.with_transaction_date(survivors)
        .withColumn("_row_valid", F.coalesce(cleanse.is_positive(survivors), F.lit(False)))
        .groupBy(*rollup.TOTAL_KEYS)
        .agg(
            F.sum(F.when(valid, F.col("amount"))).cast(MONEY).alias("daily_total"),
            F.count_if(valid).alias("transaction_count"),
            F.sum("kept").alias("deduplicated_rows"),
            F.sum("raw_rows").alias("raw_rows"),
            F.sum("quarantined_rows").alias("quarantined_rows"),
        )
    )


def totals_of(counted: DataFrame) -> DataFrame:
    """The daily totals inside a counted rollup."""
    return counted.filter("transaction_count > 0").select(*rollup.TOTAL_KEYS, "daily_total", "transaction_count")


def stage_counts(counted: DataFrame) -> DataFrame:
    """One row: rows at each stage and rows each stage removed."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    summed = counted.agg(
        total("raw_rows").alias("raw_rows"),
        total("quarantined_rows").alias("quarantined_rows"),
        total("deduplicated_rows").alias("deduplicated_rows"),
        total("transaction_count").alias("valid_rows"),
        F.count_if(F.col("transaction_count") > 0).alias("aggregated_rows"),
    )
    return summed.select(
        "*",
        (F.col("raw_rows") - F.col("quarantined_rows") - F.col("deduplicated_rows")).alias("removed_by_dedup"),
        (F.col("deduplicated_rows") - F.col("valid_rows")).alias("removed_by_filter"),
    )
