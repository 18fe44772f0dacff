"""Synthetic transactions as Spark jobs: each row depends on its number and the seed alone."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.functions import columns as fx
from txflow.schemas import MONEY

# How many rows get an issue, as a divisor of the number of rows.
DUPLICATES_PER = 20
ZEROS_PER = 33
NEGATIVES_PER = 50


def _cents(low: int, high: int, digest: Column, number: int = 0) -> Column:
    """Uniform amount between two bounds in cents, both included."""
    return ((fx.digest_draw(high - low + 1, digest, number) + low) / 100).cast(MONEY)


def _time_back(as_of: datetime, days_back: int, digest: Column) -> Column:
    bounds = (days_back + 1, 24, 60, 60)
    return fx.time_before(fx.instant(as_of), *[fx.digest_draw(b, digest, k).cast("int") for k, b in enumerate(bounds)])


def generate_transactions(spark: SparkSession, n: int, as_of: datetime, **options: int) -> DataFrame:
    """``n`` clean transactions of the days before ``as_of``, with their ``row_no``; options as in :func:`transactions`."""
    return transactions(spark.range(n).withColumnRenamed("id", "row_no"), as_of, **options)


def transactions(
    rows: DataFrame,
    as_of: datetime,
    *,
    seed: int = 42,
    customers: int = 80,
    stores: int = 25,
    days_back: int = 60,
) -> DataFrame:
    """A clean transaction for each ``row_no`` of ``rows``; it depends on that number and the seed alone."""
    row = F.col("row_no")
    name, draw, time = fx.digest(seed, row), fx.digest(seed, row, "draw"), fx.digest(seed, row, "time")
    pieces = [F.substring(name, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    named = len(fx.NAMED_MERCHANTS)
    return rows.select(
        row,
        F.concat_ws("-", *pieces).alias("transaction_id"),
        fx.customer_code(fx.digest_draw(customers, draw, 0) + 1).alias("customer_id"),
        _cents(100, 200_000, draw, 1).alias("amount"),
        _time_back(as_of, days_back, time).alias("timestamp"),
        fx.merchant_name(fx.digest_draw(stores + named, draw, 2), stores).alias("merchant"),
    )


def _spread(row: Column, total: int, picks: int) -> tuple[Column, Column]:
    """Choose exactly ``picks`` of ``total`` row numbers at even steps: (is chosen, number of the choice)."""
    step = max(1, total // picks)
    number = F.floor(row / step)
    return (row % step == step - 1) & (number < picks), number


def inject_issues(df: DataFrame, n: int, as_of: datetime, *, seed: int = 42, days_back: int = 60) -> DataFrame:
    """Add duplicates at another time, and set zero and negative amounts, in exact numbers.

    ``df`` holds ``row_no`` 0 .. n-1. n/20 rows are copied under the same id; among rows and
    copies alike, n/33 amounts become zero and n/50 become negative, so one copy of a
    transaction may be spoiled while the other is not. Nothing is shuffled.
    """
    copies = min(n, max(1, n // DUPLICATES_PER))
    chosen, number = _spread(F.col("row_no"), n, copies)
    repeated = df.filter(chosen).select(
        (number + n).alias("row_no"),
        *[
            _time_back(as_of, days_back, fx.digest(seed, F.col("row_no"), "again")).alias(c) if c == "timestamp" else F.col(c)
            for c in df.columns
            if c != "row_no"
        ],
    )
    zeros, negatives = max(1, n // ZEROS_PER), max(1, n // NEGATIVES_PER)
    spoiled = min(n + copies, zeros + negatives)
    row = F.col("row_no")
    hit, number = _spread(row, n + copies, spoiled)
    is_zero = F.floor((number + 1) * zeros / spoiled) > F.floor(number * zeros / spoiled)
    amount = (
        F.when(hit & is_zero, F.lit(0))
        .when(hit, -_cents(1, 50_000, fx.digest(seed, row, "refund")))
        .otherwise(F.col("amount"))
        .cast(MONEY)
    )
    dirty = df.unionByName(repeated.select(*df.columns)).withColumn("amount", amount)
    return dirty.drop("row_no")


def generate_daily_totals(
    spark: SparkSession, as_of: date, *, customers: int = 1000, days: int = 7, seed: int = 42
) -> DataFrame:
    """One total between 50 and 1500 for each customer on each of the last ``days`` days."""
    number = F.floor(F.col("id") / days)
    back = F.col("id") % days
    return spark.range(customers * days).select(
        fx.customer_code(number + 1).alias("customer_id"),
        fx.days_before(F.lit(as_of), back.cast("int")).alias("transaction_date"),
        _cents(5_000, 150_000, fx.digest(seed, F.col("id"), "total")).alias("daily_total"),
        F.lit(1).cast("bigint").alias("transaction_count"),
    )
