"""Dirty transactions derived from the ``events`` table, by arithmetic on its ids alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.functions import columns as fx
from txflow.schemas import MONEY


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _transaction(df: DataFrame, amount: Column, ts: Column) -> DataFrame:
    return df.select(
        F.concat(F.lit("T"), F.col("event_id").cast("string")).alias("transaction_id"),
        fx.customer_code(F.col("user_id")).alias("customer_id"),
        amount.cast(MONEY).alias("amount"),
        ts.alias("timestamp"),
        F.col("event_type").alias("merchant"),
    )


def _originals(events: DataFrame) -> DataFrame:
    amount, number = F.col("value").cast(MONEY), F.col("event_id")
    spoiled = F.when(number % 33 == 1, F.lit(0).cast(MONEY)).when(number % 50 == 2, -amount).otherwise(amount)
    return _transaction(events, spoiled, F.col("ts"))


def _copies(events: DataFrame) -> DataFrame:
    amount, number = F.col("value").cast(MONEY), F.col("event_id")
    spoiled = F.when(number % 60 == 0, F.lit(0).cast(MONEY)).otherwise(amount)
    return _transaction(events.filter(number % 20 == 0), spoiled, F.col("ts") + F.expr("interval 30 hours"))


def originals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a transaction; some amounts are zeroed, some negated."""
    return _originals(load(spark, sf_dir, "events"))


def copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The injected duplicates: 30 hours later, a third of them zeroed."""
    return _copies(load(spark, sf_dir, "events"))


def dirty_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Originals and copies together: what a raw transactions table looks like."""
    events = load(spark, sf_dir, "events")
    return _originals(events).unionByName(_copies(events))
