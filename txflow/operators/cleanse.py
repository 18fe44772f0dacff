"""Validity rules for raw transactions: filter, reasons, quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.functions import columns as fx
from txflow.schemas import is_floating

KEY_COLUMNS = ("transaction_id", "customer_id", "timestamp")


def has_keys() -> Column:
    """Rows whose identifiers and time are all present; others cannot be stored under a key."""
    return F.col("transaction_id").isNotNull() & F.col("customer_id").isNotNull() & F.col("timestamp").isNotNull()


def is_positive(df: DataFrame, amount: str = "amount") -> Column:
    """``amount > 0``, never true for NaN (which Spark orders above every number) or infinity."""
    value = F.col(amount)
    if is_floating(df.schema[amount].dataType):
        return (value > 0) & ~F.isnan(value) & (value != float("inf"))
    return value > 0


def valid_rows(df: DataFrame, amount: str = "amount") -> DataFrame:
    return df.filter(is_positive(df, amount))


def with_transaction_date(df: DataFrame, ts: str = "timestamp", name: str = "transaction_date") -> DataFrame:
    return df.withColumn(name, fx.transaction_date(F.col(ts)))


def cast_amount(df: DataFrame, amount: str = "amount") -> DataFrame:
    return df.withColumn(amount, fx.money_float(F.col(amount)))


def with_reject_reason(df: DataFrame, amount: str = "amount") -> DataFrame:
    """Add ``reject_reason``: the first rule a row breaks, or NULL for a valid row."""
    value = F.col(amount)
    reason = F.when(F.col("transaction_id").isNull(), "null_transaction_id")
    reason = reason.when(F.col("customer_id").isNull(), "null_customer_id")
    reason = reason.when(F.col("timestamp").isNull(), "null_timestamp")
    reason = reason.when(value.isNull(), "null_amount")
    if is_floating(df.schema[amount].dataType):
        reason = reason.when(F.isnan(value), "nan_amount").when(F.abs(value) == float("inf"), "infinite_amount")
    reason = reason.when(value == 0, "zero_amount").when(value < 0, "negative_amount")
    return df.withColumn("reject_reason", reason)


def rejects(df: DataFrame, amount: str = "amount") -> DataFrame:
    """The rows that break a rule, each with its reason."""
    return with_reject_reason(df, amount).filter("reject_reason is not null")
