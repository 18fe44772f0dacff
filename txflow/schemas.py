"""Declared schemas, and the one place where a frame is cast to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

RAW_TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("amount", MONEY, False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("merchant", T.StringType(), False),
    ]
)

DAILY_TOTALS = T.StructType(
    [
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("transaction_date", T.DateType(), False),
        T.StructField("daily_total", MONEY, False),
        T.StructField("transaction_count", T.LongType(), False),
    ]
)

# The same with a 32-bit total, for readers of the original table layout.
DAILY_TOTALS_FLOAT = T.StructType(
    [T.StructField("daily_total", T.FloatType(), False) if f.name == "daily_total" else f for f in DAILY_TOTALS]
)

AUDIT_TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), True),
        T.StructField("amount", MONEY, True),
        T.StructField("ts", T.TimestampType(), True),
        T.StructField("merchant", T.StringType(), True),
    ]
)


class SchemaMismatchError(ValueError):
    """A frame lacks a declared column or holds it in another type."""


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns and cast each to its declared type.

    A floating amount becomes a decimal once, here; NaN and infinities have no decimal
    and become NULL. Any other value that does not fit raises (ANSI casts).
    """
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise SchemaMismatchError(f"missing columns {missing}; found {df.columns}")
    columns = []
    for field in schema:
        value = F.col(field.name)
        have = df.schema[field.name].dataType
        if have != field.dataType:
            if is_floating(have) and isinstance(field.dataType, T.DecimalType):
                finite = ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
                value = F.when(finite, value)
            value = value.cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def assert_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Return ``df`` unchanged if names and types equal ``schema``; nullability is not compared."""
    have = [(f.name, f.dataType) for f in df.schema]
    want = [(f.name, f.dataType) for f in schema]
    if have != want:
        raise SchemaMismatchError(f"expected {schema.simpleString()}, found {df.schema.simpleString()}")
    return df
