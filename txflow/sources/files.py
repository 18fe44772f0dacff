"""Plain sources and sinks: Parquet, CSV with quarantine, literal rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.functions import columns as fx
from txflow.operators.rollup import first_rows
from txflow.schemas import RAW_TRANSACTIONS
from txflow.sources import csv_records, storage

EMPTY = "\x00"  # stands for a quoted empty text while it is parsed, which would be NULL otherwise
QUOTING = {"quote": '"', "escape": '"'}


def require_source(spark: SparkSession, path: str) -> str:
    """The path itself, or ``FileNotFoundError`` that says what to do."""
    if not storage.exists(spark, path):
        raise FileNotFoundError(f"no source at {path}; generate transactions first (python -m txflow generate)")
    return path


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | Sequence[str]) -> DataFrame:
    """A few literal rows. With a declared schema, NULL in a non-null column raises; with names, types are inferred."""
    return spark.createDataFrame(list(rows), schema if isinstance(schema, T.StructType) else list(schema))


def read_transactions_csv(spark: SparkSession, path: str, damaged: str = fx.DAMAGED_TEXT) -> tuple[DataFrame, DataFrame]:
    """Good rows in the declared schema, and quarantined records with a reason.

    All columns are read as text, so that a value that does not parse costs its row a reason and never the whole read.
    A merchant is refused only if it is missing or matches ``damaged``. Quoted fields may hold commas, doubled quotes
    and line breaks, also where Spark splits the file; a quote that is never closed costs the lines after it up to the
    next one that could close it, which are quarantined whole.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_TRANSACTIONS])
    schema = T.StructType([*text, T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "multiLine": "true", "emptyValue": EMPTY} | QUOTING
    whole = csv_records.records(spark, path)
    raw = whole.select(F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), options).alias("r"), "record", "line")
    named = [F.when(F.col(f"r.{c}") == EMPTY, "").otherwise(F.col(f"r.{c}")).alias(c) for c in text.names]
    raw = raw.select(*named, "r._corrupt", "record", "line").withColumn("_corrupt", F.when(F.col("record").isNull(), F.col("line")).otherwise(F.col("_corrupt")))
    parsed = raw.select(
        "*", fx.parse_money(F.col("amount")).alias("_amount"), fx.parse_ts(F.col("timestamp")).alias("_ts")
    )
    reason = (
        F.when(F.col("record").isNull(), "unclosed_quote")
        .when(F.col("_corrupt").isNotNull(), "malformed_line")
        .when(F.col("transaction_id").isNull(), "null_transaction_id")
        .when(F.col("customer_id").isNull(), "null_customer_id")
        .when(F.col("_amount").isNull(), "bad_amount")
        .when(F.col("_ts").isNull(), "bad_timestamp")
        .when(F.coalesce(F.col("merchant").rlike(damaged), F.lit(True)), "bad_merchant")
    )
    judged = parsed.withColumn("reason", reason)
    good = judged.filter("reason is null").select(
        "transaction_id",
        "customer_id",
        F.col("_amount").alias("amount"),
        F.col("_ts").alias("timestamp"),
        "merchant",
    )
    return good, judged.filter("reason is not null").select(*text.names, F.col("_corrupt").alias("line"), "reason")


def write_sample_csv(df: DataFrame, path: str, n: int = 20, order_by: Sequence[str] = ("transaction_id",)) -> None:
    """The first ``n`` rows as one CSV file with a header; times carry their offset."""
    write_csv(first_rows(df, n, order_by).coalesce(1), path)


def write_csv(df: DataFrame, path: str) -> None:
    """All rows as a folder of CSV files, each with a header; times carry their offset and their fraction.

    Any text comes back from :func:`read_transactions_csv` as it was: blanks are kept, and quotes inside a text doubled.
    """
    for field in df.schema:
        if isinstance(field.dataType, T.TimestampType):
            df = df.withColumn(field.name, F.date_format(field.name, "yyyy-MM-dd HH:mm:ss.SSSSSSxxx"))
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, **blanks, **QUOTING).csv(path)
