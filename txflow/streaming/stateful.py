"""Daily totals as a stateful stream: transactions are kept in state until no copy of theirs can come any more.

Two queries, each with a checkpoint of its own, run one after the other over what has arrived:

1. *Admission* cuts off what is too late. A batch's mark is the latest time of all batches before it, minus ``delay``;
   rows before the mark, and rows without keys, go to the quarantine with a reason, all others to ``admitted``. Spark's
   own watermark would drop late rows without a trace.
2. *Totals* keeps the copies of a transaction together in a session window, which ends when no copy has come for
   ``horizon``; its earliest copy is the survivor. Valid survivors are summed by customer and day in a second streaming
   aggregation, and each sum is appended to ``deltas`` once, when the watermark passes. A day's total is the sum of its
   deltas.

The result equals the batch transform of the admitted rows as long as copies of one transaction lie within ``horizon`` of
each other. State holds the transactions of ``horizon`` plus ``delay``, not all that were ever seen.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.operators import cleanse, rollup
from txflow.schemas import MONEY, RAW_TRANSACTIONS, conform
from txflow.sources import storage
from txflow.sources.winners import ROW_ORDER

DELTAS = "customer_id string, transaction_date date, delta_total decimal(18,2), delta_count bigint"


@dataclass(frozen=True)
class StreamConfig:
    """Folders of a stream, how late a row may be, and how far apart copies of a transaction may lie."""

    source: str
    root: str
    delay: str = "2 days"
    horizon: str = "7 days"
    files_per_batch: int | None = None

    def below(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def _mark(spark: SparkSession, config: StreamConfig, epoch: int) -> str | None:
    """The latest time admitted before a batch, as text of the session zone; batches without rows repeat it."""
    if epoch == 0:
        return None
    return json.loads(storage.read_text(spark, config.below(f"marks/{epoch - 1:012d}")))["latest"]


def admit(spark: SparkSession, config: StreamConfig) -> None:
    """Sort everything that arrived into ``admitted`` and ``quarantine``; a repeated batch writes the same rows again."""

    def apply(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        rows = conform(batch, RAW_TRANSACTIONS).withColumn("epoch", F.lit(epoch))
        latest = _mark(session, config, epoch)
        at = F.col("timestamp")
        late = F.lit(False) if latest is None else at < F.lit(latest).cast("timestamp") - F.expr(f"interval {config.delay}")
        reason = F.when(~cleanse.has_keys(), _missing_key()).when(late, "beyond_watermark")
        judged = rows.withColumn("reject_reason", reason).persist()
        try:
            for name, part in (
                ("quarantine", judged.filter("reject_reason is not null")),
                ("admitted", judged.filter("reject_reason is null").drop("reject_reason")),
            ):
                writer = part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                writer.partitionBy("epoch").parquet(config.below(name))
            newest = judged.filter("reject_reason is null").agg(F.max("timestamp").cast("string")).first()[0]
        finally:
            judged.unpersist()
        known = max((t for t in (latest, newest) if t is not None), default=None)
        path = config.below(f"marks/{epoch:012d}")
        storage.create_text(session, path, json.dumps({"latest": known}))

    reader = spark.readStream.schema(RAW_TRANSACTIONS)
    if config.files_per_batch:
        reader = reader.option("maxFilesPerTrigger", config.files_per_batch)
    stream = reader.parquet(config.source).writeStream.foreachBatch(apply)
    _drain(stream.option("checkpointLocation", config.below("checkpoints/admit")))


def _missing_key():
    """Which key a row lacks."""
    return (
        F.when(F.col("transaction_id").isNull(), "null_transaction_id")
        .when(F.col("customer_id").isNull(), "null_customer_id")
        .otherwise("null_timestamp")
    )


def _drain(stream) -> None:
    stream.trigger(availableNow=True).start().awaitTermination()


def survivors(rows: DataFrame, config: StreamConfig) -> DataFrame:
    """The earliest copy of each transaction, once its session has ended; ``closed`` is the end of the session."""
    timed = rows.withWatermark("timestamp", config.delay)
    session = F.session_window("timestamp", config.horizon)
    least = timed.groupBy("transaction_id", session).agg(F.min(F.struct(*ROW_ORDER)).alias("_row"))
    # Rows that only tell the time have no customer. A filter on the id would be pushed below the watermark and hide them.
    least = least.filter("_row.customer_id is not null")
    return least.select(
        "transaction_id", *[F.col(f"_row.{c}").alias(c) for c in ROW_ORDER], F.window_time("session_window").alias("closed")
    )


def deltas(rows: DataFrame, config: StreamConfig) -> DataFrame:
    """What transactions whose sessions ended on one day add to the totals of customers and days."""
    valid = cleanse.with_transaction_date(cleanse.valid_rows(survivors(rows, config)))
    return (
        valid.groupBy(F.window("closed", "1 day"), *rollup.TOTAL_KEYS)
        .agg(F.sum("amount").cast(MONEY).alias("delta_total"), F.count(F.lit(1)).alias("delta_count"))
        .select(*rollup.TOTAL_KEYS, "delta_total", "delta_count")
    )


def run_available(spark: SparkSession, config: StreamConfig, close_at: datetime | None = None) -> None:
    """Take in what has arrived since the last call, and add what is final to the totals.

    ``close_at`` says that nothing before that moment will come any more: it advances the watermark as a row of that
    time would, and so closes earlier sessions, but adds no row.
    """
    admit(spark, config)
    if close_at is not None:
        empty = {f.name: F.lit(None).cast(f.dataType) for f in RAW_TRANSACTIONS}
        beat = spark.range(1).select(*[c.alias(n) for n, c in (empty | {"timestamp": F.lit(close_at)}).items()])
        beat.write.mode("append").parquet(config.below("admitted/epoch=-1"))
    if not storage.exists(spark, config.below("admitted")):
        return
    # Whole epochs at a time: within one batch nothing is late, as admission left nothing that is late for its epoch.
    stream = spark.readStream.schema(RAW_TRANSACTIONS).parquet(config.below("admitted"))
    written = deltas(stream, config).writeStream.outputMode("append").format("parquet").partitionBy("transaction_date")
    _drain(written.option("path", config.below("deltas")).option("checkpointLocation", config.below("checkpoints/totals")))


def totals(spark: SparkSession, config: StreamConfig) -> DataFrame:
    """Daily totals of all transactions that are final."""
    if not storage.exists(spark, config.below("deltas")):
        held = spark.createDataFrame([], DELTAS)
    else:
        held = spark.read.schema(DELTAS).parquet(config.below("deltas"))
    return held.groupBy(*rollup.TOTAL_KEYS).agg(
        F.sum("delta_total").cast(MONEY).alias("daily_total"), F.sum("delta_count").alias("transaction_count")
    )


def quarantined(spark: SparkSession, config: StreamConfig) -> DataFrame:
    """Rows that were not admitted, with the reason and the batch in which they came."""
    schema = "transaction_id string, customer_id string, amount decimal(18,2), timestamp timestamp, merchant string"
    if not storage.exists(spark, config.below("quarantine")):
        return spark.createDataFrame([], f"{schema}, reject_reason string, epoch int")
    return spark.read.schema(f"{schema}, reject_reason string, epoch int").parquet(config.below("quarantine"))
