"""The incremental run fed by a folder of arriving files.

Structured Streaming keeps the list of files already read in its checkpoint; each
micro-batch is one incremental run under its own batch id, so a batch repeated after a
failure is applied once. Late rows need no watermark: all state is in the tables.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from txflow.config import FlowConfig
from txflow.plans.run import run_incremental
from txflow.schemas import RAW_TRANSACTIONS
from txflow.sources import storage


def run_available(
    spark: SparkSession,
    config: FlowConfig,
    checkpoint: str,
    schema: T.StructType = RAW_TRANSACTIONS,
    files_per_batch: int | None = None,
) -> None:
    """Process every Parquet file that arrived in ``config.source`` since the last call, then return."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def apply(batch: DataFrame, epoch: int) -> None:
        # The id in the checkpoint keeps batches of another checkpoint apart, which count from 0 again.
        feed = json.loads(storage.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]
        run_incremental(batch.sparkSession, batch, config, batch_id=f"feed-{feed}-{epoch}")

    query = (
        reader.parquet(config.source)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
