"""Quality gates, audits, reconciliation and the run report."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.functions import columns as fx
from txflow.operators.cleanse import is_positive

log = logging.getLogger("txflow")

RUN_REPORT = (
    "run_id string, finished_at timestamp, source_rows bigint, quarantined_rows bigint, deduplicated_rows bigint, "
    "valid_rows bigint, batch_keys bigint, table_rows bigint, table_version bigint, status string"
)


class QualityGateError(RuntimeError):
    """A gate with severity ``error`` did not pass."""


@dataclass(frozen=True)
class GateResult:
    name: str
    rows: int
    minimum: int

    @property
    def status(self) -> str:
        return "pass" if self.rows >= self.minimum else "fail"


def gate_min_rows(name: str, rows: int, minimum: int, severity: str = "error") -> GateResult:
    """Compare a row count with its minimum; a failure raises, or is logged with severity ``warn``."""
    if severity not in ("error", "warn"):
        raise ValueError("severity must be 'error' or 'warn'")
    result = GateResult(name, rows, minimum)
    if result.status == "fail":
        message = f"gate {name}: {rows} rows, at least {minimum} expected"
        if severity == "error":
            raise QualityGateError(message)
        log.warning(message)
    return result


def gate_status(df: DataFrame, minimum: int) -> DataFrame:
    """The gate as a one-row frame: row count, minimum, pass or fail."""
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(
        "row_count",
        F.lit(minimum).cast("bigint").alias("minimum"),
        F.when(F.col("row_count") >= minimum, "pass").otherwise("fail").alias("status"),
    )


def reconcile(batch: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the batch the table lacks or holds with other values; both sides have unique keys.

    Rows of the table outside the batch are legitimate, so the join starts from the batch.
    """
    keys = list(keys)
    values = [c for c in batch.columns if c not in keys]
    stored = table.select(*keys, F.struct(*values).alias("_stored"))
    joined = batch.select(*keys, F.struct(*values).alias("_loaded")).join(stored, keys, "left")
    missing = F.col("_stored").isNull()
    return joined.agg(
        F.count(F.lit(1)).alias("batch_rows"),
        F.count_if(missing).alias("missing_keys"),
        F.count_if(~missing & ~F.col("_stored").eqNullSafe(F.col("_loaded"))).alias("differing_values"),
    )


def assert_reconciled(batch: DataFrame, table: DataFrame, keys: Sequence[str]) -> int:
    """Raise unless every row of the batch is stored as loaded; returns the batch's row count."""
    result = reconcile(batch, table, keys).first()
    if result["missing_keys"] or result["differing_values"]:
        raise QualityGateError(
            f"load incomplete: {result['missing_keys']} keys missing, "
            f"{result['differing_values']} differ, of {result['batch_rows']}"
        )
    return result["batch_rows"]


def profile_amounts(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """One row of counts: total, distinct ids, positive, zero, negative, missing and future rows.

    Ids are pre-aggregated with their counters, so the exact distinct count needs no second pass.
    """
    amount = F.col("amount")
    future = F.lit(False) if as_of is None else F.col("timestamp") > fx.instant(as_of)
    per_id = df.groupBy("transaction_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(is_positive(df)).alias("positive"),
        F.count_if(amount == 0).alias("zero"),
        F.count_if(amount < 0).alias("negative"),
        F.count_if(amount.isNull()).alias("missing"),
        F.count_if(future).alias("future"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return per_id.agg(
        total("n").alias("total_rows"),
        F.count("transaction_id").alias("distinct_ids"),
        total(F.when(F.col("transaction_id").isNotNull(), F.col("n") - 1)).alias("duplicate_rows"),
        total("positive").alias("positive_rows"),
        total("zero").alias("zero_rows"),
        total("negative").alias("negative_rows"),
        total("missing").alias("missing_rows"),
        total("future").alias("future_rows"),
    )


def range_violations(df: DataFrame, as_of: datetime) -> DataFrame:
    """Rows of a cleansed frame that break a stated invariant: amount above 0, no future time."""
    return df.filter(~F.coalesce(is_positive(df), F.lit(False)) | (F.col("timestamp") > fx.instant(as_of)))


def run_report(spark: SparkSession, **fields: object) -> DataFrame:
    """One row that sums up a run."""
    names = [part.split()[0] for part in RUN_REPORT.split(", ")]
    return spark.createDataFrame([tuple(fields.get(n) for n in names)], RUN_REPORT)


def log_sample(df: DataFrame, n: int, order_by: Sequence[str]) -> None:
    """Log the schema and the first rows of a stated order."""
    log.info("schema %s", df.schema.simpleString())
    for row in df.orderBy(*order_by).limit(n).collect():
        log.info("  %s", row)
