"""Audits that merge: small summaries of each day's rows, stored once and put together for any period."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from txflow.operators.cleanse import is_positive
from txflow.schemas import MONEY

COUNTERS = ("total_rows", "positive_rows", "zero_rows", "negative_rows", "missing_rows")


@dataclass(frozen=True)
class Precision:
    """Sizes of the sketches, which set their errors and not what rows they cover.

    Distinct ids are off by about 1.04 / sqrt(2^ids) (0.8 % at 14), one standard deviation. A rank of a quantile is off by
    less than 2.3 / amounts^0.97 (0.7 % at 400) with a probability of 99 %. Frequent items are counted exactly while there
    are fewer than three quarters of ``items``.
    """

    ids: int = 14
    amounts: int = 400
    items: int = 10_000


def day_sketches(rows: DataFrame, item: str = "customer_id", precision: Precision = Precision()) -> DataFrame:
    """One row for each day: exact counters, and sketches of distinct ids, of amounts and of frequent values of ``item``.

    Rows without a time have the day NULL. NULL ids and items are in no sketch; a NULL amount, or one that is no finite
    number, counts as missing. No rows give no days. Sketches are merged inside the map tasks, so a day that holds a
    third of all rows is as cheap as any other. Counters do not depend on the order of rows and merges; estimates may, within
    their errors.
    """
    amount = F.col("amount").try_cast(MONEY)
    cents = (amount * 100).cast("bigint")
    return rows.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(is_positive(rows) & amount.isNotNull()).alias("positive_rows"),
        F.count_if(amount == 0).alias("zero_rows"),
        F.count_if(amount < 0).alias("negative_rows"),
        F.count_if(amount.isNull()).alias("missing_rows"),
        F.hll_sketch_agg(F.col("transaction_id").cast("string"), precision.ids).alias("ids"),
        F.kll_sketch_agg_bigint(cents, precision.amounts).alias("amounts"),
        F.expr(f"approx_top_k_accumulate(cast(`{item}` as string), {precision.items})").alias("items"),
    )


def merge_sketches(days: DataFrame, *by: Column, precision: Precision = Precision()) -> DataFrame:
    """The summaries of all rows, or of each group ``by``, as one summary of the same columns; merging repeats freely.

    No days give no row. Without groups the rows are grouped by a constant, because the sketch of frequent items can't be
    sent from a task that saw no rows.
    """
    merged = days.groupBy(*(by or [F.lit(1).alias("_all")])).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTERS],
        F.hll_union_agg("ids").alias("ids"),
        F.kll_merge_agg_bigint("amounts").alias("amounts"),
        F.expr(f"approx_top_k_combine(items, {precision.items})").alias("items"),
    )
    return merged if by else merged.drop("_all")


def sketched_profile(merged: DataFrame, quantiles: dict[str, float] | None = None, top: int = 5) -> DataFrame:
    """Summaries read out: counters, estimated distinct ids and repeated rows, quantiles and the ``top`` frequent items.

    Quantiles of no amounts at all are NULL. Estimates of distinct ids never exceed the rows.
    """
    some = F.col("total_rows") > F.col("missing_rows")
    ids = F.least(F.hll_sketch_estimate("ids"), "total_rows")
    at = {"median_amount": 0.5, "p99_amount": 0.99} if quantiles is None else quantiles
    places = [
        (F.when(some, F.kll_sketch_get_quantile_bigint("amounts", F.lit(q))).cast("decimal(20,0)") / 100).cast(MONEY).alias(name)
        for name, q in at.items()
    ]
    kept = [c for c in merged.columns if c not in ("ids", "amounts", "items")]
    frequent = F.expr(f"approx_top_k_estimate(items, {top})").alias("frequent")
    return merged.select(*kept, ids.alias("distinct_ids"), (F.col("total_rows") - ids).alias("duplicate_rows"), *places, frequent)


class SketchStore:
    """Day summaries by batch below one folder: a batch adds a folder of its own, and no stored row is read for it."""

    def __init__(self, spark: SparkSession, path: str, item: str = "customer_id", precision: Precision = Precision()):
        self.spark, self.path, self.item, self.precision = spark, path, item, precision

    def add(self, batch_id: str, rows: DataFrame) -> None:
        """Summarise the rows of a batch; a batch that is repeated takes the place of what it wrote before."""
        if not batch_id or set(batch_id) & set("/\\=") or batch_id.startswith((".", "_")):
            raise ValueError(f"not a name for a batch: {batch_id!r}")
        days = day_sketches(rows, self.item, self.precision)
        days.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def days(self, since: date | None = None, until: date | None = None) -> DataFrame:
        """Stored summaries of days from ``since`` to ``until``, both included; without limits also those of no day."""
        try:
            stored = self.spark.read.option("basePath", self.path).parquet(self.path).drop("batch")
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            raise ValueError(f"no summaries in {self.path}") from None
        if since is not None:
            stored = stored.where(F.col("day") >= F.lit(since))
        return stored if until is None else stored.where(F.col("day") <= F.lit(until))

    def profile(self, since: date | None = None, until: date | None = None, quantiles: dict[str, float] | None = None) -> DataFrame:
        """One row for the whole period, from the summaries alone; none for a period without rows."""
        return sketched_profile(merge_sketches(self.days(since, until), precision=self.precision), quantiles)
