"""Times the headline queries on one local session and prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from tempfile import TemporaryDirectory

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow import FlowConfig
from txflow.functions.columns import scaled
from txflow.operators.cleanse import with_transaction_date
from txflow.operators.rollup import daily_totals_float
from txflow.plans import catalog
from txflow.plans.daily import rollup_with_counts, stage_counts, totals_of, transform
from txflow.plans.fixtures import copies, dirty_tx, originals
from txflow.plans.run import run_incremental
from txflow.sources.keyed import KeyedTable
from txflow.sources.storage import fresh_dir, staged
from txflow.sources.versioned import VersionedTable, raw_layout

# Pure plans: the query is built outside the clock and its rows are drained inside.
HEADLINE = [
    "transform_daily_totals",
    "stage_counts",
    "dedup_first_by_time",
    "dedup_lineitem_orderkey",
    "daily_totals_float",
    "daily_totals_orders",
    "top_daily_totals",
    "audit_amount_profile",
    "merge_change_counts",
]


RUNS = 3


def best_of(prepare) -> float:
    seconds = []
    for _ in range(RUNS):
        action = prepare()
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    return round(min(seconds), 3)


def drained(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _totals(spark: SparkSession, rows: DataFrame) -> KeyedTable:
    table = KeyedTable.daily_totals(spark, fresh_dir(spark, "bench"))
    table.upsert(transform(rows))
    return table


def _raw(spark: SparkSession, sf_dir: str) -> VersionedTable:
    table = VersionedTable(spark, fresh_dir(spark, "bench"), raw_layout(), sort_by=["transaction_id"])
    table.overwrite(dirty_tx(spark, sf_dir))
    return table


def upsert_daily_totals(spark: SparkSession, sf_dir: str):
    table, batch = _totals(spark, originals(spark, sf_dir)), transform(copies(spark, sf_dir))
    return lambda: table.upsert(batch)


def serve_latest_n_per_customer(spark: SparkSession, sf_dir: str):
    table = _totals(spark, dirty_tx(spark, sf_dir))
    return lambda: drained(table.latest_per_customer(3))


def serve_customer_lookup(spark: SparkSession, sf_dir: str):
    table = _totals(spark, dirty_tx(spark, sf_dir))
    return lambda: drained(table.lookup("C00001"))


def versioned_update(spark: SparkSession, sf_dir: str):
    table = _raw(spark, sf_dir)
    return lambda: table.update(F.col("customer_id") == "C00001", {"amount": scaled(F.col("amount"))})


def versioned_merge_upsert(spark: SparkSession, sf_dir: str):
    table, source = _raw(spark, sf_dir), copies(spark, sf_dir)
    return lambda: table.merge(source, ["transaction_id"])


def incremental_batch(spark: SparkSession, sf_dir: str):
    """The late batch of the query ``incremental_equals_full``, on tables that hold the early one."""
    root, late = fresh_dir(spark, "bench"), F.col("merchant") == "purchase"
    config = FlowConfig(source="", target=f"{root}/totals", survivors=f"{root}/survivors", min_result_rows=1)
    run_incremental(spark, originals(spark, sf_dir).filter(~late).unionByName(copies(spark, sf_dir)), config, "first")
    return lambda: run_incremental(spark, originals(spark, sf_dir).filter(late), config, "second")


# Operators on tables: each prepares its table outside the clock and returns what is timed.
ON_TABLES = [
    upsert_daily_totals,
    serve_latest_n_per_customer,
    serve_customer_lookup,
    versioned_update,
    versioned_merge_upsert,
    incremental_batch,
]


def stepwise(spark: SparkSession, sf_dir: str) -> None:
    """The same run as a chain of counted steps, for comparison: native dedup, float sums, a sorted result."""
    raw = dirty_tx(spark, sf_dir)
    deduplicated = raw.dropDuplicates(["transaction_id"])
    valid = deduplicated.filter("amount > 0")
    totals = daily_totals_float(with_transaction_date(valid)).orderBy("customer_id", "transaction_date")
    for step in (raw, deduplicated, valid, totals):
        step.count()
    totals.write.format("noop").mode("overwrite").save()


def one_pass(spark: SparkSession, sf_dir: str) -> None:
    """All stage counts and the totals from one staged result."""
    with staged(rollup_with_counts(dirty_tx(spark, sf_dir)), "bench") as stage:
        stage_counts(stage.rows).collect()
        totals_of(stage.rows).write.format("noop").mode("overwrite").save()


def main() -> None:
    with TemporaryDirectory(prefix="bench-") as shared:
        print(json.dumps(measured(shared)))


def measured(shared: str) -> dict:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("txflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", shared)
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    queries["count_rows"](spark, sf_dir).collect()
    seconds = {
        name: best_of(lambda q=queries[name]: (lambda df: lambda: drained(df))(q(spark, sf_dir))) for name in HEADLINE
    }
    seconds |= {f.__name__: best_of(lambda f=f: f(spark, sf_dir)) for f in ON_TABLES}
    comparison = {f.__name__: best_of(lambda f=f: lambda: f(spark, sf_dir)) for f in (stepwise, one_pass)}
    spark.stop()
    return {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "comparison": comparison,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }


if __name__ == "__main__":
    main()
