"""Command line: ``spark-submit`` or ``python -m txflow <command>``; see ``--help``."""

from __future__ import annotations

import argparse
import logging
import os
from dataclasses import replace
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.config import FlowConfig
from txflow.operators.sketches import SketchStore
from txflow.plans.run import run_daily, run_incremental
from txflow.sources.files import write_sample_csv
from txflow.sources.generate import generate_daily_totals, generate_transactions, inject_issues
from txflow.sources.keyed import KeyedTable
from txflow.sources.versioned import VersionedTable, raw_layout
from txflow.streaming.feed import run_available


def _print(df: DataFrame) -> None:
    """All rows, one JSON object a line, a partition at a time."""
    for line in df.toJSON().toLocalIterator():
        print(line)


def generate(spark: SparkSession, args: argparse.Namespace) -> None:
    """Write dirty transactions as a new version of a table, and optionally a CSV sample."""
    clean = generate_transactions(spark, args.rows, args.as_of, seed=args.seed, customers=args.customers)
    table = VersionedTable(spark, args.table, raw_layout(), sort_by=["transaction_id"])
    table.overwrite(inject_issues(clean, args.rows, args.as_of, seed=args.seed))
    _print(table.history().select("version", "timestamp", "operation", "operationMetrics").limit(1))
    if args.sample_csv:
        write_sample_csv(table.read(), args.sample_csv)


def _config(args: argparse.Namespace) -> FlowConfig:
    """The options given, on top of the environment where it names a source and a target."""
    given = {k: v for k, v in vars(args).items() if k in FlowConfig.__dataclass_fields__ and v is not None}
    environment = {f"TXFLOW_{k.upper()}": v for k, v in given.items() if k in ("source", "target")}
    return replace(FlowConfig.from_env(os.environ | environment), **given)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    """Full run: source to daily totals, with gates and report."""
    _print(run_daily(spark, _config(args)))


def incremental(spark: SparkSession, args: argparse.Namespace) -> None:
    """Incremental run over one folder of newly arrived rows."""
    config = _config(args)
    _print(run_incremental(spark, spark.read.parquet(config.source), config, args.batch_id))


def feed(spark: SparkSession, args: argparse.Namespace) -> None:
    """Incremental runs over all files that arrived since the last call."""
    run_available(spark, _config(args), args.checkpoint)


def history(spark: SparkSession, args: argparse.Namespace) -> None:
    """All versions of a table, newest first."""
    _print(VersionedTable(spark, args.table).history())


def update(spark: SparkSession, args: argparse.Namespace) -> None:
    """Set columns of the rows that meet a condition; assignments are column=expression."""
    parts = [x.split("=", 1) for x in args.assign]
    VersionedTable(spark, args.table).update(F.expr(args.where), {c.strip(): F.expr(e) for c, e in parts})


def delete(spark: SparkSession, args: argparse.Namespace) -> None:
    """Drop the rows that meet a condition."""
    VersionedTable(spark, args.table).delete(F.expr(args.where))


def merge(spark: SparkSession, args: argparse.Namespace) -> None:
    """Update and insert by key from a Parquet folder."""
    VersionedTable(spark, args.table).merge(spark.read.parquet(args.source), args.keys.split(","))


def vacuum(spark: SparkSession, args: argparse.Namespace) -> None:
    """List the data folders that no recent version uses; --apply removes them."""
    _print(VersionedTable(spark, args.table).vacuum(args.hours, dry_run=not args.apply))


def sample_totals(spark: SparkSession, args: argparse.Namespace) -> None:
    """Load generated daily totals into the keyed table."""
    table = KeyedTable.daily_totals(spark, args.target)
    table.upsert(generate_daily_totals(spark, args.as_of.date(), customers=args.customers, days=args.days))
    print(f"{table.count()} rows")
    _print(table.sample(10))


def lookup(spark: SparkSession, args: argparse.Namespace) -> None:
    """All totals of one customer in the range of dates asked for, newest first."""
    table = KeyedTable.daily_totals(spark, args.target)
    _print(table.lookup(args.customer, args.since, args.until, newest_first=True))


def audit(spark: SparkSession, args: argparse.Namespace) -> None:
    """Summarise a Parquet folder of transactions by day, as one batch of an audit store."""
    SketchStore(spark, args.store).add(args.batch_id, spark.read.parquet(args.source))


def audit_period(spark: SparkSession, args: argparse.Namespace) -> None:
    """Counts, distinct ids, quantiles and frequent customers of a period, from an audit store alone."""
    _print(SketchStore(spark, args.store).profile(args.since, args.until))


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="txflow")
    commands = parser.add_subparsers(required=True)

    def command(function, *required: str) -> argparse.ArgumentParser:
        name = function.__name__.replace("_", "-")
        sub = commands.add_parser(name, help=(function.__doc__ or "").strip())
        sub.set_defaults(function=function)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    def moment(text: str) -> datetime:
        return datetime.fromisoformat(text)

    now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    c = command(generate, "table")
    c.add_argument("--rows", type=int, default=1200)
    c.add_argument("--customers", type=int, default=80)
    c.add_argument("--seed", type=int, default=42)
    c.add_argument("--as-of", type=moment, default=now)
    c.add_argument("--sample-csv")
    for function, required in ((run, ()), (incremental, ("batch-id",)), (feed, ("checkpoint",))):
        c = command(function, *required)
        for option in ("source", "target", "survivors", "quarantine"):
            c.add_argument(f"--{option}")
        c.add_argument("--min-rows", type=int, dest="min_result_rows")
        c.add_argument("--min-source-rows", type=int)
        c.add_argument("--validate-first", action="store_true", default=None)
    command(history, "table")
    c = command(update, "table", "where")
    c.add_argument("assign", nargs="+")
    command(delete, "table", "where")
    command(merge, "table", "source", "keys")
    c = command(vacuum, "table")
    c.add_argument("--hours", type=float, default=168)
    c.add_argument("--apply", action="store_true")
    c = command(sample_totals, "target")
    c.add_argument("--customers", type=int, default=1000)
    c.add_argument("--days", type=int, default=7)
    c.add_argument("--as-of", type=moment, default=now)
    command(audit, "store", "source", "batch-id")
    for c in (command(lookup, "target", "customer"), command(audit_period, "store")):
        c.add_argument("--since", type=date.fromisoformat)
        c.add_argument("--until", type=date.fromisoformat)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    spark = SparkSession.builder.appName("txflow").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    args.function(spark, args)


if __name__ == "__main__":
    main()
