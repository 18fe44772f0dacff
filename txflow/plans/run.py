"""Runs: the full daily run, and the incremental run that reads only what arrived."""

from __future__ import annotations

import logging
import re
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.config import FlowConfig
from txflow.operators import cleanse, quality, rollup
from txflow.plans import daily
from txflow.schemas import MONEY, RAW_TRANSACTIONS, assert_schema, conform
from txflow.sources import storage
from txflow.sources.files import require_source
from txflow.sources.keyed import KeyedTable
from txflow.sources.versioned import VersionedTable
from txflow.sources.winners import ROW_ORDER, SurvivorStore

log = logging.getLogger("txflow")

UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "Etc/UCT", "UCT", "Zulu", "Universal")


def check_session(spark: SparkSession) -> None:
    """Days are cut in the session time zone, so it must be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone is {zone}; set it to UTC")


def read_source(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Raw transactions in the canonical schema, from a versioned table or a plain Parquet folder."""
    require_source(spark, path)
    table = VersionedTable(spark, path)
    df = table.read(version) if table.exists() else spark.read.parquet(path)
    return conform(df, RAW_TRANSACTIONS)


def quarantined(raw: DataFrame, *, validate_first: bool = False) -> DataFrame:
    """Rows the daily run leaves out, with a reason: rows without keys, and transactions without a valid survivor.

    Such a transaction is listed with its earliest copy. With ``validate_first`` a later valid copy is the survivor,
    so only transactions without any valid copy are listed.
    """
    usable = cleanse.has_keys()
    keyless = cleanse.rejects(raw.filter(~usable))
    valid = F.coalesce(cleanse.is_positive(raw), F.lit(False))
    firsts = raw.filter(usable).groupBy("transaction_id").agg(
        F.min(F.struct(*ROW_ORDER)).alias("_row"), F.bool_or(valid).alias("_any_valid")
    )
    if validate_first:
        firsts = firsts.filter(~F.col("_any_valid"))
    survivors = firsts.select(*[F.col(c) if c == "transaction_id" else F.col(f"_row.{c}").alias(c) for c in raw.columns])
    return keyless.unionByName(cleanse.rejects(survivors))


def run_daily(spark: SparkSession, config: FlowConfig, run_id: str | None = None) -> DataFrame:
    """Extract, transform, load and verify; returns the one-row run report or raises.

    The source is read once: totals and stage counts come from the same staged result.
    Days absent from the source keep their stored totals, as an upsert never deletes.
    """
    check_session(spark)
    run_id = run_id or uuid.uuid4().hex
    raw = read_source(spark, config.source)
    table = KeyedTable.daily_totals(spark, config.target)
    counted = daily.rollup_with_counts(raw, validate_first=config.validate_first)
    with storage.staged(counted, "daily-run") as stage:
        counts = daily.stage_counts(stage.rows).first()
        log.info("run %s: %s", run_id, counts.asDict())
        quality.gate_min_rows("source not empty", counts["raw_rows"], config.min_source_rows)
        quality.gate_min_rows("result not empty", counts["aggregated_rows"], 1)
        quality.gate_min_rows("enough results", counts["aggregated_rows"], config.min_result_rows, "warn")
        batch = assert_schema(daily.totals_of(stage.rows), table.schema)
        if log.isEnabledFor(logging.INFO):
            quality.log_sample(batch, 10, table.keys)
        version = table.upsert(batch, stored_at=stage.path, unique=True)
        loaded = quality.assert_reconciled(batch, table.read_touching(batch), table.keys)
    if config.quarantine:
        left_out = quarantined(raw, validate_first=config.validate_first)
        left_out.write.mode("errorifexists").parquet(f"{config.quarantine}/run={run_id}")
    return _report(spark, run_id, table, version, counts, loaded, config.min_result_rows)


def _report(spark, run_id, table, version, counts, loaded, minimum, severity: str = "error") -> DataFrame:
    rows = table.count()
    gate = quality.gate_min_rows("table has enough rows", rows, minimum, severity)
    return quality.run_report(
        spark,
        run_id=run_id,
        finished_at=datetime.now(timezone.utc),
        source_rows=counts["raw_rows"],
        quarantined_rows=counts["quarantined_rows"],
        deduplicated_rows=counts["deduplicated_rows"],
        valid_rows=counts["valid_rows"],
        batch_keys=loaded,
        table_rows=rows,
        table_version=version,
        status=gate.status,
    )


# -- incremental run -----------------------------------------------------------


def survivor_table(spark: SparkSession, root: str) -> SurvivorStore:
    """The surviving copy of every transaction seen so far."""
    return SurvivorStore(spark, root)


def changed_survivors(known: DataFrame, arrived: DataFrame) -> DataFrame:
    """Transactions whose survivor is new or moves to an earlier copy, with the row that gives way.

    ``known`` and ``arrived`` hold each id once.
    """
    row = F.struct(*ROW_ORDER)
    old = known.select("transaction_id", row.alias("_old"))
    joined = arrived.select("transaction_id", row.alias("_new")).join(old, ["transaction_id"], "left")
    wins = F.col("_old").isNull() | (F.col("_new") < F.col("_old"))
    return joined.filter(wins).select(
        "transaction_id",
        *[F.col(f"_new.{c}").alias(c) for c in ROW_ORDER],
        *[F.col(f"_old.{c}").alias(f"old_{c}") for c in ("customer_id", "amount", "timestamp")],
    )


def total_changes(changes: DataFrame) -> DataFrame:
    """What the changed survivors add to and take from each daily total; exact, as amounts are decimals."""
    added = changes.select("customer_id", "timestamp", "amount", F.lit(1).alias("sign"))
    taken = changes.filter("old_timestamp is not null").select(
        F.col("old_customer_id").alias("customer_id"),
        F.col("old_timestamp").alias("timestamp"),
        F.col("old_amount").alias("amount"),
        F.lit(-1).alias("sign"),
    )
    moved = cleanse.with_transaction_date(cleanse.valid_rows(added.unionByName(taken)))
    return (
        moved.groupBy(*rollup.TOTAL_KEYS)
        .agg(F.sum(F.col("amount") * F.col("sign")).cast(MONEY).alias("delta_total"), F.sum("sign").alias("delta_count"))
        .filter("delta_total <> 0 or delta_count <> 0")
    )


def run_incremental(spark: SparkSession, arrived: DataFrame, config: FlowConfig, batch_id: str) -> DataFrame:
    """Bring survivors and daily totals up to date with newly arrived rows; equals a full run over all rows.

    A late copy that is earlier than the known survivor takes its amount from one day and adds it to another; keys left
    without transactions are deleted. Only the buckets of the arrived ids are read, and no stored survivor is rewritten
    (:class:`SurvivorStore`). What a batch changes is staged from the state before it and then applied in steps that may
    each be repeated, so an interrupted run continues from its stage, and a batch that was applied already changes
    nothing. A batch that was staged and not finished is finished before any other begins, so no result is applied to a
    state it does not belong to.

    ``config.validate_first`` lets invalid copies take no part, and must be the same for all
    batches of a pair of tables. Rows that the batch itself leaves out go to
    ``config.quarantine`` before anything is applied. Row-count gates warn: a batch is small
    by nature, and one that raised after being applied could never be followed by another.
    """
    check_session(spark)
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch_id):
        raise ValueError("a batch id is made of letters, digits, dots, dashes and underscores")
    if not config.survivors:
        raise ValueError("an incremental run needs config.survivors")
    for name, _, _ in sorted(storage.children(spark, f"{config.survivors.rstrip('/')}/_stage")):
        if name != batch_id and storage.exists(spark, f"{_stage_of(config, name)}/READY"):
            log.info("finishing batch %s before %s", name, batch_id)
            apply_batch(spark, config, name)
    counts, loaded = dict.fromkeys(("raw_rows", "quarantined_rows", "deduplicated_rows", "valid_rows"), 0), 0
    if not survivor_table(spark, config.survivors).is_done(batch_id):
        stage_batch(spark, arrived, config, batch_id)
        counts, loaded = apply_batch(spark, config, batch_id)
    totals = KeyedTable.daily_totals(spark, config.target)
    return _report(spark, batch_id, totals, totals.table.version(), counts, loaded, config.min_result_rows, severity="warn")


def _stage_of(config: FlowConfig, batch_id: str) -> str:
    return f"{config.survivors.rstrip('/')}/_stage/{batch_id}"


def stage_batch(spark: SparkSession, arrived: DataFrame, config: FlowConfig, batch_id: str) -> None:
    """Work out what a batch changes and store it, without applying anything; READY is written last."""
    stage = _stage_of(config, batch_id)
    if storage.exists(spark, f"{stage}/READY"):
        return
    storage.delete(spark, stage)
    rows = conform(arrived, RAW_TRANSACTIONS)
    if config.quarantine:
        left_out = quarantined(rows, validate_first=config.validate_first)
        left_out.write.mode("overwrite").parquet(f"{config.quarantine}/run={batch_id}")
    _stage_firsts(spark, rows, stage, config.validate_first)
    usable = spark.read.parquet(f"{stage}/firsts").filter(cleanse.has_keys()).select(*RAW_TRANSACTIONS.names)
    known = survivor_table(spark, config.survivors).known(usable, batch_id)
    changed_survivors(known, usable).write.parquet(f"{stage}/changes")
    storage.create_text(spark, f"{stage}/READY", "")


def apply_batch(spark: SparkSession, config: FlowConfig, batch_id: str) -> tuple[dict[str, int], int]:
    """Apply a staged batch; every step replaces what an earlier attempt at it may have left.

    Survivors and differences are added to the store; the totals of the changed keys are then the sums of all
    differences of their days, so they come out the same however often that is done.
    """
    stage, store = _stage_of(config, batch_id), survivor_table(spark, config.survivors)
    totals = KeyedTable.daily_totals(spark, config.target)
    counts = _arrival_counts(spark.read.parquet(f"{stage}/firsts"))
    quality.gate_min_rows("source not empty", counts["raw_rows"], config.min_source_rows, "warn")
    changes = spark.read.parquet(f"{stage}/changes")
    store.append(changes, batch_id)
    store.append_deltas(total_changes(changes), batch_id)
    with storage.staged(store.totals_after(batch_id), "changed-totals") as changed:
        upserts = changed.rows.filter("transaction_count > 0")
        emptied = changed.rows.filter("transaction_count = 0")
        days = [f"transaction_date={day}" for day in store.changed_days(batch_id)]
        totals.upsert(upserts, deletes=emptied, stored_at=changed.path, unique=True, within=days)
        loaded = quality.assert_reconciled(upserts, totals.read_touching(within=days), totals.keys)
    store.finish(batch_id)
    storage.delete(spark, stage)
    return counts, loaded


def _stage_firsts(spark: SparkSession, arrived: DataFrame, stage: str, validate_first: bool) -> None:
    """The batch's own survivors, and how many rows of it each stands for."""
    usable = cleanse.has_keys()
    candidate = usable & F.coalesce(cleanse.is_positive(arrived), F.lit(False)) if validate_first else usable
    firsts = (
        arrived.groupBy("transaction_id")
        .agg(
            F.min(F.when(candidate, F.struct(*ROW_ORDER))).alias("_row"),
            F.count(F.lit(1)).alias("_raw"),
            F.count_if(~usable).alias("_quarantined"),
        )
        .select("transaction_id", *[F.col(f"_row.{c}").alias(c) for c in ROW_ORDER], "_raw", "_quarantined")
    )
    firsts.write.mode("errorifexists").parquet(f"{stage}/firsts")


def _arrival_counts(firsts: DataFrame) -> dict[str, int]:
    counted = firsts.agg(
        F.coalesce(F.sum("_raw"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum("_quarantined"), F.lit(0)).alias("quarantined_rows"),
        F.count_if(cleanse.has_keys()).alias("deduplicated_rows"),
        F.count_if(cleanse.has_keys() & cleanse.is_positive(firsts)).alias("valid_rows"),
    )
    return counted.first().asDict()
