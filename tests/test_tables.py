"""Versioned and keyed tables on disk."""

from datetime import date, datetime, timedelta, timezone
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from txflow.functions import columns as fx
from txflow.operators import dml
from txflow.operators.quality import QualityGateError
from txflow.plans.fixtures import copies, dirty_tx
from txflow.schemas import AUDIT_TRANSACTIONS
from txflow.sources import versioned
from txflow.sources.keyed import KeyedTable
from txflow.sources.versioned import (
    AmbiguousMergeError,
    ConcurrentCommitError,
    VersionedTable,
    VersionNotFoundError,
)

SF = "/root/testdata/sf0.001"
D = Decimal
BY_DAY = {"day": "to_date(timestamp)"}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def totals(spark, *rows):
    return spark.createDataFrame(
        [(c, d, D(str(t)), n) for c, d, t, n in rows],
        "customer_id string, transaction_date date, daily_total decimal(18,2), transaction_count bigint",
    )


# -- versioned -----------------------------------------------------------------


_cast_like = dml.cast_like


@pytest.mark.parametrize("partition_by", [None, BY_DAY])
@pytest.mark.parametrize("large_source", [False, True])
def test_walkthrough_equals_pure_functions(spark, root, monkeypatch, partition_by, large_source):
    if large_source:
        monkeypatch.setattr(dml, "cast_like", lambda df, target: _cast_like(df, target).hint("merge"))
    v0 = dirty_tx(spark, SF)
    hit = F.col("customer_id") == "C00001"
    raised = {"amount": fx.scaled(F.col("amount"))}
    source = copies(spark, SF).withColumn("merchant", F.lit("MERGED")).unionByName(
        copies(spark, SF).withColumn("transaction_id", F.concat(F.lit("N"), "transaction_id"))
    )
    v1 = dml.apply_update(v0, hit, raised)
    v2 = dml.apply_delete(v1, F.col("amount") < 0)
    v3 = dml.apply_merge(v2, source, ["transaction_id"])

    table = VersionedTable(spark, root, partition_by)
    assert [table.overwrite(v0), table.update(hit, raised), table.delete(F.col("amount") < 0)] == [0, 1, 2]
    assert table.merge(source, ["transaction_id"]) == 3
    for version, expected in enumerate([v0, v1, v2, v3]):
        assert rows_of(table.read(version)) == rows_of(expected)
    assert rows_of(VersionedTable(spark, root).read()) == rows_of(v3)

    history = table.history().collect()
    assert [(r.version, r.operation) for r in history] == [(3, "MERGE"), (2, "DELETE"), (1, "UPDATE"), (0, "WRITE")]
    merge, delete, update, write = [r.operationMetrics for r in history]
    assert write["numOutputRows"] == "1050"
    assert update["numUpdatedRows"] == str(v0.filter(hit).count())
    assert delete["numDeletedRows"] == str(v1.filter("amount < 0").count())
    assert merge["numTargetRowsUpdated"] == "100" and merge["numTargetRowsInserted"] == "50"


def test_partitioned_table_rewrites_only_touched_folders(spark, root):
    table = VersionedTable(spark, root, BY_DAY)
    table.overwrite(dirty_tx(spark, SF))
    first = set(table._commit_at(0).data_dirs)
    day = F.to_date("timestamp") == F.lit(date(2024, 1, 9))
    table.delete(day)
    kept = set(table._commit_at(1).data_dirs)
    assert kept < first and len(first - kept) == 1
    assert table.read().filter(day).isEmpty()
    table.delete(F.lit(False))
    assert set(table._commit_at(2).data_dirs) == kept
    assert table.diff(1, 2).isEmpty()
    assert table.diff(0, 1).agg(F.sum("copies")).first()[0] == table.read(0).filter(day).count()


def test_update_may_move_rows_to_another_partition(spark, root):
    table = VersionedTable(spark, root, BY_DAY)
    table.overwrite(dirty_tx(spark, SF))
    before = table.read().count()
    table.update(F.col("customer_id") == "C00001", {"timestamp": F.lit("2030-01-01 00:00:00")})
    assert table.read().count() == before
    moved = table.read().filter("timestamp = '2030-01-01 00:00:00'")
    assert moved.count() == table.read(0).filter("customer_id = 'C00001'").count()
    assert any("day=2030-01-01" in d for d in table._commit_at().data_dirs)


def test_overwrite_replaces_schema(spark, root):
    table = VersionedTable(spark, root)
    table.overwrite(spark.createDataFrame([(1,)], "a int"))
    table.overwrite(spark.createDataFrame([("x", 2.0)], "b string, c double"))
    assert table.read().columns == ["b", "c"] and table.read(0).columns == ["a"]


def test_merge_rejects_repeated_source_keys_but_not_nulls(spark, root):
    table = VersionedTable(spark, root)
    table.overwrite(spark.createDataFrame([("a", 1), (None, 2)], "k string, v int"))
    with pytest.raises(AmbiguousMergeError):
        table.merge(spark.createDataFrame([("a", 1), ("a", 1)], "k string, v int"), ["k"])
    table.merge(spark.createDataFrame([(None, 7.0), (None, 8.0), ("a", 9.0)], "k string, v double"), ["k"])
    assert rows_of(table.read()) == rows_of(
        spark.createDataFrame([("a", 9), (None, 2), (None, 7), (None, 8)], "k string, v int")
    )


def test_unfinished_write_is_invisible_and_second_writer_fails(spark, root):
    table = VersionedTable(spark, root)
    df = spark.createDataFrame([(1,)], "a int")
    table.overwrite(df)
    df.write.parquet(f"{root}/snapshot=00000001-dead")
    assert table.version() == 0 and table.read().count() == 1
    stale = VersionedTable(spark, root)
    stale._versions = lambda: [0]
    table.overwrite(df)
    with pytest.raises(ConcurrentCommitError):
        stale.overwrite(df)
    assert table.version() == 1


def test_missing_tables_and_versions(spark, root):
    table = VersionedTable(spark, root)
    with pytest.raises(FileNotFoundError):
        table.read()
    with pytest.raises(FileNotFoundError):
        table.history()
    table.overwrite(spark.createDataFrame([(1,)], "a int"))
    with pytest.raises(VersionNotFoundError):
        table.read(5)
    with pytest.raises(ValueError):
        VersionedTable(spark, root + "2", {"p": "b"}).overwrite(spark.createDataFrame([("x",)], "b string"))
    with pytest.raises(ValueError, match="own column"):
        VersionedTable(spark, root + "3", {"a": "a + 1"}).overwrite(spark.createDataFrame([(1,)], "a int"))


def test_vacuum(spark, root):
    table = VersionedTable(spark, root, BY_DAY)
    table.overwrite(dirty_tx(spark, SF))
    table.delete(F.to_date("timestamp") == F.lit(date(2024, 1, 9)))
    table.overwrite(table.read())
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{root}/snapshot=00000009-dead")
    later = datetime.now(timezone.utc) + timedelta(hours=169)
    assert table.vacuum(168).isEmpty()
    plan = table.vacuum(168, now=later)
    assert {r.reason for r in plan.collect()} == {"superseded", "unfinished"}
    assert table.read(0).count() == 1050
    latest = rows_of(table.read())
    table.vacuum(168, dry_run=False, now=later)
    assert table.vacuum(168, now=later).isEmpty()
    assert rows_of(table.read()) == latest
    with pytest.raises(VersionNotFoundError):
        table.read(0)
    assert table.history().count() == 3


def test_hot_partition_is_written_by_many_tasks(spark, root):
    """A day with almost all rows is split by size; no task has to write it whole."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        df = spark.range(200_000, numPartitions=8).select(
            "id",
            F.sha2(F.col("id").cast("string"), 256).alias("text"),
            F.when(F.col("id") % 10 > 0, F.lit(date(2024, 1, 1)))
            .otherwise(F.date_add(F.lit(date(2024, 1, 2)), (F.col("id") % 7).cast("int")))
            .alias("day"),
        )
        table = VersionedTable(spark, root, {"day": "day"}, sort_by=["id"])
        table.overwrite(df)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert table.read().count() == 200_000
    files = {d.name: len(list(d.glob("*.parquet"))) for d in Path(root).glob("snapshot=*/day=*")}
    assert files["day=2024-01-01"] >= 5


# -- keyed ---------------------------------------------------------------------

DAY1, DAY2, DAY3 = date(2026, 3, 1), date(2026, 3, 2), date(2026, 3, 3)


def test_upsert_and_serving_reads(spark, root):
    table = KeyedTable.daily_totals(spark, root)
    assert table.count() == 0
    table.upsert(totals(spark, ("C1", DAY1, 1, 1), ("C1", DAY2, 2, 1), ("C2", DAY1, 3, 1)))
    table.upsert(totals(spark, ("C1", DAY2, 9, 2), ("C1", DAY3, 4, 1)))
    assert rows_of(table.read()) == rows_of(
        totals(spark, ("C1", DAY1, 1, 1), ("C1", DAY2, 9, 2), ("C2", DAY1, 3, 1), ("C1", DAY3, 4, 1))
    )
    newest = table.lookup("C1", newest_first=True).collect()
    assert [r.transaction_date for r in newest] == [DAY3, DAY2, DAY1]
    assert [r.transaction_date for r in table.lookup("C1", since=DAY2, until=DAY2).collect()] == [DAY2]
    assert {(r.customer_id, r.transaction_date) for r in table.latest_per_customer(1).collect()} == {
        ("C1", DAY3),
        ("C2", DAY1),
    }
    assert table.count() == 4 and table.sample(2).count() == 2
    assert KeyedTable.daily_totals(spark, root).count() == 4


def test_upsert_touches_only_its_days_and_lookups_prune(spark, root):
    table = KeyedTable.daily_totals(spark, root)
    table.upsert(totals(spark, ("C1", DAY1, 1, 1), ("C1", DAY2, 2, 1)))
    before = set(table.table._commit_at().data_dirs)
    table.upsert(totals(spark, ("C2", DAY2, 2, 1)))
    after = set(table.table._commit_at().data_dirs)
    assert [d.split("/")[1] for d in before & after] == ["transaction_date=2026-03-01"]
    scan = table.lookup("C1", since=DAY2)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(customer_id,C1)" in scan and "PartitionFilters: [isnotnull(transaction_date" in scan


def test_upsert_checks_keys_and_collapses_with_a_sequence(spark, root):
    table = KeyedTable.daily_totals(spark, root)
    twice = totals(spark, ("C1", DAY1, 1, 1), ("C1", DAY1, 2, 5))
    with pytest.raises(QualityGateError):
        table.upsert(twice)
    with pytest.raises(QualityGateError):
        table.upsert(totals(spark, (None, DAY1, 1, 1)))
    table.upsert(twice, sequence=["transaction_count"])
    assert rows_of(table.read()) == rows_of(totals(spark, ("C1", DAY1, 2, 5)))


def test_upsert_deletes_and_tags(spark, root):
    table = KeyedTable.daily_totals(spark, root)
    table.upsert(totals(spark, ("C1", DAY1, 1, 1), ("C2", DAY1, 2, 1)), tag="a")
    gone = totals(spark, ("C1", DAY1, 0, 0))
    version = table.upsert(totals(spark, ("C3", DAY2, 5, 1)), deletes=gone, tag="b")
    assert table.upsert(totals(spark, ("C9", DAY2, 5, 1)), tag="a") == version
    assert rows_of(table.read()) == rows_of(totals(spark, ("C2", DAY1, 2, 1), ("C3", DAY2, 5, 1)))


def test_replace_dates(spark, root):
    table = KeyedTable.daily_totals(spark, root)
    table.upsert(totals(spark, ("C1", DAY1, 1, 1), ("C2", DAY1, 2, 1), ("C1", DAY2, 3, 1)))
    table.replace_dates(totals(spark, ("C9", DAY1, 9, 1), ("C9", DAY3, 9, 1)), [DAY1])
    assert rows_of(table.read()) == rows_of(totals(spark, ("C9", DAY1, 9, 1), ("C1", DAY2, 3, 1)))


def test_audit_table(spark, root):
    table = KeyedTable.audit(spark, root, buckets=4)
    rows = dirty_tx(spark, SF).withColumnRenamed("timestamp", "ts")
    table.upsert(rows, sequence=["ts"])
    table.upsert(rows, sequence=["ts"])
    assert table.count() == 1000
    assert table.read().dtypes == [(f.name, f.dataType.simpleString()) for f in AUDIT_TRANSACTIONS]
    assert len(table.table._commit_at().data_dirs) == 4


def test_commit_only_onto_the_version_that_was_read(spark, root):
    """Another writer commits between the read of the base and the replacement; its rows stay, the late commit fails."""
    table = VersionedTable(spark, root)
    table.overwrite(spark.createDataFrame([(1,)], "id int"))
    base = table._commit_at()
    other = VersionedTable(spark, root)
    other.replace(spark.createDataFrame([(2,)], "id int"), [], "UPSERT")
    with pytest.raises(versioned.ConcurrentCommitError):
        table.replace(spark.createDataFrame([(3,)], "id int"), base.data_dirs, "UPSERT", base=base)
    assert sorted(r.id for r in table.read().collect()) == [1, 2]


def test_diff_over_a_schema_change(spark, root):
    table = VersionedTable(spark, root)
    table.overwrite(spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, name string, old int"))
    table.overwrite(spark.createDataFrame([(1, "a", 1.5), (2, "c", 2.5)], "id bigint, name string, new double"))
    got = table.diff(0, 1, ["id"]).collect()
    assert [(r.id, r.change, r.old_name, r.new_name) for r in got] == [("2", "changed", "b", "c")]
    assert table.diff(0, 1).count() == 2
    with pytest.raises(ValueError, match="old"):
        table.diff(0, 1, ["old"])
