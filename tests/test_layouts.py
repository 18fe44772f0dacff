"""Layouts for reads and merges: clustered files, buckets."""

import re
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from txflow.operators import dml
from txflow.schemas import DAILY_TOTALS, RAW_TRANSACTIONS
from txflow.sources import clustered, generate
from txflow.sources.bucketed import BucketedTable
from txflow.sources.keyed import KeyedTable
from txflow.sources.versioned import AmbiguousMergeError

AT = datetime(2026, 3, 1, 12)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# -- clustered ---------------------------------------------------------------


@pytest.fixture(scope="module")
def sixty_days(spark, tmp_path_factory):
    table = KeyedTable.daily_totals(spark, str(tmp_path_factory.mktemp("totals")))
    table.upsert(generate.generate_daily_totals(spark, date(2026, 3, 15), customers=300, days=60))
    copy = clustered.ClusteredTotals(spark, str(tmp_path_factory.mktemp("copy") / "c"), files=100)
    copy.refresh(table)
    return table, copy


def test_lookups_open_a_tenth_of_the_files(sixty_days):
    table, copy = sixty_days
    total = copy.bounds().count()
    assert total >= 200  # 100 for each month that is more than touched
    for customer in ("C00001", "C00150", "C00300"):
        assert len(copy.files_for(customer)) * 10 <= total
        got = copy.lookup(customer, newest_first=True).collect()
        assert len(got) == 60 and [r.transaction_date for r in got] == sorted((r.transaction_date for r in got), reverse=True)
        assert sorted(map(tuple, got), key=str) == rows_of(table.lookup(customer))
    day = date(2026, 2, 3)
    one = copy.lookup("C00150", since=day, until=day)
    assert len(one.inputFiles()) <= 2 and rows_of(one) == rows_of(table.lookup("C00150", day, day))
    week = (date(2026, 1, 29), date(2026, 2, 4))
    assert rows_of(copy.lookup("C00007", *week)) == rows_of(table.lookup("C00007", *week))
    assert copy.lookup("C99999").isEmpty() and copy.lookup("C00001", until=date(2020, 1, 1)).isEmpty()


def test_a_refresh_replaces_whole_months(spark, tmp_path):
    table = KeyedTable.daily_totals(spark, str(tmp_path / "t"))
    copy = clustered.ClusteredTotals(spark, str(tmp_path / "c"), files=4)
    copy.refresh(table)
    assert copy.lookup("C00001").isEmpty() and copy.bounds().isEmpty()
    table.upsert(generate.generate_daily_totals(spark, date(2026, 3, 15), customers=20, days=40))
    copy.refresh(table)
    held = {str(p) for p in Path(tmp_path / "c" / "data").rglob("*.parquet")}
    changed = spark.createDataFrame([("C00003", date(2026, 3, 2), Decimal("1.25"), 9)], DAILY_TOTALS)
    table.upsert(changed)
    copy.refresh(table, ["2026-03"])
    now = {str(p) for p in Path(tmp_path / "c" / "data").rglob("*.parquet")}
    assert {f for f in held if "month=2026-02" in f} == {f for f in now if "month=2026-02" in f}
    assert not {f for f in held if "month=2026-03" in f} & now
    assert rows_of(copy.lookup("C00003")) == rows_of(table.lookup("C00003"))
    table.replace_dates(changed, [date(2026, 3, d) for d in range(1, 16)])
    copy.refresh(table, ["2026-03", "2026-02"])
    assert rows_of(copy.lookup("C00003")) == rows_of(table.lookup("C00003"))
    table.replace_dates(changed.limit(0), [date(2026, 3, d) for d in range(1, 16)])
    copy.refresh(table)
    assert rows_of(copy.lookup("C00003")) == rows_of(table.lookup("C00003"))
    assert {r.month for r in copy.bounds().collect()} == {"2026-02"}


def test_interleaved_bits(spark):
    a, b = F.col("a"), F.col("b")
    df = spark.createDataFrame([(5, 2), (0, 3), (7, 0)], "a int, b int")
    got = [r[0] for r in df.select(clustered.interleaved({"a": (a, 3), "b": (b, 2)})).collect()]
    # bits in order: a2, a1, b1, a0, b0
    assert got == [0b10110, 0b00101, 0b11010]
    ends = ["b", "d", "f"]
    places = spark.createDataFrame([(x,) for x in "abcdefg"], "v string").select(clustered.place(F.col("v"), ends))
    assert [r[0] for r in places.collect()] == [0, 0, 1, 1, 2, 2, 3]


# -- buckets -----------------------------------------------------------------


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def test_a_merge_does_not_shuffle_the_target(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "b"), RAW_TRANSACTIONS, ["transaction_id"], buckets=6)
    rows = generate.inject_issues(generate.generate_transactions(spark, 3000, AT), 3000, AT)
    table.overwrite(rows)
    assert rows_of(table.read()) == rows_of(rows)
    source = generate.generate_transactions(spark, 3100, AT, seed=9).drop("row_no").withColumn(
        "transaction_id", F.when(F.col("merchant") == "PHARMACY", F.col("transaction_id"))  # the others get ids of the target
        .otherwise(F.lit(None))
    ).filter("transaction_id is not null").unionByName(rows.dropDuplicates(["transaction_id"]).limit(700).withColumn("merchant", F.lit("NEW")))
    source.write.parquet(str(tmp_path / "source"))
    source = spark.read.parquet(str(tmp_path / "source"))
    expected = rows_of(dml.apply_merge(rows, source, ["transaction_id"]))
    plan = plan_of(table.merged(source))
    target_side = plan[: plan.index("ShuffleQueryStage")] if "ShuffleQueryStage" in plan else plan
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan and target_side
    table.merge(source)
    assert rows_of(table.read()) == expected
    files = list(Path(tmp_path / "b").glob(f"{table._generations()[-1]}/*.parquet"))
    assert len(files) == 6  # a file for each bucket
    grouped = plan_of(table.read().groupBy("transaction_id").count())
    assert "Exchange" not in grouped
    assert len(table.vacuum()) == 1 and rows_of(table.read()) == expected


def test_merge_in_buckets_by_the_rules(spark, tmp_path):
    schema = "k string, v int"
    table = BucketedTable(spark, str(tmp_path / "b"), spark.createDataFrame([], schema).schema, ["k"], buckets=3)
    assert not table.exists() and table.read().isEmpty() and table.vacuum() == []
    table.overwrite(spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], schema))
    table.merge(spark.createDataFrame([("a", 9), (None, 8), ("c", None)], schema))
    assert rows_of(table.read()) == sorted([("a", 9), ("a", 9), (None, 3), ("b", 4), (None, 8), ("c", None)], key=str)
    with pytest.raises(AmbiguousMergeError):
        table.merge(spark.createDataFrame([("a", 1), ("a", 2)], schema))
    with pytest.raises(ValueError, match="NULL key"):
        table.upsert(spark.createDataFrame([(None, 1)], schema))
    table.upsert(spark.createDataFrame([("b", 1), ("b", 5)], schema), sequence=["v"])
    assert (("b", 5) in rows_of(table.read())) and ("b", 4) not in rows_of(table.read())
    again = BucketedTable(spark, str(tmp_path / "b"), table.schema, ["k"], buckets=3)
    assert rows_of(again.read()) == rows_of(table.read())
    assert re.fullmatch(r"\d{8}-[0-9a-f]{12}", again.merge(spark.createDataFrame([], schema)))
