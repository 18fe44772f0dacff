"""Hand-made rows for the rules that tables of clean data cannot show."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.functions import columns as fx
from txflow.operators import cleanse, dml, quality, rollup, upsert
from txflow.operators.dedup import dedupe, duplicate_keys
from txflow.plans import daily
from txflow.plans.fixtures import dirty_tx
from txflow.plans.run import ROW_ORDER, quarantined
from txflow.schemas import AUDIT_TRANSACTIONS, RAW_TRANSACTIONS, SchemaMismatchError, assert_schema, conform

SF = "/root/testdata/sf0.01"
TX = "transaction_id string, customer_id string, amount decimal(18,2), timestamp timestamp, merchant string"


def ts(text):
    return datetime.fromisoformat(text)


def tx(spark, *rows, amount="decimal(18,2)"):
    return spark.createDataFrame(
        [(i, c, Decimal(str(a)) if amount.startswith("dec") and a is not None else a, t, "STORE_1") for i, c, a, t in rows],
        TX.replace("decimal(18,2)", amount),
    )


def values(df):
    return sorted(tuple(r) for r in df.collect())


T1, T2 = ts("2026-03-15 23:30:00"), ts("2026-03-16 00:30:00")


@pytest.mark.parametrize("strategy", ["struct", "window"])
@pytest.mark.parametrize("parts", [1, 3])
def test_survivor_is_earliest(spark, strategy, parts):
    df = tx(spark, ("a", "C1", 99, T2), ("a", "C1", 10, T1)).repartition(parts)
    assert values(dedupe(df, ["transaction_id"], ROW_ORDER, strategy=strategy).select("amount", "timestamp")) == [
        (Decimal("10.00"), T1)
    ]


def test_survivor_does_not_depend_on_layout(spark):
    df = dirty_tx(spark, SF)
    layouts = [df, df.repartition(7), df.orderBy(F.col("amount").desc()), df.coalesce(1)]
    results = [values(dedupe(x, ["transaction_id"], ROW_ORDER)) for x in layouts]
    results.append(values(dedupe(df, ["transaction_id"], ROW_ORDER, strategy="window")))
    assert len(results[0]) == 10_000
    assert all(r == results[0] for r in results)


def test_dedup_is_idempotent_and_ties_are_broken(spark):
    df = tx(spark, ("a", "C2", 5, T1), ("a", "C1", 7, T1), ("a", "C1", 6, T1))
    once = dedupe(df, ["transaction_id"], ROW_ORDER)
    assert values(once) == [("a", "C1", Decimal("6.00"), T1, "STORE_1")]
    assert values(dedupe(once, ["transaction_id"], ROW_ORDER)) == values(once)


def test_dedup_any_on_equal_copies(spark):
    df = tx(spark, ("a", "C1", 1, T1), ("a", "C1", 1, T1), ("b", "C1", 1, T1))
    assert dedupe(df, ["transaction_id"], ROW_ORDER, strategy="any").count() == 2
    with pytest.raises(ValueError):
        dedupe(df, ["transaction_id"], ROW_ORDER, strategy="some")


def test_dedup_plan_has_one_shuffle_with_partial_aggregate(spark):
    plan = dedupe(dirty_tx(spark, SF), ["transaction_id"], ROW_ORDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_min" in plan


def test_transform_plan_reads_four_columns_in_two_shuffles(spark):
    raw = dirty_tx(spark, SF)
    path = spark.conf.get("spark.checkpoint.dir") + "/plan-check"
    raw.write.mode("overwrite").parquet(path)
    plan = daily.transform(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2
    assert "merchant" not in plan.split("ReadSchema")[1]


def test_zeroed_survivor_drops_transaction_unless_validated_first(spark):
    df = tx(spark, ("b", "C1", 0, T1), ("b", "C1", 5, T2))
    assert values(daily.transform(df)) == []
    assert values(daily.transform(df, validate_first=True)) == [("C1", date(2026, 3, 16), Decimal("5.00"), 1)]


def test_keyless_rows_are_quarantined_not_collapsed(spark):
    df = tx(
        spark, (None, "C3", 1, T1), (None, "C3", 2, T1), ("c", None, 3, T1), ("d", "C1", 0.1, None), ("d", "C1", 4, T2)
    )
    assert values(daily.transform(df)) == [("C1", date(2026, 3, 16), Decimal("4.00"), 1)]
    reasons = values(quarantined(df).groupBy("reject_reason").count())
    assert reasons == [("null_customer_id", 1), ("null_timestamp", 1), ("null_transaction_id", 2)]
    counts = daily.stage_counts(daily.rollup_with_counts(df)).first().asDict()
    assert counts["raw_rows"] == 5 and counts["quarantined_rows"] == 4
    assert counts["deduplicated_rows"] == counts["valid_rows"] == counts["aggregated_rows"] == 1


def test_four_bad_amounts_have_four_reasons(spark):
    rows = [("a", "C1", None, T1), ("b", "C1", float("nan"), T1), ("c", "C1", 0.0, T1), ("d", "C1", -1.0, T1)]
    df = tx(spark, *rows, ("e", "C1", 2.5, T1), amount="float")
    assert values(cleanse.rejects(df).select("transaction_id", "reject_reason")) == [
        ("a", "null_amount"),
        ("b", "nan_amount"),
        ("c", "zero_amount"),
        ("d", "negative_amount"),
    ]
    assert values(cleanse.valid_rows(df).select("transaction_id")) == [("e",)]
    assert values(daily.transform(conform(df, RAW_TRANSACTIONS)).select("daily_total")) == [(Decimal("2.50"),)]


def test_counted_rollup_agrees_with_transform(spark):
    raw = dirty_tx(spark, SF)
    for first in (False, True):
        counted = daily.rollup_with_counts(raw, validate_first=first)
        assert values(daily.totals_of(counted)) == values(daily.transform(raw, validate_first=first))


def test_totals_add_up_to_valid_amounts(spark):
    raw = dirty_tx(spark, SF)
    valid = cleanse.valid_rows(daily.keep_first(raw)).agg(F.sum("amount")).first()[0]
    assert daily.transform(raw).agg(F.sum("daily_total")).first()[0] == valid


def test_midnight(spark):
    df = tx(spark, ("a", "C1", 1, ts("2026-03-15 23:59:59.999999")), ("b", "C1", 2, ts("2026-03-16 00:00:00")))
    assert values(daily.transform(df).select("transaction_date")) == [(date(2026, 3, 15),), (date(2026, 3, 16),)]


def test_columns(spark):
    row = spark.range(1).select(
        fx.customer_code(F.lit(7)).alias("a"),
        fx.customer_code(F.lit(1234567)).alias("b"),
        fx.merchant_name(F.lit(0)).alias("c"),
        fx.merchant_name(F.lit(25)).alias("d"),
        fx.merchant_name(F.lit(29)).alias("e"),
        fx.parse_ts(F.lit("2026-03-15 10:30:00+02:00")).alias("f"),
        fx.parse_ts(F.lit("soon")).alias("g"),
        fx.scaled(F.lit(Decimal("0.50"))).alias("h"),
        fx.parse_money(F.lit("x")).alias("i"),
    )
    assert list(row.first()) == [
        "C00007",
        "C1234567",
        "STORE_1",
        "ONLINE_SHOP",
        "RESTAURANT",
        ts("2026-03-15 08:30:00"),
        None,
        Decimal("0.51"),
        None,
    ]


# -- schemas -------------------------------------------------------------------


def test_conform(spark):
    df = tx(spark, ("a", "C1", 0.1, T1), ("b", "C1", float("inf"), T1), amount="float").withColumn("x", F.lit(1))
    out = conform(df, RAW_TRANSACTIONS)
    assert_schema(out, RAW_TRANSACTIONS)
    assert values(out.select("transaction_id", "amount").filter("amount is not null")) == [("a", Decimal("0.10"))]
    with pytest.raises(SchemaMismatchError):
        conform(df.drop("merchant"), RAW_TRANSACTIONS)
    with pytest.raises(SchemaMismatchError):
        assert_schema(out, AUDIT_TRANSACTIONS)


# -- update, delete, merge, diff -----------------------------------------------


def kv(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v decimal(18,2)")


def D(text):
    return Decimal(text)


def key(row):
    return tuple((x is not None, x) for x in row)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def test_delete_keeps_null_and_zero(spark):
    df = kv(spark, ("a", D("-1")), ("b", None), ("c", D("0")))
    assert rows_of(dml.apply_delete(df, F.col("v") < 0)) == [("b", None), ("c", D("0.00"))]


def test_update_casts_and_ignores_null_conditions(spark):
    df = spark.createDataFrame([("a", 10.0), ("b", None)], "k string, v float")
    out = dml.apply_update(df, F.col("v") > 1, {"v": F.round(F.col("v") * 1.01, 2)})
    assert out.schema["v"].dataType == T.FloatType()
    assert rows_of(out)[1][0] == "b" and abs(rows_of(out)[0][1] - 10.1) < 1e-5
    with pytest.raises(ValueError):
        dml.apply_update(df, F.col("v") > 1, {"w": F.lit(1)})
    with pytest.raises(PySparkException):
        dml.apply_update(kv(spark, ("a", D("1"))), F.lit(True), {"v": F.lit(1e20)}).collect()


TARGET = [("a", D("1")), ("a", D("2")), ("b", D("3")), (None, D("4")), ("hot", D("5")), ("hot", D("6"))]
SOURCE = [("a", D("10")), ("hot", D("50")), ("new", D("7")), (None, D("8"))]
MERGED = [("a", D("10")), ("a", D("10")), ("b", D("3")), ("hot", D("50")), ("hot", D("50")), ("new", D("7"))]
MERGED = sorted([*MERGED, (None, D("4")), (None, D("8"))], key=key)


def test_merge(spark):
    assert rows_of(dml.apply_merge(kv(spark, *TARGET), kv(spark, *SOURCE), ["k"])) == MERGED


def test_merge_plans(spark):
    """No full outer join, which could not be split; a source below Spark's own threshold leaves the target unshuffled."""
    path = spark.conf.get("spark.checkpoint.dir") + "/merge-plan"
    kv(spark, *TARGET).write.mode("overwrite").parquet(path)
    kv(spark, *SOURCE).write.mode("overwrite").parquet(f"{path}-source")
    target, source = spark.read.parquet(path), spark.read.parquet(f"{path}-source")
    plan = lambda: dml.apply_merge(target, source, ["k"])._jdf.queryExecution().executedPlan().toString()
    small = plan()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = plan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in small
    assert large.count("SortMergeJoin") == 2 and "FullOuter" not in large
    assert "LeftOuter" in large and "LeftAnti" in large


def test_merge_skew_is_split(spark):
    """More than a thousand frequent keys, one of them with a third of all rows: AQE splits the target's side."""
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1500).cast("string")
    target = spark.range(n).select(key.alias("k"), F.col("id").cast("decimal(18,2)").alias("v"))
    source = spark.range(1500).select(F.col("id").cast("string").alias("k"), F.lit(-1).cast("decimal(18,2)").alias("v"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = dml.apply_merge(target, source, ["k"])
        assert out.filter("v = -1").count() == n + 499 == out.count()  # source keys that no row has are inserted
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert "SortMergeJoin(skew=true)" in plan


def test_merge_with_nothing_and_into_nothing(spark):
    target, none = kv(spark, *TARGET), kv(spark, ("x", D("1"))).filter("false")
    assert rows_of(dml.apply_merge(target, none, ["k"])) == rows_of(target)
    assert rows_of(dml.apply_merge(none, target, ["k"])) == rows_of(target)


def test_merge_against_brute_force(spark):
    target = [(f"k{i % 37}", D(str(i))) for i in range(500)] + [("k3", D(str(i))) for i in range(250)]
    source = [(f"k{i}", D(str(-i))) for i in range(0, 60, 2)]
    by_key = dict(source)
    expected = [(k, by_key.get(k, v)) for k, v in target]
    expected += [(k, v) for k, v in source if k not in {k for k, _ in target}]
    t, s = kv(spark, *target).repartition(5), kv(spark, *source)
    assert rows_of(dml.apply_merge(t, s, ["k"])) == sorted(expected)
    counts = dml.merge_change_counts(t, s, ["k"]).first()
    assert counts.rows_updated == sum(k in by_key for k, _ in target)
    assert counts.rows_inserted == sum(k not in {k for k, _ in target} for k, _ in source)


def test_diff_with_null_keys(spark):
    a = kv(spark, (None, D("1")), (None, D("1")), (None, D("2")), ("a", D("5")))
    b = kv(spark, (None, D("2")), (None, D("3")), ("a", D("6")))
    assert rows_of(dml.diff_keyed(a, b, ["k"])) == sorted(
        [("a", "changed", D("5"), D("6")), (None, "removed", D("1"), None), (None, "removed", D("1"), None), (None, "added", None, D("3"))],
        key=key,
    )


def test_infinity_is_not_valid(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (1.0,), (None,)], "amount double")
    assert [r.amount for r in cleanse.valid_rows(df).collect()] == [1.0]
    named = df.selectExpr("'t' transaction_id", "'c' customer_id", "timestamp'2024-01-01' timestamp", "amount")
    assert sorted(r.reject_reason for r in cleanse.rejects(named).collect()) == [
        "infinite_amount", "infinite_amount", "nan_amount", "null_amount"
    ]


def test_window_strategy_breaks_ties(spark):
    rows = [("a", 1, "y", {"m": 2}), ("a", 1, "x", {"m": 2}), ("a", 1, "x", {"m": 1})]
    for layout in (rows, rows[::-1]):
        df = spark.createDataFrame(layout, "k string, t int, v string, m map<string,int>").repartition(3)
        got = dedupe(df, ["k"], ["t"], strategy="window").collect()
        assert [(r.v, r.m) for r in got] == [("x", {"m": 1})]


def test_diff(spark):
    a = kv(spark, ("a", D("1")), ("b", None), ("c", D("3")), ("d", D("4")))
    b = kv(spark, ("a", D("1")), ("b", None), ("c", D("9")), ("e", D("5")))
    assert rows_of(dml.diff_keyed(a, b, ["k"])) == [
        ("c", "changed", D("3"), D("9")),
        ("d", "removed", D("4"), None),
        ("e", "added", None, D("5")),
    ]
    with pytest.raises(PySparkException):
        dml.diff_keyed(kv(spark, ("a", D("1")), ("a", D("2"))), b, ["k"]).collect()
    twice = kv(spark, ("a", D("1")), ("a", D("1")), ("a", D("1")))
    assert rows_of(dml.diff_rows(twice, kv(spark, ("a", D("1")), ("b", None)))) == [
        ("a", D("1"), "removed", 2),
        ("b", None, "added", 1),
    ]


# -- upsert and quality --------------------------------------------------------


def test_upsert_is_idempotent_and_deletes(spark):
    table, batch = kv(spark, ("a", D("1")), ("b", D("2"))), kv(spark, ("b", D("3")), ("c", D("4")))
    once = upsert.apply_upsert(table, batch, ["k"])
    assert rows_of(once) == [("a", D("1")), ("b", D("3")), ("c", D("4"))]
    assert rows_of(upsert.apply_upsert(once, batch, ["k"])) == rows_of(once)
    gone = kv(spark, ("a", None)).select("k")
    assert rows_of(upsert.apply_upsert(once, batch, ["k"], deletes=gone)) == [("b", D("3")), ("c", D("4"))]


def test_gates(spark):
    assert quality.gate_min_rows("x", 10, 10).status == "pass"
    assert quality.gate_min_rows("x", 9, 10, "warn").status == "fail"
    with pytest.raises(quality.QualityGateError):
        quality.gate_min_rows("x", 0, 1)
    with pytest.raises(ValueError):
        quality.gate_min_rows("x", 0, 1, "maybe")


def test_reconcile(spark):
    batch, table = kv(spark, ("a", D("1")), ("b", D("2")), ("c", None)), kv(spark, ("b", D("9")), ("c", None), ("z", D("1")))
    assert tuple(quality.reconcile(batch, table, ["k"]).first()) == (3, 1, 1)
    with pytest.raises(quality.QualityGateError):
        quality.assert_reconciled(batch, table, ["k"])
    assert quality.assert_reconciled(table, table, ["k"]) == 3


def test_audits(spark):
    df = tx(spark, ("a", "C1", 1, T1), ("a", "C1", 0, T2), ("b", "C1", -1, T1), (None, "C1", None, T1), ("c", "C1", 2, T2))
    assert values(duplicate_keys(df, ["transaction_id"])) == [("a", 2)]
    profile = quality.profile_amounts(df, as_of=T1).first().asDict()
    assert profile == {
        "total_rows": 5,
        "distinct_ids": 3,
        "duplicate_rows": 1,
        "positive_rows": 2,
        "zero_rows": 1,
        "negative_rows": 1,
        "missing_rows": 1,
        "future_rows": 2,
    }
    assert values(quality.range_violations(df, as_of=T1).filter("amount is not null").select("amount")) == [
        (D("-1"),),
        (D("0"),),
        (D("2"),),
    ]


def test_float_totals(spark):
    df = cleanse.with_transaction_date(tx(spark, ("a", "C1", 0.1, T1), ("b", "C1", 0.2, T1)))
    assert values(rollup.daily_totals_float(df).select("daily_total")) == [(0.3,)]
