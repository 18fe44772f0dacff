"""Sums and digests that do not depend on the order of rows."""

import random
import struct
from datetime import datetime, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from txflow.operators import digests, dml, rollup
from txflow.operators.quality import QualityGateError
from txflow.sources import generate
from txflow.sources.versioned import VersionedTable, raw_layout

AT = datetime(2026, 3, 1, 12)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def as_float(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def cents(x):
    """An exact number rounded half away from zero, as a double."""
    size = abs(x) * 100
    whole = size.numerator // size.denominator
    return (-1 if x < 0 else 1) * (whole + (size - whole >= Fraction(1, 2))) / 100.0


def test_float_sums_are_exact_in_any_order(spark):
    draw = random.Random(1)
    rows = []
    for group in range(60):
        low, high = [(-3, 7), (-45, -2), (-10, 3), (0, 17)][group % 4]
        for _ in range(draw.choice([1, 2, 60])):
            rows.append((group, as_float(10 ** draw.uniform(low, high) * draw.choice([1, 1, 1, -1]))))
    ties = [(100, 0.125), (101, -0.125), (102, 0.125), (102, 1e-40), (103, 0.125), (103, -1e-40), (104, 0.5), (104, -0.375), (105, 0.0)]
    expected = {}
    for group, x in rows + ties:
        expected[group] = expected.get(group, Fraction(0)) + Fraction(as_float(x))
    expected = {g: cents(x) for g, x in expected.items()} | {200: None, 201: 2.0}
    df = spark.createDataFrame(rows + ties + [(200, None), (201, 2.0), (201, None)], "g int, amount float")
    for parts in (1, 7, 64):
        got = df.repartition(parts).groupBy("g").agg(rollup.exact_float_sum(F.col("amount")).alias("s")).collect()
        assert {r.g: r.s for r in got} == expected
    odd = spark.createDataFrame([(1, float("inf")), (1, 1.0), (2, float("nan")), (3, float("-inf"))], "g int, amount float")
    got = {r.g: r.s for r in odd.groupBy("g").agg(rollup.exact_float_sum(F.col("amount")).alias("s")).collect()}
    assert got[1] == float("inf") and got[2] != got[2] and got[3] == float("-inf")


def place():
    return {"day": F.to_date("timestamp"), "bucket": digests.key_bucket(["transaction_id"], 8)}


def test_digests_know_equal_and_changed_rows(spark):
    rows = generate.generate_transactions(spark, 2000, AT).drop("row_no")
    held = digests.leaves(rows, place())
    assert digests.differing(held, digests.leaves(rows.repartition(7), place()), ["day", "bucket"]).isEmpty()
    one = rows.first()
    changed = rows.withColumn("amount", F.when(F.col("transaction_id") == one.transaction_id, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(18,2)"))
    assert [r.day for r in digests.differing(held, digests.leaves(changed, place()), ["day", "bucket"]).collect()] == [one.timestamp.date()]
    # two equal rows more do not cancel out, and a NULL is not its neighbour
    twice = rows.unionByName(rows.limit(1)).unionByName(rows.limit(1))
    assert digests.differing(held, digests.leaves(twice, place()), ["day", "bucket"]).count() == 1
    schema = "a string, b string"
    shifted = [digests.leaves(spark.createDataFrame([r], schema), {"p": F.lit(1)}) for r in ((None, "x"), ("x", None))]
    assert digests.differing(*shifted, ["p"]).count() == 1
    assert digests.assert_equal(rows, rows.repartition(3), place()) == 2000
    with pytest.raises(QualityGateError):
        digests.assert_equal(rows, changed, place())


@pytest.mark.parametrize("most", [1000, 0])
def test_diff_by_digests_equals_the_join(spark, most):
    rows = generate.generate_transactions(spark, 1500, AT).drop("row_no")
    key = F.col("transaction_id")
    after = (
        rows.filter(~key.startswith("0a"))
        .withColumn("timestamp", F.when(key.startswith("1"), F.col("timestamp") + F.expr("interval 3 days")).otherwise(F.col("timestamp")))
        .withColumn("merchant", F.when(key.startswith("2b"), F.lit(None)).otherwise(F.col("merchant")))
        .unionByName(generate.generate_transactions(spark, 5, AT, seed=3).drop("row_no"))
    )
    got = digests.diff(rows, after, ["transaction_id"], place(), most=most)
    assert rows_of(got) == rows_of(dml.diff_keyed(rows, after, ["transaction_id"])) and not got.isEmpty()
    assert digests.diff(rows, rows, ["transaction_id"], place(), most=most).isEmpty()


def test_one_changed_row_reads_one_leaf(spark, tmp_path):
    """Stored by the leaf's own columns, what differs is all that is read for the join."""
    rows = generate.generate_transactions(spark, 2000, AT).drop("row_no")
    paths = [str(tmp_path / n) for n in "ab"]
    one = rows.first()
    other = rows.withColumn("merchant", F.when(F.col("transaction_id") == one.transaction_id, "X").otherwise(F.col("merchant")))
    for path, df in zip(paths, (rows, other), strict=True):
        df.withColumns(place()).write.partitionBy("day", "bucket").parquet(path)
    stored = {"day": F.col("day"), "bucket": F.col("bucket")}
    a, b = (spark.read.parquet(p) for p in paths)
    found = digests.differing(digests.leaves(a, stored), digests.leaves(b, stored), ["day", "bucket"]).collect()
    assert len(found) == 1
    held = digests.within(a, found, stored)
    assert "day#" in held._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    assert len({r[0].rsplit("/", 1)[0] for r in held.select(F.input_file_name()).collect()}) == 1
    assert [r.change for r in digests.diff(a, b, ["transaction_id"], stored).collect()] == ["changed"]


def test_a_change_of_one_id_rewrites_one_bucket(spark, root):
    table = VersionedTable(spark, root, raw_layout(8), sort_by=["transaction_id"])
    rows = generate.generate_transactions(spark, 500, AT).drop("row_no")
    table.overwrite(rows.unionByName(rows.limit(3).withColumn("timestamp", F.lit(AT + timedelta(days=1)))))
    name = rows.first().transaction_id
    for change in (lambda: table.update(F.col("transaction_id") == name, {"merchant": F.lit("X")}), lambda: table.delete(F.col("transaction_id") == name)):
        before = set(table.read().inputFiles())
        change()
        assert len(before) >= 8 and len(before - set(table.read().inputFiles())) == 1
