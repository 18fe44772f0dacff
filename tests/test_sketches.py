"""Audits by merged sketches, against exact values."""

import json
import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from txflow.__main__ import main
from txflow.operators import sketches
from txflow.operators.sketches import SketchStore

START = datetime(2026, 1, 1)
FIELDS = "transaction_id string, customer_id string, amount double, timestamp timestamp, merchant string"


def drawn(n, seed, days=20):
    """Rows of which a third fall on one day and a third belong to one customer."""
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        day = 3 if draw.random() < 1 / 3 else draw.randrange(days)
        who = "C0" if draw.random() < 1 / 3 else f"C{draw.randrange(1, 400)}"
        amount = draw.choice([None, 0.0, -5.0, float("nan")]) if draw.random() < 0.1 else round(draw.lognormvariate(3, 1), 2)
        at = START + timedelta(days=day, seconds=draw.randrange(86_400))
        out.append((f"T{draw.randrange(n)}", who, amount, at, "m"))
    return out


def exact(rows):
    amounts = sorted(r[2] for r in rows if r[2] is not None and r[2] == r[2])
    return {"rows": len(rows), "ids": len({r[0] for r in rows}), "amounts": amounts, "who": Counter(r[1] for r in rows)}


def test_periods_from_batches_are_within_bounds(spark, root):
    batches = {f"b{k}": drawn(6000, k) for k in range(3)}
    store = SketchStore(spark, root)
    for name, rows in batches.items():
        store.add(name, spark.createDataFrame(rows, FIELDS).repartition(7))
    store.add("b1", spark.createDataFrame(batches["b1"], FIELDS))  # repeated: takes its own place
    every = [r for rows in batches.values() for r in rows]
    for since, until in [(None, None), (date(2026, 1, 4), date(2026, 1, 4)), (date(2026, 1, 2), date(2026, 1, 11))]:
        inside = [r for r in every if (since is None or r[3].date() >= since) and (until is None or r[3].date() <= until)]
        want = exact(inside)
        got = store.profile(since, until).first()
        assert got.total_rows == want["rows"]
        assert got.positive_rows == sum(x > 0 for x in want["amounts"])
        assert got.zero_rows == sum(x == 0 for x in want["amounts"])
        assert got.negative_rows == sum(x < 0 for x in want["amounts"])
        assert got.missing_rows == want["rows"] - len(want["amounts"])
        assert abs(got.distinct_ids - want["ids"]) <= 0.03 * want["ids"]
        assert got.duplicate_rows == got.total_rows - got.distinct_ids
        for value, q in ((got.median_amount, 0.5), (got.p99_amount, 0.99)):
            below = sum(x < float(value) for x in want["amounts"]) / len(want["amounts"])
            upto = sum(x <= float(value) for x in want["amounts"]) / len(want["amounts"])
            assert below - 0.02 <= q <= upto + 0.02
        # Fewer customers than tracked items: their counts are exact.
        assert (got.frequent[0]["item"], got.frequent[0]["count"]) == want["who"].most_common(1)[0]


def test_counters_do_not_depend_on_partitions_and_merging_is_associative(spark):
    rows = spark.createDataFrame(drawn(3000, 9), FIELDS)
    seen = set()
    for parts in (1, 8, 32):
        days = sketches.day_sketches(rows.repartition(parts))
        whole = sketches.sketched_profile(sketches.merge_sketches(days)).first()
        halves = sketches.merge_sketches(days, (F.dayofmonth("day") % 2).alias("odd"))
        again = sketches.sketched_profile(sketches.merge_sketches(halves)).first()
        assert abs(whole.distinct_ids - again.distinct_ids) <= 0.01 * whole.distinct_ids
        seen.add((whole.total_rows, whole.positive_rows, whole.frequent[0]["count"]))
        seen.add((again.total_rows, again.positive_rows, again.frequent[0]["count"]))
    assert len(seen) == 1


def test_odd_rows_and_empty_tables(spark, root):
    odd = [(None, None, None, None, None), (None, None, float("inf"), START, None), ("T1", "C1", float("nan"), START, "m")]
    store = SketchStore(spark, root)
    with pytest.raises(ValueError, match="no summaries"):
        store.profile()
    store.add("none", spark.createDataFrame([], FIELDS))
    store.add("odd", spark.createDataFrame(odd, FIELDS))
    got = store.profile().first()
    assert (got.total_rows, got.missing_rows, got.distinct_ids, got.median_amount) == (3, 3, 1, None)
    assert store.profile(since=START.date()).first().total_rows == 2
    assert store.profile(since=date(2030, 1, 1)).count() == 0
    for name in ("", "a/b", "x=1", "_x"):
        with pytest.raises(ValueError, match="not a name"):
            store.add(name, spark.createDataFrame(odd, FIELDS))


def test_a_period_reads_no_history(spark, root):
    """The plan scans the summaries alone, with the days pushed down."""
    store = SketchStore(spark, root)
    store.add("b", spark.createDataFrame(drawn(500, 2), FIELDS))
    plan = store.profile(date(2026, 1, 2), date(2026, 1, 3))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and root.split("/")[-1] in plan and "transaction_id" not in plan
    assert "GreaterThanOrEqual(day,2026-01-02)" in plan and "LessThanOrEqual(day,2026-01-03)" in plan


def test_command_line(spark, root, tmp_path, capsys):
    rows = drawn(800, 4)
    spark.createDataFrame(rows, FIELDS).write.parquet(str(tmp_path / "new"))
    for _ in range(2):
        main(["audit", "--store", root, "--source", str(tmp_path / "new"), "--batch-id", "day-1"])
    capsys.readouterr()
    main(["audit-period", "--store", root, "--since", "2026-01-04", "--until", "2026-01-04"])
    (line,) = [x for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert json.loads(line)["total_rows"] == sum(r[3].date() == date(2026, 1, 4) for r in rows)
