"""Sources, generators, the daily and incremental runs, the stream and the command line."""

import json
import random
from dataclasses import replace
from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from txflow import FlowConfig, QualityGateError, spark_settings
from txflow.__main__ import main
from txflow.operators import quality
from txflow.plans import daily, run
from txflow.plans.fixtures import copies, dirty_tx, originals
from txflow.schemas import RAW_TRANSACTIONS, conform
from txflow.sources import csv_records, files, generate
from txflow.sources.keyed import KeyedTable
from txflow.sources.versioned import VersionedTable
from txflow.sources.winners import SurvivorStore
from txflow.streaming.feed import run_available

SF = "/root/testdata/sf0.001"
TX = "transaction_id string, customer_id string, amount decimal(18,2), timestamp timestamp, merchant string"
AS_OF = datetime(2026, 3, 15, 12, 0, 0)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def raw(spark):
    return conform(dirty_tx(spark, SF), RAW_TRANSACTIONS)


# -- sources -------------------------------------------------------------------

CSV = """transaction_id,customer_id,amount,timestamp,merchant
t-1,alice,12.40,2024-02-29 08:05:09+00:00,7-ELEVEN
t-2,bob,0.99,2024-02-29 23:30:00-02:00,purchase
t-3,carol,twelve,2024-02-29 08:00:00+00:00,kiosk
t-4,dave,3.00,last week,kiosk
,erin,3.00,2024-02-29 08:00:00+00:00,kiosk
t-6,,3.00,2024-02-29 08:00:00+00:00,kiosk
t-7,frank,3.00,2024-02-29 08:00:00+00:00,kio<b>sk
t-8,grace"""


def test_csv_with_damaged_tail(spark, tmp_path):
    path = tmp_path / "sample.csv"
    path.write_text(CSV)
    good, bad = files.read_transactions_csv(spark, str(path))
    assert good.dtypes == [(f.name, f.dataType.simpleString()) for f in RAW_TRANSACTIONS]
    assert rows_of(good.select("transaction_id", "amount", "timestamp")) == [
        ("t-1", Decimal("12.40"), datetime(2024, 2, 29, 8, 5, 9)),
        ("t-2", Decimal("0.99"), datetime(2024, 3, 1, 1, 30)),
    ]
    assert sorted(r.reason for r in bad.collect()) == [
        "bad_amount",
        "bad_merchant",
        "bad_timestamp",
        "malformed_line",
        "null_customer_id",
        "null_transaction_id",
    ]
    assert good.count() == 2 and bad.count() == 6


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    files.write_sample_csv(generate.generate_transactions(spark, 50, AS_OF).drop("row_no"), path)
    good, bad = files.read_transactions_csv(spark, path)
    expected = generate.generate_transactions(spark, 50, AS_OF).drop("row_no").orderBy("transaction_id").limit(20)
    assert bad.isEmpty() and rows_of(good) == rows_of(expected)


ODD_NAMES = ["two\nlines", "a,b", 'say "so"', '"', '""', " blanks ", "x\r\ny", "\n", "plain", "", '",\n"', "tail\\", '\\"', 'one "two', "c\n" * 40]


@pytest.mark.parametrize("split", [None, 64, 257])
def test_csv_of_any_text_round_trips(spark, tmp_path, split, request):
    """Line breaks and quotes inside fields, in one file that Spark cuts anywhere."""
    names = [ODD_NAMES[(k * 7) % len(ODD_NAMES)] for k in range(120)]
    rows = [(f"t{k:03d}", "C1", Decimal(k + 1), AS_OF, name) for k, name in enumerate(names)]
    path = str(tmp_path / "odd")
    files.write_csv(spark.createDataFrame(rows, TX).coalesce(1), path)
    if split:
        for key, value in (("maxPartitionBytes", split), ("openCostInBytes", 0)):
            spark.conf.set(f"spark.sql.files.{key}", value)
            request.addfinalizer(lambda key=key: spark.conf.unset(f"spark.sql.files.{key}"))
        assert csv_records.lines_of(spark, path).select("block").distinct().count() > 10
    good, bad = files.read_transactions_csv(spark, path)
    assert rows_of(good) == sorted(rows, key=str) and bad.isEmpty()


@pytest.mark.parametrize("split", [None, 40])
def test_unclosed_quotes_lose_nothing_silently(spark, tmp_path, split, request):
    if split:
        for key, value in (("maxPartitionBytes", split), ("openCostInBytes", 0)):
            spark.conf.set(f"spark.sql.files.{key}", value)
            request.addfinalizer(lambda key=key: spark.conf.unset(f"spark.sql.files.{key}"))
    at = "2024-02-29 08:05:09+00:00"
    head = "transaction_id,customer_id,amount,timestamp,merchant"
    (tmp_path / "a.csv").write_text("\n".join([head, f"t-1,a,1.00,{at},KIOSK", f't-2,a,1.00,{at},5" PIPE', f't-3,a,1.00,{at},"OPEN', *(f"u-{k},a,1.00,{at},KIOSK" for k in range(30))]))
    for limit in (10, 1000):
        got = csv_records.records(spark, str(tmp_path / "a.csv"), max_lines=limit).collect()
        assert sorted(r.record for r in got if r.record is not None) == [f"t-1,a,1.00,{at},KIOSK", f't-2,a,1.00,{at},5" PIPE']
        assert len([r for r in got if r.record is None]) == 31
    closed = tmp_path / "b.csv"
    closed.write_text("\n".join([head, f't-1,a,1.00,{at},"' + "x\n" * 20 + '"', f"t-2,a,1.00,{at},KIOSK"]))
    assert len([r for r in csv_records.records(spark, str(closed), max_lines=10).collect() if r.record is None]) == 21
    good, bad = files.read_transactions_csv(spark, str(tmp_path / "a.csv"))
    assert sorted(r.transaction_id for r in good.collect()) == ["t-1", "t-2"]
    assert [r.reason for r in bad.collect()] == ["unclosed_quote"] * 31


def test_states_of_lines_against_a_plain_reader(spark):
    """Both ends of random lines, against one character after another."""
    draw = random.Random(7)
    lines = ["".join(draw.choice(['"', '""', ",", "a", " "]) for _ in range(draw.randrange(9))) for _ in range(400)]

    def plain(line, inside):
        k, start = 0, not inside
        while k < len(line):
            if inside and line[k] == '"':
                if line[k + 1 : k + 2] == '"':
                    k += 1
                else:
                    inside = False
            elif not inside and line[k] == '"' and start:
                inside = True
            start = not inside and line[k] == ","
            k += 1
        return int(inside)

    out, into = csv_records.ends(F.col("line"))
    got = spark.createDataFrame([(x,) for x in lines], "line string").select("line", out, into).collect()
    assert [tuple(r) for r in got] == [(x, plain(x, False), plain(x, True)) for x in lines]


def test_literal_rows(spark):
    row = ("t", "C1", Decimal("1.00"), AS_OF, None)
    with pytest.raises(PySparkException):
        files.from_rows(spark, [row], RAW_TRANSACTIONS)
    inferred = files.from_rows(spark, [("t", 9.5, AS_OF)], ["id", "amount", "timestamp"])
    assert dict(inferred.dtypes) == {"id": "string", "amount": "double", "timestamp": "timestamp"}


def test_missing_source(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="generate"):
        files.require_source(spark, str(tmp_path / "none"))


# -- generators ----------------------------------------------------------------


def test_generated_rows_do_not_depend_on_partitions(spark):
    a = generate.generate_transactions(spark, 1200, AS_OF)
    assert rows_of(a) == rows_of(generate.generate_transactions(spark, 1200, AS_OF).repartition(3))
    assert rows_of(a) != rows_of(generate.generate_transactions(spark, 1200, AS_OF, seed=1))
    stats = a.agg(
        F.count_distinct("transaction_id"),
        F.count_distinct("customer_id"),
        F.count_distinct("merchant"),
        F.min("amount") >= 1,
        F.max("amount") <= 2000,
        F.max("timestamp") <= F.lit(AS_OF),
        F.min("timestamp") > F.lit(AS_OF) - F.expr("interval 61 days"),
        F.bool_and(F.col("transaction_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")),
        F.bool_and(F.col("customer_id").between("C00001", "C00080")),
    ).first()
    assert tuple(stats) == (1200, 80, 30, True, True, True, True, True, True)


@pytest.mark.parametrize("n", [1, 7, 99, 1200, 3333])
def test_injected_issues_have_exact_numbers(spark, n):
    dirty = generate.inject_issues(generate.generate_transactions(spark, n, AS_OF), n, AS_OF)
    copied, zeros, negatives = max(1, n // 20), max(1, n // 33), max(1, n // 50)
    counts = quality.profile_amounts(dirty).first()
    assert counts.total_rows == n + copied and counts.distinct_ids == n
    assert counts.zero_rows + counts.negative_rows == min(n + copied, zeros + negatives)
    if n >= 99:
        assert (counts.zero_rows, counts.negative_rows) == (zeros, negatives)
    if n == 1200:
        assert (counts.total_rows, counts.duplicate_rows, zeros, negatives) == (1260, 60, 36, 24)
        assert dirty.filter("amount < -500.00").isEmpty()


def test_generated_totals(spark):
    df = generate.generate_daily_totals(spark, date(2026, 3, 15))
    assert df.count() == 7000 and df.dropDuplicates(["customer_id", "transaction_date"]).count() == 7000
    low, high, first, last = df.agg(
        F.min("daily_total"), F.max("daily_total"), F.min("transaction_date"), F.max("transaction_date")
    ).first()
    assert 50 <= low <= high <= 1500 and (first, last) == (date(2026, 3, 9), date(2026, 3, 15))


# -- daily run -----------------------------------------------------------------


def test_daily_run(spark, tmp_path):
    source, target = str(tmp_path / "raw"), str(tmp_path / "totals")
    VersionedTable(spark, source).overwrite(raw(spark))
    config = FlowConfig(source, target, quarantine=str(tmp_path / "quarantine"))
    report = run.run_daily(spark, config, "r1").first()
    assert (report.source_rows, report.deduplicated_rows, report.valid_rows) == (1050, 1000, 949)
    assert (report.batch_keys, report.table_rows, report.status) == (396, 396, "pass")
    table = KeyedTable.daily_totals(spark, target)
    assert rows_of(table.read()) == rows_of(daily.transform(raw(spark)))
    assert spark.read.parquet(f"{config.quarantine}/run=r1").count() == 1000 - 949
    again = run.run_daily(spark, FlowConfig(source, target)).first()
    assert again.table_rows == 396 and again.table_version == report.table_version + 1
    assert rows_of(table.read()) == rows_of(table.read(report.table_version))


def test_daily_run_gates(spark, tmp_path):
    source = str(tmp_path / "raw")
    with pytest.raises(FileNotFoundError):
        run.run_daily(spark, FlowConfig(source, str(tmp_path / "a")))
    table = VersionedTable(spark, source)
    table.overwrite(raw(spark).filter("false"))
    with pytest.raises(QualityGateError, match="source not empty"):
        run.run_daily(spark, FlowConfig(source, str(tmp_path / "b")))
    table.overwrite(raw(spark).filter("amount <= 0"))
    with pytest.raises(QualityGateError, match="result not empty"):
        run.run_daily(spark, FlowConfig(source, str(tmp_path / "c")))
    table.overwrite(raw(spark).orderBy("transaction_id").limit(5))
    with pytest.raises(QualityGateError, match="enough rows"):
        run.run_daily(spark, FlowConfig(source, str(tmp_path / "d")))
    assert run.run_daily(spark, FlowConfig(source, str(tmp_path / "e"), min_result_rows=1)).first().status == "pass"


def test_session_zone_is_checked(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            run.run_daily(spark, FlowConfig(str(tmp_path), str(tmp_path)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


# -- incremental run -----------------------------------------------------------


def flow(tmp_path, **more):
    return FlowConfig(str(tmp_path / "in"), str(tmp_path / "t"), survivors=str(tmp_path / "s"), min_result_rows=1, **more)


@pytest.mark.parametrize("large", [False, True])
def test_incremental_equals_full_with_late_and_repeated_rows(spark, tmp_path, request, large):
    if large:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    config = flow(tmp_path)
    first, second = copies(spark, SF), dirty_tx(spark, SF)
    run.run_incremental(spark, first, config, "1")
    table = KeyedTable.daily_totals(spark, config.target)
    assert rows_of(table.read()) == rows_of(daily.transform(conform(first, RAW_TRANSACTIONS)))
    stale = set(rows_of(table.read().select("customer_id", "transaction_date")))
    report = run.run_incremental(spark, second, config, "2").first()
    assert rows_of(table.read()) == rows_of(daily.transform(raw(spark)))
    assert stale - set(rows_of(table.read().select("customer_id", "transaction_date")))
    assert run.survivor_table(spark, config.survivors).read().count() == 1000
    version = report.table_version
    assert run.run_incremental(spark, second, config, "2").first().table_version == version
    assert rows_of(table.read()) == rows_of(daily.transform(raw(spark)))


def brute_force(rows):
    """Daily totals by plain Python: earliest copy per id (NULLs first among equals), then positive amounts."""
    first = {}
    for i, c, a, t, m in rows:
        if None in (i, c, t):
            continue
        order = (t, c, (a is not None, a or 0), m)
        if i not in first or order < first[i]:
            first[i] = order
    totals = {}
    for t, c, (known, a), _ in first.values():
        if known and a > 0:
            total, count = totals.get((c, t.date()), (Decimal(0), 0))
            totals[c, t.date()] = (total + a, count + 1)
    return sorted(((c, d, total, n) for (c, d), (total, n) in totals.items()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_batches_against_brute_force(spark, tmp_path, seed):
    draw = random.Random(seed)
    config = flow(tmp_path)
    seen = []
    for number in range(3):
        batch = [
            (
                draw.choice([None, "HOT", "HOT", "HOT", *(f"t{i}" for i in range(30))]),
                draw.choice([None, *"ABC", *"ABC"]),
                draw.choice([None, Decimal(0), Decimal("-1.50"), *(Decimal(i) / 4 for i in range(1, 40))]),
                draw.choice([None, *(datetime(2026, 3, 1 + i // 4, 6 * (i % 4)) for i in range(20))]),
                draw.choice(["X", "Y"]),
            )
            for _ in range(80)
        ]
        seen += batch
        arrived = spark.createDataFrame(batch, TX)
        run.run_incremental(spark, arrived, config, str(number))
        table = KeyedTable.daily_totals(spark, config.target)
        assert rows_of(table.read()) == brute_force(seen)
    everything = spark.createDataFrame(seen, TX)
    assert rows_of(daily.transform(everything)) == brute_force(seen)
    counts = daily.stage_counts(daily.rollup_with_counts(everything)).first()
    assert counts.raw_rows == len(seen)
    assert counts.quarantined_rows == sum(None in (i, c, t) for i, c, _, t, _ in seen)


STEPS = {"survivors": (SurvivorStore, "append"), "deltas": (SurvivorStore, "append_deltas"), "totals": (KeyedTable, "upsert"), "done": (SurvivorStore, "finish")}


@pytest.mark.parametrize("other", [False, True])
@pytest.mark.parametrize("broken", STEPS)
def test_interrupted_incremental_run_continues(spark, tmp_path, monkeypatch, broken, other):
    """A run that is lost at any step is finished by the next call, or before another batch."""
    config = flow(tmp_path)
    late = F.col("merchant") == "purchase"
    run.run_incremental(spark, originals(spark, SF).filter(~late).unionByName(copies(spark, SF)), config, "1")
    second = originals(spark, SF).filter(late)
    owner, step = STEPS[broken]
    whole = getattr(owner, step)

    def fail(self, *args, **kwargs):
        if broken in ("survivors", "deltas"):
            whole(self, *args, **kwargs)  # lost just after its work
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(owner, step, fail)
        with pytest.raises(RuntimeError, match="lost"):
            run.run_incremental(spark, second, config, "2")
    if other:
        run.run_incremental(spark, copies(spark, SF), config, "3")
    report = run.run_incremental(spark, second, config, "2").first()
    assert report.source_rows == (0 if other else second.count())
    assert rows_of(KeyedTable.daily_totals(spark, config.target).read()) == rows_of(daily.transform(raw(spark)))


def data_files(root):
    return {str(p): p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}


def test_a_batch_of_one_id_reads_one_bucket_and_rewrites_nothing(spark, tmp_path):
    config = flow(tmp_path)
    run.run_incremental(spark, dirty_tx(spark, SF), config, "1")
    store = run.survivor_table(spark, config.survivors)
    before = data_files(config.survivors)
    assert len([f for f in before if "/winners/" in f]) >= store.buckets // 2
    one = raw(spark).filter("transaction_id = 'T7'").limit(1).withColumn("timestamp", F.to_timestamp(F.lit("2020-01-01 05:00:00")))
    known = store.known(one.select("transaction_id"), "2")
    assert len(known.inputFiles()) == 1 and known.count() == 1
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(transaction_id,T7)" in plan or "In(transaction_id, [T7])" in plan
    run.run_incremental(spark, one, config, "2")
    after = data_files(config.survivors)
    assert before.items() <= after.items()  # nothing is rewritten or gone
    fresh = [f for f in after if f not in before]
    assert sum("/winners/" in f for f in fresh) == 1 and sum("/deltas/" in f for f in fresh) == 2
    assert rows_of(KeyedTable.daily_totals(spark, config.target).read()) == rows_of(daily.transform(raw(spark).unionByName(one)))


def test_survivor_files_carry_bloom_filters(spark, tmp_path):
    store = SurvivorStore(spark, str(tmp_path / "s"), buckets=1)
    rows = generate.generate_transactions(spark, 20_000, AS_OF).drop("row_no")
    store.append(rows, "1")
    scan = spark.read.parquet(f"{store.root}/winners")
    present = rows.select("transaction_id").first()[0]
    seen = lambda value: rows_read(scan.filter(F.col("transaction_id") == value))
    assert 0 < seen(present) <= 20_000 and seen("7fffffff-none") == 0  # inside the range of ids, in no row


def rows_read(df):
    """Rows that the scan of a drained frame gave, by its own metric."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_compacted_survivors_stay_the_same(spark, tmp_path):
    config = flow(tmp_path)
    late = F.col("merchant") == "purchase"
    run.run_incremental(spark, originals(spark, SF).filter(~late).unionByName(copies(spark, SF)), config, "1")
    run.run_incremental(spark, originals(spark, SF).filter(late), config, "2")
    store = run.survivor_table(spark, config.survivors)
    rows = rows_of(store.read())
    assert store.compact() > store.buckets and store.compact() == 0
    assert rows_of(run.survivor_table(spark, config.survivors).read()) == rows
    run.run_incremental(spark, dirty_tx(spark, SF), config, "3")
    assert rows_of(KeyedTable.daily_totals(spark, config.target).read()) == rows_of(daily.transform(raw(spark)))


def test_feed_of_arriving_files(spark, tmp_path):
    config = flow(tmp_path)
    conform(copies(spark, SF), RAW_TRANSACTIONS).coalesce(1).write.parquet(config.source)
    run_available(spark, config, str(tmp_path / "checkpoint"))
    conform(originals(spark, SF), RAW_TRANSACTIONS).repartition(2).write.mode("append").parquet(config.source)
    run_available(spark, config, str(tmp_path / "checkpoint"), files_per_batch=1)
    table = KeyedTable.daily_totals(spark, config.target)
    assert rows_of(table.read()) == rows_of(daily.transform(raw(spark)))
    version = table.table.version()
    run_available(spark, config, str(tmp_path / "checkpoint"))
    assert table.table.version() == version
    run_available(spark, config, str(tmp_path / "second checkpoint"))
    assert table.table.version() > version and rows_of(table.read()) == rows_of(daily.transform(raw(spark)))


# -- configuration and command line --------------------------------------------


def test_config():
    config = FlowConfig.from_env({"TXFLOW_SOURCE": "a", "TXFLOW_TARGET": "b", "TXFLOW_MIN_ROWS": "3"})
    assert (config.source, config.target, config.min_result_rows) == ("a", "b", 3)
    with pytest.raises(ValueError):
        FlowConfig.from_env({})
    assert spark_settings(10**14, 8000)["spark.sql.shuffle.partitions"] == "745059"
    assert spark_settings(10, 8)["spark.sql.shuffle.partitions"] == "8"


def test_command_line(spark, tmp_path, capsys):
    table, target = str(tmp_path / "raw"), str(tmp_path / "totals")
    at = ["--as-of", "2026-03-15T12:00:00"]
    main(["generate", "--table", table, "--sample-csv", str(tmp_path / "csv"), *at])
    assert VersionedTable(spark, table).read().count() == 1260
    main(["run", "--source", table, "--target", target])
    main(["update", "--table", table, "--where", "customer_id = 'C00001'", "amount=amount + 1"])
    main(["delete", "--table", table, "--where", "amount < 0"])
    VersionedTable(spark, table).read().limit(1).withColumn("transaction_id", F.lit("NEW-1")).write.parquet(str(tmp_path / "new"))
    main(["merge", "--table", table, "--source", str(tmp_path / "new"), "--keys", "transaction_id"])
    capsys.readouterr()
    main(["history", "--table", table])
    assert [json.loads(x)["operation"] for x in capsys.readouterr().out.splitlines()] == ["MERGE", "DELETE", "UPDATE", "WRITE"]
    main(["vacuum", "--table", table, "--hours", "0"])
    assert VersionedTable(spark, table).version() == 3
    main(["sample-totals", "--target", target, "--customers", "10", "--days", "2", *at])
    capsys.readouterr()
    main(["lookup", "--target", target, "--customer", "C00001"])
    assert "2026-03-15" in capsys.readouterr().out


def test_lookup_prints_every_day(spark, tmp_path, capsys):
    days = [(date(2024, 1, 1) + timedelta(days=d), Decimal(d + 1)) for d in range(40)]
    rows = spark.createDataFrame([("C1", d, v, 1) for d, v in days], "customer_id string, transaction_date date, daily_total decimal(18,2), transaction_count bigint")
    KeyedTable.daily_totals(spark, str(tmp_path / "t")).upsert(rows)
    main(["lookup", "--target", str(tmp_path / "t"), "--customer", "C1"])
    assert len(capsys.readouterr().out.splitlines()) == 40


def test_environment_reaches_the_command_line(spark, tmp_path, capsys, monkeypatch):
    raw(spark).write.parquet(str(tmp_path / "raw"))
    monkeypatch.setenv("TXFLOW_SOURCE", str(tmp_path / "raw"))
    monkeypatch.setenv("TXFLOW_TARGET", str(tmp_path / "totals"))
    monkeypatch.setenv("TXFLOW_VALIDATE_FIRST", "true")
    main(["run", "--quarantine", str(tmp_path / "q")])
    assert json.loads(capsys.readouterr().out)["status"] == "pass"
    stored = KeyedTable.daily_totals(spark, str(tmp_path / "totals")).read()
    assert rows_of(stored) == rows_of(daily.transform(raw(spark), validate_first=True))


def test_feed_of_single_rows_is_not_stuck(spark, tmp_path):
    """Fewer keys than the gate asks for: the run warns, and later files are still taken."""
    config = replace(flow(tmp_path), min_result_rows=10)
    for n in range(3):
        conform(raw(spark).filter(f"transaction_id = 'T{n + 3}'").limit(1), RAW_TRANSACTIONS).coalesce(1).write.mode("append").parquet(config.source)
        run_available(spark, config, str(tmp_path / "checkpoint"), files_per_batch=1)
    assert run.survivor_table(spark, config.survivors).read().count() == 3


def test_incremental_quarantine_and_order_of_validation(spark, tmp_path):
    at = datetime(2024, 1, 1, 8)
    rows = [("a", "C", Decimal(0), at, "M"), ("a", "C", Decimal(7), at + timedelta(hours=1), "M"), ("b", "C", Decimal(-1), at, "M")]
    for first in (True, False):
        root = tmp_path / str(first)
        config = FlowConfig("", f"{root}/t", f"{root}/s", quarantine=f"{root}/q", min_result_rows=1, validate_first=first)
        run.run_incremental(spark, spark.createDataFrame(rows, TX), config, "1")
        totals = [r.daily_total for r in KeyedTable.daily_totals(spark, config.target).read().collect()]
        left_out = sorted(r.transaction_id for r in spark.read.parquet(f"{root}/q/run=1").collect())
        assert (totals, left_out) == (([Decimal("7.00")], ["b"]) if first else ([], ["a", "b"]))
