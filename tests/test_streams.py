"""The stateful stream against the batch transform."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txflow.plans import daily
from txflow.plans.fixtures import copies, dirty_tx, originals
from txflow.schemas import RAW_TRANSACTIONS, conform
from txflow.streaming import stateful

SF = "/root/testdata/sf0.001"
TX = "transaction_id string, customer_id string, amount decimal(18,2), timestamp timestamp, merchant string"
AT = datetime(2026, 3, 1, 12)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def arrive(df, config):
    conform(df, RAW_TRANSACTIONS).coalesce(1).write.mode("append").parquet(config.source)


def config_at(tmp_path, **more):
    return stateful.StreamConfig(str(tmp_path / "in"), str(tmp_path / "out"), **more)


def test_three_files_one_late_equal_the_batch(spark, tmp_path):
    """Late copies that are the earlier ones, within the watermark; everything closes at the end."""
    config = config_at(tmp_path, delay="40 days")
    late = F.col("merchant") == "purchase"
    for part in (copies(spark, SF), originals(spark, SF).filter(~late), originals(spark, SF).filter(late)):
        arrive(part, config)
        stateful.run_available(spark, config)
    assert stateful.totals(spark, config).isEmpty()  # nothing is final yet
    stateful.run_available(spark, config, close_at=datetime(2027, 1, 1))
    expected = daily.transform(conform(dirty_tx(spark, SF), RAW_TRANSACTIONS))
    assert rows_of(stateful.totals(spark, config)) == rows_of(expected)
    assert stateful.quarantined(spark, config).isEmpty()
    stateful.run_available(spark, config)
    assert rows_of(stateful.totals(spark, config)) == rows_of(expected)


def test_rows_beyond_the_watermark_are_quarantined(spark, tmp_path):
    config = config_at(tmp_path, delay="2 days", horizon="3 days")

    def row(name, days, amount="1.00", customer="C1"):
        return (name, customer, Decimal(amount), AT + timedelta(days=days), "M")

    first = [row("a", 0), row("b", 5), row("b", 6, "9.00"), row("z", 5, "0.00")]
    second = [row("a", 1, "7.00"), row("c", 3), row("d", 4), row("b", 4.5, "2.50"), (None, "C1", Decimal(1), AT, "M"), ("k", None, None, AT, "M")]
    third = [row("e", 20), row("f", 19), row("c", 9, "4.00")]
    for rows in (first, second, third):
        arrive(spark.createDataFrame(rows, TX), config)
        stateful.run_available(spark, config)
    got = {(r.transaction_id, r.reject_reason, r.epoch) for r in stateful.quarantined(spark, config).collect()}
    assert got == {("a", "beyond_watermark", 1), ("c", "beyond_watermark", 1), (None, "null_transaction_id", 1), ("k", "null_customer_id", 1)}
    stateful.run_available(spark, config, close_at=AT + timedelta(days=60))
    out = {("a", 1), ("c", 3)}
    kept = [r for r in [*first, *second, *third] if None not in r and (r[0], (r[3] - AT).days) not in out]
    expected = daily.transform(spark.createDataFrame(kept, TX))
    assert rows_of(stateful.totals(spark, config)) == rows_of(expected)
    assert ("C1", (AT + timedelta(days=4.5)).date(), Decimal("2.50"), 1) in rows_of(expected)  # the earliest copy of b


def test_what_is_final_appears_before_the_end(spark, tmp_path):
    config = config_at(tmp_path, delay="1 day", horizon="2 days")
    for day in (0, 10, 20):
        arrive(spark.createDataFrame([(f"t{day}", "C1", Decimal("3.00"), AT + timedelta(days=day), "M")], TX), config)
        stateful.run_available(spark, config)
    assert [r.transaction_date.day for r in stateful.totals(spark, config).orderBy("transaction_date").collect()] == [1, 11]


@pytest.mark.parametrize("per_batch", [None, 1])
def test_a_repeated_admission_changes_nothing(spark, tmp_path, monkeypatch, per_batch):
    config = config_at(tmp_path, delay="40 days", files_per_batch=per_batch)
    arrive(dirty_tx(spark, SF), config)
    arrive(copies(spark, SF), config)
    real = stateful.storage.create_text

    def lost(spark, path, text):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(stateful.storage, "create_text", lost)
        with pytest.raises(Exception, match="lost"):
            stateful.admit(spark, config)
    assert stateful.storage.create_text is real
    stateful.run_available(spark, config)
    stateful.run_available(spark, config, close_at=datetime(2027, 1, 1))
    assert rows_of(stateful.totals(spark, config)) == rows_of(daily.transform(conform(dirty_tx(spark, SF), RAW_TRANSACTIONS)))


def test_an_empty_stream(spark, tmp_path):
    config = config_at(tmp_path)
    arrive(spark.createDataFrame([], TX), config)
    stateful.run_available(spark, config)
    assert stateful.totals(spark, config).isEmpty() and stateful.quarantined(spark, config).isEmpty()
