"""Every query against its SQL, at sf0.01, on names, types, row counts and values."""

import os
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from txflow.plans import catalog

SF = os.environ.get("TXFLOW_TEST_SF", "/root/testdata/sf0.01")
QUERIES, ORACLE = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in sorted(Path(SF).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def _plain(value):
    return f"{value:.2f}" if isinstance(value, Decimal) else str(value)


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


DUCK_TYPES = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "FLOAT": "float"}
DUCK_TYPES |= {"DATE": "date", "TIMESTAMP": "timestamp_ntz", "DECIMAL(18,2)": "decimal(18,2)", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    types = {d[0]: DUCK_TYPES[str(d[1])] for d in result.description}
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert dict(df.dtypes) == types
    assert _rows(df.collect(), df.columns) == _rows(expected, names)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["customer_id", "transaction_date", "daily_total", "transaction_count"]
    assert df.count() == 396


def test_known_sizes(spark):
    counts = QUERIES["stage_counts"](spark, "/root/testdata/sf0.01").first()
    assert (counts.raw_rows, counts.deduplicated_rows, counts.valid_rows, counts.aggregated_rows) == (
        10_500,
        10_000,
        9_503,
        3_942,
    )
