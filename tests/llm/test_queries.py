"""Every query runs whole; those with SQL equal it."""

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from txflow.llm import catalog

from .conftest import SF

ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in sorted(Path(SF).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in entry_points.queries() if re.match(r"op\d+_|pipeline$", n)]
    assert sorted(n.split("_")[0] for n in names) == sorted([*(f"op{k}" for k in range(1, 14)), "pipeline"])
    assert set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    order = sorted(names)
    assert sorted(df.columns) == order
    plain = lambda rows, at: sorted(str([row[at(c)] for c in order]) for row in rows)
    assert plain(df.collect(), df.columns.index) == plain(expected, names.index)


NATIVE = ("op1_imatch", "op2_licenses", "op8_quality")


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, name):
    plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)
