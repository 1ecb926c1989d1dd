"""Every query against its SQL, and the shape of the plans."""

import duckdb
import pytest

import __spark_entry__ as entry
from checks.compare import TABLES, compare
from conftest import SMALL

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    verdict = compare(spark, con, QUERIES[name], SQL.get(name), SMALL)
    assert not verdict.startswith("BAD"), verdict


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.endswith(("_stream", "_stream_median"))])
def test_plan_has_no_python_and_no_product(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "CartesianProduct",
                     "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
