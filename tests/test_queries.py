"""Every registered query against its SQL, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from quern.plans import registry

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


@pytest.fixture(scope="module")
def oracle():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    return c


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    return f"{v:.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, oracle, name):
    got = registry.QUERIES[name](spark, D)
    rows = got.collect()
    if name not in registry.ORACLE_SQL:
        assert rows
        return
    sql = oracle.execute(registry.ORACLE_SQL[name])
    columns = [c[0] for c in sql.description]
    assert sorted(columns) == sorted(got.columns)
    order = sorted(columns)
    want = sorted(tuple(cell(r[columns.index(c)]) for c in order) for r in sql.fetchall())
    assert sorted(tuple(cell(r[c]) for c in order) for r in rows) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_no_nested_loops(spark):
    """Joins of tables are equi-joins; only one-row tables and lists of groups are crossed."""
    few = {"j14_grid", "d9_grid_fill"}
    for name, f in registry.QUERIES.items():
        if name[0] in "jwu" and name not in few:
            plan = f(spark, D)._jdf.queryExecution().executedPlan().toString()
            assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
