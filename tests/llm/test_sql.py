"""The operators' queries against their SQL, on the smallest tables."""

import duckdb
import pytest

from quern.llm.queries import ORACLE_SQL, QUERIES

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        c.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    sql = c.execute(ORACLE_SQL[name])
    columns = sorted(x[0] for x in sql.description)
    place = [[x[0] for x in sql.description].index(n) for n in columns]
    cell = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    want = sorted([cell(r[i]) for i in place] for r in sql.fetchall())
    got = QUERIES[name](spark, D)
    assert sorted(got.columns) == columns
    assert sorted([cell(r[n]) for n in columns] for r in got.collect()) == want
