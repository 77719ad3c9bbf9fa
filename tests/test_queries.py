"""Every linkage query against its SQL, on the smallest tables."""

import duckdb
import pytest

from kinveil.plans.linkage import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    rows = sorted((str(tuple(r[c] for c in columns)) for r in got.collect()))
    if name not in SQL:
        assert rows
        return
    con = duckdb.connect()
    for t in ("customer", "part", "orders", "documents"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    cur = con.execute(SQL[name])
    at = [d[0] for d in cur.description]
    assert sorted(at) == columns
    assert rows == sorted(str(tuple(r[at.index(c)] for c in columns)) for r in cur.fetchall())
