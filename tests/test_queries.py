"""Every query with SQL is held against DuckDB on the smallest tables."""

import glob
import os

import pytest

from plumbline.plans.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(rows):
    number = lambda v: float(v) if hasattr(v, "as_tuple") else v
    return sorted(([number(v) for v in r] for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    at = [names.index(c) for c in sorted(names)]
    assert plain(tuple(r[c] for c in sorted(df.columns)) for r in df.collect()) == plain(tuple(r[i] for i in at) for r in result.fetchall())
