import os

import pytest

import __spark_entry__ as entry
from nightledger.plans import checks, problems, reference

FOLDER = "/root/testdata/sf0.001"
CORE = {n: m for m in (problems, reference, checks) for n in m.QUERIES}


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(CORE) <= set(entry.queries())


@pytest.fixture(scope="module")
def tables():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{FOLDER}/{f}'")
    return con


def told(rows):
    return sorted("|".join(f"{x:.9g}" if isinstance(x, float) else str(x) for x in r) for r in rows)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(CORE))
def test_queries_as_sql(spark, tables, name):
    module = CORE[name]
    df = module.QUERIES[name](spark, FOLDER)
    got = [tuple(r) for r in df.collect()]
    if name in module.SQL:
        columns = ", ".join(f'"{c}"' for c in df.columns)
        assert told(got) == told(tables.execute(f"select {columns} from ({module.SQL[name]})").fetchall())
