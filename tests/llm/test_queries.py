import os

import pytest

from nightledger.llm import queries as q

FOLDER = "/root/testdata/sf0.001"


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
@pytest.mark.parametrize("name", sorted(q.SQL))
def test_queries_as_sql(spark, tables, name):
    df = q.QUERIES[name](spark, FOLDER)
    columns = ", ".join(f'"{c}"' for c in df.columns)
    assert told(tuple(r) for r in df.collect()) == told(tables.execute(f"select {columns} from ({q.SQL[name]})").fetchall())
