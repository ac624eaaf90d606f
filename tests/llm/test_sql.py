import pytest

from lakemart.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{SF_DIR}/{table}.parquet')")
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    wanted = con.execute(ORACLES[name])
    found = [d[0] for d in wanted.description]
    assert sorted(found) == columns
    order = [found.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in order) for r in wanted.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == want
