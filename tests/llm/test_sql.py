import glob
import os

import duckdb
import pytest

from gridloom.llm import queries

SF = "/root/testdata/sf0.001"


def rows(names, values):
    at = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr([v[i] for i in at]) for v in values)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    found, expected = queries.QUERIES[name](spark, SF), con.execute(queries.SQL[name])
    assert rows(found.columns, found.collect()) == rows([c[0] for c in expected.description], expected.fetchall())
