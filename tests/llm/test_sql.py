"""The registered queries that SQL can express, against DuckDB; and that all of them are registered."""

import duckdb
import pytest

import __spark_entry__ as entry
from estuary.llm.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(entry.queries()) >= {*QUERIES, "pipeline"} and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    
    def nulls_last(row):
        return [(x is None, x) for x in row]

    assert sorted(map(tuple, got.select(*names).collect()), key=nulls_last) == sorted(want.fetchall(), key=nulls_last)
