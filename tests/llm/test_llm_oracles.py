"""The queries that SQL can express give what DuckDB gives."""

import os

import duckdb
import pytest

from sievework.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    duck = duckdb.connect()
    for f in os.listdir(FOLDER):
        duck.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{f}'")
    df = queries.QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    r = duck.execute(queries.ORACLES[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert sorted(map(tuple, df.select(*cols).collect())) == sorted(tuple(row[i] for i in at) for row in r.fetchall())
