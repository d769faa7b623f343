"""Every query with SQL gives what DuckDB gives on the smallest tables; the others run."""

import os

import duckdb
import pytest

from sievework import catalogue

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(FOLDER):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{f}'")
    return c


def plain(rows):
    return sorted(tuple("None" if v is None else repr(round(v, 9)) if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = plain(df.select(*cols).collect())
    if name not in catalogue.ORACLES:
        assert got
        return
    r = duck.execute(catalogue.ORACLES[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == plain([tuple(row[i] for i in at) for row in r.fetchall()])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
