"""Every catalog query against its SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
from orolith.plans import oracle
from orolith.plans import queries as catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    return tuple(value) if isinstance(value, list) else value


@pytest.mark.parametrize("name", list(oracle.SQL))
def test_query(spark, duck, name):
    found = catalog.QUERIES[name](spark, SF)
    result = duck.execute(oracle.SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(found.columns)
    assert sorted((tuple(map(plain, r)) for r in found.select(*names).collect()), key=str) == sorted((tuple(map(plain, r)) for r in result.fetchall()), key=str)


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in oracle.SQL])
def test_query_without_sql(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(oracle.SQL) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
