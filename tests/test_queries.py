"""Every query against its SQL twin."""

import duckdb
import pytest

import __spark_entry__ as entry
from noticemill import catalog

from .conftest import SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def rows(values, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(str(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, SMALL)
    found = rows([tuple(r) for r in df.collect()], df.columns)
    cursor = db.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert found == rows(cursor.fetchall(), names)
    assert found[1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.ORACLE_SQL) <= set(entry.oracle_sql())
