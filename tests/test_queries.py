"""Every registered query against its SQL on the smallest tables."""

import datetime as dt
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the generated tables")


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, engine, name):
    df = contract.queries()[name](spark, SF)
    got = table(df.columns, df.collect())
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert got[1]
        return
    cursor = engine.execute(sql)
    columns = [c[0] for c in cursor.description]
    assert got == table(columns, cursor.fetchall())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
