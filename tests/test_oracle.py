"""Every query of the library's own operators against its SQL on the smallest tables."""

import datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_point
from plumbmart.queries.catalog import QUERIES, SQL
from plumbmart.queries.inputs import TABLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, Decimal):
        return format(value.normalize(), "f") if value else "0"
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ")
    return str(value)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(SQL[name])
    want = table([d[0] for d in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


KINDS = {"string": "VARCHAR", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_types_agree(spark, duck, name):
    """The same column types on both sides, so that a hash of values can agree."""
    fields = QUERIES[name](spark, FOLDER).schema.fields
    got = {f.name: KINDS.get(k := f.dataType.simpleString(), k.upper()) for f in fields}
    want = {r[0]: r[1] for r in duck.execute("describe " + SQL[name]).fetchall()}
    assert got == want


def test_entry(spark):
    assert entry_point.entry(spark).count() == 5
