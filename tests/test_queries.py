"""Every registered query against its SQL: column names, types, row count and values."""

import datetime as dt
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

SF = os.environ.get("QUAYSIDE_TEST_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}
QUERIES, ORACLE = queries(), oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    got = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    if name not in ORACLE:
        assert got.columns
        return
    result = db.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    want = result.fetchall()
    assert sorted(got.columns) == sorted(columns)
    ours = {c: TYPES.get(t, t) for c, t in got.dtypes}
    assert ours == types
    order = sorted(columns)
    mine = Counter(tuple(plain(r[got.columns.index(c)]) for c in order) for r in rows)
    theirs = Counter(tuple(plain(r[columns.index(c)]) for c in order) for r in want)
    assert sum(mine.values()) == sum(theirs.values())
    assert mine == theirs
    assert rows or name == "may be empty"


def test_oracle_has_no_stray_names():
    assert set(ORACLE) <= set(QUERIES)
