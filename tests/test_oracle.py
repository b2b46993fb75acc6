"""Every registered query against its SQL twin on whole tables."""

import math
import os

import duckdb
import pytest

from samples import TABLES
from tidemark.plans.registered import load_all

QUERIES, SQL = load_all()
SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, spark, duck):
    df = QUERIES[name](spark, SF_DIR)
    found = df.collect()
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    wanted = cursor.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert len(found) == len(wanted)
    mine, theirs = rows_of(df.columns, found), rows_of(names, wanted)
    different = [(a, b) for a, b in zip(mine, theirs) if a != b]
    assert not different, different[:5]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(name, spark):
    assert QUERIES[name](spark, SF_DIR).count() > 0
