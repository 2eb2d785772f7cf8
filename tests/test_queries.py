"""Registered queries against their SQL, on the smallest test tables."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

from docframe.plans import catalog
from tools.check import TABLES, plain

SF = "/root/testdata/sf0.001"
NAMES = sorted(catalog.queries())

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = con.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    want = Counter(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
    assert sorted(names) == columns
    assert got == want
