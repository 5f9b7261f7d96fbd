"""Every query of the library's own operators against its DuckDB SQL, at the smallest scale."""

import datetime
import glob
import os

import duckdb
import pytest

from docpack.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
SLOW = {"scan_compressed"}  # tests/test_archives.py has its formats and codecs


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def rows(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    plain = lambda x: round(x, 9) if isinstance(x, float) else x.isoformat() if isinstance(x, datetime.datetime) else x
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, tables, name):
    out = QUERIES[name](spark, SF)
    got = rows(out.columns, out.collect())
    cursor = tables.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(out.columns) == sorted(names)
    assert got == rows(names, cursor.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
