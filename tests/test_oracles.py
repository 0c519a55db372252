"""Every registered query of the library against its DuckDB statement."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from weft.plans import catalog

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    if isinstance(value, bool) or value is None:
        return value
    return float(value) if isinstance(value, int) else str(value) if not isinstance(value, (str, bytes)) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr), [columns[k] for k in order]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(FOLDER):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_statement(spark, duck, name):
    got = entry.queries()[name](spark, FOLDER)
    mine, names = rows_of(got.columns, got.collect())
    cursor = duck.execute(catalog.ORACLES[name])
    theirs, other = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert names == other
    assert len(mine) == len(theirs)
    assert mine == theirs
