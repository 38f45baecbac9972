"""Every registered query against its SQL, on the given tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from suite.oracle import ORACLE
from suite.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return c


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(([_plain(r[i]) for i in order] for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = con.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    ours, theirs = _sorted(df.columns, df.collect()), _sorted(names, cursor.fetchall())
    assert theirs, "an empty result compares nothing"
    assert ours == theirs
    assert [type(v) for v in ours[0] if v is not None] == [
        type(v) for v in theirs[0] if v is not None
    ]


def test_entry(spark):
    assert entry.entry(spark).count() == 2
