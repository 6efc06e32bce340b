"""Every query against its SQL twin, on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from workload.oracle import ORACLE
from workload.queries import QUERIES

FOLDER = entry.FLAGSHIP_DATA
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in columns) for r in df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    expected = sorted(tuple(str(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert got == expected


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
