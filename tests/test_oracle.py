"""Every registered query against its SQL in DuckDB."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from workload import catalog

SF_DIR = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

QUERIES = catalog.QUERIES
ORACLES = catalog.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLES.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    order = sorted(got.columns)
    expected = duck.execute(ORACLES[name])
    titles = [d[0] for d in expected.description]
    assert sorted(titles) == order
    picks = [titles.index(c) for c in order]
    want = Counter(tuple(row[i] for i in picks) for row in expected.fetchall())
    assert want
    assert Counter(tuple(row) for row in got.select(order).collect()) == want


def test_entry(spark):
    assert entry_points.entry(spark).count() == 519
