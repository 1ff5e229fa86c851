"""The registered queries against SQL, or that they give a row per document."""

import ast
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from helpers import SF_DIR

import __spark_entry__ as entry_points
from sift.llm.queries import ORACLES, QUERIES

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "conversations", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def test_all_are_registered():
    assert QUERIES.items() <= entry_points.queries().items()
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 11)} | {"op11", "op12", "op13"}
    assert "pipeline" in entry_points.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
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


def test_nothing_else_imports_this_subpackage():
    for path in [*ROOT.glob("sift/**/*.py"), *ROOT.glob("workload/*.py"), ROOT / "bench.py"]:
        if "llm" in path.parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [getattr(node, "module", None) or ""] if isinstance(node, ast.ImportFrom) else []
            names += [a.name for a in getattr(node, "names", [])] if isinstance(node, ast.Import) else []
            assert not any("llm" in n for n in names), path
