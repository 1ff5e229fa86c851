"""Small tables for the operators' tests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

SF_DIR = "/root/testdata/sf0.01"


def table(spark: SparkSession, rows: Iterable, schema: str = "doc_id bigint, text string") -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def with_clashes(df: DataFrame, *names: str) -> DataFrame:
    """Extra columns that an operator may use as names of its own."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit(f"mine {n}") for n in names})


def by_id(df: DataFrame, name: str = "doc_id") -> dict:
    return {r[name]: r for r in df.collect()}


def components_of(nodes: Iterable, links: Iterable[tuple]) -> dict:
    """The smallest node each node is connected with, by hand."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in parent}
