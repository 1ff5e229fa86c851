"""The gate's outputs by their set definition, in Spark SQL.

Window, union of branches and multiset difference: one scan and one full-row
shuffle per branch. Tests check the tally against it, the benchmark times the
two against each other. It needs ANSI mode off, as its rules rely on Spark's
lenient implicit casts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from sift.operators.rules import BAD_DATE, DUPLICATE, NEGATIVE, NULL
from sift.sources.rulefile import REASON_COLUMN


def set_form(
    source: DataFrame,
    null_check: Sequence[str],
    no_negative_value: Sequence[str],
    dateformatchecks: Sequence[str],
) -> tuple[DataFrame, DataFrame]:
    """(accepted, ledger)."""
    columns = ", ".join(f"`{c}`" for c in source.columns)
    failing = (
        [(NULL, f"`{c}` IS NULL") for c in null_check]
        + [(NEGATIVE, f"`{c}` < 0") for c in no_negative_value]
        + [
            (BAD_DATE, f"date_format(`{c}`, 'yyyy-MM-dd') IS NULL")
            for c in dateformatchecks
        ]
    )
    branches = " UNION ALL ".join(
        [f"SELECT {columns}, '{DUPLICATE}' AS {REASON_COLUMN} FROM ranked WHERE copy_no > 1"]
        + [
            f"SELECT {columns}, '{reason}' FROM ranked WHERE copy_no = 1 AND {test}"
            for reason, test in failing
        ]
    )
    ranked = (
        "WITH ranked AS (SELECT *, row_number() OVER "
        f"(PARTITION BY {columns} ORDER BY `{source.columns[0]}`) AS copy_no FROM {{source}})"
    )
    spark = source.sparkSession
    ledger = spark.sql(f"{ranked} {branches}", source=source)
    accepted = spark.sql(
        f"SELECT * FROM {{source}} EXCEPT ALL SELECT {columns} FROM {{ledger}}",
        source=source,
        ledger=ledger,
    )
    return accepted, ledger
