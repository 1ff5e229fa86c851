"""Table names and dated paths, for one job or for a whole table of paths."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def table_name(path: str) -> str:
    """Last path segment up to its first dot: `/rules/orders.v2.json` -> `orders`."""
    return path.rsplit("/", 1)[-1].partition(".")[0]


def table_name_column(path: Column) -> Column:
    """`table_name` for a column of paths."""
    return F.substring_index(F.substring_index(path, "/", -1), ".", 1)


def dated(prefix: str, processed_date: str) -> str:
    """The prefix followed by the date, verbatim; no separator is added."""
    return prefix + processed_date


def dated_column(prefix: str, processed_date: Column) -> Column:
    """`dated` for a column of dates."""
    return F.concat(F.lit(prefix), processed_date)


@dataclass(frozen=True)
class GatePaths:
    """The four places one run touches."""

    source: str
    target: str
    pending: str
    audit: str
