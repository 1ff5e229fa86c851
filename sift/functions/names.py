"""Column names as the rule file spells them.

A rule file may spell a column in another case than the source, may put it
in back quotes, and may name a column that holds a dot.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def case_sensitive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"


def bare(name: str) -> str:
    """The name without the back quotes the rule file may have put around it."""
    if len(name) > 2 and name[0] == name[-1] == "`":
        return name[1:-1].replace("``", "`")
    return name


def column(name: str) -> Column:
    """Reference a top-level column, whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def find(name: str, columns: Sequence[str], exact_case: bool) -> int | None:
    """Position of `name` in `columns`, or None; exact spelling is preferred."""
    for wanted in (name, bare(name)):
        if wanted in columns:
            return columns.index(wanted)
    if not exact_case:
        lowered = [c.lower() for c in columns]
        if bare(name).lower() in lowered:
            return lowered.index(bare(name).lower())
    return None


def repeated(names: Iterable[str], exact_case: bool) -> list[str]:
    """Names that occur more than once."""
    seen: set[str] = set()
    again = []
    for name in names:
        key = bare(name) if exact_case else bare(name).lower()
        if key in seen:
            again.append(name)
        seen.add(key)
    return again
