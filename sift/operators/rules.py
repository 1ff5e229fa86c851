"""Row rules: what fails, and the reason the ledger gives for it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sift.functions import names
from sift.functions.coerce import TEXT_TYPES, is_moment, is_negative
from sift.sources.rulefile import GateConfig

# The reason texts of the reject ledger.
DUPLICATE = "Duplicate record"
NULL = "Null Record"
NEGATIVE = "Negative Value"
BAD_DATE = "Incorrect Dateformat"

# Reasons of checks beyond the rule file's own.
MALFORMED = "Malformed record"
REPEATED_KEY = "Duplicate key"

# The rule file's key, or the option, behind each reason.
CHECKS = {
    NULL: "null_check",
    NEGATIVE: "no_negative_value",
    BAD_DATE: "dateformatchecks",
    MALFORMED: "malformed",
    REPEATED_KEY: "duplicate_check",
}

SEMANTICS = ("legacy", "exact")


@dataclass(frozen=True)
class Rule:
    """One check on one column. `test` maps the column to "this value fails";
    a NULL answer means it does not."""

    reason: str
    column: str
    test: Callable[[Column], Column]

    def fails(self, value: Column) -> Column:
        return F.coalesce(self.test(value), F.lit(False))


def malformed_rule(column: str) -> Rule:
    """`column` holds the line of a record that doesn't fit the header, else NULL."""
    return Rule(MALFORMED, column, lambda value: value.isNotNull())


def null_rule(column: str) -> Rule:
    return Rule(NULL, column, lambda value: value.isNull())


def negative_rule(column: str, dtype: T.DataType, *, exact: bool = False) -> Rule:
    if not isinstance(dtype, TEXT_TYPES):
        return Rule(NEGATIVE, column, lambda value: value < 0)
    # A text without a minus sign is never negative, so the number is only
    # worked out for the few that have one.
    return Rule(
        NEGATIVE, column, lambda value: value.contains("-") & is_negative(value, exact=exact)
    )


def date_rule(column: str, dtype: T.DataType, *, exact: bool = False) -> Rule:
    if not isinstance(dtype, TEXT_TYPES):
        return Rule(BAD_DATE, column, lambda value: value.isNull())
    return Rule(BAD_DATE, column, lambda value: ~is_moment(value, exact=exact))


def configured_rules(
    config: GateConfig,
    schema: T.StructType,
    *,
    semantics: str = "legacy",
    case_sensitive: bool = False,
) -> list[Rule]:
    """One rule per configured (check, column): null, negative, date, each in
    the rule file's column order. A column listed twice is tested twice."""
    if semantics not in SEMANTICS:
        raise ValueError(f"semantics must be one of {SEMANTICS}, not {semantics!r}")
    exact = semantics == "exact"

    def source_fields(listed: tuple[str, ...]) -> list[T.StructField]:
        return [schema[names.find(name, schema.names, case_sensitive)] for name in listed]

    return [
        *(null_rule(f.name) for f in source_fields(config.null_check)),
        *(
            negative_rule(f.name, f.dataType, exact=exact)
            for f in source_fields(config.no_negative_value)
        ),
        *(
            date_rule(f.name, f.dataType, exact=exact)
            for f in source_fields(config.dateformatchecks)
        ),
    ]
