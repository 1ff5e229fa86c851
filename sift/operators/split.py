"""Accepted rows, reject ledger, and the single branches, off one tally.

A distinct row with m copies that fails k rules has m-1 ledger rows tagged as
duplicates and k tagged by rule, and is accepted once if k is 0. That is the
multiset "source except all ledger" without the union of branches and without
the set difference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sift.operators.expand import repeat_rows
from sift.operators.rules import CHECKS, DUPLICATE
from sift.operators.tally import COPIES, FAILED, Tally
from sift.sources.rulefile import CHECK_COLUMN, CHECKED_COLUMN, REASON_COLUMN

_ORDINAL = "_ordinal"


def surplus() -> Column:
    """Copies beyond the first."""
    return F.col(COPIES) - 1


def ledger_rows_per_row() -> Column:
    return surplus() + F.col(FAILED)


def accepted_rows(t: Tally) -> DataFrame:
    """Distinct rows that pass every rule."""
    return t.frame.filter(t.passes).select(*t.source_columns())


def unique_rows(t: Tally) -> DataFrame:
    """Every distinct row once, valid or not."""
    return t.frame.select(*t.source_columns())


def reject_ledger(t: Tally) -> DataFrame:
    """One row per failure: the source columns and `reject_reason`."""
    bound = surplus()
    reason = F.when(F.col(_ORDINAL) <= bound, DUPLICATE)
    for text in t.reasons:
        bound = bound + t.count_of(text)
        reason = reason.when(F.col(_ORDINAL) <= bound, text)
    rows = repeat_rows(t.ledger_frame(), ledger_rows_per_row(), _ORDINAL)
    return rows.select(*t.source_columns(), reason.alias(REASON_COLUMN))


def explained_ledger(t: Tally) -> DataFrame:
    """The ledger with the check and the column behind each failure, both NULL
    for surplus copies. The tally must tell failures apart by rule."""
    if not t.by_rule:
        raise ValueError("this tally doesn't tell failures apart by rule")
    labels = F.array(
        F.struct(
            F.lit(DUPLICATE).alias("reason"),
            F.lit(None).cast("string").alias("check"),
            F.lit(None).cast("string").alias("column"),
        ),
        *(
            F.struct(
                F.lit(reason).alias("reason"),
                F.lit(CHECKS[reason]).alias("check"),
                F.lit(column).alias("column"),
            )
            for reason, column in t.rules
        ),
    )
    rows = repeat_rows(t.ledger_frame(), ledger_rows_per_row(), _ORDINAL)
    # the copies come first, then the failed rules in their order
    nth = (F.col(_ORDINAL) - surplus()).cast("int")
    failed = F.try_element_at(t.failed_rules(), F.greatest(nth, F.lit(1)))
    label = F.element_at(labels, F.when(nth > 0, failed + 2).otherwise(1))
    return rows.withColumn("_label", label).select(
        *t.source_columns(),
        F.col("_label.reason").alias(REASON_COLUMN),
        F.col("_label.check").alias(CHECK_COLUMN),
        F.col("_label.column").alias(CHECKED_COLUMN),
    )


def duplicate_rows(t: Tally) -> DataFrame:
    """The surplus copies, tagged."""
    return _tagged(t, surplus(), DUPLICATE, hot=True)


def rule_rejects(t: Tally, reason: str) -> DataFrame:
    """The ledger rows of one reason; a row has one per failed column."""
    return _tagged(t, t.count_of(reason), reason, hot=False)


def _tagged(t: Tally, times: Column, reason: str, *, hot: bool) -> DataFrame:
    rows = repeat_rows(t.ledger_frame(), times, _ORDINAL, hot=hot)
    return rows.select(*t.source_columns(), F.lit(reason).alias(REASON_COLUMN))


def rank_duplicates(t: Tally, *, rank: str = "rn") -> DataFrame:
    """Every source row with its number among its copies, from 1.

    The copies of a row are all alike, so numbering them needs no window.
    """
    if rank in t.columns:
        raise ValueError(f"the source has a column called {rank!r}; name another rank column")
    rows = repeat_rows(t.frame, F.col(COPIES), _ORDINAL)
    return rows.select(*t.source_columns(), F.col(_ORDINAL).alias(rank))
