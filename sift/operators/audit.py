"""Counts of a run and the audit row made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sift.operators.rules import DUPLICATE
from sift.operators.split import ledger_rows_per_row, surplus
from sift.operators.tally import COPIES, FAILED, Tally

AUDIT_COLUMNS = ("tablename", "sourcecount", "rejectcount", "writtencount", "loadtimestamp")


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value.cast("bigint")), F.lit(0).cast("bigint"))


def counts(t: Tally) -> DataFrame:
    """One row of counts.

    `overlap` is what keeps the audit from adding up when a row fails more
    than one rule: source = reject + written - overlap. `largest` is the most
    ledger rows any one distinct row has.
    """
    return t.frame.agg(*(column.alias(name) for name, column in count_columns().items()))


def count_columns() -> dict[str, Column]:
    """The aggregates over a tally that `counts` gives."""
    return {
        "sourcecount": _total(F.col(COPIES)),
        "uniquecount": F.count(F.lit(1)),
        "rejectcount": _total(ledger_rows_per_row()),
        "writtencount": F.count_if(F.col(FAILED) == 0),
        "overlap": _total(F.greatest(F.col(FAILED) - 1, F.lit(0))),
        "largest": F.coalesce(F.max(ledger_rows_per_row()), F.lit(0).cast("bigint")),
    }


def reason_counts(t: Tally) -> DataFrame:
    """Ledger rows per reason that occurs, counted without building the ledger."""
    reasons = (DUPLICATE, *t.reasons)
    totals = t.frame.agg(
        _total(surplus()).alias("n0"),
        *(_total(t.count_of(text)).alias(f"n{at}") for at, text in enumerate(t.reasons, 1)),
    )
    pairs = (
        F.struct(F.lit(text).alias("reject_reason"), F.col(f"n{at}").alias("rows"))
        for at, text in enumerate(reasons)
    )
    return totals.select(F.inline(F.array(*pairs))).filter(F.col("rows") > 0)


def audit_row(counted: DataFrame, table: str) -> DataFrame:
    """The audit record: table, source, reject and written counts, load time."""
    return counted.select(
        F.lit(table).alias("tablename"),
        "sourcecount",
        "rejectcount",
        "writtencount",
        F.current_timestamp().alias("loadtimestamp"),
    )


def fixed_audit_row(spark: SparkSession, measured: dict, table: str) -> DataFrame:
    """The audit record of a finished run; its load time no longer moves."""
    values = {**measured, "tablename": table}
    row = tuple(values[name] for name in AUDIT_COLUMNS)
    return spark.createDataFrame(
        [row],
        "tablename string, sourcecount bigint, rejectcount bigint, writtencount bigint, "
        "loadtimestamp timestamp",
    ).coalesce(1)
