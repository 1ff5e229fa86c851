"""Rows that share a key: one is accepted, the others go to the ledger."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from sift.operators import tally as tallies
from sift.operators.rules import REPEATED_KEY
from sift.operators.tally import FAILED, Tally


def one_per_key(t: Tally, keys: Sequence[str], latest: Sequence[Column]) -> Tally:
    """Fail all rows of a key but one, among those that pass every other rule.

    The row with the largest values of `latest` stays, NULL being the
    smallest; among equals the one whose whole row is the largest, so the
    choice doesn't depend on how rows are dealt out. NULL keys equal each
    other. A key whose rows all fail otherwise has no row that stays.

    The largest row per key comes from a grouping that is combined before the
    shuffle, so a key that a third of the rows share costs each task one
    record. Only keys with two or more rows are joined back.
    """
    named = [t.position(name) for name in keys]
    rank = F.struct(
        *(column.alias(f"o{at}") for at, column in enumerate(latest)),
        *(F.col(f"c{at}") for at in range(len(t.columns))),
    )
    # A condition inside the aggregates rather than a filter: Catalyst would
    # take minutes to see what a filter on a sum of twenty rules implies.
    passing = F.col(FAILED) == 0
    groups = (
        t.frame.groupBy(*(column.alias(f"k{at}") for at, column in enumerate(named)))
        .agg(F.max(F.when(passing, rank)).alias("_first"), F.count_if(passing).alias("_rows"))
        .filter("_rows > 1")
        .drop("_rows")
    )
    same = [column.eqNullSafe(F.col(f"k{at}")) for at, column in enumerate(named)]
    loses = F.coalesce(passing & (rank < F.col("_first")), F.lit(False))
    reason = f"r{len(t.reasons)}"
    changed = {reason: loses.cast("int"), FAILED: F.col(FAILED) + loses.cast("int")}
    if t.by_rule:
        number, bit = divmod(len(t.rules), tallies.BITS)
        before = F.col(f"b{number}") if bit else F.lit(0).cast("bigint")
        mine = F.when(loses, F.lit(1 << bit).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        changed[f"b{number}"] = before.bitwiseOR(mine)
    frame = t.frame.join(groups, same, "left").withColumns(changed)
    return replace(
        t,
        frame=frame.drop("_first", *(f"k{at}" for at in range(len(keys)))),
        reasons=(*t.reasons, REPEATED_KEY),
        passes=F.col(FAILED) == 0,
        marked=None,
        counted=None,
        rules=(*t.rules, (REPEATED_KEY, ", ".join(keys))) if t.by_rule else (),
    )
