"""The tally: every distinct row once, with its copies and its failures.

All outputs of the gate are read off this one frame. The full row is the
grouping key, so copies collapse before the shuffle (a row that makes up a
third of the table leaves each map task as one record), NULL equals NULL, and
the rules are worked out once per distinct row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sift.operators.rules import Rule

COPIES = "copies"
FAILED = "failed"
MARKED = "marked"
# Rules whose failures one integer column can hold, a bit each.
BITS = 62


@dataclass(frozen=True)
class Tally:
    """`frame` holds the source columns by position (`c0`, `c1`, ...), so no
    source name can clash with the counters: `copies`, `failed` (failed rules
    in all) and one count per reason (`r0`, ...). Where failures are told
    apart by rule, `b0`, ... hold a bit for each of `rules`."""

    frame: DataFrame
    columns: tuple[str, ...]
    reasons: tuple[str, ...]
    passes: Column
    marked: Column | None = None  # which stored rows have a part in the ledger
    by_rule: bool = False
    rules: tuple[tuple[str, str], ...] = ()  # (reason, column) of each bit
    counted: Mapping[str, int] | None = None  # what was observed while it was stored

    def source_columns(self) -> list[Column]:
        """The row itself, under its own names."""
        return [F.col(f"c{at}").alias(name) for at, name in enumerate(self.columns)]

    def position(self, name: str) -> Column:
        """A source column, as `frame` knows it."""
        return F.col(f"c{self.columns.index(name)}")

    def failed_rules(self) -> Column:
        """Positions in `rules` of those that a distinct row fails."""
        return F.array_compact(
            F.array(
                *(
                    F.when(F.getbit(F.col(f"b{at // BITS}"), F.lit(at % BITS)) == 1, at)
                    for at in range(len(self.rules))
                )
            )
        )

    def count_of(self, reason: str) -> Column:
        """How often a distinct row fails for a reason."""
        if reason not in self.reasons:
            return F.lit(0)
        return F.col(f"r{self.reasons.index(reason)}")

    def stage(self, path: str, observed: Mapping[str, Column] | None = None) -> Tally:
        """Write the tally once and go on from the stored table.

        Parquet rather than a cache: it survives lost executors, and each
        output reads only the columns it needs. Rows with copies or failures
        lie in a folder of their own, so the ledger reads nothing else.

        `observed` are aggregates that are worked out while the rows are
        written. The write is the last stage of its job, and Spark takes up
        what such a task has counted only once, however often it is tried.
        """
        spark = self.frame.sparkSession
        marked = (F.col(COPIES) > 1) | (F.col(FAILED) > 0)
        frame = self.frame.drop(MARKED).withColumn(MARKED, marked.cast("int"))
        watched, seen = frame, None
        if observed:
            seen = Observation()
            watched = frame.observe(seen, *(c.alias(name) for name, c in observed.items()))
        writer = watched.write.mode("overwrite").option("compression", "zstd")
        writer.partitionBy(MARKED).parquet(path)
        stored = spark.read.schema(frame.schema).parquet(path)
        return replace(
            self,
            frame=stored,
            passes=F.col(FAILED) == 0,
            marked=F.col(MARKED) == 1,
            counted=seen.get if seen else None,
        )

    def ledger_frame(self) -> DataFrame:
        """The rows the ledger is made from, and maybe others without a part."""
        return self.frame if self.marked is None else self.frame.filter(self.marked)


def tally(df: DataFrame, rules: Sequence[Rule], *, by_rule: bool = False) -> Tally:
    """Count copies and failures; `by_rule` also keeps which rules failed."""
    positions = [f"c{at}" for at in range(len(df.columns))]
    reasons = tuple(dict.fromkeys(rule.reason for rule in rules))
    failing = [
        (rule.reason, rule.fails(F.col(positions[df.columns.index(rule.column)])))
        for rule in rules
    ]
    counters = {
        f"r{at}": reduce(add, (fails.cast("int") for given, fails in failing if given == reason))
        for at, reason in enumerate(reasons)
    }
    grouped = df.toDF(*positions).groupBy(*positions).agg(F.count(F.lit(1)).alias(COPIES))
    bits = {
        f"b{first // BITS}": reduce(
            Column.bitwiseOR,
            (
                F.when(fails, F.lit(1 << at).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
                for at, (_, fails) in enumerate(failing[first : first + BITS])
            ),
        )
        for first in range(0, len(failing) if by_rule else 0, BITS)
    }
    frame = grouped.select(
        "*",
        *(counter.alias(name) for name, counter in counters.items()),
        reduce(add, counters.values(), F.lit(0)).alias(FAILED),
        *(column.alias(name) for name, column in bits.items()),
    )
    passes = reduce(and_, (~fails for _, fails in failing), F.lit(True))
    told = tuple((rule.reason, rule.column) for rule in rules) if by_rule else ()
    return Tally(frame, tuple(df.columns), reasons, passes, by_rule=by_rule, rules=told)


def failures_by_rule(t: Tally, rules: Sequence[tuple[str, Rule]]) -> DataFrame:
    """Failing distinct rows per labelled rule: (param, column_name, failures)."""
    counted = t.frame.agg(
        *(
            F.count_if(rule.fails(F.col(f"c{t.columns.index(rule.column)}"))).alias(f"n{at}")
            for at, (_, rule) in enumerate(rules)
        )
    )
    per_rule = (
        F.struct(
            F.lit(param).alias("param"),
            F.lit(rule.column).alias("column_name"),
            F.col(f"n{at}").alias("failures"),
        )
        for at, (param, rule) in enumerate(rules)
    )
    return counted.select(F.inline(F.array(*per_rule)))
