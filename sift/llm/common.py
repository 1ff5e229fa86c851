"""What the operators of this folder share: text rules and staged tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sift.sources.scratch import drop_path, scratch_path

# A word is a run without blanks; the blanks are space, tab, \n, \v, \f, \r.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def text_key(column: str) -> Column:
    """A 128-bit digest of a text as it is, null as empty; to find it again by."""
    return F.unhex(F.md5(text_or_empty(column)))


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_PATTERN)).cast("bigint")


# Rows and bytes that travel to and from Python at once.
BATCH_ROWS, BATCH_BYTES = 1000, 8 * 2**20


def bound_batches(spark: SparkSession) -> None:
    """Keep what an executor holds outside the heap small while texts travel.

    Spark's own batches take up to 64 MB of texts, several times over on both
    sides. Only the session can set this, and a lazy result needs it when it
    is used, so the session keeps the lower limits. Results don't depend on
    them.
    """
    limits = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": (BATCH_ROWS, 10_000),
        "spark.sql.execution.arrow.maxBytesPerBatch": (BATCH_BYTES, 64 * 2**20),
    }
    for key, (most, default) in limits.items():
        held = spark.conf.get(key, None) or ""
        now = int(held) if held.isdigit() else default
        if not 0 < now <= most:
            spark.conf.set(key, most)


# Paths of the tables staged since `staged_tables` was entered, if it was.
_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def staged_tables() -> Iterator[list[str]]:
    """Collects the paths of what is staged inside, for `drop_staged`."""
    paths: list[str] = []
    token = _staged.set(paths)
    try:
        yield paths
    finally:
        _staged.reset(token)


def drop_staged(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables that nothing reads any more."""
    for path in paths:
        drop_path(spark, path)


# Spark deletes what a job has shuffled when it ends, not when the driver's heap is tidied.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping(spark: SparkSession, *kept: str) -> Iterator[None]:
    """Of the tables staged inside, only those labelled as in `kept` stay, and
    what their jobs shuffle goes with these. No lazy frame may need the others."""
    held = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    done: list[str] = []
    paths: list[str] = []
    try:
        with staged_tables() as paths:
            yield
        done = [p for p in paths if p.rsplit("/", 1)[-1].rsplit("-", 1)[0] not in kept]
        drop_staged(spark, done)
    finally:
        if held is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, held)
        if (outer := _staged.get()) is not None:
            outer += [p for p in paths if p not in done]


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to shared storage and read it back.

    Cuts the lineage, so that a lost executor costs a read and not the jobs
    before, and gives adaptive execution true sizes.
    """
    bound_batches(df.sparkSession)
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    if (paths := _staged.get()) is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str, size: int = 2**21) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch whose values of `column` take about `size` bytes.

    Keeps what a task builds from a batch small, however long its texts are;
    a single longer row is a piece of its own.
    """
    held = batch.column(batch.schema.get_field_index(column)).nbytes
    rows = max(1, int(len(batch) * size / max(held, 1)))
    for at in range(0, len(batch), rows):
        yield batch.slice(at, rows)
