"""Session settings that fit the size of a table, while one job runs."""

from __future__ import annotations

import threading
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SPLIT_SIZE = "spark.sql.files.maxPartitionBytes"

MB, GB = 1024**2, 1024**3
# Source bytes one reduce task should group, so that it need not spill.
PARTITION_BYTES = 512 * MB
# Scan tasks to aim for at most, and how large one may get for it.
SCAN_TASKS, LARGEST_SPLIT = 65_536, GB
# Shuffle blocks, scan tasks times reduce tasks, that the drivers' and the
# shuffle services' tables should hold at most.
SHUFFLE_BLOCKS = 4_000_000_000
# Spark's estimate for a source of unknown size is far above any real table.
UNKNOWN_BYTES = 1024**6

_staging = threading.Lock()


def estimated_bytes(df: DataFrame) -> int | None:
    """Bytes of what `df` reads, by Catalyst's statistics of its scans (for
    files, their listed sizes), or None if one is unknown. The scans are added
    up, as the estimate for a join of them may be their product."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(leaves.apply(at).stats().sizeInBytes()) for at in range(leaves.size()))
    return size if size < UNKNOWN_BYTES else None


@dataclass(frozen=True)
class ShuffleSize:
    """How a table is cut for one full-row shuffle."""

    split_bytes: int
    partitions: int


def shuffle_size(size: int, split_bytes: int, partitions: int) -> ShuffleSize:
    """Settings for a source of `size` stored bytes, never below the given ones.

    One reduce task per PARTITION_BYTES, as long as the blocks between scan
    and reduce tasks stay below SHUFFLE_BLOCKS. Scan tasks grow first, up to
    LARGEST_SPLIT; then reduce tasks get larger, which costs them spilling but
    not failing, as the aggregation sorts on disk what does not fit. Stored
    bytes of a compressed source stand for about three times as much in
    memory.
    """
    split = max(split_bytes, min(LARGEST_SPLIT, ceil(size / SCAN_TASKS)))
    maps = max(1, ceil(size / split))
    wanted = min(ceil(size / PARTITION_BYTES), SHUFFLE_BLOCKS // maps)
    return ShuffleSize(split, max(partitions, wanted))


def _bytes_of(setting: str) -> int:
    """Spark's spelling of a size: a number of bytes, or one with a unit."""
    units = {"b": 1, "k": 1024, "kb": 1024, "m": MB, "mb": MB, "g": GB, "gb": GB}
    text = setting.strip().lower()
    digits = text.rstrip("bkmg")
    return int(digits) * units[text[len(digits) :] or "b"]


@contextmanager
def staging_settings(
    spark: SparkSession, source: DataFrame, source_bytes: int | None = None
) -> Iterator[None]:
    """Settings for the job that shuffles `source` once and stages the result.

    With the default of 200 shuffle partitions a table of many terabytes would
    put hundreds of gigabytes into each reduce task; adaptive execution can
    merge partitions that turn out small, but cannot split an aggregation's.
    `source_bytes` gives the size of a source that Spark does not know; without
    it such a source keeps the session's numbers, with a warning.

    Two open writers, for the two folders of the staged table, spare a sort of
    all rows by folder. The settings belong to the session, so runs that share
    a process must not overlap; a second one fails at once.
    """
    if not _staging.acquire(blocking=False):
        raise RuntimeError("another run is staging; runs of one process must not overlap")
    partitions = (
        INITIAL_PARTITIONS if spark.conf.get(INITIAL_PARTITIONS, None) else SHUFFLE_PARTITIONS
    )
    before = {key: spark.conf.get(key) for key in (partitions, OPEN_WRITERS, SPLIT_SIZE)}
    try:
        wanted = {OPEN_WRITERS: max(2, int(before[OPEN_WRITERS]))}
        size = estimated_bytes(source) if source_bytes is None else source_bytes
        if size is None:
            warnings.warn(
                f"the size of the source is unknown; {partitions} stays {before[partitions]}. "
                "Give source_bytes",
                stacklevel=3,
            )
        else:
            fit = shuffle_size(size, _bytes_of(before[SPLIT_SIZE]), int(before[partitions]))
            wanted |= {partitions: fit.partitions, SPLIT_SIZE: fit.split_bytes}
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
        _staging.release()
