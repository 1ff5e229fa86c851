"""Turn counts back into rows without putting a hot row into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Copies up to which a record is repeated where it lies.
HOT = 1_000
# Copies made from one record in one go; a hot record travels as several
# chunks, which the exchange deals out to different tasks.
CHUNK = 100_000


def repeat_rows(df: DataFrame, times: Column, ordinal: str, *, hot: bool = True) -> DataFrame:
    """Repeat every row `times` times, numbered 1.. in `ordinal`.

    Rows with up to HOT copies are repeated in place; only rows with more
    travel, in chunks, to as many tasks as the session's shuffles have. Both
    arms are read off the same shuffle below. The number of tasks is explicit
    because adaptive coalescing would judge the chunks by their bytes, not by
    the rows they stand for. Without `hot` nothing travels, for callers that
    know no row has many copies.
    """
    counted = df.withColumn("_times", times.cast("bigint"))
    one_by_one = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times")))
    few = counted.filter(F.col("_times").between(1, HOT) if hot else F.col("_times") > 0)
    few = few.withColumn(ordinal, one_by_one).drop("_times")
    if not hot:
        return few
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashable = [F.col(f.name) for f in df.schema if not _holds_map(f.dataType)]
    first = F.col("_chunk") * CHUNK + 1
    last = F.least(F.col("_times"), (F.col("_chunk") + 1) * CHUNK)
    many = (
        counted.filter(F.col("_times") > HOT)
        .withColumn("_chunk", F.explode(F.expr(f"sequence(0L, (_times - 1) div {CHUNK})")))
        .repartition(tasks, "_chunk", *hashable)
        .withColumn(ordinal, F.explode(F.sequence(first, last)))
        .drop("_times", "_chunk")
    )
    return few.union(many)


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype)
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    return isinstance(dtype, T.MapType)
