"""Mix sources to target weights by repeating documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sift.llm.common import count_words, stage, text_or_empty

# Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
# The mix holds SHARE times all words, a source at most LIMIT times its own.
SHARE = (3, 2)
LIMIT = 2
# Hash bins per source; the draw is cut at the edge of a bin.
BINS = 4096


def hash_bin(id_col: str, seed: str) -> Column:
    """A document's place in 0..BINS-1, the same in every run and engine."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("bigint") % BINS).alias("bin")


def source_plan(sized: DataFrame) -> DataFrame:
    """Per source: its words, its target, whole copies, and the bins that get one more.

    Targets are weight times a common level, but for sources that would pass
    LIMIT times their words; those stop there and the rest is shared out
    again. Taking the sources by limit over weight, a source stops if its
    limit is below the level of those not yet stopped, so one ordered pass
    gives what repeated sharing ends with. All in whole numbers, but for one
    division.

    The fraction of a copy is drawn by hash bin: bins join in order while
    that brings the source's words closer to its target, so each document has
    the fraction as its chance and the source comes within half a bin, or
    half a document, of its target.
    """
    per_bin = sized.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    totals = per_bin.groupBy("source").agg(F.sum("words").alias("source_size"))

    everything = Window.partitionBy()
    by_name = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (place + 1).cast("int"))
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    by_level = Window.partitionBy().orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(0, Window.unboundedFollowing)
    num, den = SHARE
    # level of those from here on, times den and their weight
    left = F.lit(num).cast("decimal(5,0)") * F.col("all_words") - F.lit(den * LIMIT).cast(
        "decimal(5,0)"
    ) * F.coalesce(F.sum("source_size").over(before), F.lit(0)).cast("decimal(25,0)")
    limit = F.lit(den * LIMIT).cast("decimal(5,0)") * F.col("source_size").cast("decimal(20,0)")
    plan = (
        totals.withColumn("weight", weight)
        .withColumn("all_words", F.sum("source_size").over(everything).cast("decimal(25,0)"))
        .withColumn(
            "stopped",
            (limit * F.sum("weight").over(onward).cast("decimal(12,0)"))
            <= left * F.col("weight").cast("decimal(5,0)"),
        )
    )
    stopped_words = F.sum(F.when(F.col("stopped"), F.col("source_size")).otherwise(0))
    open_weight = F.sum(F.when(F.col("stopped"), 0).otherwise(F.col("weight")))
    plan = plan.withColumn("stopped_words", stopped_words.over(everything)).withColumn(
        "open_weight", open_weight.over(everything)
    )
    shared = (
        (F.lit(num) * whole("all_words") - F.lit(den * LIMIT) * whole("stopped_words"))
        * F.col("weight")
    ).cast("double") / (F.lit(den) * F.col("open_weight"))
    target = F.when(F.col("stopped"), (F.lit(LIMIT) * F.col("source_size")).cast("double"))
    plan = plan.select("source", "source_size", target.otherwise(shared).alias("target"))
    copies = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(
        F.floor(F.col("target") / F.col("source_size"))
    )
    plan = plan.withColumn("copies", copies.cast("int"))

    by_bin = Window.partitionBy("source").orderBy("bin")
    reached = F.sum("words").over(by_bin) - F.col("words") / 2
    same = F.col("p.source").eqNullSafe(F.col("b.source"))
    cut = (
        per_bin.withColumn("reached", reached).alias("b")
        .join(plan.alias("p"), same)
        .filter("b.reached <= p.target - p.copies * p.source_size")
        .groupBy("b.source")
        .agg(F.max("b.bin").alias("last_bin"))
    )
    same = F.col("p.source").eqNullSafe(F.col("c.source"))
    return plan.alias("p").join(cut.alias("c"), same, "left").select("p.*", "c.last_bin")


def _draw(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str
) -> DataFrame:
    """Each row as `row`, with its size, source_size, target and copies."""
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(source_col).alias("source"),
        count_words(text_or_empty(text_col)).alias("size"),
        hash_bin(id_col, seed),
    )
    # stored, so that its true size decides how it is joined, and so that a
    # source with very many rows can be split if it isn't broadcast
    plan = stage(source_plan(sized), "mix-plan")
    same = F.col("d.source").eqNullSafe(F.col("p.source"))
    drawn = F.coalesce(F.col("d.bin") <= F.col("p.last_bin"), F.lit(False)).cast("int")
    copies = F.col("p.copies") + F.when(F.col("p.copies") < LIMIT, drawn).otherwise(0)
    return sized.alias("d").join(plan.alias("p"), same).select(
        "d.row", "d.size", "p.source_size", "p.target", copies.alias("copies")
    )


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = "mix",
) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, copies, taken.

    `copies` is how often the mix takes the document, `taken` the words it
    takes. Words are counted per source and hash bin before anything is
    shuffled, so a source with a third of all rows costs a map task no more
    than its bins. A null text has no words, a null source is a source of its
    own and the last, a null id draws like an empty one, and rows with the
    same id and source draw alike. A source without words has target 0. Other
    columns are not read.
    """
    narrow = docs.select(*dict.fromkeys((id_col, text_col, source_col)))
    return _draw(narrow, id_col, text_col, source_col, seed).select(
        F.col(f"row.{id_col}").alias("doc_id"),
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = "mix",
) -> DataFrame:
    """The mix itself: every row of `docs` as often as `mix` takes it."""
    drawn = _draw(docs, id_col, text_col, source_col, seed).filter("copies > 0")
    repeated = drawn.select("row", F.explode(F.sequence(F.lit(1), "copies")))
    return repeated.select("row.*")
