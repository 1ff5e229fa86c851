"""From raw documents to token ids, in five stages.

Each stage gets what the one before kept, as stored, and calls one operator
of `sift.llm`. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sift.llm import bpe, exact_dedup, mixing, near_dedup, quality
from sift.llm.common import drop_staged, read_table, stage, staged_tables

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Words in a shingle of the near-duplicate stage.
SHINGLE = 5


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the quality classifier accepts."""
    found = quality.assess(docs, read_table(spark, sf_dir, "labels"))
    return found.filter("accepted").select(*docs.columns)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row, with the largest id; a null id is the smallest."""
    return exact_dedup.distinct_rows(docs, keep="largest")


def distant_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row, with the smallest id; a null id
    is the largest."""
    return near_dedup.distant_rows(docs, k=SHINGLE)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mixing.mixed_documents(docs).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, and whether the ids decode to the text."""
    import public_tokenizers

    coder = bpe.ByteBpe.from_file(
        spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
    coded = coder.encode(docs.select("doc_id", "text"), bytes_col="decoded")
    return coded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("bigint").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("exact_dedup", distinct_texts),
    ("near_dedup", distant_texts),
    ("mixing", mixed_sources),
    ("byte_bpe", token_ids),
]

# The first stage fits a model, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's result stored and read again.

    Once it is stored, what the stage staged inside and the result before it
    are deleted; the last result stays, as the caller reads it.
    """
    docs, before = read_table(spark, sf_dir, "documents"), []
    for name, apply in STAGES:
        with staged_tables() as made:
            docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
        drop_staged(spark, [*before, *made[:-1]])
        before = made[-1:]
    return docs
