"""Exact duplicates by a 128-bit hash, confirmed byte by byte."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sift.llm.common import ascii_lower, stage, text_or_empty


def exact_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] = ascii_lower,
    digest: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are grouped by the 128-bit digest of the normalised text and, inside
    a digest, by the bytes themselves, so texts that merely collide stay
    apart. `keep` says whether the smallest or the largest id of a group
    stays. The grouping collapses copies before the shuffle, so a text that
    makes up a third of the table costs each map task one record; only groups
    of two or more are stored, without their texts, and joined back on the
    narrow digests, where adaptive execution can split a hot one.

    A null text counts as empty, and all empty texts form one group. A null
    id never stays while its group has another one. Rows that share id and
    text stay or go together. Other columns are not read.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be 'smallest' or 'largest', not {keep!r}")
    best = F.min if keep == "smallest" else F.max
    rows = docs.select(
        F.col(id_col).alias("doc_id"), normalise(text_or_empty(text_col)).alias("body")
    )
    repeated = (
        rows.groupBy(digest(F.col("body")).alias("digest"), "body")
        .agg(best("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .filter("group_size > 1")
        .select("digest", F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    repeated = stage(repeated, "copies")
    # members find their group by both digests; two different texts that
    # agree in both must not be merged
    clash = repeated.groupBy("digest", "text_sha256").count().filter("count > 1")
    if not clash.isEmpty():
        raise RuntimeError("two different texts share both their digests")
    members = rows.select(
        "doc_id", digest(F.col("body")).alias("digest"), F.sha2("body", 256).alias("text_sha256")
    )
    found = members.join(repeated, ["digest", "text_sha256"], "left")
    in_group = F.col("group_size").isNotNull()
    keep_id = F.when(in_group, F.col("keep_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
    )


def distinct_rows(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] = ascii_lower,
    digest: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One whole row of `docs` for each group of equal texts.

    Groups are those of `exact_groups`. Of a group the row with the smallest
    or largest id stays, a null id only if the group has no other; among equal
    ids the order of the whole rows decides, so reruns agree whatever the ids.
    One grouping does it: copies collapse before the shuffle, and the rows
    travel once. Column names don't matter; columns must have an order.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be 'smallest' or 'largest', not {keep!r}")
    named = [F.col(f"`{c}`") for c in docs.columns]
    row = F.struct(*(column.alias(f"c{at}") for at, column in enumerate(named)))
    place, body = F.col(f"`{id_col}`"), normalise(text_or_empty(f"`{text_col}`"))
    best = F.max(F.struct(place.alias("id"), row.alias("row")))
    if keep == "smallest":
        best = F.min(F.struct(place.isNull().alias("none"), place.alias("id"), row.alias("row")))
    kept = (
        docs.groupBy(digest(body).alias("digest"), body.alias("body"))
        .agg(best.alias("best"))
        .select("best.row.*")
    )
    return kept.toDF(*docs.columns)
