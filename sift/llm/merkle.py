"""A Merkle manifest of a dataset; proofs come from a butterfly exchange."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import partial
from hashlib import sha256
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from sift.llm.common import stage

# What a node's digest is hashed with on the way up: the digests of its run to
# the left and to the right of it, each put together.
STEP = "struct<before: string, after: string>"


def leaf_digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of values, each spelled with its length (`-` if
    null), so that no two different rows spell alike."""

    def spelled(value: Column) -> Column:
        text = value.cast("string")
        known = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        return F.coalesce(known, F.lit("-"))

    return F.sha2(F.concat(*map(spelled, values)), 256)


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest and a proof lead to."""
    return F.aggregate(
        proof, digest, lambda at, step: F.sha2(F.concat(step["before"], at, step["after"]), 256)
    )


def proof_text(proof: Column) -> Column:
    """All siblings of a proof, from the leaf to the root, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "")


def height(size: int, fanout: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while size > 1:
        size, levels = -(-size // fanout), levels + 1
    return levels


def climb(digests: list[str], levels: int, fanout: int) -> tuple[str, list[list[dict]]]:
    """The digest above all of `digests` after so many levels, and each one's steps."""
    steps: list[list[dict]] = [[] for _ in digests]
    nodes, width = digests, 1
    for _ in range(levels):
        runs = [nodes[at : at + fanout] for at in range(0, len(nodes), fanout)]
        level = [
            {"before": "".join(run[:i]), "after": "".join(run[i + 1 :])}
            for run in runs
            for i in range(len(run))
        ]
        for at, path in enumerate(steps):
            path.append(level[at // width])
        nodes = [sha256("".join(run).encode()).hexdigest() for run in runs]
        width *= fanout
    return nodes[0], steps


def numbered(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """`nodes` with `at`, each one's place in its `tree`, and `size`, the tree's nodes.

    `order` must tell all nodes of a tree apart. A tree of any size is sorted
    by ranges in many tasks, each of which counts on from the ones before.
    """
    schema = T.StructType(
        [
            *nodes.schema,
            T.StructField("part", T.IntegerType()),
            T.StructField("place", T.LongType()),
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, place = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for tree in batch.column("tree").to_pylist():
                place = place + 1 if tree == last else 0
                last = tree
                places.append(place)
            parts = pa.array([part] * len(batch), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, parts, pa.array(places, pa.int64())], names=schema.names
            )

    ordered = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = stage(ordered.mapInArrow(count, schema), "merkle-places")
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("tree", "part").agg(F.count("*").alias("n"))
    parts = stage(
        parts.select(
            "tree",
            "part",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
            F.sum("n").over(tree).alias("size"),
        ),
        "merkle-parts",
    )
    at = (F.col("before") + F.col("place")).alias("at")
    return placed.join(parts, ["tree", "part"]).select(*nodes.columns, at, "size")


def local_trees(nodes: DataFrame, fanout: int, depth: int) -> DataFrame:
    """`nodes` with `block`, its `top`, and the `steps` up to there.

    A block is an aligned stretch of fanout**depth nodes of one tree. Blocks
    are dealt out by number, so that a tree that holds a third of all nodes is
    spread over all tasks, and a task holds one block at a time.
    """
    span = fanout**depth
    added = T.StructType.fromDDL(f"block bigint, top string, steps array<{STEP}>")
    schema = T.StructType([*nodes.schema, *added[1:]])
    dealt = nodes.withColumn("block", F.floor(F.col("at") / span))
    schema = T.StructType([*dealt.schema, *added[1:]])
    arrow = to_arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield from batch.to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in groupby(rows(batches), itemgetter("tree", "block")):
            held = list(block)
            levels = min(depth, height(held[0]["size"], fanout))
            top, steps = climb([row["digest"] for row in held], levels, fanout)
            for row, path in zip(held, steps, strict=True):
                row |= {"top": top, "steps": path}
            yield pa.RecordBatch.from_pylist(held, schema=arrow)

    ordered = dealt.repartition("tree", "block").sortWithinPartitions("tree", "block", "at")
    return ordered.mapInArrow(run, schema)


def exchange(blocks: DataFrame, reach: int, fanout: int) -> DataFrame:
    """One round: blocks swap tops with those `reach` and 2 * `reach` away, ...

    Before the round a block's `top` is the digest of the subtree of `reach`
    blocks that it lies in; after it, of `reach` * `fanout` blocks. Blocks at
    the same place (seat) of neighbouring subtrees form a group, and every
    member hashes the common ancestor for itself. The last subtree of a tree
    may have fewer blocks than seats; these then sit in for the missing ones
    by turns, which adds less than one message per block of its neighbours.
    """
    child = F.floor(F.col("block") / reach)
    digit = child % fanout
    blocks_there = F.least(F.lit(reach), F.col("blocks") - child * reach)
    stride = F.when(digit > 0, blocks_there).otherwise(F.lit(reach))
    low = F.col("block") % reach
    seats = F.sequence(low, F.lit(reach - 1).cast("bigint"), stride.cast("bigint"))
    member = F.struct(
        "digit",
        "top",
        F.when(F.col("seat") == F.col("low"), F.struct("block", "blocks", "path")).alias("own"),
    )
    open_ = F.col("blocks") > reach
    groups = (
        blocks.filter(open_)
        .select("*", digit.alias("digit"), low.alias("low"), F.explode(seats).alias("seat"))
        .groupBy("tree", F.floor(F.col("block") / (reach * fanout)).alias("parent"), "seat")
        .agg(F.array_sort(F.collect_list(member)).alias("run"))
    )
    tops = lambda run: F.array_join(F.transform(run, lambda m: m["top"]), "")
    mine = F.col("mine.digit")
    step = F.struct(
        tops(F.filter("run", lambda m: m["digit"] < mine)).alias("before"),
        tops(F.filter("run", lambda m: m["digit"] > mine)).alias("after"),
    )
    swapped = (
        groups.select("tree", "run", F.explode("run").alias("mine"))
        .filter("mine.own is not null")
        .select(
            "tree",
            "mine.own.block",
            "mine.own.blocks",
            F.sha2(tops(F.col("run")), 256).alias("top"),
            F.concat("mine.own.path", F.array(step)).alias("path"),
        )
    )
    return blocks.filter(~open_).select(*swapped.columns).union(swapped)


def butterfly(blocks: DataFrame, fanout: int) -> DataFrame:
    """Blocks (tree, block, blocks, top, path) with the root as `top`, and the
    steps up to it: one round per level, and none of them goes back down."""
    most, reach = blocks.agg(F.max("blocks")).first()[0] or 0, 1
    while reach < most:
        blocks = stage(exchange(blocks, reach, fanout), "merkle-butterfly")
        reach *= fanout
    return blocks


def forest(
    nodes: DataFrame, order: Sequence[str], fanout: int, depth: int
) -> tuple[DataFrame, DataFrame]:
    """A tree over each `tree` of `nodes`, whose digests are in `digest`.

    Gives the nodes with their block and the steps inside it, and the blocks
    with their tree's root and the steps from there on.
    """
    nodes = stage(local_trees(numbered(nodes, order), fanout, depth), "merkle-nodes")
    blocks = nodes.filter(F.col("at") % fanout**depth == 0).select(
        "tree",
        "block",
        F.ceil(F.col("size") / fanout**depth).alias("blocks"),
        "top",
        F.array().cast(f"array<{STEP}>").alias("path"),
    )
    blocks = butterfly(stage(blocks, "merkle-blocks"), fanout)
    return nodes, blocks.select("tree", "block", F.col("top").alias("root"), "path")


def merkle_manifest(
    docs: DataFrame,
    *,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    source_col: str = "source",
    keep: Mapping[str, Column] | None = None,
    fanout: int = 3,
    depth: int = 6,
) -> DataFrame:
    """One row per input row: doc_id, leaf, subroot, root, proof, and what `keep` adds.

    A leaf is the digest of a row's `fields`. The leaves of a source, by id,
    are hashed in runs of `fanout`, level by level, up to its subroot; the
    subroots, by source, likewise up to the root. A node without siblings is
    hashed alone, and a tree of one leaf is that leaf. `proof` holds a step
    for each level from the leaf to the root, for `fold`.

    1. Leaves are numbered in their source by a sort in ranges.
    2. Aligned blocks of fanout**depth leaves are hashed up to their tops.
    3. Blocks swap tops in a butterfly: in round r groups of `fanout` blocks
       that are fanout**r apart exchange theirs and each hashes the ancestor,
       so after the last round every block has its proof up to the subroot.
    4. The subroots go through the same steps as one tree.

    Texts are read once and don't travel; a row costs its digests. `keep` are
    columns over `docs` that are worked out in the same scan.

    A null source is a source of its own and comes first, then sources by
    their bytes; null ids come first in their source. Rows that share source
    and id lie by their leaves; repeated rows are leaves of their own, all
    with valid proofs. Other columns are not read.
    """
    if fanout < 2 or depth < 0:
        raise ValueError("a fanout of at least 2 and a depth of at least 0, please")
    kept = [column.alias(f"keep_{name}") for name, column in (keep or {}).items()]
    leaves = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("-")).alias("tree"),
        leaf_digest(*(F.col(name) for name in fields)).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
        *kept,
    )
    build = partial(forest, fanout=fanout, depth=depth)
    leaves, blocks = build(stage(leaves, "merkle-leaves"), ["doc_id", "digest", "row"])
    subroots = blocks.filter("block = 0").select(
        F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("root").alias("digest")
    )
    sources, tops = build(stage(subroots, "merkle-subroots"), ["source"])
    above = sources.join(tops, ["tree", "block"]).select(
        F.col("source").alias("tree"), F.concat("steps", "path").alias("above"), tops["root"]
    )
    blocks = blocks.withColumnRenamed("root", "subroot").join(stage(above, "merkle-above"), "tree")
    upper = blocks.select("tree", "block", "subroot", "root", F.concat("path", "above").alias("upper"))
    return leaves.join(stage(upper, "merkle-upper"), ["tree", "block"]).select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.concat("steps", "upper").alias("proof"),
        *(F.col(f"keep_{name}").alias(name) for name in keep or {}),
    )
