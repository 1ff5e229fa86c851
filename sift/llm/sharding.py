"""Shards of near-equal bytes, cut from an ordered sequence of groups."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sift.llm.common import stage, text_or_empty

# Hex digits by which the sequence is summed up at first, and by which an
# undecided stretch of it is looked at more closely.
FIRST, CLOSER = 3, 2
# Each shard is numbered in this many parts at once.
PARTS = 1024


@dataclass(frozen=True)
class Block:
    """A stretch of the sequence: all groups whose key begins with `prefix`."""

    prefix: str
    size: int
    atomic: bool  # a single group, which no shard boundary may divide


def fill(blocks: list[Block], capacity: int, shards: int, *, whole: bool) -> list[tuple] | None:
    """Fill shards in order, each as full as it gets; None if they don't suffice.

    With `whole`, no block is divided, else only atomic ones aren't. Gives
    for each cut the index of the block it falls in or before, and whether it
    divides that block.
    """
    cuts, room = [], capacity
    for at, block in enumerate(blocks):
        size = block.size
        if size <= room:
            room -= size
        elif whole or block.atomic:
            if size > capacity:
                return None
            cuts.append((at, False))
            room = capacity - size
        else:
            size -= room
            cuts.append((at, room > 0))
            while size > capacity:
                cuts.append((at, True))
                size -= capacity
            room = capacity - size
        if len(cuts) >= shards:
            return None
    return cuts


def least_capacity(blocks: list[Block], shards: int, *, whole: bool) -> int:
    """The smallest capacity with which `shards` shards suffice, by bisection."""
    total = sum(b.size for b in blocks)
    largest = max((b.size for b in blocks if whole or b.atomic), default=1)
    low, high = max(ceil(total / shards), largest, 1), max(total, 1)
    while low < high:
        middle = (low + high) // 2
        if fill(blocks, middle, shards, whole=whole) is None:
            low = middle + 1
        else:
            high = middle
    return low


def _blocks(groups: DataFrame, digits: int) -> list[Block]:
    summed = (
        groups.groupBy(F.substring("key", 1, digits).alias("prefix"))
        .agg(F.sum("size").alias("size"), F.min("key").alias("a"), F.max("key").alias("z"))
        .collect()
    )
    return sorted(
        (Block(r.prefix, int(r.size), r.a == r.z) for r in summed), key=lambda b: b.prefix
    )


def boundaries(groups: DataFrame, shards: int) -> list[str]:
    """Key prefixes at which shards 1, 2, ... begin.

    `groups` has (key, size), keys being hex digests. The whole sequence is
    never on the driver: it sees the sums of 16**FIRST stretches. If these may
    be divided anywhere, the smallest capacity is a lower bound; if not, an
    upper one. Only stretches in which a cut between the two bounds can fall
    are summed up more closely, until the lower bound's cuts divide nothing.
    """
    blocks, digits = _blocks(groups, FIRST), FIRST
    while True:
        low = least_capacity(blocks, shards, whole=False)
        high = least_capacity(blocks, shards, whole=True)
        cuts = fill(blocks, low, shards, whole=False)
        if low == high or not any(divides for _, divides in cuts):
            if any(divides for _, divides in cuts):
                cuts = fill(blocks, low, shards, whole=True)
            return [blocks[at].prefix for at, _ in cuts]
        late = fill(blocks, high, shards, whole=False)
        ends = [at for at, _ in late] + [len(blocks) - 1] * (len(cuts) - len(late))
        open_ = {
            i
            for (a, _), z in zip(cuts, ends, strict=False)
            for i in range(min(a, z), max(a, z) + 1)
            if not blocks[i].atomic
        }
        open_ |= {at for at, divides in cuts if divides}
        prefixes: dict[int, list[str]] = {}
        for i in open_:
            prefixes.setdefault(len(blocks[i].prefix), []).append(blocks[i].prefix)
        finer = []
        for digits, these in prefixes.items():
            inside = F.substring("key", 1, digits).isin(these)
            finer += _blocks(groups.filter(inside), digits + CLOSER)
        blocks = sorted(
            [b for i, b in enumerate(blocks) if i not in open_] + finer, key=lambda b: b.prefix
        )


def shard_by_bytes(
    docs: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, shard, slot.

    Equal texts form a group that stays in one shard. Groups are ordered by
    the MD5 of their text, and the sequence is cut so that the largest shard
    is as small as it can be; `size` is the text's UTF-8 bytes plus one.
    `slot` counts from 0 without gaps inside a shard. It is numbered in PARTS
    parts per shard, dealt by a hash of the id, so neither a large shard nor a
    large group is sorted in one task; the parts' sizes, at most shards *
    PARTS rows, are what is broadcast.

    A null text counts as empty; a group larger than the mean makes its shard
    the largest; with fewer groups than shards the last shards stay empty; an
    empty table has no rows. Repeated rows and null ids have slots of their
    own.
    """
    text = text_or_empty(text_col)
    rows = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text).cast("bigint") + 1).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(text).alias("key"),
        ),
        "shard-rows",
    )
    begins = boundaries(rows.groupBy("key").agg(F.sum("size").alias("size")), shards)
    shard = F.lit(0)
    for prefix in begins:
        shard = shard + (F.col("key") >= prefix).cast("int")
    part = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(PARTS)).cast("int")
    placed = rows.select(
        "doc_id", "size", "text_crc32", shard.alias("shard"), part.alias("part")
    )
    sizes = placed.groupBy("shard", "part").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "shard", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32")
    numbered = placed.withColumn("number", F.row_number().over(inside) - 1)
    return numbered.join(F.broadcast(offsets), ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("offset") + F.col("number")).alias("slot"),
    )
