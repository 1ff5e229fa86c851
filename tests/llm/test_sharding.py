import random
import zlib
from collections import defaultdict

import pytest
from helpers import by_id, table, with_clashes
from pyspark.sql import functions as F

from sift.llm.sharding import boundaries, shard_by_bytes


def least(sizes: list[int], shards: int) -> int:
    """The smallest possible largest part, by trying every capacity."""
    capacity = max(sizes)
    while True:
        parts, room = 1, capacity
        for s in sizes:
            if s > room:
                parts, room = parts + 1, capacity
            room -= s
        if parts <= shards:
            return capacity
        capacity += 1


@pytest.mark.parametrize("n, shards", [(3, 5), (40, 4), (3000, 7), (20_000, 16)])
def test_cuts_are_the_best_ones(spark, n, shards):
    draw = random.Random(n)
    rows = [(f"{draw.getrandbits(128):032x}", draw.choice([1, 5, 40, 900])) for _ in range(n)]
    groups = table(spark, rows, "key string, size bigint")
    begins = boundaries(groups, shards)
    parts = [0] * shards
    for key, size in rows:
        parts[sum(key >= b for b in begins)] += size
    assert max(parts) == least([s for _, s in sorted(rows)], shards)


def test_rows(spark):
    texts = [None, "", "é" * 10, *["copy"] * 500, *[f"text {i}" * (i % 50) for i in range(1500)]]
    docs = with_clashes(table(spark, enumerate(texts)), "key", "size", "part", "shard", "offset")
    got = by_id(shard_by_bytes(docs, 4))
    assert len(got) == len(texts)
    slots, sizes, homes = defaultdict(list), defaultdict(int), defaultdict(set)
    for i, text in enumerate(texts):
        data = (text or "").encode()
        assert (got[i].size, got[i].text_crc32) == (len(data) + 1, zlib.crc32(data))
        slots[got[i].shard].append(got[i].slot)
        sizes[got[i].shard] += got[i].size
        homes[text or ""].add(got[i].shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())
    assert max(sizes.values()) < 1.1 * min(sizes.values())
    assert by_id(shard_by_bytes(docs.repartition(3), 4)) == got


def test_a_group_above_the_mean_and_few_groups(spark):
    docs = table(spark, [(i, "hot" if i % 2 else f"t{i}") for i in range(300)])
    got = shard_by_bytes(docs, 4).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    assert max(r.s for r in got) <= 150 * 4 + 5
    few = shard_by_bytes(table(spark, [(1, "a"), (2, "a"), (None, "b")]), 16).collect()
    assert len(few) == 3 and {r.slot for r in few} <= {0, 1}
    assert shard_by_bytes(table(spark, []), 16).collect() == []
