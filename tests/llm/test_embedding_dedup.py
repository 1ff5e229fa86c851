import math

import numpy as np
import pytest
from helpers import by_id, components_of, table, with_clashes
from pyspark.sql import functions as F

from sift.llm import embedding_dedup
from sift.llm.embedding_dedup import near_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def by_hand(rows: list[tuple], cosine: float) -> dict:
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], dtype=np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= cosine
    np.fill_diagonal(near, False)
    found = components_of(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near), strict=True)])
    return {i: (int(near[k].sum()), found[i], found[i] == i) for k, i in enumerate(ids)}


def vectors(n: int, dim: int, seed: int) -> list[tuple]:
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, dim))
    rows = [centres[i % 12] + draw.normal(size=dim) * draw.choice([0.05, 0.3, 1.0]) for i in range(n)]
    rows += [rows[7]] * 20 + [rows[7] * 3]  # copies, and the same direction
    order = draw.permutation(len(rows))
    return [(int(order[i]), [float(v) for v in row]) for i, row in enumerate(rows)]


@pytest.mark.parametrize("block, side, fan, dim", [(256, 16, 8, 16), (16, 2, 2, 16), (8, 3, 4, 3)])
def test_equals_brute_force(spark, monkeypatch, block, side, fan, dim):
    for name, value in (("BLOCK", block), ("SIDES", (1, side)), ("FAN", fan)):
        monkeypatch.setattr(embedding_dedup, name, value)
    rows = vectors(500, dim, block)
    data = with_clashes(table(spark, [(*r, 1) for r in rows], SCHEMA), "rep", "weight", "block", "vector")
    got = near_vectors(data).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == by_hand(rows, 0.9)


def test_distant_blocks_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)
    draw = np.random.default_rng(2)
    centres = np.linalg.qr(draw.normal(size=(32, 32)))[0][:8]
    rows = [(i, (centres[i // 600] + draw.normal(size=32) * 0.01).tolist(), 0) for i in range(4800)]
    classes = table(spark, [(i, v, 1) for i, v, _ in rows], "rep bigint, vector array<float>, weight bigint")
    epsilon = math.sqrt(0.2)
    axes = embedding_dedup.principal_axes(classes, 32)
    blocks = embedding_dedup.grid_blocks(classes, 32, axes, epsilon)
    n = blocks.count()
    assert embedding_dedup.near_blocks(blocks, epsilon).count() < n * (n + 1) / 3
    got = near_vectors(table(spark, rows, SCHEMA)).collect()
    assert all(r.n_links == 599 and r.component_id == r.vec_id // 600 * 600 for r in got)


def test_blocks_are_cut_between_cells(monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 8)
    cells = np.array([[0] * 5 + [1] * 20 + [2] * 3])
    assert embedding_dedup.block_bounds(cells) == [(0, 5), (5, 13), (13, 21), (21, 28)]
    assert embedding_dedup.block_bounds(np.zeros((1, 0))) == []


def test_vectors_without_a_direction_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, None, 0), (4, [0.0, 0.0], 0), (5, [nan, 1.0], 0),
        (6, [inf, 1.0], 0), (7, [None, 1.0], 0), (8, [], 0), (9, [1.0, 0.0, 0.0], 0),
        (None, [1.0, 0.0], 0), (10, [-0.0, 1.0], 0), (11, [0.0, 1.0], 0),
        (12, [3e38, 3e38], 0), (13, [1e-38, 1e-38], 0), (14, [nan, 1.0], 0),
    ]
    got = near_vectors(table(spark, rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    found = {r.vec_id: (r.n_links, r.component_id) for r in got}
    assert found[1] == (1, 1) and found[2] == (1, 1)
    assert found[10] == (1, 10) and found[11] == (1, 10)
    assert found[12] == (1, 12) and found[13] == (1, 12)
    assert all(found[i] == (0, i) for i in (3, 4, 5, 6, 7, 8, 9, 14, None))
    assert near_vectors(table(spark, [], SCHEMA)).collect() == []
    assert near_vectors(table(spark, [(1, None, 0)], SCHEMA)).first().kept


def test_repeated_rows_count_as_vectors(spark):
    got = by_id(near_vectors(table(spark, [(1, [1.0, 2.0], 0)] * 3, SCHEMA)), "vec_id")
    assert got[1].n_links == 2


def test_few_cosines_are_taken_where_few_vectors_link(spark):
    from helpers import SF_DIR

    from sift.llm.common import read_table

    rows = read_table(spark, SF_DIR, "embeddings").select(
        F.col("vec_id").alias("rep"), F.col("embedding").alias("vector"), F.lit(1).cast("bigint").alias("weight")
    )
    near = F.transform("vector", lambda x: (x * 1.01 + 0.001).cast("float"))
    rows = rows.union(rows.filter("rep < 20").select(F.col("rep") + 10_000, near, "weight"))
    axes = embedding_dedup.principal_axes(rows, 64)
    blocks = embedding_dedup.grid_blocks(rows, 64, axes, math.sqrt(0.2))
    pairs = embedding_dedup.near_blocks(blocks, math.sqrt(0.2))
    made = embedding_dedup.join_tiles(blocks, pairs, 0.9, 64, axes, 8)
    taken = made.filter("rep is null").agg(F.sum("links")).first()[0]
    assert 20 <= taken < 520 * 519 / 2 / 10


def test_the_bound_is_never_below_the_cosine():
    draw = np.random.default_rng(5)
    unit = embedding_dedup.unit_rows(draw.normal(size=(300, 40)) ** 3)
    axes = np.linalg.qr(draw.normal(size=(40, 40)))[0]
    bound = embedding_dedup.bounded(unit, axes)
    assert (bound @ bound.T >= unit @ unit.T - 1e-5).all()


def test_tiles_are_few_enough_and_many_enough():
    assert embedding_dedup.tile_side(3, 8) == embedding_dedup.SIDES[0]
    assert embedding_dedup.tile_side(200, 6) == 29
    assert embedding_dedup.tile_side(10**6, 8) == embedding_dedup.SIDES[1]


def test_doubles_keep_their_precision(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.9, math.sqrt(1 - 0.9**2) - 1e-9]), (3, [0.9, math.sqrt(1 - 0.9**2) + 1e-7])]
    got = by_id(near_vectors(table(spark, rows, "vec_id bigint, embedding array<double>")), "vec_id")
    assert got[1].n_links == 1 and got[2].n_links == 2 and got[3].n_links == 1
