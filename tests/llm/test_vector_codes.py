from hashlib import sha256

import numpy as np
import pytest
from helpers import table, with_clashes
from pyspark.sql import functions as F

from sift.llm.vector_codes import Gnat, encode_vectors, floor_root

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def nearest(points: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    apart = ((queries[:, None] - points[None]) ** 2).sum(axis=2)
    return apart.argmin(axis=1), apart.min(axis=1)


def by_hand(rows: list[tuple], entries: int, rounds: int, scale: int) -> tuple[list[tuple], str]:
    kept = [r for r in rows if r[1] is not None and all(v is not None and np.isfinite(v) for v in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.floor(np.array([r[1] for r in kept], np.float32).astype(float) * scale).astype(np.int64)
    x = x.reshape(len(kept), 4, -1)
    books = [x[:entries, p].copy() for p in range(4)]
    for again in range(rounds + 1):
        found = [nearest(books[p], x[:, p]) for p in range(4)]
        for p in range(4) if again < rounds else ():
            for e in set(found[p][0].tolist()):
                mine = x[found[p][0] == e, p]
                books[p][e] = [sum(c) // len(mine) for c in mine.T.tolist()]
    digest = sha256(",".join(str(v) for b in books for v in b.ravel()).encode()).hexdigest()
    rows = [
        (r[0], bytes(int(f[i]) for f, _ in found), int(sum(d[i] for _, d in found)), r[2])
        for i, r in enumerate(kept)
    ]
    return rows, digest


def encoded(spark, rows, **options):
    data = with_clashes(table(spark, rows, SCHEMA).repartition(5), "vector", "code", "kept", "part")
    made, books = encode_vectors(data, keep=[F.col("label")], **options)
    assert made.columns == ["vec_id", "code", "error", "label"]
    key = lambda r: tuple(str(v) for v in r)
    return sorted(((r[0], bytes(r[1]), r[2], r[3]) for r in made.collect()), key=key), books


def same(spark, rows, entries=256, rounds=4, scale=1024):
    got, books = encoded(spark, rows, entries=entries, rounds=rounds, scale=scale)
    want, digest = by_hand(rows, entries, rounds, scale)
    assert got == sorted(want, key=lambda r: tuple(str(v) for v in r))
    assert books.digest() == digest
    return books


@pytest.mark.parametrize("entries, rounds, scale, spread", [(256, 4, 1024, 1.0), (20, 2, 1, 3.0), (7, 0, 8, 0.2)])
def test_equals_brute_force(spark, entries, rounds, scale, spread):
    draw = np.random.default_rng(entries)
    rows = [(int(i), (draw.normal(size=16) * spread).tolist(), int(i) % 3) for i in draw.permutation(900)]
    rows += [(1000 + i, rows[5][1], 0) for i in range(300)]  # copies
    same(spark, rows, entries, rounds, scale)


def test_ties_and_unused_entries(spark):
    rows = [(i, [float(i % 2)] * 4, 0) for i in range(10)] + [(20, [0.5] * 4, 1), (21, [-0.5] * 4, 1)]
    books = same(spark, rows, entries=4, scale=2)
    assert books.entries.shape == (4, 4, 1)


def test_rows_without_a_usable_vector(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [nan, 1.0, 1.0, 1.0], 0), (3, [1.0, -inf, 1.0, 1.0], 0), (4, [None, 1.0, 1.0, 1.0], 0)]
    rows += [(None, [3.0, 2.0, 1.0, -0.0], None), (None, [-3.0, 2.0, 1.0, 0.0], 1), (5, [0.0] * 4, None)]
    rows += [(6, [1.0, 2.0, 3.0, -4.0], 1)] * 3 + [(6, [1.0, 2.0, 3.0, -5.0], 1)]
    same(spark, rows)
    same(spark, rows, entries=3)


def test_empty_tables(spark):
    for rows in ([], [(1, None, 0)]):
        got, books = encoded(spark, rows)
        assert got == [] and books.entries.size == 0


def test_vectors_that_do_not_fit(spark):
    for bad in ([1.0] * 6, [], [3e38] * 4):
        with pytest.raises(ValueError):
            encoded(spark, [(1, bad, 0)])
    with pytest.raises(ValueError):
        encoded(spark, [(1, [1.0] * 4, 0), (2, [1.0] * 8, 0)])


def test_codes_stand_for_vectors(spark):
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(size=8).tolist(), 0) for i in range(200)]
    made, books = encode_vectors(table(spark, rows, SCHEMA))
    back = {r.vec_id: r.vector for r in books.decode(made).collect()}
    for i, vector, _ in rows:  # each vector is an entry of every codebook
        assert np.abs(np.array(back[i]) - vector).max() <= 1 / 1024
    odd = table(spark, [(1, None), (2, bytearray(4))], "vec_id bigint, code binary")
    found = {r.vec_id: r.vector for r in books.decode(odd).collect()}
    assert found[1] is None and len(found[2]) == 8


@pytest.mark.parametrize("n, dim, spread", [(256, 16, 300), (256, 16, 2), (700, 2, 4), (300, 3, 1000), (17, 1, 3), (1, 4, 9), (40, 5, 0)])
def test_gnat_finds_the_first_nearest(n, dim, spread):
    draw = np.random.default_rng(n)
    points = np.floor(draw.normal(size=(n, dim)) * spread).astype(np.int64)
    queries = np.floor(draw.normal(size=(2000, dim)) * spread).astype(np.int64)
    queries[:n] = points[: len(queries)]
    tree = Gnat(points)
    found, distance = tree.search(queries)
    want = nearest(points, queries)
    assert (found == want[0]).all() and (distance == want[1]).all()
    assert tree.compared <= len(queries) * n
    if n > 100 and dim <= 3:
        assert tree.compared < len(queries) * n / 4


def test_gnat_passes_over_subtrees_and_large_numbers():
    draw = np.random.default_rng(3)
    centres = draw.integers(-(2**24), 2**24, (10, 16))
    points = centres[draw.integers(0, 10, 256)] + draw.integers(-50, 50, (256, 16))
    queries = centres[draw.integers(0, 10, 3000)] + draw.integers(-50, 50, (3000, 16))
    tree = Gnat(points)
    assert (tree.search(queries)[0] == nearest(points, queries)[0]).all()
    assert tree.compared < len(queries) * 256 / 5


def test_roots_are_exact():
    x = np.array([0, 1, 2, 3, 4, 2**60 - 1, 2**60, 2**60 + 1, (2**30 + 7) ** 2, (2**30 + 7) ** 2 - 1])
    assert floor_root(x).tolist() == [0, 1, 1, 1, 2, 2**30 - 1, 2**30, 2**30, 2**30 + 7, 2**30 + 6]
