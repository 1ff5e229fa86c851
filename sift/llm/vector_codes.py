"""Vectors compressed to codes; each codebook is searched with a GNAT."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sift.llm.common import bound_batches

# Split points of a GNAT node at most.
DEGREE = 16
# Vectors that are searched for at once.
TOGETHER = 4096
# What squared distances must stay below, to be exact integers.
LARGEST = 2**62


def squared(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances between two sets of integer points, as integers."""
    apart = points @ (-2 * others.T)
    apart += np.einsum("ij,ij->i", points, points)[:, None]
    apart += np.einsum("ij,ij->i", others, others)
    return apart


def floor_root(x: np.ndarray) -> np.ndarray:
    """The integer part of square roots, exact where doubles are not."""
    root = np.sqrt(x.astype(np.float64)).astype(np.int64)
    root -= root * root > x
    root += (root + 1) ** 2 <= x
    return root


@dataclass(frozen=True)
class Node:
    """Split points, by rising number, and the points nearest to each as children.

    `low[i, j]` and `high[i, j]` bound the distances from split point i to
    split point j and all that is below it, rounded away from each other.
    """

    splits: np.ndarray
    low: np.ndarray
    high: np.ndarray
    children: list[Node | None]


class Gnat:
    """Finds the nearest of integer points, of equally near ones the first.

    A subtree is passed over only if its distance ranges, to its own split
    point and to the query's nearest one, leave it strictly farther away than
    the nearest point so far, with all roots rounded to the safe side; what is
    left is compared by exact squared distances.
    """

    def __init__(self, points: np.ndarray) -> None:
        self.points = np.ascontiguousarray(points, np.int64)
        self.root = self._build(np.arange(len(points))) if len(points) else None
        self.compared = 0

    def _build(self, members: np.ndarray) -> Node:
        points = self.points[members]
        # each split point is the farthest from those before it
        picks, nearest = [0], squared(points, points[:1])[:, 0]
        while len(picks) < min(DEGREE, len(members)):
            nearest[picks] = -1
            picks.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, squared(points, points[picks[-1:]])[:, 0])
        picks.sort()
        distance = squared(points, points[picks])
        owner = distance.argmin(axis=1)
        owner[picks] = np.arange(len(picks))
        root = floor_root(distance).T  # split points by members
        low = np.stack([root[:, owner == j].min(axis=1) for j in range(len(picks))], axis=1)
        high = np.stack([root[:, owner == j].max(axis=1) + 1 for j in range(len(picks))], axis=1)
        owner[picks] = -1
        below = [members[owner == j] for j in range(len(picks))]
        children = [self._build(part) if len(part) else None for part in below]
        return Node(members[picks], low, high, children)

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each query's nearest point, and the squared distance."""
        best = np.full(len(queries), LARGEST, np.int64)
        found = np.full(len(queries), len(self.points), np.int64)
        if self.root is not None:
            self._visit(self.root, np.arange(len(queries)), queries, best, found)
        return found, best

    def _visit(
        self, node: Node, rows: np.ndarray, queries: np.ndarray, best: np.ndarray, found: np.ndarray
    ) -> None:
        distance = squared(queries[rows], self.points[node.splits])
        self.compared += distance.size
        near = distance.argmin(axis=1)
        least, number = distance[np.arange(len(rows)), near], node.splits[near]
        nearer = (least < best[rows]) | ((least == best[rows]) & (number < found[rows]))
        best[rows[nearer]], found[rows[nearer]] = least[nearer], number[nearer]
        if not any(node.children):
            return
        # below the nearest split point first: that leaves least of the others
        for j, child in enumerate(node.children):
            if child and len(at := np.flatnonzero(near == j)):
                self._visit(child, rows[at], queries, best, found)
        root = floor_root(distance)
        bound = floor_root(best[rows])[:, None] + 1
        far = root - node.high.diagonal() > bound
        far |= node.low[near] - (floor_root(least)[:, None] + 1) > bound
        for j, child in enumerate(node.children):
            if child and len(at := np.flatnonzero(~far[:, j] & (near != j))):
                self._visit(child, rows[at], queries, best, found)


@dataclass(frozen=True)
class Codebooks:
    """`entries[part, entry]` are integer points; all parts have equally many."""

    entries: np.ndarray
    scale: int

    @cached_property
    def trees(self) -> list[Gnat]:
        return [Gnat(book) for book in self.entries]

    @property
    def dim(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def parts(self, column: pa.Array) -> np.ndarray:
        """Vectors of a batch as integer points (row, part, position)."""
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        whole = np.floor(flat * self.scale).astype(np.int64)
        return whole.reshape(len(column), self.entries.shape[0], self.entries.shape[2])

    def assign(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part, and the squared distances."""
        found = [tree.search(parts[:, at]) for at, tree in enumerate(self.trees)]
        return np.stack([f for f, _ in found], axis=1), np.stack([d for _, d in found], axis=1)

    def digest(self) -> str:
        """Of all components, by part, entry and position within the part."""
        return sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def decode(self, coded: DataFrame, code_col: str = "code", vector_col: str = "vector") -> DataFrame:
        """`coded` with the vector that each code stands for, a null for none."""
        added = T.StructField(vector_col, T.ArrayType(T.DoubleType()))
        schema = T.StructType([*coded.schema, added])
        entries, scale = self.entries, self.scale

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at = np.arange(len(entries))
            for batch in batches:
                vectors = [
                    None if c is None else ((entries[at, list(c)].ravel() + 0.5) / scale).tolist()
                    for c in batch.column(code_col).to_pylist()
                ]
                column = pa.array(vectors, pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, column], names=schema.names)

        bound_batches(coded.sparkSession)
        return coded.mapInArrow(run, schema)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of TOGETHER rows or somewhat more."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= TOGETHER:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def whole_vectors(vectors: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector is there and has finite components only."""
    x = F.col(vector_col)
    return vectors.filter(
        F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    )


def check_lengths(vectors: DataFrame, parts: int, scale: int) -> int:
    """The vectors' common length; 0 without vectors."""
    size = F.size("vector")
    largest = F.array_max(F.transform("vector", lambda v: F.abs(v)))
    low, high, most = vectors.agg(F.min(size), F.max(size), F.max(largest)).first()
    if low is None:
        return 0
    if low != high or low % parts or not low:
        raise ValueError(f"vectors must have one length, a multiple of {parts}; found {low} to {high}")
    if (2 * (float(most) * scale + 1)) ** 2 * low >= LARGEST:
        raise ValueError(f"components up to {most} are too large for exact distances")
    return low


def improved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Entries moved to the mean, rounded down, of the parts assigned to them.

    Each task adds up its own vectors; one row per part and entry leaves it.
    """
    count, size, width = books.entries.shape
    sums = [f"s{at}" for at in range(width)]
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("part", "entry", "n", *sums)])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((count, size), np.int64)
        total = np.zeros((count, size, width), np.int64)
        for batch in _together(batches):
            parts = books.parts(batch.column("vector"))
            found, _ = books.assign(parts)
            for part in range(count):
                n[part] += np.bincount(found[:, part], minlength=size)
                np.add.at(total[part], found[:, part], parts[:, part])
        part, entry = np.nonzero(n)
        rows = [part, entry, n[part, entry], *total[part, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names=schema.names)

    added = vectors.select("vector").mapInArrow(add_up, schema).groupBy("part", "entry")
    entries = books.entries.copy()
    for row in added.agg(F.sum("n").alias("n"), *(F.sum(s).alias(s) for s in sums)).collect():
        entries[row.part, row.entry] = [row[s] // row.n for s in sums]
    return Codebooks(entries, books.scale)


def encode_vectors(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    keep: Sequence[Column] = (),
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
) -> tuple[DataFrame, Codebooks]:
    """(vec_id, code, error, and what `keep` adds) per usable vector, and the codebooks.

    A component x counts as the integer floor(scale * x). Vectors are cut into
    equal `parts`, and a code has a byte per part: the number of the nearest
    codebook entry. Codebooks start as the parts of the first `entries`
    vectors by id and are moved to the means of their parts in so many
    `rounds`. `error` is the squared distance, in integers, from the vector to
    what its code stands for.

    Every vector has a part in every round. The driver sees the entries and
    their sums, parts * entries rows; so do the tasks.

    Vectors that are null, or hold a null, NaN or infinite component have no
    row. Rows that share an id are vectors of their own; where the first
    vectors are looked for, they lie by their components, and a null id comes
    last. Fewer vectors than `entries` make shorter codebooks. An empty table
    gives no rows. Vectors that are empty, or differ in length, or can't be cut
    into parts, or are too large for exact integers raise ValueError. Other
    columns are not read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a byte tells 1 to 256 entries apart")
    usable = whole_vectors(vectors, vector_col).select(
        F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"), F.struct(F.lit(0).alias("_"), *keep).alias("kept")
    )
    bound_batches(vectors.sparkSession)
    dim = check_lengths(usable, parts, scale)
    first = usable.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries if dim else 0)
    start = np.array([row.vector for row in first.select("vector").collect()], np.float64)
    points = np.floor(start * scale).astype(np.int64).reshape(len(start), parts, dim // parts)
    books = Codebooks(np.ascontiguousarray(points.transpose(1, 0, 2)), scale)
    for _ in range(rounds if dim else 0):
        books = improved(usable, books)

    schema = T.StructType(
        [
            usable.schema["vec_id"],
            T.StructField("code", T.BinaryType()),
            T.StructField("error", T.LongType()),
            usable.schema["kept"],
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches):
            found, distance = books.assign(books.parts(batch.column("vector")))
            codes = [row.tobytes() for row in found.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array(codes, pa.binary()),
                    pa.array(distance.sum(axis=1)),
                    batch.column("kept"),
                ],
                names=schema.names,
            )

    coded = usable.mapInArrow(encode, schema)
    kept = [F.col("kept")[f.name].alias(f.name) for f in schema["kept"].dataType[1:]]
    return coded.select("vec_id", "code", "error", *kept), books
