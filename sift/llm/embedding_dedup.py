"""Near-duplicate embeddings by an epsilon grid order join."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sift.llm.common import stage
from sift.llm.components import components

# Vectors the principal axes are fitted on at most. The axes only decide how
# much can be skipped, never what is found.
AXES_SAMPLE = 4096
# Leading axes by whose grid cells the vectors are sorted.
LEADING = 8
# Vectors in a block, intervals in an interval.
BLOCK, FAN = 256, 8
# Blocks along the side of a tile, at least and at most.
SIDES = (8, 64)
# Leading axes by which a pair of vectors is first bounded.
BOUNDING = 24
# Room for rounding: in single precision, and in distances between boxes.
ROUNDING = 1e-4


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of those that have a direction."""
    x = F.col(vector_col)
    whole = F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    )
    return vectors.select(F.col(id_col).alias("vec_id"), x.alias("vector")).filter(
        whole & F.exists("vector", lambda v: v != 0)
    )


def principal_axes(classes: DataFrame, dim: int) -> np.ndarray:
    """Orthogonal axes of a bounded sample, by falling variance."""
    some = classes.filter(F.size("vector") == dim).orderBy(F.xxhash64("vector"), "rep")
    rows = some.limit(AXES_SAMPLE).select("vector").collect()
    units = unit_rows(np.array([r.vector for r in rows], dtype=np.float64))
    _, axes = np.linalg.eigh(units.T @ units)
    return np.ascontiguousarray(axes[:, ::-1])


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares must not overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, dim)


def grid_blocks(classes: DataFrame, dim: int, axes: np.ndarray, epsilon: float) -> DataFrame:
    """Blocks of neighbours in epsilon grid order, with their boxes.

    A vector's cell is its place on the leading axes in steps of epsilon;
    cells are ordered axis by axis. The order is cut into ranges, so that no
    task sorts everything; coordinate and id follow the cell, so that a full
    cell is cut as well.
    """
    cells = [f"cell{i}" for i in range(min(LEADING, dim))]
    fields = [T.StructField(c, T.IntegerType()) for c in cells]
    placed_schema = T.StructType(
        [*classes.schema, *fields, T.StructField("first", T.DoubleType())]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = unit_rows(_matrix(batch.column("vector"), dim)) @ axes[:, : len(cells)]
            grid = np.floor(at / epsilon).astype(np.int32)
            columns = [pa.array(grid[:, i]) for i in range(len(cells))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns, pa.array(at[:, 0])], names=placed_schema.names
            )

    block_schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("seq", T.IntegerType()),
            T.StructField("reps", T.ArrayType(classes.schema["rep"].dataType)),
            T.StructField("weights", T.ArrayType(T.LongType())),
            T.StructField("matrix", T.BinaryType()),
            T.StructField("low", T.BinaryType()),
            T.StructField("high", T.BinaryType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at, end in block_bounds(np.stack([batch.column(c) for c in cells])):
                piece = batch.slice(at, end - at)
                unit = unit_rows(_matrix(piece.column("vector"), dim))
                turned = unit @ axes
                values = {
                    "part": part,
                    "seq": seq,
                    "reps": piece.column("rep").to_pylist(),
                    "weights": piece.column("weight").to_pylist(),
                    "matrix": piece.column("vector").flatten().to_numpy(zero_copy_only=False).tobytes(),
                    "low": turned.min(axis=0).tobytes(),
                    "high": turned.max(axis=0).tobytes(),
                }
                seq += 1
                yield pa.RecordBatch.from_pylist([values], schema=arrow_schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow_schema = to_arrow_schema(block_schema)
    ordered = (
        classes.filter(F.size("vector") == dim)
        .mapInArrow(place, placed_schema)
        .repartitionByRange(*cells, "first", "rep")
        .sortWithinPartitions(*cells, "first", "rep")
    )
    blocks = stage(ordered.mapInArrow(cut, block_schema), "grid")
    # a block's number counts on from the tasks before, of which there are few
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    tasks = blocks.groupBy("part").agg(F.count("*").alias("n")).select("part", first)
    number = (F.col("first") + F.col("seq")).cast("int").alias("block")
    held = blocks.join(tasks, "part").select(number, "reps", "weights", "matrix", "low", "high")
    return stage(held, "blocks")


def block_bounds(cells: np.ndarray) -> list[tuple[int, int]]:
    """Where to cut a sorted stretch: at most BLOCK vectors, and between two
    cells rather than inside one if that leaves a quarter of a block."""
    n = cells.shape[1]
    changes = np.flatnonzero((cells[:, 1:] != cells[:, :-1]).any(axis=0)) + 1
    bounds, at = [], 0
    while at < n:
        end = min(at + BLOCK, n)
        if end < n:
            last = np.searchsorted(changes, end, "right") - 1
            if last >= 0 and changes[last] >= at + max(1, BLOCK // 4):
                end = int(changes[last])
        bounds.append((at, end))
        at = end
    return bounds


def near_blocks(blocks: DataFrame, epsilon: float) -> DataFrame:
    """Pairs of blocks (p, q), p <= q, that may hold neighbours.

    Intervals of the order are joined from the whole downwards: a pair of
    intervals whose boxes are more than epsilon apart is skipped with all that
    is in it, any other one is replaced by the pairs of its parts.
    """
    count = blocks.count()
    levels = 0
    while FAN**levels < count:
        levels += 1
    boxes = {0: blocks.select(F.col("block").alias("at"), "low", "high")}
    for level in range(1, levels):
        boxes[level] = stage(merge_boxes(boxes[level - 1]), f"boxes{level}")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            side = {
                name: np.frombuffer(b"".join(batch.column(name).to_pylist())).reshape(
                    len(batch), -1
                )
                for name in ("low_p", "high_p", "low_q", "high_q")
            }
            gap = np.maximum(side["low_p"] - side["high_q"], side["low_q"] - side["high_p"])
            apart = np.sqrt((np.maximum(gap, 0) ** 2).sum(axis=1))
            keep = pa.array(apart <= epsilon + ROUNDING)
            yield batch.select(["p", "q"]).filter(keep)

    spark = blocks.sparkSession
    pairs = spark.range(1).select(F.lit(0).alias("p"), F.lit(0).alias("q"))
    parts = F.sequence(F.lit(0), F.lit(FAN - 1))
    for level in range(levels - 1, -1, -1):
        children = (
            pairs.withColumn("i", F.explode(parts))
            .withColumn("j", F.explode(parts))
            .select((F.col("p") * FAN + F.col("i")).alias("p"), (F.col("q") * FAN + F.col("j")).alias("q"))
            .filter("p <= q")
        )
        of = lambda side, level=level: boxes[level].select(
            F.col("at").alias(side),
            F.col("low").alias(f"low_{side}"),
            F.col("high").alias(f"high_{side}"),
        )
        kept = children.join(of("p"), "p").join(of("q"), "q").mapInArrow(close, "p int, q int")
        pairs = stage(kept, f"intervals{level}")
    return pairs


def merge_boxes(boxes: DataFrame) -> DataFrame:
    """Boxes of intervals of FAN boxes."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        low = np.min([np.frombuffer(x) for x in pdf["low"]], axis=0)
        high = np.max([np.frombuffer(x) for x in pdf["high"]], axis=0)
        return pd.DataFrame(
            {"at": [int(pdf["at"].iloc[0]) // FAN], "low": [low.tobytes()], "high": [high.tobytes()]}
        )

    parent = F.floor(F.col("at") / FAN)
    return boxes.groupBy(parent).applyInPandas(merge, "at int, low binary, high binary")


def tile_side(blocks: int, tasks: int) -> int:
    """Blocks along a tile's side: as many as leave a few tiles for each task,
    since every block travels once per tile in its row and column."""
    tiles = ceil(sqrt(8 * tasks))
    return min(max(ceil(blocks / tiles), SIDES[0]), SIDES[1])


def bounded(unit: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Unit vectors by their first coordinates on `axes` and the length of the
    rest. The product of two of these is at least the cosine: what the rests
    add to it is at most the product of their lengths."""
    first = unit @ axes[:, :BOUNDING]
    rest = np.sqrt(np.maximum(0, 1 - (first * first).sum(axis=1)))
    return np.concatenate([first, rest[:, None]], axis=1).astype(np.float32)


def join_tiles(
    blocks: DataFrame, pairs: DataFrame, least: float, dim: int, axes: np.ndarray, side: int
) -> DataFrame:
    """(rep, links, near): partial counts of links, and a smaller neighbour.

    Tiles of `side` by `side` blocks are compared in one task each, so a block
    travels once per tile and a task holds two sides of a tile. A pair of
    vectors is first bounded on the leading axes; only where that leaves room
    for a link is its cosine taken, in double precision. `near` names the
    smallest vector of the tile that the vector is connected with inside the
    tile. A row without a rep has the number of cosines that a tile took.
    """
    tile = [F.floor(F.col(c) / side).cast("int").alias(f"tile_{c}") for c in ("p", "q")]
    tiled = stage(pairs.select("p", "q", *tile), "tiles")
    held_by = [F.col("tile_p").alias("of_p"), F.col("tile_q").alias("of_q")]
    wanted = tiled.select(*held_by, F.explode(F.array("p", "q")).alias("block")).distinct()
    payload = wanted.join(blocks.select("block", "reps", "weights", "matrix"), "block")
    rep_type = blocks.schema["reps"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("rep", rep_type),
            T.StructField("links", T.LongType()),
            T.StructField("near", rep_type),
        ]
    )

    def compare(held: pd.DataFrame, todo: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values("block")
        units, bounds, begin, at = {}, {}, {}, 0
        for b, matrix, own in zip(held["block"], held["matrix"], held["reps"], strict=True):
            kind = np.dtype(f"f{len(matrix) // (len(own) * dim)}")
            units[b] = unit_rows(np.frombuffer(matrix, kind).reshape(-1, dim).astype(np.float64))
            bounds[b] = bounded(units[b], axes)
            begin[b], at = at, at + len(own)
        reps = np.array([r for block in held["reps"] for r in block], dtype=object)
        weights = np.array([w for block in held["weights"] for w in block], dtype=np.int64)
        links = np.zeros(at, np.int64)
        label = np.arange(at)
        hits, taken = [], 0
        for p, q in zip(todo["p"], todo["q"], strict=True):
            room = np.flatnonzero(bounds[p] @ bounds[q].T >= least - ROUNDING)
            i, j = np.divmod(room, len(bounds[q]))
            if p == q:
                i, j = i[i < j], j[i < j]
            taken += len(i)
            exact = np.einsum("ij,ij->i", units[p][i], units[q][j])
            i, j = i[exact >= least] + begin[p], j[exact >= least] + begin[q]
            if not len(i):
                continue
            links += np.bincount(i, weights[j], at).astype(np.int64)
            links += np.bincount(j, weights[i], at).astype(np.int64)
            hits.append(np.unique(thin(np.stack([i, j]), at), axis=1))
        if hits:
            label = connect(np.concatenate(hits, axis=1), label, reps)
        found = np.nonzero(links)[0]
        return pd.DataFrame(
            {
                "rep": [*reps[found], None],
                "links": [*links[found], taken],
                "near": [*reps[label[found]], None],
            }
        ).astype({"rep": "Int64", "near": "Int64"} if isinstance(rep_type, T.IntegralType) else {})

    sides = payload.groupBy("of_p", "of_q").cogroup(tiled.groupBy("tile_p", "tile_q"))
    return sides.applyInPandas(compare, schema)


def thin(hits: np.ndarray, n: int) -> np.ndarray:
    """Fewer pairs that connect the same vectors."""
    label = connect(hits, np.arange(n), None)
    nodes = np.unique(hits)
    return np.stack([label[nodes], nodes])


def connect(hits: np.ndarray, label: np.ndarray, reps: np.ndarray | None) -> np.ndarray:
    """For each vector the first one, by `reps` or else by place, of its component."""
    if reps is not None:
        rank = np.empty(len(label), np.int64)
        order = np.array(sorted(range(len(reps)), key=reps.__getitem__))
        rank[order] = np.arange(len(reps))
        return order[connect(rank[hits], np.arange(len(label)), None)][rank]
    while True:
        before = label.copy()
        least = np.minimum(label[hits[0]], label[hits[1]])
        np.minimum.at(label, hits[0], least)
        np.minimum.at(label, hits[1], least)
        label = label[label]
        if (label == before).all():
            return label


def near_vectors(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = 0.9,
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors with a cosine of at least `cosine` are linked; component_id is the
    smallest id reachable. For unit vectors that is a distance of at most
    epsilon = sqrt(2 - 2 * cosine), and only blocks that are provably further
    apart are skipped; in the others a pair of vectors is left out only if a
    bound on its leading axes is too low. So all links are found and counted. Equal vectors are
    compared once and counted by their number; links are counted, not
    written out.

    Vectors that are null, empty, zero, or hold a null, NaN or infinite
    component link with nothing. Vectors of different lengths link with
    nothing; each length is joined by itself. Rows that share an id are
    vectors of their own with the same name. Other columns are not read.
    """
    if not 0 < cosine <= 1:
        raise ValueError("the cosine must be above 0 and at most 1")
    epsilon = sqrt(max(0.0, 2 - 2 * cosine)) or ROUNDING
    usable = valid_vectors(vectors, id_col, vector_col).filter("vec_id is not null")
    classes = stage(
        usable.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")),
        "vectors",
    )
    dims = [r[0] for r in classes.select(F.size("vector")).distinct().orderBy(F.size("vector")).collect()]
    found = None
    for dim in dims:
        axes = principal_axes(classes, dim)
        blocks = grid_blocks(classes, dim, axes, epsilon)
        side = tile_side(blocks.count(), vectors.sparkSession.sparkContext.defaultParallelism)
        pairs = near_blocks(blocks, epsilon)
        tiles = join_tiles(blocks, pairs, cosine, dim, axes, side).filter("rep is not null")
        found = tiles if found is None else found.union(tiles)
    ids = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    if found is None:
        zero = F.lit(0).cast("bigint").alias("n_links")
        return ids.select("vec_id", zero, F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = stage(found, "links")
    labels = components(found.select(F.col("rep").alias("a"), F.col("near").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = stage(
        classes.join(counts, "rep", "left")
        .join(labels, classes["rep"] == labels["node"], "left")
        .select(
            "vector",
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
            F.coalesce("component", "rep").alias("component"),
        ),
        "vector-classes",
    )
    ids = ids.withColumn("vector", F.when(F.col("vec_id").isNotNull(), F.col("vector")))
    component = F.coalesce("component", "vec_id")
    return ids.join(classes, "vector", "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
