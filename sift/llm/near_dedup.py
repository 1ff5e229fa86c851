"""Near duplicates by SetSketch registers, confirmed on whole shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sift.llm.common import WORD_PATTERN, slices, stage, text_key
from sift.llm.components import components
from sift.llm.shingles import WordHashes, shingle_hashes, shingle_set, split_words

# Fixed values of the sketch: base, rate and largest register. With so small a
# base two registers agree about as often as the sets overlap.
BASE, RATE, LARGEST = 1.001, 20.0, 2**16 - 1
# Types that Spark has no hash for.
UNHASHED = (T.MapType, T.VariantType)
# Shingles whose register values are computed at once.
CHUNK = 2048


@dataclass(frozen=True)
class Sketch:
    """`bands` groups of `rows` registers; a candidate agrees in a whole group.

    At a Jaccard similarity of 0.8 a pair is missed with a chance of
    (1 - 0.8**rows)**bands, 1.2e-7 here.
    """

    bands: int = 40
    rows: int = 5

    @property
    def size(self) -> int:
        return self.bands * self.rows

    def factors(self) -> np.ndarray:
        draw = np.random.default_rng(20_240_601)
        return draw.integers(1, 2**63, self.size, np.uint64) * np.uint64(2) + np.uint64(1)

    def registers(self, shingles: np.ndarray) -> np.ndarray:
        """Each register is the smallest of the shingles' exponential variables,
        on a logarithmic scale and truncated; the sketch of a union is the
        larger of both registers."""
        factors = self.factors()[:, None]
        least = np.full(self.size, 2**64 - 1, np.uint64)
        for at in range(0, len(shingles), CHUNK):
            mixed = shingles[None, at : at + CHUNK] * factors
            mixed ^= mixed >> np.uint64(31)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            np.minimum(least, mixed.min(axis=1), out=least)
        exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
        value = np.floor(1 - np.log(exponential) / np.log(BASE))
        return np.clip(value, 0, LARGEST).astype(np.uint16)

    def keys(self, registers: np.ndarray) -> np.ndarray:
        """One 64-bit key per band, for many sketches at once."""
        bands = registers.reshape(-1, self.bands, self.rows).astype(np.uint64)
        mixed = np.broadcast_to(np.arange(self.bands, dtype=np.uint64), bands.shape[:2]).copy()
        for i in range(self.rows):
            mixed = (mixed ^ bands[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(32)
        return mixed.view(np.int64)


def joint_estimate(
    a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray
) -> np.ndarray:
    """Jaccard similarity by maximum likelihood, given both set sizes.

    The numbers of registers that are larger in a, larger in b and equal are
    trinomial; their chances depend on the similarity alone once the sizes are
    known. The likelihood is taken on a grid.
    """
    above = (a > b).sum(axis=1)[:, None]
    below = (a < b).sum(axis=1)[:, None]
    equal = a.shape[1] - above - below
    u = (size_a / (size_a + size_b))[:, None]
    most = np.minimum(u / (1 - u), (1 - u) / u)
    grid = np.linspace(0, 1, 201)[None, :] * most
    chance = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    larger = chance(u - (1 - u) * grid)
    smaller = chance((1 - u) - u * grid)
    tiny = 1e-300
    fit = (
        above * np.log(larger + tiny)
        + below * np.log(smaller + tiny)
        + equal * np.log(np.maximum(1 - larger - smaller, 0) + tiny)
    )
    return np.take_along_axis(grid, fit.argmax(axis=1)[:, None], axis=1)[:, 0]


def sketch_documents(docs: DataFrame, k: int, sketch: Sketch) -> DataFrame:
    """`docs` with content, n_shingles and registers instead of their `text`.

    `content` is a 128-bit digest of the word sequence; without words it and
    the registers are null.
    """
    names = [c for c in docs.columns if c != "text"]
    added = T.StructType.fromDDL("content binary, n_shingles bigint, registers binary")
    schema = T.StructType([*(docs.schema[c] for c in names), *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            contents, counts, registers = [], [], []
            for text in batch.column("text"):
                words = split_words(text.as_py())
                found = np.unique(shingle_hashes(hashes.of(words), k))
                counts.append(len(found))
                contents.append(hashlib.md5(b" ".join(words)).digest() if words else None)
                registers.append(sketch.registers(found).tobytes() if words else None)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names),
                    pa.array(contents, pa.binary()),
                    pa.array(counts, pa.int64()),
                    pa.array(registers, pa.binary()),
                ],
                names=schema.names,
            )

    return docs.select(*names, "text").mapInArrow(run, schema)


def band_rows(sketched: DataFrame, sketch: Sketch) -> DataFrame:
    """(key, doc_id), one row per band."""
    schema = T.StructType([T.StructField("key", T.LongType()), sketched.schema["doc_id"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            registers = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16)
            keys = sketch.keys(registers)
            rows = np.repeat(np.arange(len(keys)), sketch.bands)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), batch.column("doc_id").take(pa.array(rows))],
                names=schema.names,
            )

    return sketched.select("doc_id", "registers").mapInArrow(run, schema)


def likely(pairs: DataFrame, sketched: DataFrame, sketch: Sketch, threshold: float) -> DataFrame:
    """The pairs (a, b) whose estimate isn't six deviations below the threshold."""
    least = threshold - 6 * float(np.sqrt(threshold * (1 - threshold) / sketch.size))
    of = lambda side: sketched.select(
        F.col("doc_id").alias(side),
        F.col("registers").alias(f"registers_{side}"),
        F.col("n_shingles").alias(f"n_{side}"),
    )
    schema = pairs.select("a", "b").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = []
            for side in "ab":
                joined = b"".join(batch.column(f"registers_{side}").to_pylist())
                both.append(np.frombuffer(joined, np.uint16).reshape(-1, sketch.size))
            both += [batch.column(f"n_{s}").to_numpy(zero_copy_only=False) for s in "ab"]
            parts = [
                joint_estimate(*(column[at : at + 1000] for column in both)) >= least
                for at in range(0, len(batch), 1000)
            ]
            keep = np.concatenate(parts) if parts else np.zeros(0, bool)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return pairs.join(of("a"), "a").join(of("b"), "b").mapInArrow(run, schema)


def confirm(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets overlap enough, by the whole texts."""
    of = lambda side: texts.select(
        F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}")
    )
    schema = pairs.select("a", "b").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, set()
        for batch in batches:
            keep = []
            texts_a, texts_b = batch.column("text_a"), batch.column("text_b")
            for i, b in enumerate(batch.column("b")):
                if (b := b.as_py()) != last:
                    last, last_set = b, shingle_set(split_words(texts_b[i].as_py()), k)
                own = shingle_set(split_words(texts_a[i].as_py()), k)
                shared = len(own & last_set)
                keep.append(100 * shared >= percent * (len(own) + len(last_set) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(of("a"), "a").join(of("b"), "b").mapInArrow(run, schema)


def central_members(shared: DataFrame) -> DataFrame:
    """(key, head): of each bucket the member with most company in all its buckets.

    Among copies with random edits that is the least edited one, which is
    more alike to all others than they are to each other.
    """
    company = stage(shared.groupBy("doc_id").agg(F.sum("n").alias("company")), "company")
    rank = F.struct("company", F.xxhash64("doc_id"), "doc_id")
    best = shared.join(company, "doc_id").groupBy("key").agg(F.max(rank).alias("best"))
    return best.select("key", F.col("best.doc_id").alias("head"))


def shingle_rows(texts: DataFrame, k: int) -> DataFrame:
    """(doc_id, shingle): the hashed sets of `texts` (doc_id, text), as rows."""
    schema = T.StructType([texts.schema["doc_id"], T.StructField("shingle", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for piece in slices(batch, "text"):
                sets = [
                    np.unique(shingle_hashes(hashes.of(split_words(t.as_py())), k))
                    for t in piece.column("text")
                ]
                rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id").take(pa.array(rows)),
                        pa.array(np.concatenate(sets).view(np.int64)),
                    ],
                    names=schema.names,
                )

    return texts.select("doc_id", "text").mapInArrow(run, schema)


def rare_prefixes(texts: DataFrame, counts: DataFrame, k: int, percent: int) -> DataFrame:
    """(shingle, doc_id, n, place): of each document the rarest shingles, as far
    as the first one that it shares with a similar document can be from the
    rarest on. `counts` has doc_id and n. Shingles that no other document of
    `texts` has come first and can't be shared, so they take places only.
    """
    rows = stage(shingle_rows(texts, k), "shingles")
    several = rows.groupBy("shingle").agg(F.count("*").alias("documents"))
    several = stage(several.filter("documents > 1"), "shared-shingles")
    mine = Window.partitionBy("doc_id")
    rank = F.row_number().over(mine.orderBy("documents", "shingle"))
    placed = (
        rows.join(several, "shingle")
        .withColumn("rank", rank)
        .withColumn("shared", F.count("*").over(mine))
        .join(counts, "doc_id")
        .withColumn("place", F.col("n") - F.col("shared") + F.col("rank") - 1)
    )
    return placed.filter(f"100 * (n - place) >= {percent} * n").select(
        "shingle", "doc_id", "n", "place"
    )


def near_classes(
    docs: DataFrame, k: int, percent: int, sketch: Sketch, *, by_id: bool
) -> tuple[DataFrame, DataFrame]:
    """The rows of `docs` (doc_id, key, text, and others) without their texts,
    with content and n_shingles; and (content, first, component) for every
    content. `key` tells texts apart.

    A content is one node of the graph, whatever the ids of the texts that
    have it; `first` is the smallest id among these. `by_id` leaves out rows
    without an id and links all contents that have an id in common.

    1. Texts with the same words are one class.
    2. Classes that agree in a band of registers are candidates. Each bucket
       first compares all its members with its most central one, which takes
       linear work and joins what belongs together in most buckets.
    3. Where a bucket still holds several components, its members outside the
       largest one are compared with documents of other components, if both
       have one of their rarest shingles in common, near enough to the rarest
       to leave room for the similarity. So any two members of a bucket are
       connected, compared, or provably not similar: no link among candidates
       is lost, however large the bucket.

    Candidates are dropped if the likelihood estimate is six deviations too
    low; the rest is confirmed on the sets of the whole texts.
    """
    rows = stage(sketch_documents(docs, k, sketch), "sketches")
    usable = rows.filter("content is not null")
    if by_id:
        usable = usable.filter("doc_id is not null")
    classes = usable.groupBy("content").agg(
        F.min("doc_id").alias("first"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("registers").alias("registers"),
        F.min("key").alias("key"),  # of one of its texts, which will do for all
    )
    # the nodes are numbered once and for all as they are stored
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    sketched = classes.select(F.col("node").alias("doc_id"), "n_shingles", "registers")

    buckets = band_rows(sketched, sketch)
    sizes = buckets.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    # rows of buckets with two or more members, and the texts of these
    shared = stage(buckets.join(stage(sizes, "bucket-sizes"), "key"), "buckets")
    members = shared.select("doc_id").distinct()
    wanted = classes.select("key", F.col("node").alias("doc_id")).join(members, "doc_id")
    texts = docs.select("key", "text").join(stage(wanted, "bucket-members").hint("merge"), "key")
    texts = stage(texts.groupBy("doc_id").agg(F.first("text").alias("text")), "texts")
    heads = stage(central_members(shared), "heads")
    stars = shared.join(heads, "key").filter("doc_id != head")
    first = stage(
        stars.select(
            F.greatest("doc_id", "head").alias("a"), F.least("doc_id", "head").alias("b")
        ).distinct(),
        "stars",
    )

    def links(pairs: DataFrame) -> DataFrame:
        plausible = stage(likely(pairs, sketched, sketch, percent / 100), "candidates")
        return stage(confirm(plausible, texts, k, percent), "links")

    edges = links(first)
    if by_id:
        edges = edges.union(same_ids(usable, classes))
    found = components(edges)
    second = across_components(shared, sketched, texts, found, first, k, percent)
    if not second.isEmpty():
        found = components(edges.union(links(second)))
    return rows.drop("registers"), stage(
        classes.join(found, "node", "left").select(
            "content", "first", F.coalesce("component", "node").alias("component")
        ),
        "components",
    )


def same_ids(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the contents of ids that have several."""
    of = usable.join(classes.select("content", "node"), "content").select("doc_id", "node")
    ends = of.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("most"))
    several = stage(ends.filter("b != most").select("doc_id", "b"), "repeated-ids")
    return of.join(several, "doc_id").filter("node != b").select(F.col("node").alias("a"), "b")


def near_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    percent: int = 80,
    sketch: Sketch = Sketch(),
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of k-word shingles have a Jaccard
    similarity of at least `percent` hundredths; component_id is the smallest
    id reachable by links, as `near_classes` finds them.

    A document without words has an empty set and links with nothing. With
    fewer than k words the whole sequence is the one shingle. Null ids are
    documents of their own that link with nothing; rows that share an id are
    one document when links are followed, each with the links of all of its
    texts. Other columns are not read.
    """
    text = F.col(text_col).cast("string")
    docs = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    docs = docs.withColumn("key", text_key("text"))
    rows, classes = near_classes(docs, k, percent, sketch, by_id=True)
    least = stage(classes.groupBy("component").agg(F.min("first").alias("least")), "least-ids")
    of = stage(classes.join(least, "component").select("content", "least"), "class-ids")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("least")), "doc_id")
    return rows.join(of, "content", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def distant_rows(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    percent: int = 80,
    sketch: Sketch = Sketch(),
) -> DataFrame:
    """One whole row of `docs` for each group of near duplicates.

    Groups are those of `near_groups`, but of rows, whatever their ids. The
    row with the smallest id stays, a null id only if the group has no other;
    then digests of the text and the whole row decide. Rows without words all
    stay. The choice is made on narrow rows; the rows themselves travel once,
    by these digests, and repeated ones collapse before.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row = F.struct(*(column.alias(f"c{at}") for at, column in enumerate(columns)))
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, UNHASHED)]
    text = F.col(f"`{text_col}`").cast("string")
    keyed = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        text_key(f"`{text_col}`").alias("key"),
        F.xxhash64(*hashed).alias("rest"),
        text.alias("text"),
        row.alias("row"),
    )
    rows, classes = near_classes(keyed.drop("row"), k, percent, sketch, by_id=False)
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key", "rest")).alias("best")
    stays = (
        rows.filter("content is not null")
        .join(classes.select("content", "component"), "content")
        .groupBy("component")
        .agg(best)
        .select("best.key", "best.rest")
    )
    worded = F.coalesce(F.regexp_like("text", F.lit(WORD_PATTERN)), F.lit(False))
    single = keyed.filter(worded).groupBy("key", "rest").agg(F.first("row").alias("row"))
    stays = stage(stays, "near-stays").hint("merge")
    kept = single.join(stays, ["key", "rest"], "left_semi").select("row")
    return kept.union(keyed.filter(~worded).select("row")).select("row.*").toDF(*docs.columns)


def across_components(
    shared: DataFrame,
    sketched: DataFrame,
    texts: DataFrame,
    found: DataFrame,
    tried: DataFrame,
    k: int,
    percent: int,
) -> DataFrame:
    """Pairs of documents that were candidates, are in different components, can
    be similar, and were not tried yet."""
    of = found.withColumnRenamed("node", "doc_id")
    labelled = stage(
        shared.select("key", "doc_id")
        .join(of, "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id")),
        "labelled",
    )
    parts = labelled.groupBy("key", "component").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("key").agg(
        F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("parts")
    )
    mixed = stage(
        mixed.filter("parts > 1").select("key", F.col("most.component").alias("main")), "mixed"
    )
    members = stage(
        labelled.join(mixed, "key")
        .groupBy("doc_id", "component")
        .agg(F.max(F.col("component") != F.col("main")).alias("outside")),
        "members",
    )
    open_ = members.select("doc_id")
    counts = sketched.select("doc_id", F.col("n_shingles").alias("n"))
    counts = stage(counts.join(open_, "doc_id", "left_semi"), "shingle-counts")
    prefixes = rare_prefixes(texts.join(open_, "doc_id", "left_semi"), counts, k, percent)
    prefixes = stage(prefixes.join(members, "doc_id"), "prefixes")
    x = prefixes.filter("outside").select(
        "shingle", *[F.col(c).alias(f"x_{c}") for c in ("doc_id", "n", "place", "component")]
    )
    # what two sets share begins with a common shingle, and only what follows
    # it in either can be shared as well
    pairs = (
        x.join(prefixes, "shingle")
        .filter("component != x_component and (not outside or doc_id < x_doc_id)")
        .filter(
            f"{100 + percent} * least(n - place, x_n - x_place) >= {percent} * (n + x_n)"
        )
        .select(
            F.greatest("x_doc_id", "doc_id").alias("a"), F.least("x_doc_id", "doc_id").alias("b")
        )
        .distinct()
    )
    return stage(pairs.join(tried, ["a", "b"], "left_anti"), "across")
