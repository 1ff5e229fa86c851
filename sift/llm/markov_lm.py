"""A hidden Markov language model over all words of a corpus."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sift.llm import hmm
from sift.llm.common import slices, stage
from sift.llm.hmm import Counts, Hmm
from sift.llm.shingles import split_words

# A word is common if it makes up at least one in COMMON of all tokens, so at
# most COMMON words are, whatever the corpus.
COMMON = 2**20
# Longer words are known by their digest, behind a byte that no text has.
LONGEST, DIGEST = 64, b"\xff"
# Different words that a task counts before it starts anew.
MEMORY = 200_000
# The symbol of the end; those of common words follow, then those of shapes.
END = 0
# Shapes: by the last letter, the length, and whether marks follow the letters.
LETTERS, BANDS, MARKS = 64, (3, 5, 8, 13), ".,;:!?&#$%*@|\"'()[]{}<>-_/\\=+~^`"
SHAPES = 1 + (LETTERS + 2) * (len(BANDS) + 1) * 2


def split_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of texts (A-Z in lower case, null as empty), one after the
    other, and where each text's begin and end."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, bounds = lists.flatten(), lists.offsets.to_numpy()
    full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # blanks at the ends
    if not full.all():
        bounds = np.concatenate([[0], np.cumsum(full)])[bounds]
        words = words.filter(pa.array(full))
    return words, bounds


def word_keys(words: pa.Array) -> pa.Array:
    """Words as bytes, long ones as digests."""
    keys = words.cast(pa.binary())
    long = np.flatnonzero(pc.binary_length(keys).to_numpy(zero_copy_only=False) > LONGEST)
    if not len(long):
        return keys
    digests = [DIGEST + blake2b(keys[at].as_py(), digest_size=16).digest() for at in long.tolist()]
    mask = np.zeros(len(keys), bool)
    mask[long] = True
    return pc.replace_with_mask(keys, pa.array(mask), pa.array(digests, pa.binary()))


def word_shapes(keys: pa.Array) -> np.ndarray:
    """For each key a number below SHAPES that depends on the word's look alone."""
    short = pc.invert(pc.starts_with(keys, DIGEST))
    text = pc.if_else(short, keys, b"").cast(pa.string())
    core = pc.utf8_rtrim(text, MARKS)
    last = pc.utf8_slice_codeunits(core, -1).dictionary_encode()
    kinds = np.array(
        [0 if not c else 1 if c.isdigit() else 2 + ord(c) % LETTERS for c in last.dictionary.to_pylist()],
        np.int32,
    )
    kind = kinds[last.indices.to_numpy()]
    band = np.searchsorted(BANDS, pc.utf8_length(text).to_numpy(), "right")
    marked = pc.not_equal(core, text).to_numpy(zero_copy_only=False)
    shape = 1 + (kind * (len(BANDS) + 1) + band) * 2 + marked
    return np.where(short.to_numpy(zero_copy_only=False), shape, 0).astype(np.int32)


@dataclass(frozen=True)
class Lexicon:
    """Counts of the training tokens. `words` (word, n) has all of them, staged;
    the rest is what tasks need to number symbols, and is bounded."""

    words: DataFrame
    tokens: int
    types: int
    ends: int
    common: list[bytes]
    common_counts: np.ndarray
    shape_tokens: np.ndarray
    shape_types: np.ndarray

    def symbol_counts(self) -> np.ndarray:
        return np.concatenate([[self.ends], self.common_counts, self.shape_tokens]).astype(float)

    def symbol_types(self) -> np.ndarray:
        """Words that a symbol stands for, one unknown word for each shape."""
        single = np.ones(1 + len(self.common))
        return np.concatenate([single, self.shape_types + 1.0])

    def log_counts(self) -> np.ndarray:
        """log10(count + 1) of the end and the common words, 0 for shapes."""
        known = np.concatenate([[self.ends], self.common_counts])
        return np.concatenate([np.log10(known + 1.0), np.zeros(SHAPES)])

    def log_shapes(self) -> np.ndarray:
        """What a shape's words share their chance over, as -log10; else 0."""
        inside = np.log10(self.shape_tokens + self.shape_types + 1.0)
        return np.concatenate([np.zeros(1 + len(self.common)), -inside])

    def is_rare(self) -> Column:
        return F.col("n") * COMMON < self.tokens


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) of `texts` (text); tasks count before anything travels."""
    schema = T.StructType(
        [T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())]
    )

    def flush(found: Counter) -> pa.RecordBatch:
        keys = word_keys(pa.array(found.keys(), pa.binary()))
        counts = pa.array(list(found.values()), pa.int64())
        return pa.RecordBatch.from_arrays([keys, counts], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                found.update(split_words(text.as_py()))
                if len(found) > MEMORY:
                    yield flush(found)
                    found.clear()
        yield flush(found)

    counted = texts.select("text").mapInArrow(run, schema)
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def shape_totals(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and different words of each shape."""
    schema = "shape int, tokens bigint, types bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, types = np.zeros(SHAPES, np.int64), np.zeros(SHAPES, np.int64)
        for batch in batches:
            shapes = word_shapes(batch.column("word"))
            np.add.at(tokens, shapes, batch.column("n").to_numpy())
            np.add.at(types, shapes, 1)
        at = np.flatnonzero(types)
        columns = [pa.array(at.astype(np.int32)), pa.array(tokens[at]), pa.array(types[at])]
        yield pa.RecordBatch.from_arrays(columns, names=["shape", "tokens", "types"])

    totals = words.mapInArrow(run, schema).groupBy("shape")
    tokens, types = np.zeros(SHAPES, np.int64), np.zeros(SHAPES, np.int64)
    for row in totals.agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).collect():
        tokens[row["shape"]], types[row["shape"]] = row["tokens"], row["types"]
    return tokens, types


def lexicon(texts: DataFrame) -> Lexicon:
    """Count all words of `texts` (text); each text ends with one more token."""
    words = stage(count_words(texts), "lm-words")
    total, types = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = texts.count()
    tokens = total + ends
    frequent = words.filter(F.col("n") * COMMON >= tokens).toArrow()
    frequent = frequent.sort_by([("n", "descending"), ("word", "ascending")])
    rare = words.filter(F.col("n") * COMMON < tokens)
    return Lexicon(
        words,
        tokens,
        types + (ends > 0),
        ends,
        frequent["word"].to_pylist(),
        frequent["n"].to_numpy().astype(np.int64),
        *shape_totals(rare),
    )


def encode(rows: DataFrame, held: Lexicon) -> DataFrame:
    """`rows` (row, doc_id, held_out, text) with the texts as symbols.

    Adds n_tokens, `known` and `weight` (number and summed log10(count + 1) of
    common words and the end), `symbols`, and the text's `rare` words, which
    have yet to be looked up.
    """
    added = T.StructType.fromDDL(
        "n_tokens bigint, known bigint, weight double, symbols binary, rare array<binary>"
    )
    names = [c for c in rows.columns if c != "text"]
    schema = T.StructType([*(rows.schema[c] for c in names), *added])
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((held.common, held.log_counts()))
    ends = held.ends

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_, logs = shared.value
        common = pa.array(words_, pa.binary())
        for batch in (piece for b in batches for piece in slices(b, "text", 2**23)):
            words, bounds = split_texts(batch.column("text"))
            keys = word_keys(words)
            number = pc.index_in(keys, value_set=common).fill_null(-1).to_numpy() + 1
            unusual = np.flatnonzero(number == 0)
            rare = keys.take(pa.array(unusual))
            number[unusual] = 1 + len(common) + word_shapes(rare)
            # an end after each text's words
            numbers = np.insert(number, bounds[1:], END).astype(np.int32)
            bounds = bounds + np.arange(len(bounds))
            usual = (numbers <= len(common)) & ((numbers != END) | (ends > 0))
            held_by = np.searchsorted(unusual, (bounds - np.arange(len(bounds))))
            columns = [
                *(batch.column(c) for c in names),
                pa.array(np.diff(bounds)),
                pa.array(np.add.reduceat(usual, bounds[:-1], dtype=np.int64)),
                pa.array(np.add.reduceat(logs[numbers], bounds[:-1])),
                pa.BinaryArray.from_buffers(
                    pa.binary(), len(batch), [None, pa.py_buffer((4 * bounds).astype(np.int32)), pa.py_buffer(numbers)]
                ),
                pa.ListArray.from_arrays(pa.array(held_by.astype(np.int32)), rare),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def _sequences(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(s.as_buffer(), np.int32) for s in batch.column("symbols")]


def expected_counts(encoded: DataFrame, model: Hmm) -> Counts:
    """What the texts' symbols are expected to have done under `model`.

    Each task adds up its own texts and sends a row per symbol that it met,
    at most COMMON + SHAPES; the sums are as many, whatever the corpus.
    """
    states, size = model.states, len(model.emit)
    names = [f"s{at}" for at in range(states)]
    schema = T.StructType(
        [T.StructField("symbol", T.IntegerType()), *(T.StructField(c, T.FloatType()) for c in names)]
    )
    shared = encoded.sparkSession.sparkContext.broadcast(model.single())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = shared.value
        counts = Counts.of(given)
        for pool in hmm.pools(s for batch in batches for s in _sequences(batch)):
            hmm.expect(given, pool, counts)
        met = np.flatnonzero(counts.emit.any(axis=1))
        # moves and starts travel as symbols below zero
        numbers = np.concatenate([met, -1 - np.arange(states + 1)]).astype(np.int32)
        rows = np.concatenate([counts.emit[met], counts.move, counts.start[None]])
        columns = [pa.array(numbers), *(pa.array(c) for c in rows.T.astype(np.float32))]
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    summed = encoded.select("symbols").mapInArrow(run, schema).groupBy("symbol")
    table = summed.agg(*(F.sum(c).alias(c) for c in names)).toArrow()
    shared.destroy()
    rows = np.zeros((size + states + 1, states))
    rows[table["symbol"].to_numpy()] = np.stack([table[c].to_numpy() for c in names], axis=1)
    return Counts(rows[-1 - states], rows[size + 1 :][::-1], rows[:size])


def train(encoded: DataFrame, held: Lexicon, states: int, passes: int) -> Hmm:
    """Baum-Welch over all of `encoded`, the same start every time."""
    types = held.symbol_types()
    model = hmm.first_model(held.symbol_counts() + types, states)
    for _ in range(passes if held.ends else 0):
        model = hmm.improved(expected_counts(encoded, model), types)
    return model


def chain_scores(encoded: DataFrame, held: Lexicon, model: Hmm) -> DataFrame:
    """`encoded` without its symbols, with `chain`: log10 of the chance of the
    symbols, and of the rare words given their shapes but for their counts."""
    names = ["row", "doc_id", "held_out", "n_tokens", "known", "weight"]
    schema = T.StructType(
        [*(encoded.schema[c] for c in names), T.StructField("chain", T.DoubleType())]
    )
    shared = encoded.sparkSession.sparkContext.broadcast((model, held.log_shapes()))

    def score(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        given, inside = shared.value
        sequences = [s for batch in batches for s in _sequences(batch)]
        chain = hmm.log10_likelihood(given, hmm.Pool.of(sequences))
        chain += [inside[s].sum() for s in sequences]
        together = pa.concat_batches([batch.select(names) for batch in batches])
        return pa.RecordBatch.from_arrays([*together.columns, pa.array(chain)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(b.column("symbols").nbytes for b in waiting) >= 4 * hmm.POOL:
                yield score(waiting)
                waiting = []
        if waiting:
            yield score(waiting)

    return encoded.select(*names, "symbols").mapInArrow(run, schema)


def rare_words(encoded: DataFrame, held: Lexicon) -> DataFrame:
    """(row, rare_known, rare_weight) of texts with rare words: how many of them
    the training texts have, and the sum of log10(count + 1)."""
    looked = encoded.select("row", F.explode("rare").alias("word"))
    counts = held.words.filter(held.is_rare())
    count = F.coalesce("n", F.lit(0))
    return (
        looked.join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.count_if(count > 0).alias("rare_known"),
            F.sum(F.log10(count + 1)).alias("rare_weight"),
        )
    )


def score_documents(
    docs: DataFrame,
    training: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    states: int = 8,
    passes: int = 6,
) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    Tokens are the words, A-Z in lower case, then one end. The model learns
    from the texts for which `training` holds; held_out is its opposite, and
    a null counts as false.

    A hidden state moves from token to token and emits symbols: the end, the
    common words (at least one in 2**20 of all training tokens, so there are at
    most that many), and for all other words their shape, of SHAPES. A rare
    word's chance within its shape follows its own count plus one; all unknown
    words of a shape share one such place. Each Baum-Welch pass goes over all
    training texts, whole: tasks add up expected counts, Spark adds up theirs,
    and the model comes back by broadcast, COMMON + SHAPES rows at most.

    `score` is the log10 probability of the text by the scaled forward
    recursion over all of it. `base_score` is that of independent tokens with
    one added to each count, all unknown words together counting as one.
    The counts of rare words, of any number, are joined as a table.

    A null text counts as empty and has the end alone. Rows that share an id
    are documents of their own. Without training texts scores are what adding
    one to no counts gives, and nothing is known. Other columns are not read.
    """
    given = F.coalesce(training, F.lit(False))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), (~given).alias("held_out")
    )
    held = lexicon(rows.filter(~F.col("held_out")))
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    encoded = stage(encode(numbered, held), "lm-symbols")
    model = train(encoded.filter(~F.col("held_out")), held, states, passes)
    chains = stage(chain_scores(encoded, held, model), "lm-chains")
    rare = stage(rare_words(encoded, held), "lm-rare")
    rare_weight = F.coalesce("rare_weight", F.lit(0.0))
    per_token = float(np.log10(held.tokens + held.types + 1))
    return chains.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(held.tokens).cast("bigint").alias("train_tokens"),
        (F.col("weight") + rare_weight - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("chain") + rare_weight).alias("score"),
    )
