"""Language identification by known words, backing off to character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sift.llm.common import slices, stage

# Names what has no letters to go by.
UNDETERMINED = "und"
# A word, or an n-gram, is known if it makes up at least one in SHARE of some
# language's words, or n-grams of that length. So a language has at most SHARE
# of each in the model, however large the corpus and wherever counts tie.
SHARE = 2**17
LONGEST = 4
# Added to every count.
SMOOTHING = 0.5
# Counts a task holds before it hands them on; scores of words a task remembers.
HELD, MEMORY = 300_000, 1_200_000

_WORDS = re.compile(r"[^\W\d_]+").findall


def words_of(text: str) -> list[str]:
    return _WORDS(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a word with a blank on either side; single letters
    without the blanks."""
    marked = word if n == 1 else f" {word} "
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass(frozen=True)
class Table:
    """Log frequencies of names. A language that lacks a name has its `base`;
    what a name has above that lies side by side in `langs` and `above`, from
    starts[row] on. So the table is as large as the counts that it is made of,
    however many languages there are."""

    rows: dict[str, int] = field(default_factory=dict)
    base: np.ndarray = field(default_factory=lambda: np.zeros(0))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    langs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    above: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @classmethod
    def of(cls, names: np.ndarray, langs: np.ndarray, n: np.ndarray, totals: np.ndarray) -> Table:
        """From counts n of names in languages, and all counts of each language."""
        known, row = np.unique(names, return_inverse=True)
        order = np.lexsort((langs, row))
        starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(known)))])
        base = np.log(SMOOTHING / (totals + SMOOTHING * (len(known) + 1)))
        above = np.log((n[order] + SMOOTHING) / SMOOTHING)
        rows = {name: i for i, name in enumerate(known.tolist())}
        return cls(rows, base, starts.astype(np.int64), langs[order], above)

    def add_means(self, scores: np.ndarray, at: list[int], evidence: list[list[int]]) -> None:
        """To scores[at[i]] the mean log frequencies of the names evidence[i]."""
        sizes = np.array([len(rows) for rows in evidence])
        names = np.array([row for rows in evidence for row in rows])
        held = np.diff(self.starts)[names]
        within = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
        entry = np.repeat(self.starts[names], held) + within
        weight = np.repeat(np.repeat(1 / sizes, sizes), held)
        cell = np.repeat(np.repeat(np.array(at), sizes), held) * scores.shape[1] + self.langs[entry]
        flat = np.bincount(cell, self.above[entry] * weight, scores.size)
        scores += flat.reshape(scores.shape)
        scores[at] += self.base


@dataclass(frozen=True)
class LanguageModel:
    """tables[0] is of words, tables[n] of n-grams."""

    languages: list[str]
    tables: list[Table] = field(repr=False)

    def evidence(self, word: str) -> tuple[int, list[int]]:
        """The table that decides on a word and its rows there: the word itself,
        else its longest known n-grams; table -1 if nothing is known."""
        if (row := self.tables[0].rows.get(word)) is not None:
            return 0, [row]
        for n in range(LONGEST, 0, -1):
            rows = self.tables[n].rows
            if known := [r for g in grams_of(word, n) if (r := rows.get(g)) is not None]:
                return n, known
        return -1, []

    def score(self, words: list[str]) -> np.ndarray:
        """A row of scores per word, the mean of its evidence, all at once."""
        scores = np.zeros((len(words), len(self.languages)))
        found: list[list] = [[] for _ in range(LONGEST + 2)]
        for i, word in enumerate(words):
            n, rows = self.evidence(word)
            found[n].append((i, rows))
        for table, these in zip(self.tables, found, strict=False):
            if these:
                table.add_means(scores, [i for i, _ in these], [rows for _, rows in these])
        return scores


class Scorer:
    """Scores texts, remembering the words it has met."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.model.languages)))

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        languages = self.model.languages
        if not languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        words = [words_of(t) if t else [] for t in texts]
        if len(self.known) * len(languages) > MEMORY:
            self.forget()
        new = list(set().union(*words).difference(self.known))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.rows = np.concatenate([self.rows, self.model.score(new)])
        found = []
        for text, mine in zip(texts, words, strict=True):
            if not mine or not any(map(str.isalpha, text)):
                found.append((UNDETERMINED, 0.0))
                continue
            at = np.fromiter(map(self.known.__getitem__, mine), np.int64, len(mine))
            total = self.rows[at].sum(axis=0)
            best = int(total.argmax())
            found.append((languages[best], float(1 / np.exp(total - total[best]).sum())))
        return found


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over the whole texts of `docs` (lang, text)."""
    schema = T.StructType.fromDDL("lang string, word string, n bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def flush() -> pa.RecordBatch:
            langs = [lang for lang, c in counts.items() for _ in c]
            words = [w for c in counts.values() for w in c]
            numbers = [n for c in counts.values() for n in c.values()]
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(words, pa.string()),
                 pa.array(numbers, pa.int64())],
                names=schema.names,
            )

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                counts.setdefault(lang.as_py(), Counter()).update(words_of(text.as_py()))
                if sum(map(len, counts.values())) >= HELD:
                    yield flush()
        yield flush()

    return docs.select("lang", "text").mapInArrow(run, schema).groupBy("lang", "word").agg(
        F.sum("n").alias("n")
    )


def count_grams(words: DataFrame) -> DataFrame:
    """(lang, length, gram, n) of counted words (lang, word, n)."""
    schema = T.StructType.fromDDL("lang string, length int, gram string, n bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            langs, lengths, grams = zip(*counts, strict=True) if counts else ((), (), ())
            numbers = list(counts.values())
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(langs, pa.string()),
                    pa.array(lengths, pa.int32()),
                    pa.array(grams, pa.string()),
                    pa.array(numbers, pa.int64()),
                ],
                names=schema.names,
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("lang", "word", "n"))
            for lang, word, n in zip(*columns, strict=True):
                for length in range(1, LONGEST + 1):
                    for gram in grams_of(word, length):
                        counts[lang, length, gram] += n
                if len(counts) >= HELD:
                    yield flush()
        yield flush()

    found = words.select("lang", "word", "n").mapInArrow(run, schema)
    return found.groupBy("lang", "length", "gram").agg(F.sum("n").alias("n"))


def known_counts(counts: DataFrame, groups: list[str], name: str) -> DataFrame:
    """The rows of all names that are known, by their share in some language.

    Which names these are is decided on the counts where they lie, against
    the totals of each language, a row per language and length.
    """
    totals = counts.groupBy(*groups).agg(F.sum("n").alias("total"))
    same = [g for g in groups if g != "lang"]
    known = counts.join(F.broadcast(totals), groups).filter(F.col("n") * SHARE >= F.col("total"))
    names = stage(known.select(*same, name).distinct(), "known-names")
    return counts.join(names, [*same, name])


def train(docs: DataFrame) -> LanguageModel:
    """Learn from `docs` (lang, text); rows where either is null teach nothing.

    What reaches the driver are the known words and n-grams with their counts,
    at most SHARE per language and length.
    """
    words = stage(count_words(docs.filter("lang is not null and text is not null")), "words")
    grams = stage(count_grams(words), "grams")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").collect()
    languages = [r.lang for r in totals]
    number = {lang: i for i, lang in enumerate(languages)}
    every = np.zeros((LONGEST + 1, len(languages)))
    every[0] = [r.n for r in totals]
    for r in grams.groupBy("lang", "length").agg(F.sum("n").alias("n")).collect():
        every[r.length, number[r.lang]] = r.n

    def table(rows: pa.Table, totals: np.ndarray) -> Table:
        langs = [number[lang] for lang in rows["lang"].to_pylist()]
        names = np.array(rows["name"].to_pylist(), dtype=object)
        return Table.of(names, np.array(langs, np.int32), rows["n"].to_numpy().astype(float), totals)

    found = known_counts(words, ["lang"], "word")
    tables = [table(found.select("lang", F.col("word").alias("name"), "n").toArrow(), every[0])]
    found = stage(known_counts(grams, ["lang", "length"], "gram"), "known-grams")
    for n in range(1, LONGEST + 1):
        of = found.filter(F.col("length") == n).select("lang", F.col("gram").alias("name"), "n")
        tables.append(table(of.toArrow(), every[n]))
    return LanguageModel(languages, tables)


def predict(docs: DataFrame, model: LanguageModel, text_col: str, *keep: Column) -> DataFrame:
    """Columns `keep` of each row, lang_pred and score."""
    rows = docs.select(*keep, F.col(text_col).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [
            *rows.schema.fields[:-1],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for piece in slices(batch, "_text"):
                found = scorer(piece.column("_text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        *piece.columns[:-1],
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)


def identify(
    docs: DataFrame,
    learnt: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    Learns from the rows for which `learnt` holds and both text and language
    are known, and predicts every row from its whole text alone. Known words,
    at least one in SHARE of a language's, score by their log frequency in
    each language, others by their longest known character n-grams; the score
    is the softmax of the sums. A
    text that is null or has no letter, and any text if nothing was learnt, is
    `und` with score 0. Letters that were never seen favour no language; a tie
    goes to the first language by name.
    """
    teaching = docs.filter(learnt).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    held_out = (~F.coalesce(learnt, F.lit(False))).alias("held_out")
    return predict(docs, train(teaching), text_col, F.col(id_col).alias("doc_id"), held_out)
