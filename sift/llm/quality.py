"""Quality and toxicity of documents: weak labels, then hashed linear scorers."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sift.llm.common import slices, stage

# Buckets of the hashed features.
SHAPE_BUCKETS, WORD_BUCKETS = 2**12, 2**18
# Different texts of each class that a scorer is fitted on at most (for toxicity
# half as many more toxic ones, and four times as many clean ones), those with the
# smallest hashes; everything else here covers all documents.
SAMPLE = 2000
# A word counts towards toxicity if its share in either class differs by so
# many standard errors.
SCREEN = 4.0
# Words at which a text's shapes count half.
LITTLE = 10
# Leading letters of a word that are a feature beside the whole word.
STEM = 5
# Words whose features a task remembers.
MEMORY = 100_000

# From these scores on a document is good enough, and too toxic. A clean
# document lost weighs more than a toxic one let through.
GOOD_ENOUGH, TOO_TOXIC = 0.5, 0.8

GOOD, UNSURE, BAD = 1, 0, -1


@dataclass(frozen=True)
class Profile:
    """What the labellers look at: shares of a text's words."""

    words: int
    marked: float  # end in two or more symbols
    capital: float  # have capital letters only
    repeated: float  # are the same as the word before
    wordless: float  # have no letter or digit
    symbols: float  # symbols per word
    stopped: float  # of the words with letters, those that end in a stop or comma
    short: float  # those with at most three characters
    distinct: float  # different ones


def band(value: float, good: tuple[float, float], bad: tuple[float, float]) -> int:
    """Good inside `good`, bad outside `bad`, else unsure."""
    if good[0] <= value <= good[1]:
        return GOOD
    return UNSURE if bad[0] <= value <= bad[1] else BAD


# Each labeller sees one property and may be wrong; how far it is to be
# trusted is estimated, not set. The first four only ever object.
LABELLERS: dict[str, Callable[[Profile], int]] = {
    "marked": lambda p: BAD if p.marked > 0.1 else UNSURE,
    "capital": lambda p: BAD if p.capital > 0.3 and p.words >= 5 else UNSURE,
    "repeated": lambda p: BAD if p.repeated > 0.15 else UNSURE,
    "wordless": lambda p: BAD if p.wordless > 0.15 else UNSURE,
    "stopped": lambda p: band(p.stopped, (0.04, 0.35), (0.02, 0.6)) if p.words >= 20 else UNSURE,
    "short": lambda p: band(p.short, (0.25, 0.75), (0.12, 0.9)) if p.words >= 20 else UNSURE,
    "distinct": lambda p: band(p.distinct, (0.35, 1), (0.2, 1)) if p.words >= 50 else UNSURE,
    "symbols": lambda p: band(p.symbols, (0, 0.4), (0, 0.8)),
}

# Words that insult, by language. Each list is a labeller of
# toxicity that objects to a text with one of its words.
INSULTS = {
    "en": """bastard bitch clown coward creep cretin crap disgusting dumb dumbass fool freak
        garbage idiot idiots idiotic imbecile jerk liar loser losers lunatic maggot moron morons
        moronic parasite pathetic pig pigs psycho rat retard scum scumbag shit slut stupid trash
        ugly vermin whore worthless wretch""",
    "de": "abschaum arschloch blödmann dummkopf schlampe schwachkopf trottel versager",
    "fr": "abruti connard crétin imbécile minable ordure salaud salope",
    "es": "basura cabrón estúpido gilipollas imbécil inútil patético perdedor",
}
TOXIC_LABELLERS: dict[str, Callable[[set[str]], int]] = {
    lang: lambda words, known=frozenset(listed.split()): UNSURE if known.isdisjoint(words) else BAD
    for lang, listed in INSULTS.items()
}

# How often, of all its objections, a list objects to texts that aren't toxic
# at most, and how often the table of labels is wrong.
HEURISTIC_ERRORS, LABEL_ERRORS = 0.1, 0.01

_LOWER = re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_DIGITS = re.compile(r"\d+")
_MARKED = re.compile(r"[^\w.,;:]{2,}$")
_SYMBOL = re.compile(r"[^\w\s]")
_LETTERS = re.compile(r"[^\W\d_]+")


def shapes_of(text: str) -> Counter:
    """Words with runs of small letters, capitals and digits as a, A and 0."""
    return Counter(_DIGITS.sub("0", _UPPER.sub("A", _LOWER.sub("a", text))).split())


def profile(text: str, shapes: Counter) -> Profile:
    words = text.split()
    n = len(words)
    if not n:
        return Profile(0, *[0.0] * 8)

    def count(holds: Callable[[str], object]) -> int:
        return sum(c for s, c in shapes.items() if holds(s))

    bare = {s for s in shapes if not ("a" in s or "A" in s)}
    lettered = [w for w in words if w not in bare] if bare else words
    m = max(len(lettered), 1)
    return Profile(
        n,
        count(_MARKED.search) / n,
        count(lambda s: "A" in s and "a" not in s) / n,
        sum(map(eq, words, words[1:])) / n,
        count(lambda s: s in bare and "0" not in s) / n,
        sum(len(_SYMBOL.findall(s)) * c for s, c in shapes.items()) / n,
        count(lambda s: s not in bare and s[-1] in ".,;:") / m,
        sum(len(w) <= 3 for w in lettered) / m,
        len(set(lettered)) / m,
    )


def shape_features(p: Profile, shapes: Counter) -> dict[int, float]:
    """Hashed shares of shapes, and of repeated and distinct words; a vector of
    length 1, but shorter for the few words of a short text, which prove less."""
    found: dict[int, float] = {}

    def add(name: str, value: float) -> None:
        bucket = crc32(name.encode()) % SHAPE_BUCKETS
        found[bucket] = found.get(bucket, 0.0) + value

    for shape, count in shapes.items():
        add(shape, (count / p.words) ** 0.5)
    add("=repeated", p.repeated**0.5)
    add("=distinct", p.distinct**0.5)
    length = sum(v * v for v in found.values()) ** 0.5
    trust = p.words / (p.words + LITTLE) / length
    return {k: v * trust for k, v in found.items()}


class WordBuckets(dict):
    """Buckets of a word: its own and that of its first letters."""

    def __missing__(self, word: str) -> tuple[int, int]:
        own = crc32(word.encode()) % WORD_BUCKETS
        stem = crc32(b"^" + word[:STEM].encode()) % WORD_BUCKETS
        self[word] = found = (own, stem)
        return found

    def of(self, text: str) -> np.ndarray:
        if len(self) > MEMORY:
            self.clear()
        pairs = map(self.__getitem__, set(_LETTERS.findall(text.lower())))
        return np.array(list({b for pair in pairs for b in pair}), np.int64)


# --- weak labels ----------------------------------------------------------


@dataclass(frozen=True)
class LabelModel:
    """Chance of the good class, and of each labeller's votes in either class."""

    good: float
    votes: np.ndarray  # class (bad, good), labeller, vote (bad, unsure, good)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Chance of being good, for rows of votes."""
        if not len(patterns):
            return np.zeros(0)
        each = np.log(self.votes[:, np.arange(patterns.shape[1]), patterns + 1]).sum(axis=2)
        odds = each[1] - each[0] + np.log(self.good) - np.log1p(-self.good)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def estimate(
    patterns: np.ndarray,
    counts: np.ndarray,
    rounds: int = 100,
    *,
    lean: float = 0.0,
    errors: np.ndarray | None = None,
) -> LabelModel:
    """Expectation-maximisation over vote patterns and how often each occurs.

    Starts from the votes, objections counting three times, and from `lean`
    where nobody votes. Labellers are taken as independent given the class;
    one half is added to every count. Where votes are too few to tell which
    class is which, `errors` bounds how often each labeller votes wrongly in a
    class, as a share of how often it votes so at all.
    """
    start = patterns.sum(axis=1) - 2.0 * (patterns == BAD).sum(axis=1)
    start += lean * (patterns == UNSURE).all(axis=1)
    good = 1 / (1 + np.exp(-np.clip(start, -30, 30)))
    for _ in range(rounds):
        weight = np.stack([(1 - good) * counts, good * counts])
        shown = np.stack([patterns == v for v in (BAD, UNSURE, GOOD)], axis=2)
        votes = np.einsum("cp,plv->clv", weight, shown) + 0.5
        votes /= votes.sum(axis=2, keepdims=True)
        if errors is not None:
            said = np.einsum("p,plv->lv", counts, shown) / counts.sum()
            for kind, wrong in ((0, GOOD + 1), (1, BAD + 1)):
                most = np.minimum(votes[kind, :, wrong], errors * said[:, wrong] + 1e-6)
                votes[kind, :, UNSURE + 1] += votes[kind, :, wrong] - most
                votes[kind, :, wrong] = most
        share = (weight[1].sum() + 0.5) / (counts.sum() + 1)
        model = LabelModel(float(share), votes)
        before, good = good, model.posterior(patterns)
        if np.abs(good - before).max(initial=0) < 1e-6:
            break
    return model


# --- linear scorer --------------------------------------------------------


def telling(rows: list[np.ndarray], labels: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets whose shares of the two classes' rows differ by SCREEN standard errors."""
    in_class = [
        np.bincount(np.concatenate([r for r, c in zip(rows, labels, strict=True) if c == v]), None, buckets)
        for v in (0, 1)
    ]
    n = [(labels == v).sum() for v in (0, 1)]
    share = (in_class[0] + in_class[1]) / sum(n)
    error = np.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]))
    return np.abs(in_class[1] / n[1] - in_class[0] / n[0]) > SCREEN * error


def fit_linear(
    rows: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    buckets: int,
    share: float,
    rounds: int = 80,
) -> np.ndarray:
    """Weights of a logistic model of sparse rows (buckets, values); labels are
    chances. The last weight, the constant, is not fitted but set to the odds
    of `share`, the labels' mean outside the sample, so that a row without
    evidence scores as such. Full gradients, steps scaled by the gradients'
    running squares."""
    weights = np.zeros(buckets + 1)
    if not rows:
        return weights
    at = np.concatenate([r[0] for r in rows])
    value = np.concatenate([r[1] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    used, at = np.unique(at, return_inverse=True)
    odds = lambda p: np.log(p) - np.log1p(-p)
    constant = odds(np.clip(labels.mean(), 1e-3, 0.999))
    small = np.zeros(len(used))
    mean, square = np.zeros(len(used)), np.full(len(used), 1e-8)
    for step in range(1, rounds + 1):
        score = np.bincount(row, small[at] * value, len(rows)) + constant
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels) / len(rows)
        gradient = np.bincount(at, error[row] * value, len(used)) + 1e-5 * small
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        move = 0.3 / step**0.3 * (mean / (1 - 0.9**step))
        small -= move / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights[used], weights[-1] = small, odds(np.clip(share, 1e-3, 0.999))
    return weights


def logistic(weights: np.ndarray, at: np.ndarray, value: np.ndarray | float = 1.0) -> float:
    score = float((weights[at] * value).sum() + weights[-1])
    return 1 / (1 + np.exp(-min(max(score, -500), 500)))


@dataclass(frozen=True)
class QualityModel:
    """Both scorers' weights; no toxicity is known if one side has no text."""

    shapes: np.ndarray
    words: np.ndarray | None

    def quality(self, text: str) -> float:
        shapes = shapes_of(text)
        if not shapes:
            return 0.0
        found = shape_features(profile(text, shapes), shapes)
        return logistic(self.shapes, np.fromiter(found, np.int64), np.fromiter(found.values(), float))

    def toxicity(self, text: str, buckets: WordBuckets) -> float:
        return 0.0 if self.words is None else logistic(self.words, buckets.of(text))


# --- over tables ----------------------------------------------------------


def vote(docs: DataFrame) -> DataFrame:
    """(doc_id, key, pattern, toxic, buckets, shares) of `docs` (doc_id, key,
    text), without the texts that have no words: the votes of both sets of
    labellers, and the features of the shapes."""
    added = "pattern array<int>, toxic array<int>, buckets array<int>, shares array<double>"
    names = ["doc_id", "key"]
    schema = T.StructType([*(docs.schema[c] for c in names), *T.StructType.fromDDL(added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, columns = [], ([], [], [], [])
            for i, text in enumerate(batch.column("text")):
                text = text.as_py() or ""
                if not (shapes := shapes_of(text)):
                    continue
                seen = profile(text, shapes)
                words = set(_LETTERS.findall(text.lower()))
                found = shape_features(seen, shapes)
                kept.append(i)
                for column, value in zip(
                    columns,
                    (
                        [label(seen) for label in LABELLERS.values()],
                        [label(words) for label in TOXIC_LABELLERS.values()],
                        list(found),
                        list(found.values()),
                    ),
                    strict=True,
                ):
                    column.append(value)
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(pa.array(kept, pa.int64())) for c in names),
                    *(pa.array(c, pa.list_(k)) for c, k in zip(columns, kinds, strict=True)),
                ],
                names=schema.names,
            )

    return docs.select(*names, "text").mapInArrow(run, schema)


def sampled(rows: DataFrame, patterns: list[list[int]], most: int = SAMPLE) -> DataFrame:
    """(key) of at most `most` different texts of `rows` (key, pattern) with one
    of these vote patterns, the same ones in every run."""
    spark = rows.sparkSession
    wanted = spark.createDataFrame([(p,) for p in patterns], "pattern array<int>")
    found = rows.join(F.broadcast(wanted), "pattern", "left_semi").select("key").distinct()
    return found.orderBy(F.xxhash64("key"), "key").limit(most)


def patterns_of(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The vote patterns of `rows`, in order, and how many rows have each. There
    are at most three to the number of labellers."""
    found = rows.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()
    return np.array([r.pattern for r in found]), np.array([r.n for r in found], dtype=float)


def fit_quality(votes: DataFrame) -> np.ndarray:
    """Label model by EM over all documents' vote patterns, and the scorer
    fitted on a bounded sample of either side."""
    patterns, counts = patterns_of(votes)
    if not len(patterns):
        return np.zeros(SHAPE_BUCKETS + 1)
    model = estimate(patterns, counts)
    chance = model.posterior(patterns)
    known = {tuple(p): float(c) for p, c in zip(patterns.tolist(), chance, strict=True)}
    rows, labels = [], []
    for good in (True, False):
        side = patterns[(chance >= 0.5) == good].tolist()
        if not side:
            continue
        some = votes.join(F.broadcast(sampled(votes, side)), "key").groupBy("key")
        first = some.agg(*(F.first(c).alias(c) for c in ("pattern", "buckets", "shares")))
        for r in first.orderBy("key").collect():
            rows.append((np.array(r.buckets), np.array(r.shares)))
            labels.append(known[tuple(r.pattern)])
    return fit_linear(rows, np.array(labels), SHAPE_BUCKETS, model.good)


def toxic_votes(votes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(key, pattern): the toxicity labellers' votes with that of `labels`
    (doc_id, toxic) as one more; rows that contradict each other don't vote."""
    if labels is None:
        unsure = F.array(F.lit(UNSURE))
        return votes.select("key", F.concat("toxic", unsure).alias("pattern"))
    value = F.col("toxic").cast("int")
    known = labels.select("doc_id", value.alias("toxic")).filter("toxic in (0, 1)")
    said = known.groupBy("doc_id").agg(F.min("toxic").alias("least"), F.max("toxic").alias("most"))
    speaks = F.when(F.col("least") == 1, BAD).when(F.col("most") == 0, GOOD)
    said = stage(said.select("doc_id", speaks.alias("said")), "label-votes")
    own = F.array(F.coalesce("said", F.lit(UNSURE)))
    return votes.join(said, "doc_id", "left").select("key", F.concat("toxic", own).alias("pattern"))


def fit_toxicity(docs: DataFrame, votes: DataFrame, labels: DataFrame | None) -> np.ndarray | None:
    """Label model by EM over all documents' votes on toxicity, and a scorer of
    words fitted on its chances, on a bounded sample of either side: texts
    that are rather toxic, at most SAMPLE that no list objects to and half as
    many others, and four times SAMPLE that a labeller speaks for or, without
    labels, of all others, as a word must be rare there to tell. None if one
    side has no text."""
    voted = stage(toxic_votes(votes, labels), "toxic-votes")
    patterns, counts = patterns_of(voted)
    if not len(patterns):
        return None
    errors = np.array([HEURISTIC_ERRORS] * len(TOXIC_LABELLERS) + [LABEL_ERRORS])
    model = estimate(patterns, counts, lean=3.0, errors=errors)
    chance = 1 - model.posterior(patterns)
    toxic, vouched = chance >= 0.5, (patterns == GOOD).any(axis=1)
    clean = ~toxic & vouched if (~toxic & vouched).any() else ~toxic
    if not toxic.any() or not clean.any():
        return None
    side = {tuple(p): float(c) for p, c in zip(patterns.tolist(), chance, strict=True)}
    # what only the labels tell teaches words that the lists lack, and is not
    # to be outnumbered by what the lists tell as well
    listed = (patterns[:, :-1] == BAD).any(axis=1)
    picked = sampled(voted, patterns[clean].tolist(), 4 * SAMPLE)
    for of, most in ((toxic & ~listed, SAMPLE), (toxic & listed, SAMPLE // 2)):
        if of.any():
            picked = picked.union(sampled(voted, patterns[of].tolist(), most))
    picked = stage(picked.distinct(), "labelled")
    said = voted.join(F.broadcast(picked), "key").groupBy("key")
    said = stage(said.agg(F.min("pattern").alias("pattern")), "sample-votes")
    schema = "key binary, buckets array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = WordBuckets()
        for batch in batches:
            found = [buckets.of(t.as_py() or "").tolist() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(found, pa.list_(pa.int64()))],
                names=["key", "buckets"],
            )

    texts = docs.select("key", "text").join(F.broadcast(said.select("key")), "key")
    texts = texts.groupBy("key").agg(F.first("text").alias("text"))
    found = texts.mapInArrow(run, schema).join(said, "key").toArrow().sort_by("key")
    held = found["buckets"].combine_chunks()
    ends = np.concatenate([[0], np.cumsum(held.value_lengths().to_numpy())])
    flat = held.flatten().to_numpy()
    rows = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    known = np.array([side[tuple(pattern)] for pattern in found["pattern"].to_pylist()])
    tells = telling(rows, (known >= 0.5).astype(int), WORD_BUCKETS)
    rows = [b[tells[b]] for b in rows]
    return fit_linear([(b, np.ones(len(b))) for b in rows], known, WORD_BUCKETS, 1 - model.good)


def assess(
    docs: DataFrame,
    labels: DataFrame | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All rows and columns of `docs`, and quality_score, toxic_score, accepted.

    Heuristic labellers vote on every document, EM estimates how far each can
    be trusted, and a linear scorer learns the resulting chances, on at most
    SAMPLE different texts per class: of hashed word shapes for quality, of
    hashed words for toxicity. Neither needs labels. `labels` (doc_id, toxic),
    if given, is one more labeller of toxicity, and what the others can't see,
    like insults in a language that they don't know, the scorer learns from
    it. A document is accepted from quality GOOD_ENOUGH on and below toxicity
    TOO_TOXIC.

    A text that is null or has no words has quality 0 and is not accepted.
    Repeated rows are scored alike; a null id has no label. Labels that are
    neither 0 nor 1, or that contradict each other, say nothing. The three
    names must not be columns of `docs`.
    """
    added = ("quality_score", "toxic_score", "accepted")
    if taken := sorted(set(added) & set(docs.columns)):
        raise ValueError(f"the table has columns {taken} already")
    text = F.col(text_col)
    key = F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("key")
    plain = docs.select(F.col(id_col).alias("doc_id"), key, text.alias("text"))
    votes = stage(vote(plain), "votes")
    fitted = QualityModel(fit_quality(votes), fit_toxicity(plain, votes, labels))
    model = docs.sparkSession.sparkContext.broadcast(fitted)
    schema = T.StructType(
        [
            *docs.schema,
            T.StructField("quality_score", T.DoubleType()),
            T.StructField("toxic_score", T.DoubleType()),
            T.StructField("accepted", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = WordBuckets()
        for batch in batches:
            for piece in slices(batch, text_col):
                held = piece.column(piece.schema.get_field_index(text_col))
                texts = [t or "" for t in held.to_pylist()]
                quality = np.array([model.value.quality(t) for t in texts])
                toxic = np.array([model.value.toxicity(t, buckets) for t in texts])
                accepted = (quality >= GOOD_ENOUGH) & (toxic < TOO_TOXIC)
                yield pa.RecordBatch.from_arrays(
                    [
                        *piece.columns,
                        pa.array(quality, pa.float64()),
                        pa.array(toxic, pa.float64()),
                        pa.array(accepted, pa.bool_()),
                    ],
                    names=schema.names,
                )

    return docs.mapInArrow(run, schema)
