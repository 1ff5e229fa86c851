import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import SF_DIR, table, with_clashes
from pyspark.sql import functions as F

from sift.llm import hmm, markov_lm
from sift.llm.common import read_table
from sift.llm.hmm import Counts, Hmm, Pool
from sift.llm.markov_lm import score_documents, split_texts, word_keys, word_shapes


def word_key(word: bytes) -> bytes:
    return word_keys(pa.array([word], pa.binary()))[0].as_py()


def word_shape(key: bytes) -> int:
    """The definition, for one word."""
    if key[:1] == markov_lm.DIGEST:
        return 0
    text = key.decode()
    core = text.rstrip(markov_lm.MARKS)
    last = core[-1:]
    kind = 0 if not last else 1 if last.isdigit() else 2 + ord(last) % markov_lm.LETTERS
    band = sum(len(text) >= least for least in markov_lm.BANDS)
    return 1 + (kind * (len(markov_lm.BANDS) + 1) + band) * 2 + (core != text)


def plain_expectation(model: Hmm, symbols) -> tuple:
    """Likelihood, chances of states, and moves, one symbol at a time, unscaled."""
    ahead = [model.start * model.emit[symbols[0]]]
    for s in symbols[1:]:
        ahead.append((ahead[-1] @ model.move) * model.emit[s])
    back = [np.ones(model.states)]
    for s in symbols[:0:-1]:
        back.insert(0, model.move @ (model.emit[s] * back[0]))
    chance = ahead[-1].sum()
    moves = np.zeros_like(model.move)
    for at in range(len(symbols) - 1):
        moves += np.outer(ahead[at], model.emit[symbols[at + 1]] * back[at + 1]) * model.move / chance
    return chance, [a * b / chance for a, b in zip(ahead, back, strict=True)], moves


@pytest.mark.parametrize("size", [1000, 10, 6, 1])
def test_forward_and_backward(size):
    draw = np.random.default_rng(0)
    model = Hmm(draw.dirichlet(np.ones(3)), draw.dirichlet(np.ones(3), 3), draw.dirichlet(np.ones(7), 3).T.copy())
    sequences = [draw.integers(0, 7, n).astype(np.int32) for n in (5, 1, 9, 3, 9, 4)]
    pool, counts = Pool.of(sequences), Counts.of(model)
    hmm.expect(model, pool, counts, size)
    want = Counts.of(model)
    chances = []
    for symbols in sequences:
        chance, states, moves = plain_expectation(model, symbols)
        chances.append(math.log10(chance))
        want.start += states[0]
        want.move += moves
        for s, state in zip(symbols, states, strict=True):
            want.emit[s] += state
    assert np.allclose(hmm.log10_likelihood(model, pool, size), chances)
    for name in ("start", "move", "emit"):
        assert np.allclose(getattr(counts, name), getattr(want, name))


def test_a_long_sequence_does_not_underflow():
    model = hmm.first_model(np.ones(50), 4)
    sequence = np.random.default_rng(1).integers(0, 50, 100_000).astype(np.int32)
    (found,) = hmm.log10_likelihood(model, Pool.of([sequence]))
    assert -190_000 < found < -150_000
    counts = Counts.of(model)
    hmm.expect(model, Pool.of([sequence]), counts, 1000)
    assert np.isclose(counts.emit.sum(), 100_000) and np.isclose(counts.move.sum(), 99_999)


def test_training_never_lowers_the_likelihood():
    draw = np.random.default_rng(2)
    blocks = [draw.integers(0, 20, 30) + 20 * draw.integers(0, 3) for _ in range(60)]
    sequences = [np.concatenate(blocks[i : i + 3]).astype(np.int32) for i in range(0, 60, 3)]
    model, last, types = hmm.first_model(np.ones(60), 3), -np.inf, np.full(60, 1e-9)
    for _ in range(30):
        counts = Counts.of(model)
        for pool in hmm.pools(sequences, 200):
            hmm.expect(model, pool, counts)
        now = sum(hmm.log10_likelihood(model, Pool.of(sequences)))
        assert now >= last - 0.1
        model, last = hmm.improved(counts, types), now
    assert last > -20 * 90 * 1.5  # each third of the words has found its state


def by_hand(rows: list[tuple], states: int, passes: int) -> dict:
    """Everything with plain counters and one text at a time."""
    texts = [(i, held, (text or "").encode().lower().split()) for i, held, text in rows]
    counted = Counter(word_key(w) for _, held, words in texts if not held for w in words)
    ends = sum(not held for _, held, _ in texts)
    tokens, types = sum(counted.values()) + ends, len(counted) + (ends > 0)
    common = sorted((w for w, n in counted.items() if n * markov_lm.COMMON >= tokens), key=lambda w: (-counted[w], w))
    number = {w: 1 + at for at, w in enumerate(common)}
    symbol = lambda w: number.get(word_key(w)) or 1 + len(common) + word_shape(word_key(w))
    size = 1 + len(common) + markov_lm.SHAPES
    weight, inside = np.zeros(size), Counter()
    weight[0], stands_for = ends, np.ones(size)
    for word, n in counted.items():
        at = number.get(word) or 1 + len(common) + word_shape(word)
        weight[at] += n
        if word not in number:
            stands_for[at] += 1
            inside[at] += n + 1
    sequences = [[*map(symbol, words), 0] for _, _, words in texts]
    model = hmm.first_model(weight + stands_for, states)
    for _ in range(passes if ends else 0):
        counts = Counts.of(model)
        for (_, held, _), sequence in zip(texts, sequences, strict=True):
            if held:
                continue
            _, chances, moves = plain_expectation(model, sequence)
            counts.start += chances[0]
            counts.move += moves
            for s, chance in zip(sequence, chances, strict=True):
                counts.emit[s] += chance
        model = hmm.improved(counts, stands_for)
    found = {}
    for (i, held, words), sequence in zip(texts, sequences, strict=True):
        n = [counted[word_key(w)] for w in words]
        base = sum(math.log10((c + 1) / (tokens + types + 1)) for c in [*n, ends])
        score = math.log10(plain_expectation(model, sequence)[0])
        for word, c, s in zip(words, n, sequence, strict=False):
            if word_key(word) not in number:
                score += math.log10((c + 1) / (inside[s] + 1))
        found[i] = (held, len(sequence), sum(c > 0 for c in [*n, ends]), tokens, base, score)
    return found


def scored(docs, **options) -> dict:
    made = score_documents(docs, F.col("lang") != "test", **options)
    return {r.doc_id: tuple(r)[1:] for r in made.collect()}


SCHEMA = "doc_id bigint, lang string, text string"


@pytest.mark.parametrize("common", [2**20, 60])
def test_equals_plain_version(spark, monkeypatch, common):
    monkeypatch.setattr(markov_lm, "COMMON", common)
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF_DIR, "documents").limit(120).collect()]
    rows = [(i, "test" if i % 5 == 2 else "fit", " ".join(t.split()[:60])) for i, t in docs]
    rows += [(-1, "test", "never seen, these 12 words: été " + "x" * 100), (-2, "fit", None), (-3, "test", ""), (-4, "fit", "y" * 90 + " the")]
    want = by_hand([(i, lang == "test", t) for i, lang, t in rows], 4, 2)
    data = with_clashes(table(spark, rows, SCHEMA), "row", "n", "word", "symbols", "rare", "score")
    got = scored(data.repartition(3), states=4, passes=2)
    assert got.keys() == want.keys()
    for i, (*exact, base, score) in want.items():
        assert list(got[i][:4]) == exact
        assert got[i][4] == pytest.approx(base) and got[i][5] == pytest.approx(score, rel=1e-4)


def test_chances_add_up_to_one(spark):
    """All words of a shape, the unknown one included, share the shape's chance."""
    rows = [(i, "fit", f"a{i} b{i % 7} the end of {i % 3}") for i in range(60)]
    docs = table(spark, rows, SCHEMA)
    held = markov_lm.lexicon(docs)
    types = held.symbol_types()
    assert types.sum() == held.types + markov_lm.SHAPES
    model = hmm.first_model(held.symbol_counts() + types, 3)
    for matrix in (model.start, model.move.T, model.emit):
        assert np.allclose(matrix.sum(axis=0), 1)
    counts = Counts(*(np.random.default_rng(1).random(x.shape) for x in (model.start, model.move, model.emit)))
    assert np.allclose(hmm.improved(counts, types).emit.sum(axis=0), 1)


def test_rare_words_get_their_counts(spark, monkeypatch):
    monkeypatch.setattr(markov_lm, "COMMON", 4)
    rows = [(1, "fit", "the the the the Rare,"), (2, "test", "the rare, rarer,"), (3, "test", "rare, rare, new")]
    got = scored(table(spark, rows, SCHEMA))
    assert [got[i][:4] for i in (1, 2, 3)] == [(False, 6, 6, 6), (True, 4, 3, 6), (True, 4, 3, 6)]
    assert got[3][4] == pytest.approx(2 * math.log10(2 / 10) + math.log10(1 / 10) + math.log10(2 / 10))


def test_odd_rows_and_empty_tables(spark):
    assert scored(table(spark, [], SCHEMA)) == {}
    rows = [(None, None, "no language, so not learnt from"), (1, "test", None), (1, "test", None)]
    made = score_documents(table(spark, rows, SCHEMA), F.col("lang") != "test").collect()
    assert len(made) == 3 and all(r.held_out and r.n_known == r.train_tokens == r.base_score == 0 for r in made)
    assert all(math.isfinite(r.score) and r.score < 0 for r in made)
    rows = [(1, "fit", "long " * 200_000), (2, "fit", "x" * 500_000), (2, "test", "x" * 500_000 + " long")]
    made = score_documents(table(spark, rows, SCHEMA), F.col("lang") != "test", passes=1).collect()
    assert sorted((r.n_tokens, r.n_known) for r in made) == [(2, 2), (3, 3), (200_001, 200_001)]


def test_shapes():
    words = ["", "a", "é", "été,", "12", "x9%", "***", "漢字", "w" * 64, "🙂!", "w" * 65, "ab..", "%", "७"]
    keys = word_keys(pa.array([w.encode() for w in words], pa.binary()))
    found = word_shapes(keys)
    assert found.tolist() == [word_shape(k) for k in keys.to_pylist()]
    assert found.min() == 0 and found.max() < markov_lm.SHAPES
    assert len(keys[10].as_py()) == 17 and keys[8].as_py() == b"w" * 64


def test_texts_are_split_at_ascii_blanks_only():
    texts = [" A\tb\n\n", None, "", "É\u00a0é\x1fx \x0b\x0c\r y", "  "]
    words, bounds = split_texts(pa.array(texts))
    split = [words.to_pylist()[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert split == [["a", "b"], [], [], ["É\u00a0é\x1fx", "y"], []]


def test_predicts_unseen_texts_better_than_independent_words(spark):
    docs = read_table(spark, SF_DIR, "documents")
    made = score_documents(docs, F.col("doc_id") % 7 != 2).filter("held_out")
    total = made.agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert total[0] - total[1] > 0.05 * total[2]  # log10 per token
