import functools
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from helpers import SF_DIR, table, with_clashes
from pyspark.sql import functions as F

from sift.llm.common import read_table
from sift.llm.language import (
    LONGEST,
    SMOOTHING,
    UNDETERMINED,
    Table,
    grams_of,
    identify,
    known_counts,
    train,
    words_of,
)
from sift.llm.queries import op3_language_id

SCHEMA = "doc_id bigint, text string, lang string"
TEXTS = {"en": "the cat and the dog are in the house", "fr": "le chat et les chiens sont dans une maison"}


def small(spark, extra=()):
    rows = [(i, f"{text} {i}", lang) for i in range(10) for lang, text in TEXTS.items()]
    return table(spark, [*rows, *extra], SCHEMA)


def test_held_out_accuracy_and_split(spark):
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF_DIR}/documents.parquet'").fetchall())
    got = op3_language_id(spark, SF_DIR).collect()
    assert len(got) == len(truth)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


def test_words_first_then_shorter_grams(spark):
    model = train(small(spark).select("lang", "text"))
    assert model.languages == ["en", "fr"]
    score = lambda w: dict(zip(model.languages, model.score([w])[0], strict=True))
    assert score("house")["en"] > score("house")["fr"]
    assert score("housing")["en"] > score("housing")["fr"]  # by " hou", "hous"
    assert score("xxa")["fr"] != score("xxa")["en"]  # by shorter ones
    assert model.score(["Ж", "house"])[0].tolist() == [0, 0]
    assert grams_of("ab", 3) == [" ab", "ab "] and grams_of("ab", 1) == ["a", "b"]


def test_odd_texts(spark):
    odd = [(100, None, "en"), (101, "", "fr"), (102, "12 ² !?", "en"), (103, "LE CHAT " * 50_000, None),
           (104, "Ж", None), (None, "the dog", None)]
    docs = with_clashes(small(spark, odd), "lang_pred", "score", "held_out", "_text", "word")
    learnt = F.col("doc_id") != 3
    got = identify(docs, learnt).collect()
    found = {r.doc_id: r for r in got}
    assert len(got) == docs.count()
    assert {found[i].lang_pred for i in (100, 101, 102)} == {UNDETERMINED}
    assert {found[i].score for i in (100, 101, 102)} == {0.0}
    assert found[103].lang_pred == "fr" and found[None].lang_pred == "en"
    assert found[104].lang_pred == "en" and found[104].score == 0.5
    assert found[3].held_out and not found[4].held_out and found[None].held_out


def test_nothing_to_learn_from(spark):
    got = identify(table(spark, [(1, "the dog", None)], SCHEMA), F.lit(True)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [(UNDETERMINED, 0.0)]
    assert identify(table(spark, [], SCHEMA), F.lit(True)).collect() == []


def test_names_are_known_by_their_share(spark, monkeypatch):
    monkeypatch.setattr("sift.llm.language.SHARE", 4)
    counts = [("a", "w0", 9), ("a", "w1", 5), ("a", "w2", 5), ("a", "w3", 1), ("b", "w3", 1), ("b", "w1", 2), ("b", "w4", 9)]
    known = known_counts(table(spark, counts, "lang string, word string, n bigint"), ["lang"], "word")
    # ties stay together, and a name that one language knows has all its counts
    assert sorted((r.lang, r.word, r.n) for r in known.collect()) == [
        ("a", "w0", 9), ("a", "w1", 5), ("a", "w2", 5), ("b", "w1", 2), ("b", "w4", 9)
    ]


def by_hand(rows: list[tuple], learnt, share: int) -> dict:
    """The definition, with plain counters, one word at a time."""
    counts: list[dict] = [{} for _ in range(LONGEST + 1)]
    for i, text, lang in rows:
        if learnt(i) and lang is not None:
            for word in words_of(text or ""):
                counts[0].setdefault(lang, Counter())[word] += 1
                for n in range(1, LONGEST + 1):
                    counts[n].setdefault(lang, Counter()).update(grams_of(word, n))
    langs = sorted(counts[0])
    known, totals = [], []
    for of in counts:
        totals.append({lang: sum(of[lang].values()) for lang in of})
        known.append({x for lang, c in of.items() for x, k in c.items() if k * share >= totals[-1][lang]})

    def log(n: int, name: str, lang: str) -> float:
        held = counts[n].get(lang, {}).get(name, 0)
        return math.log((held + SMOOTHING) / (totals[n].get(lang, 0) + SMOOTHING * (len(known[n]) + 1)))

    @functools.cache
    def score(word: str) -> list[float]:
        if word in known[0]:
            return [log(0, word, lang) for lang in langs]
        for n in range(LONGEST, 0, -1):
            if found := [g for g in grams_of(word, n) if g in known[n]]:
                return [sum(log(n, g, lang) for g in found) / len(found) for lang in langs]
        return [0.0] * len(langs)

    result = {}
    for i, text, _ in rows:
        words = words_of(text or "")
        if not words or not any(map(str.isalpha, text)):
            result[i] = (UNDETERMINED, 0.0)
            continue
        total = [sum(column) for column in zip(*map(score, words), strict=True)]
        best = max(total)
        result[i] = (langs[total.index(best)], 1 / sum(math.exp(t - best) for t in total))
    return result


@pytest.mark.parametrize("share", [2**17, 300])
def test_equals_the_definition_on_every_row(spark, monkeypatch, share):
    monkeypatch.setattr("sift.llm.language.SHARE", share)
    docs = read_table(spark, SF_DIR, "documents").select("doc_id", "text", "lang")
    want = by_hand([tuple(r) for r in docs.collect()], lambda i: i % 4 != 2, share)
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs, F.col("doc_id") % 4 != 2).collect()}
    assert got.keys() == want.keys()
    for i, (lang, score) in want.items():
        assert got[i][0] == lang and got[i][1] == pytest.approx(score, rel=1e-6), i


def test_a_table_is_as_large_as_its_counts():
    names = np.array(["b", "a", "b"], dtype=object)
    made = Table.of(names, np.array([1, 0, 0], np.int32), np.array([2.0, 3.0, 1.0]), np.full(200, 10.0))
    assert made.rows == {"a": 0, "b": 1} and made.starts.tolist() == [0, 1, 3]
    assert made.langs.tolist() == [0, 0, 1] and len(made.above) == 3
    scores = np.zeros((2, 200))
    made.add_means(scores, [1], [[0, 1]])
    both = np.log((np.array([[3, 0], [1, 2]]) + SMOOTHING) / (10 + SMOOTHING * 3)).mean(axis=0)
    assert np.allclose(scores[1, :2], both) and not scores[0].any()
