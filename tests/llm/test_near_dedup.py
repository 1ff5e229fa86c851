import random
from itertools import combinations

import numpy as np
import pytest
from helpers import by_id, components_of, table, with_clashes
from pyspark.sql import functions as F

from sift.llm.components import components
from sift.llm.near_dedup import Sketch, distant_rows, joint_estimate, near_groups
from sift.llm.shingles import WordHashes, shingle_hashes, shingle_set, split_words


def edited(words: list[str], draw: random.Random, edits: int) -> str:
    words = list(words)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"new{draw.getrandbits(30)}"
    return " ".join(words)


def corpus(draw: random.Random) -> list[tuple]:
    """Families of near copies around the threshold, exact copies, short texts."""
    texts = []
    for family in range(25):
        words = [f"w{family}_{draw.randrange(80)}" for _ in range(draw.choice([30, 90, 200]))]
        texts += [edited(words, draw, draw.choice([0, 1, 2, 3, 5, 8])) for _ in range(12)]
    texts += ["a b c", "A  B\tC", "a b", "a b d", "", None, " \n", "x", "X", "a b c d"]
    hot = [f"hot{i}" for i in range(120)]
    texts += [edited(hot, draw, draw.choice([0, 1, 4])) for _ in range(150)]
    draw.shuffle(texts)
    return list(enumerate(texts))


def by_hand(rows: list[tuple], k: int, percent: int) -> dict:
    sets = {i: shingle_set(split_words(t), k) for i, t in rows}
    links = []
    for a, b in combinations([i for i in sets if sets[i]], 2):
        shared = len(sets[a] & sets[b])
        if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
            links.append((a, b))
    found = components_of(sets, links)
    return {i: (len(sets[i]), found[i], found[i] == i) for i in sets}


@pytest.mark.parametrize("k", [4, 5])
def test_equals_brute_force(spark, k):
    rows = corpus(random.Random(k))
    docs = with_clashes(table(spark, rows), "content", "registers", "component_id", "key", "head")
    got = near_groups(docs, k=k).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == by_hand(rows, k, 80)


def test_links_across_a_chain_of_copies(spark):
    # neighbours are alike, the ends are not, and no text is like all others
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 12 : i * 12 + 200])) for i in range(15)]
    got = by_id(near_groups(table(spark, rows), k=4))
    assert {got[i].component_id for i in range(15)} == {0}


def test_odd_rows(spark):
    rows = [(3, "a b c d e"), (3, "a b c d e"), (None, "a b c d e"), (1, None), (2, "")]
    got = near_groups(table(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.n_shingles) for r in got) == [
        (-1, -1, 1), (1, 1, 0), (2, 2, 0), (3, 3, 1), (3, 3, 1),
    ]
    assert near_groups(table(spark, [])).collect() == []
    assert near_groups(table(spark, [(1, None)])).first().kept


def test_a_very_long_text(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    got = by_id(near_groups(table(spark, [(1, long), (2, long + " more"), (3, long[:100])])))
    assert (got[2].component_id, got[3].component_id) == (1, 3)
    assert got[1].n_shingles == 59_996


def test_sketches_merge_and_estimate():
    draw = np.random.default_rng(1)
    sketch = Sketch(bands=100, rows=5)
    for share in (0.2, 0.5, 0.8, 0.95):
        n = 4000
        both = int(2 * n * share / (1 + share))
        x = draw.integers(0, 2**63, 2 * n - both, np.uint64)
        a, b = x[:n], x[n - both :]
        ra, rb = sketch.registers(a), sketch.registers(b)
        assert (np.maximum(ra, rb) == sketch.registers(x)).all()
        sizes = np.array([len(a)]), np.array([len(b)])
        estimate = joint_estimate(ra[None], rb[None], *sizes)[0]
        assert abs(estimate - share) < 5 * np.sqrt(share * (1 - share) / sketch.size) + 0.01


def test_shingle_hashes_follow_the_words():
    words = split_words("A b\x0bC d\x0ce a B c\td e")
    hashes = shingle_hashes(WordHashes().of(words), 4)
    assert len(hashes) == 7 and len(set(hashes.tolist())) == len(shingle_set(words, 4))
    assert split_words("ÀÉ A\xa0B") == ["ÀÉ".encode(), "a\xa0b".encode()]


def test_components(spark):
    draw = random.Random(3)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)]
    links += [(i, i + 1) for i in range(1000, 1100)]  # a path
    links += [(2000, i) for i in range(2001, 2200)] + [(5, 5)]  # a star, a loop
    want = components_of({n for e in links if e[0] != e[1] for n in e}, links)
    got = components(table(spark, links, "a bigint, b bigint"))
    assert {r.node: r.component for r in got.collect()} == want
    assert components(table(spark, [], "a bigint, b bigint")).collect() == []


def test_rows_that_share_an_id_are_one_document(spark):
    p, q = ([f"{x}{i}" for i in range(60)] for x in "pq")
    near = lambda words, n: " ".join([*words, f"more{n}"])
    rows = [(5, " ".join(p)), (5, " ".join(q)), (2, near(p, 1)), (3, near(q, 2)), (9, "alone here")]
    for parts in (1, 7):
        got = near_groups(table(spark, rows).repartition(parts), k=4).collect()
        found = sorted((r.doc_id, r.component_id, r.kept) for r in got)
        assert found == [(2, 2, True), (3, 2, False), (5, 2, False), (5, 2, False), (9, 9, True)]


def test_one_row_of_each_group(spark):
    p = [f"p{i}" for i in range(60)]
    a, b, c = " ".join(p), " ".join([*p, "more"]), " ".join(["less", *p]).upper()
    rows = [(5, a, 1.0), (4, b, 2.0), (4, b, 1.0), (4, b, 1.0), (None, c, 0.0), (7, "other words", None)]
    rows += [(7, "other words", None), (8, "", 1.0), (8, None, 1.0), (8, "", 1.0)]
    docs = table(spark, rows, "doc_id bigint, text string, `c0` double").withColumn("row", F.lit("mine"))
    for parts in (1, 4):
        got = distant_rows(docs.repartition(parts), k=4)
        assert got.columns == docs.columns
        kept = sorted(((r.doc_id, r.text, r.c0) for r in got.collect()), key=str)
        rest = [(7, "other words", None), (8, "", 1.0), (8, "", 1.0), (8, None, 1.0)]
        assert [k for k in kept if k[0] != 4] == sorted(rest, key=str)
        assert len(kept) == 5
    assert distant_rows(docs.limit(0)).collect() == []
