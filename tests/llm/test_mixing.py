from collections import Counter, defaultdict

from helpers import table, with_clashes

from sift.llm.mixing import LIMIT, mix, mixed_documents

SCHEMA = "doc_id bigint, text string, source string"


def water_level(words: dict, weights: dict) -> dict:
    """Shared out again and again until no source is above its limit."""
    left, open_, target = 1.5 * sum(words.values()), set(words), {}
    while True:
        total = sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / total >= LIMIT * words[s]] if total else []
        if not over:
            return target | {s: left * weights[s] / total for s in open_}
        for s in over:
            target[s] = LIMIT * words[s]
            open_.remove(s)
        left = 1.5 * sum(words.values()) - sum(target.values())


def corpus():
    rows, words = [], Counter()
    for i in range(3000):
        source = ["a", "b", "c", "d", None, "hot"][i % 6 if i % 2 else 5]
        n = 1 + (i * 7919) % 90
        rows.append((i, " ".join(["w"] * n), source))
        words[source] += n
    return rows, words


def test_targets_and_taken_words(spark):
    rows, words = corpus()
    docs = with_clashes(table(spark, rows, SCHEMA), "size", "bin", "copies", "target", "row")
    got = mix(docs).collect()
    assert len(got) == len(rows)
    order = sorted(s for s in words if s) + [None]
    wanted = water_level(words, {s: [3, 1, 2][i % 3] for i, s in enumerate(order)})
    source = {r[0]: r[2] for r in rows}
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == words[source[r.doc_id]]
        assert abs(r.target - wanted[source[r.doc_id]]) < 1e-6 * max(1, r.target)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source[r.doc_id]] += r.taken
    for s in words:
        assert abs(taken[s] - wanted[s]) <= 90


def test_reruns_and_partitioning_change_nothing(spark):
    docs = table(spark, corpus()[0], SCHEMA)
    first = sorted(map(tuple, mix(docs).collect()))
    assert sorted(map(tuple, mix(docs.repartition(13)).collect())) == first


def test_the_mix_repeats_whole_rows(spark):
    docs = with_clashes(table(spark, corpus()[0], SCHEMA), "copies")
    copies = {r.doc_id: r.copies for r in mix(docs).collect()}
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    found = Counter(r.doc_id for r in mixed.collect())
    assert found == {k: v for k, v in copies.items() if v}


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x y", "b"), (3, "x", "b"), (3, "x", "b")]
    got = mix(table(spark, rows, SCHEMA)).collect()
    assert sorted(r.size for r in got) == [0, 0, 1, 1, 2]
    assert all(r.target == 0 and r.taken == 0 for r in got if r.size == 0)
    assert mix(table(spark, [], SCHEMA)).collect() == []
    assert mix(table(spark, [(1, None, None)], SCHEMA)).first().taken == 0
