from hashlib import sha256

import pytest
from helpers import table, with_clashes
from pyspark.sql import functions as F

from sift.llm.merkle import climb, fold, height, leaf_digest, merkle_manifest, proof_text

SCHEMA = "doc_id bigint, source string, text string"
FIELDS = ("doc_id", "source", "text")


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(row: tuple) -> str:
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def by_hand(nodes: list[str], fanout: int) -> tuple[str, list[list[tuple]]]:
    """The root, and for every leaf its siblings to the left and right, level by level."""
    steps, place, now = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(now) > 1:
        for path, at in zip(steps, place, strict=True):
            run = at // fanout * fanout
            path.append(("".join(now[run:at]), "".join(now[at + 1 : run + fanout])))
        now = [digest("".join(now[at : at + fanout])) for at in range(0, len(now), fanout)]
        place = [at // fanout for at in place]
    return now[0], steps


def manifest_by_hand(rows: list[tuple], fanout: int) -> list[tuple]:
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row), row[0]))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = [by_hand([x[2] for x in sorted(sources[s], key=lambda x: x[:3])], fanout) for s in names]
    root, above = by_hand([t[0] for t in trees], fanout)
    found = []
    for at, name in enumerate(names):
        for x, steps in zip(sorted(sources[name], key=lambda x: x[:3]), trees[at][1], strict=True):
            found.append((x[3], x[2], trees[at][0], root, tuple(steps + above[at])))
    return found


def rows_of(made) -> list[tuple]:
    return [
        (r.doc_id, r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.proof))
        for r in made.collect()
    ]


@pytest.mark.parametrize(
    "fanout, depth, n", [(3, 1, 100), (3, 6, 100), (3, 2, 300), (2, 1, 77), (3, 0, 40), (4, 1, 230)]
)
def test_equals_plain_trees(spark, fanout, depth, n):
    names = ["a", "b", None, "é", "zz", ""]
    rows = [(n - i, names[i * i % 6] if i % 3 else "hot", f"text {i}\n" * (i % 5)) for i in range(n)]
    rows += [(n + 1 + i, f"site{i}", "alone") for i in range(20)]
    docs = with_clashes(table(spark, rows, SCHEMA), "tree", "block", "digest", "row", "at", "top", "size")
    made = merkle_manifest(docs.repartition(5), fields=FIELDS, fanout=fanout, depth=depth)
    assert sorted(rows_of(made)) == sorted(manifest_by_hand(rows, fanout))
    assert made.filter(fold(F.col("leaf"), F.col("proof")) != F.col("root")).isEmpty()


def test_odd_rows(spark):
    rows = [(1, None, None), (None, None, "x"), (None, None, "y"), (None, "", ""), (2, "a", "long " * 400_000)]
    rows += [(3, "a", "same")] * 3 + [(3, "a", "other"), (-4, "a", ""), (5, "ü", "ü")]
    made = merkle_manifest(table(spark, rows, SCHEMA), fields=FIELDS)
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(rows_of(made), key=key) == sorted(manifest_by_hand(rows, 3), key=key)


def test_empty_and_single(spark):
    assert merkle_manifest(table(spark, [], SCHEMA), fields=FIELDS).collect() == []
    (only,) = merkle_manifest(table(spark, [(1, "a", "b")], SCHEMA), fields=FIELDS).collect()
    assert only.leaf == only.subroot == only.root and only.proof == []


def test_a_change_is_found(spark):
    rows = [(i, f"s{i % 3}", f"text {i}") for i in range(50)]
    changed = leaf_digest(F.col("doc_id"), F.col("source"), F.concat("text", F.lit("!")))
    docs = table(spark, rows, SCHEMA)
    made = merkle_manifest(docs, fields=FIELDS, keep={"root_": F.col("text"), "changed": changed})
    whole = made.select("root_", (fold(F.col("changed"), F.col("proof")) == F.col("root")).alias("ok"))
    assert {r.root_ for r in whole.collect()} == {t for _, _, t in rows}
    assert whole.filter("ok").isEmpty()
    # another row's leaf doesn't fit a proof either, and no boundary can be moved
    moved = table(spark, [(1, "ab", "c")], SCHEMA).select(leaf_digest(*map(F.col, FIELDS))).first()[0]
    assert moved != leaf((1, "a", "bc"))


def test_proof_text_lists_all_siblings(spark):
    rows = [(i, "s", str(i)) for i in range(7)]
    made = merkle_manifest(table(spark, rows, SCHEMA), fields=FIELDS, depth=1)
    got = {r.doc_id: r.t for r in made.select("doc_id", proof_text(F.col("proof")).alias("t")).collect()}
    assert got == {i: "".join(a + b for a, b in p) for i, _, _, _, p in manifest_by_hand(rows, 3)}


def test_climb():
    names = [digest(str(i)) for i in range(5)]
    assert height(5, 3) == 2 and height(1, 3) == 0 and height(9, 3) == 2 and height(10, 3) == 3
    top, steps = climb(names, 2, 3)
    assert (top, [[tuple(s.values()) for s in p] for p in steps]) == by_hand(names, 3)
    lone, steps = climb(names[:1], 2, 3)
    assert lone == digest(digest(names[0])) and steps[0] == [{"before": "", "after": ""}] * 2
