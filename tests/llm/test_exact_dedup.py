import hashlib

import pytest
from helpers import by_id, table, with_clashes
from pyspark.sql import functions as F

from sift.llm.exact_dedup import distinct_rows, exact_groups

ROWS = [(1, "Aa"), (2, "aA"), (3, None), (4, ""), (5, "É"), (6, "é"), (9, "aa"), (7, "b"), (8, "x" * 200_000)]


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_groups(spark, keep):
    docs = with_clashes(table(spark, ROWS), "keep_id", "digest", "body", "group_size")
    got = by_id(exact_groups(docs, keep=keep))
    pick = min if keep == "smallest" else max
    for same in ([1, 2, 9], [3, 4], [5], [6], [7], [8]):
        for i in same:
            assert got[i].keep_id == pick(same)
            assert got[i].group_size == len(same)
            assert got[i].kept == (i == pick(same))
    assert got[2].text_sha256 == hashlib.sha256(b"aa").hexdigest()
    assert got[3].text_sha256 == hashlib.sha256(b"").hexdigest()


def test_colliding_digests_are_told_apart_by_the_bytes(spark):
    got = by_id(exact_groups(table(spark, ROWS), digest=lambda c: F.lit("same")))
    assert got[2].keep_id == 1 and got[4].keep_id == 3
    assert all(got[i].kept and got[i].group_size == 1 for i in (5, 6, 7, 8))


def test_repeated_rows_and_null_ids(spark):
    rows = [(7, "b"), (7, "b"), (None, "b"), (None, "c")]
    got = exact_groups(table(spark, rows)).collect()
    assert sorted((r.doc_id, r.group_size, r.kept) for r in got if r.doc_id) == [(7, 3, True)] * 2
    assert sorted(r.kept for r in got if r.doc_id is None) == [False, True]


def test_empty_table_and_bad_choice(spark):
    assert exact_groups(table(spark, [])).collect() == []
    with pytest.raises(ValueError):
        exact_groups(table(spark, []), keep="any")


def test_one_row_of_each_text(spark):
    rows = [(7, "b", 1), (7, "c", 1), (9, "B", 2), (3, "d", 1), (3, "d", 1), (3, "d", 0), (None, "e", 1), (None, "e", 1)]
    rows += [(None, "F", 3), (2, "f", 1), (4, None, 1), (6, "", 1)]
    docs = table(spark, rows, "doc_id bigint, text string, `body` int").repartition(3)
    key = lambda r: tuple(map(str, r))
    largest = sorted((tuple(r) for r in distinct_rows(docs, keep="largest").collect()), key=key)
    assert largest == sorted([(7, "c", 1), (9, "B", 2), (3, "d", 1), (None, "e", 1), (2, "f", 1), (6, "", 1)], key=key)
    smallest = sorted((tuple(r) for r in distinct_rows(docs).collect()), key=key)
    assert smallest == sorted([(7, "b", 1), (7, "c", 1), (3, "d", 0), (None, "e", 1), (2, "f", 1), (4, None, 1)], key=key)
    # a digest that tells nothing apart: the bytes still do
    assert distinct_rows(docs, digest=lambda body: F.lit("same")).count() == 6
    assert distinct_rows(docs).columns == docs.columns and distinct_rows(docs.limit(0)).collect() == []
