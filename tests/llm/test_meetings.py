"""Keys meet in tasks, as packed columns: without sort-merge joins of single rows."""

import numpy as np

from linkloom.llm.matching import candidates
from linkloom.runtime import Scratch, distinct_rows, meetings

ROWS = "row long, own boolean, core string, org string, branches long, sig long, house string, places array<string>"


def test_meetings_are_all_pairs_of_equal_keys():
    r = np.random.default_rng(1)
    keys, first = r.integers(-5, 5, 200), r.random(200) < 0.4
    for most in (1, 7, 1_000_000):
        got = [(int(a), int(b)) for x, y in meetings(keys, first, ~first, most) for a, b in zip(x, y)]
        assert sorted(got) == [(i, j) for i in range(200) for j in range(200) if first[i] and not first[j] and keys[i] == keys[j]]
    assert not list(meetings(keys[:0], first[:0], first[:0]))


def test_distinct_rows():
    a, b = distinct_rows(np.array([1, 2, 1, 1]), np.array([3, 3, 3, 4]))
    assert sorted(zip(a.tolist(), b.tolist())) == [(1, 3), (1, 4), (2, 3)]
    assert [len(c) for c in distinct_rows(np.array([], int), np.array([], int))] == [0, 0]


def test_candidates_without_a_join_of_keys(spark):
    rows = spark.createDataFrame(
        [
            (1, True, "acme", "o1", 1, 10, "5", ["oslo"]), (2, True, "zed", "o2", 1, None, None, None), (3, False, "acme", "o1", 1, 11, "6", ["oslo"]),
            (4, False, "acne", "o3", 0, 10, "5", ["bergen"]), (5, False, None, None, 0, 10, "5", ["bergen"]), (6, False, "zed", "o2", 1, None, None, None), (7, False, "zed", "o2", 1, 12, "1", ["rome"]),
            (8, False, "acme", "o9", 0, 13, "5", ["nice"]),
        ],
        ROWS,
    )
    links = spark.createDataFrame([(10, 13)], "a long, b long")
    found = candidates(rows, links, Scratch(spark, "test"))
    assert sorted(map(tuple, found.collect())) == [(1, 3, 0), (1, 5, 1), (1, 8, 1), (2, 6, 0), (2, 7, 0)]
    # The only join finds the buildings near by.
    assert found._jdf.queryExecution().sparkPlan().toString().count("Join") == 1
