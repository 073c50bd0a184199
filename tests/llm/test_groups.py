"""Groups equal union-find on chains, rings, stars, trees and random graphs."""

import random

import pytest

from linkloom.llm.groups import group_links, record_groups


def brute(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        for x in (a, b):
            if x is not None:
                find(x)
        if a is not None and b is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    groups = {}
    for x in parent:
        groups.setdefault(find(x), []).append(x)
    return {x: min(g) for g in groups.values() for x in g}


def name(i):
    return f"v{i:05d}"


def graphs():
    r = random.Random(7)
    chain = [(name(i), name(i + 1)) for i in range(130)]
    shuffled = r.sample(range(400), 90)
    yield "chain", chain
    yield "shuffled chain", [(name(a), name(b)) for a, b in zip(shuffled, shuffled[1:])]
    yield "ring", [(name(i), name((i + 1) % 61)) for i in range(61)]
    yield "two rings with tail", [(name(i), name((i + 1) % 9)) for i in range(9)] + [(name(100 + i), name(100 + (i + 1) % 6)) for i in range(6)] + [(name(3), name(200)), (name(200), name(201)), (name(201), name(103))]
    yield "star", [(name(0), name(i)) for i in range(1, 200)]
    yield "clique", [(name(i), name(j)) for i in range(9) for j in range(i)]
    yield "tree", [(name(i), name(i // 2)) for i in range(1, 150)]
    yield "random", [(name(r.randrange(300)), name(r.randrange(300))) for _ in range(260)]
    yield "dense", [(name(r.randrange(60)), name(r.randrange(60))) for _ in range(400)]
    yield "loops and nulls", [("a", "a"), ("b", None), (None, "c"), (None, None), ("d", "e"), ("e", "d"), ("d", "e")]


@pytest.mark.parametrize("what,links", list(graphs()), ids=[k for k, _ in graphs()])
def test_groups(spark, what, links):
    df = spark.createDataFrame([(a, b, "v") for a, b in links], "a string, b string, entity_id string")
    got = [(r.entity_id, r.group_id) for r in group_links(df, core_links=0).collect()]
    assert len(got) == len(dict(got))
    assert dict(got) == brute(links)


def test_core_in_one_task(spark):
    links = [(a and f"{what} {a}", b and f"{what} {b}") for what, some in graphs() for a, b in some]
    got = [(r.entity_id, r.group_id) for r in group_links(spark.createDataFrame(links, "a string, b string")).collect()]
    assert len(got) == len(dict(got))
    assert dict(got) == brute(links)


def test_empty(spark):
    assert group_links(spark.createDataFrame([], "a string, b string")).count() == 0


def test_ids_in_lists(spark):
    rows = [
        (" s1-00000001\t", "S2-00000002, s2-00000003 ,junk,S2-0000004,, S3-00000009"), ("S1-00000002", None), ("S1-00000003", ""), ("nothing", "S2-00000005"),
        (None, "S2-00000006"), ("S1-00000001", "S2-00000002"), ("S1-00000004", "S2-00000005,S2-00000005"),
    ]
    df = spark.createDataFrame(rows, "source1_entity_id string, matched_entity_ids string")
    got = {r.entity_id: r.group_id for r in record_groups(df).collect()}
    one = "S1-00000001"
    assert got == {
        one: one, "S2-00000002": one, "S2-00000003": one, "S3-00000009": one, "S1-00000002": "S1-00000002", "S1-00000003": "S1-00000003",
        "S2-00000005": "S1-00000004", "S1-00000004": "S1-00000004", "S2-00000006": "S2-00000006",
    }


@pytest.mark.parametrize("between", [",", ", ", ";", " ; ", "|", " ", "\t", " ,\t", "\u00a0,", ",,", "\n"])
def test_separators(spark, between):
    rows = [("S1-00000009", between.join(["S2-00000002", "s3-00000003", "S9", "S2-000000021", "00000004", "n/a", "S1-00000001"]) + between)]
    df = spark.createDataFrame(rows, "source1_entity_id string, matched_entity_ids string")
    got = {r.entity_id: r.group_id for r in record_groups(df).collect()}
    assert got == dict.fromkeys(["S1-00000009", "S2-00000002", "S3-00000003", "S1-00000001"], "S1-00000001")


def test_numbers(spark):
    df = spark.createDataFrame([(5, 3), (3, 9), (7, 7), (None, 1)], "a long, b long")
    assert {r.entity_id: r.group_id for r in group_links(df).collect()} == {3: 3, 5: 3, 9: 3, 7: 7, 1: 1}
