"""Marginals against enumeration; matches of small tables."""

import itertools
import math

import pytest

from linkloom.llm.matching import match_records, propagate
from linkloom.runtime import Scratch


def enumerate_marginals(pairs):
    """Exact marginals: at most one pair of a c, and the true pairs of an a at one site."""
    total, each = 0.0, [0.0] * len(pairs)
    for on in itertools.product((0, 1), repeat=len(pairs)):
        chosen = [p for p, x in zip(pairs, on) if x]
        if len({p[1] for p in chosen}) < len(chosen):
            continue
        if any(len({p[2] for p in chosen if p[0] == a and p[2] is not None}) > 1 for a in {p[0] for p in chosen}):
            continue
        w = math.exp(sum(p[3] for p in chosen))
        total += w
        for i, x in enumerate(on):
            each[i] += w * x
    return [x / total for x in each]


CASES = {
    "alone": [("a", "x", 1, 2.0)],
    "two owners": [("a", "x", 1, 2.0), ("b", "x", 1, 2.0)],
    "two sites": [("a", "x", 1, 2.0), ("a", "y", 2, 1.0)],
    "one site": [("a", "x", 1, 2.0), ("a", "y", 1, 1.0)],
    "no site": [("a", "x", None, 2.0), ("b", "x", None, 1.0), ("a", "y", 4, -1.0)],
    "tree": [("a", "x", 1, 1.0), ("b", "x", 1, 0.5), ("b", "y", 2, 2.0), ("c", "y", 2, -1.0)],
}


@pytest.mark.parametrize("case", CASES)
def test_propagation_is_exact_on_trees(spark, case):
    pairs = CASES[case]
    df = spark.createDataFrame(pairs, "a string, c string, site long, logit double")
    got = {(r.a, r.c): r.confidence for r in propagate(df, Scratch(spark, "t"), rounds=60, change=1e-5).collect()}
    for (a, c, _, _), want in zip(pairs, enumerate_marginals(pairs)):
        assert abs(got[(a, c)] - want) < 0.01, (case, a, c)


def test_propagation_settles_on_a_ring(spark):
    pairs = [("a", "x", 1, 3.0), ("b", "x", 1, 0.0), ("b", "y", 1, 3.0), ("a", "y", 1, 0.0)]
    df = spark.createDataFrame(pairs, "a string, c string, site long, logit double")
    got = {(r.a, r.c): r.confidence for r in propagate(df, Scratch(spark, "t")).collect()}
    assert got[("a", "x")] > 0.9 and got[("b", "y")] > 0.9 and got[("b", "x")] < 0.2 and got[("a", "y")] < 0.2


def test_propagation_reports_that_it_did_not_settle(spark):
    df = spark.createDataFrame([("a", "x", 1, 2.0), ("b", "x", 1, 2.0)], "a string, c string, site long, logit double")
    with pytest.warns(RuntimeWarning, match="after 1 rounds"):
        propagate(df, Scratch(spark, "t"), rounds=1)


REC = "entity_id string, clean_name string, clean_addr string, postal string, confidence string"
ROWS = [
    ("S1-00000001", "summit pelmorisk tavjordov pharmacy", "12 mill road relpon falls 21213", "21213"), ("S1-00000002", "summit pelmorisk tavjordov pharmacy", "77 quarry lane vikvoville 20011", "20011"),
    ("S1-00000003", "zebrukvas dorlynpel motors", "12 mill road relpon falls 21213", "21213"), ("S2-00000001", "pelmorsk tavjordov phcy", "relpon falls 12 mill rd", ""),
    ("S2-00000002", "summit tavjordov pelmorisk", "77 quary ln 20011", "20011"), ("S3-00000001", "zebrukvas dorlynpel", None, None), ("S3-00000002", None, None, None),
    ("S3-00000003", "summit pelmorisk tavjordov", "", ""), ("S2-00000001", "pelmorsk tavjordov phcy", "relpon falls 12 mill rd", ""), (None, "x", "y", ""),
]


def test_matches(spark):
    df = spark.createDataFrame([(*r, "c") for r in ROWS], REC)
    none = spark.createDataFrame([], "source1_entity_id string, matched_entity_ids string")
    got = {(r[0], r[1]): r[2] for r in match_records(df, none).collect()}
    sure = {k for k, v in got.items() if v >= 0.5}
    assert sure == {("S1-00000001", "S2-00000001"), ("S1-00000002", "S2-00000002"), ("S1-00000003", "S3-00000001")}
    # One of two equal branches, and nothing to tell them apart.
    assert abs(got[("S1-00000001", "S3-00000003")] - got[("S1-00000002", "S3-00000003")]) < 0.05
    assert match_records(df.limit(0), none).count() == 0


def test_one_clear_partner_among_many_branches(spark):
    rows = [(f"S1-{i:08d}", "pelmorisk tavjordov bakery", f"{100 + i} mill road relpon falls 21213", "21213", "") for i in range(30)]
    rows += [("S1-00000099", "pelmorisk tavjordov pharmacy", "7 quarry lane vikvoville 20011", "20011", "")]
    rows += [("S2-00000001", "pelmorisk tavjordov pharmacy", None, None, ""), ("S2-00000002", "pelmorisk tavjordov bakery", "", "", "")]
    none = spark.createDataFrame([], "source1_entity_id string, matched_entity_ids string")
    got = {(r[0], r[1]): r[2] for r in match_records(spark.createDataFrame(rows, REC), none).collect()}
    # Odds with PRIOR: the partner of the same trade against thirty of another trade.
    same, other = (math.exp(3.0 + 1.5 + 2.0 - 5.0 + x) for x in (0.5, -0.5))
    assert abs(got[("S1-00000099", "S2-00000001")] - same / (1 + same + 30 * other)) < 0.01
    best = max((v, k) for k, v in got.items() if k[1] == "S2-00000001")
    assert best[1] == ("S1-00000099", "S2-00000001")
    assert all(v < 1 / 21 for (a, c), v in got.items() if c == "S2-00000002") and all(a for a, _ in got)


def test_held_out_labels(spark, data):
    from linkloom.llm.queries import business_records
    from linkloom.sources.tables import table

    labels = table(spark, "/root/testdata/sf0.01", "train_matches") if data.endswith("sf0.001") else table(spark, data, "train_matches")
    records = business_records(spark, "/root/testdata/sf0.01" if data.endswith("sf0.001") else data)
    fitted, held = labels.where("hash(source1_entity_id) % 2 = 0"), labels.where("hash(source1_entity_id) % 2 <> 0").collect()
    true = {(r[0], x) for r in held for x in (r[1] or "").split(",") if x}
    ids = {r[0] for r in held}
    found = {(r[0], r[1]) for r in match_records(records, fitted).where("confidence >= 0.5").collect() if r[0] in ids}
    assert len(found & true) >= 0.97 * len(true) and len(found & true) >= 0.97 * len(found)
