"""Mixes keep their caps and reach their shares."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from linkloom.llm.mixing import mix_documents, running_sums

TARGETS = "mix_name string, source string, target_weight double, max_repeats int"


def docs(spark, n=400):
    rows = [(i, " ".join(["word"] * (1 + i % 13)), "big" if i % 4 else "small", "clash") for i in range(n)]
    rows += [(1000, None, "big", ""), (1001, "", "big", ""), (1002, "x y", None, ""), (None, "no id", "big", ""), (5, "again and again", "big", "")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, repeats string")


def test_shares_and_caps(spark):
    targets = spark.createDataFrame([("m", "big", 1.0, 1), ("m", "small", 1.0, 4), ("m", "none", 3.0, 9), ("m", None, 1.0, 1), ("w", "big", 0.0, 1), ("w", "small", 2.0, None), ("w", "small", 1.0, 2)], TARGETS)
    rows, shares = mix_documents(docs(spark), targets)
    rows, shares = rows.collect(), {(r.mix_name, r.source): r for r in shares.collect()}
    cap = {("m", "big"): 1, ("m", "small"): 4, ("w", "small"): 2}
    tokens = defaultdict(int)
    seen = set()
    for r in rows:
        assert 1 <= r.repeats <= cap[(r.mix_name, r.source)]
        assert (r.mix_name, r.source, r.doc_id) not in seen
        seen.add((r.mix_name, r.source, r.doc_id))
        tokens[(r.mix_name, r.source)] += r.n_tokens * r.repeats
    for key, r in shares.items():
        assert r.tokens == tokens[key] <= r.budget
    for s in ("big", "small"):
        assert abs(shares[("m", s)].reached_share - 0.5) < 0.02 and shares[("m", s)].budget - shares[("m", s)].tokens < 14
    assert shares[("m", "none")].reached_share == 0 and shares[("w", "big")].tokens == 0
    assert shares[("w", "small")].reached_share == 1


def test_given_total(spark):
    targets = spark.createDataFrame([("m", "big", 3.0, 1), ("m", "small", 1.0, 1)], TARGETS)
    shares = {r.source: r for r in mix_documents(docs(spark), targets, total_tokens=400)[1].collect()}
    assert shares["big"].budget == 300 and shares["small"].budget == 100


def test_empty_texts_keep_the_cap(spark):
    # Half of the documents have no tokens and the budget is a whole number of epochs: none of them may appear once more.
    rows = [(i, "" if i % 2 else "one two three", "s") for i in range(200)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_documents(d, spark.createDataFrame([("m", "s", 1.0, 2)], TARGETS))[0].collect()
    assert len(got) == 200 and {r.repeats for r in got} == {2}


def test_running_sums_equal_one_window(spark):
    sized = spark.createDataFrame([("a" if i % 3 else "b", i, i % 7) for i in range(500)], "source string, doc_id long, n_tokens long")
    few, many = ({(r.source, r.doc_id): r.running for r in running_sums(sized, 3, n).collect()} for n in (10, 10_000))
    assert few == many and len(few) == 500
    assert max(v for (s, _), v in few.items() if s == "a") == sum(i % 7 for i in range(500) if i % 3)


@pytest.mark.parametrize("empty", ["documents", "targets"])
def test_empty(spark, empty):
    d, t = docs(spark, 10), spark.createDataFrame([("m", "big", 1.0, 1)], TARGETS)
    rows, shares = mix_documents(d.limit(0) if empty == "documents" else d, t.limit(0) if empty == "targets" else t)
    assert rows.count() == 0
    assert shares.count() == (1 if empty == "documents" else 0)
    assert shares.where(F.col("reached_share") > 0).count() == 0
