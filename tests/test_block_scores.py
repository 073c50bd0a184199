"""Scores of block pairs: equal to scoring the pairs one by one, and without writing them."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from linkloom.config import Options
from linkloom.operators import decide as D
from linkloom.operators.block_scores import block_scores, rounded_pairs, rounded_stats
from linkloom.operators.features import build_features, pair_attributes
from linkloom.operators.neighbors import tfidf_topk
from linkloom.plans import core
from linkloom.plans.pipeline import candidate_pairs, exact_blocks
from linkloom.runtime import Scratch, regroup
from linkloom.sources import records as R

SOURCE = "entity_id string, business_name string, business_address string, country string, seen_at timestamp, loaded_at timestamp"


def made(seed, prefix, n):
    r = random.Random(seed)
    first, last = ["Acme", "New", "7eleven", "Akme", "Zed", "", "Bo"], ["Bakery", "Motors Ltd", "bakery bakery", "", "Grill & Bar"]
    long = " ".join(f"w{i}" for i in range(40))
    for i in range(n):
        address = r.choice([f"{r.randint(1, 9)} Main Rd {r.randint(10000, 10004)}", f"{long} {r.randint(1, 3)}", "", f"No {r.randint(1, 3)} Hill St ٣٣٣٣٣"])
        yield f"{prefix}-{i:08d}", f"{r.choice(first)} {r.choice(last)}", address, r.choice(["US", " us", "FR", ""])


def sides(spark):
    return [R.normalize(spark.createDataFrame(list(made(*x)), "entity_id string, business_name string, business_address string, country string")) for x in ((1, "S1", 60), (2, "S2", 90))]


@pytest.mark.parametrize("cap", [None, 800, 12, 3, 0])
def test_scores_equal_those_of_single_pairs(spark, cap):
    left, right = sides(spark)
    f = build_features(pair_attributes(exact_blocks(left, right, cap), left, right))
    want = f.select("source1_entity_id", "candidate_entity_id", F.round((F.col("name_jaccard") + F.col("addr_jaccard") + F.col("postal_match")) / 3, 6).alias("prob")).localCheckpoint()
    assert sorted(rounded_pairs(block_scores(left, right, cap)).collect()) == sorted(want.collect())
    both = block_scores(left, right, cap, 0.5, pairs="above", stats=True)
    assert sorted(rounded_pairs(both).collect()) == sorted(want.where("prob >= 0.5").collect())
    assert sorted(rounded_pairs(block_scores(left, right, cap, 0.5, pairs="above")).collect()) == sorted(want.where("prob >= 0.5").collect())
    digits = lambda rows: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows)
    columns = ["source1_entity_id", "top_score", "n_candidates", "n_above", "second_score", "margin"]
    assert digits(rounded_stats(both).select(*columns).collect()) == digits(D.entity_stats(want, 0.5).select(*columns).collect())


def test_regrouped_rows_are_whole_and_together(spark):
    df = spark.range(2000).select((F.col("id") % 37 - 18).alias("k"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("é"), "id")).alias("t")).repartition(3)
    got = regroup(df, "k").withColumn("task", F.spark_partition_id())
    assert sorted(map(str, got.select("k", "t").collect())) == sorted(map(str, df.collect()))
    assert got.groupBy("k").agg(F.countDistinct("task").alias("n")).where("n > 1").count() == 0


@pytest.fixture(scope="module")
def crowd(spark, tmp_path_factory):
    """A block of 150 records with 200: 30,000 pairs, of which 200 are alike."""
    d = str(tmp_path_factory.mktemp("crowd"))
    for n, rows in ((1, 150), (2, 100), (3, 100)):
        data = [(f"S{n}-{i:08d}", f"Acme {'own' if n == 1 else 'other'}{i}" if i or n == 2 else "Acme bakery", f"{i} Way{i} Town{i}", "US", None, None) for i in range(rows)]
        spark.createDataFrame(data, SOURCE).write.parquet(f"{d}/source{n}.parquet")
    return d


@pytest.fixture
def written(monkeypatch):
    """Numbers of rows of the tables that a query writes on its way."""
    counts = []
    cut = Scratch.cut

    def counted(self, df):
        out = cut(self, df)
        counts.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "cut", counted)
    return counts


# each wrote all 30,000 pairs, twice.
def test_threshold_filter_writes_no_pairs(spark, crowd, written):
    assert core.QUERIES["threshold_filter"](spark, crowd).count() > 0
    assert max(written) <= 200


def test_singleton_reject_writes_no_pairs(spark, crowd, written):
    assert core.QUERIES["singleton_reject"](spark, crowd).count() > 0
    assert max(written) <= 800


def test_decide_matches_writes_no_pairs(spark, crowd, written):
    assert core.QUERIES["decide_matches"](spark, crowd).count() == 150
    assert max(written) <= 800


def test_entity_stats_writes_no_pairs(spark, crowd, written):
    assert core.QUERIES["entity_stats"](spark, crowd).count() == 150
    assert max(written) <= 800


def test_second_best_writes_no_pairs(spark, crowd, written):
    assert core.QUERIES["second_best"](spark, crowd).count() == 150
    assert max(written) <= 800


@pytest.mark.parametrize("cap", [None, 12, 0])
def test_candidate_pairs_are_not_shuffled(spark, cap):
    # F8: block pairs and neighbours went through a shuffle to find those that are both.
    left, right = sides(spark)
    options = Options(block_cap=cap, top_k=5)
    near = tfidf_topk(left, right, 5).select("source1_entity_id", "candidate_entity_id")
    want = exact_blocks(left, right, cap).unionByName(near).distinct()
    found = candidate_pairs(left, right, options)
    assert sorted(found.collect()) == sorted(want.collect())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(source1_entity_id" not in plan and "Aggregate" not in plan
