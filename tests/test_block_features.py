"""Similarities of block pairs computed in the blocks' tasks: equal to those of single pairs, and without joins of pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkloom.functions.similarity import KERNELS, jaro_winkler, token_set_ratio
from linkloom.operators import decide as D
from linkloom.operators.block_features import _jaro_winkler, _Texts, block_features
from linkloom.operators.features import FEATURES, build_features, pair_attributes
from linkloom.plans import core
from linkloom.plans.pipeline import exact_blocks
from tests.test_block_scores import sides

HARD = ["", "a", "a b", "b a", "a a b", "ab ba ab", "x_y 12", "w" * 63, "w" * 64, "w" * 65, "b " + "w" * 62, "b " + "w" * 61 + "a", " ".join(f"w{i}" for i in range(40)), " ".join(f"w{i}" for i in range(3, 30))]


def test_columns_equal_single_comparisons():
    r = random.Random(5)
    some = ["".join(r.choice("ab1 ") for _ in range(r.randint(1, 140))) for _ in range(60)]
    texts = HARD + [" ".join(x.split()) for x in some]
    t = _Texts(pa.array(texts, pa.string()))
    x, y = (i.ravel() for i in np.meshgrid(t.of, t.of))
    pairs = [(t.read(a), t.read(b)) for a, b in zip(x, y)]
    assert _jaro_winkler(t.raw, x, t.raw, y).tolist() == [jaro_winkler(*p) for p in pairs]
    assert t.compared(x, y)[1].tolist() == [token_set_ratio(*p) for p in pairs]


@pytest.mark.parametrize("cap", [None, 12])
def test_features_equal_those_of_single_pairs(spark, cap):
    left, right = sides(spark)
    ids = right.select("entity_id").orderBy("entity_id").limit(40).agg(F.concat_ws(" , ", F.collect_list("entity_id"))).first()[0]
    truth = left.select(F.col("entity_id").alias("source1_entity_id"), F.when(F.col("entity_id") < "S1-00000030", ids).when(F.col("entity_id") < "S1-00000040", "nan").alias("matched_entity_ids"))
    want = D.label_pairs(build_features(pair_attributes(exact_blocks(left, right, cap), left, right)), truth)
    got = block_features(left, right, cap, truth)
    assert sorted(got.collect()) == sorted(want.select(got.columns).collect())
    assert got.where("label = 1").count() > 0


def test_score_pairs_joins_no_pairs(spark, data, monkeypatch):
    """Each pair is compared where its records meet; single comparisons of strings are not called."""
    monkeypatch.setattr(core, "pair_attributes", None)
    monkeypatch.setattr(core, "build_features", None)
    scores = core.score_pairs(spark, data)
    assert scores.columns == ["source1_entity_id", "candidate_entity_id", "prob"] and scores.count() > 0
    assert set(KERNELS) <= set(FEATURES)
