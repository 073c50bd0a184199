"""Training and inference from records to match lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from linkloom.config import Options
from linkloom.operators import blocking as B
from linkloom.operators.block_scores import HASHES, block_keys, block_pairs, within_cap
from linkloom.operators.decide import decide_matches, explode_ids
from linkloom.operators.evaluate import score_at_threshold, sweep_grid, threshold_sweep
from linkloom.operators.features import build_features, pair_attributes
from linkloom.operators.model import Classifier, train
from linkloom.operators.neighbors import tfidf_topk
from linkloom.operators.sampling import candidate_pool, country_sample, entity_split, sample_rows
from linkloom.runtime import Scratch
from linkloom.sources.records import first_rows, normalize


def exact_blocks(left: DataFrame, right: DataFrame, cap: int | None) -> DataFrame:
    """Pairs that share any of the six keys; normalized, deduplicated records.  The keys of both sides are written once."""
    scratch = Scratch(left.sparkSession, "blocks")
    return B.capped_block_join(*[scratch.cut(k) for k in B.sides_keys(left, right)], cap)


def candidate_pairs(left: DataFrame, right: DataFrame, options: Options = Options()) -> DataFrame:
    """Block pairs and nearest neighbours, each pair once."""
    scratch = Scratch(left.sparkSession, "candidates")
    one, two, over = block_keys(left, right, options.block_cap)
    one, two = scratch.cut(one), scratch.cut(two)
    # A neighbour that shares a block is among its pairs, so that no pairs have to be compared with others.
    kept = one.withColumns({h: within_cap(h, over) for h in HASHES})
    near = tfidf_topk(kept, country_sample(two, options.country_sample, options.seed), options.top_k, options.vocabulary, HASHES)
    pairs = block_pairs(one, two, over).unionByName(near.select("source1_entity_id", "candidate_entity_id"))
    return B.cap_pairs(pairs, options.pair_cap)


@dataclass
class Result:
    matches: DataFrame
    candidates: DataFrame


def run_inference(source1: DataFrame, others: DataFrame, model: Classifier, options: Options = Options()) -> Result:
    """Match and candidate lists, one row for each source-1 id.  Records come as delivered."""
    scratch = Scratch(source1.sparkSession, "inference")
    left, right = scratch.cut(normalize(first_rows(source1))), scratch.cut(normalize(first_rows(others)))
    pairs = scratch.cut(candidate_pairs(left, right, options))
    every = left.selectExpr("entity_id AS source1_entity_id")
    scored = scratch.cut(model.score(build_features(pair_attributes(pairs, left, right))))
    return Result(decide_matches(scored, every, options.threshold, options.margin), B.collapse_ids(pairs, every, "candidate_entity_ids"))


@dataclass
class Validation:
    """Held-out records: their features, their truth (a row for every one), and the rows the model may learn from."""

    features: DataFrame
    truth: DataFrame
    training: DataFrame
    training_truth: DataFrame


def prepare_data(source1: DataFrame, others: DataFrame, truth: DataFrame, options: Options = Options(), sample_size: int | None = None, val_split: float = 0.2, sides: tuple[bool, ...] = (False, True)) -> Validation:
    """Records split by entity, with candidates and features of both sides (or of the held-out one alone: ``sides=(True,)``)."""
    scratch = Scratch(source1.sparkSession, "training")
    ids = truth.selectExpr("source1_entity_id AS entity_id").distinct()
    left = normalize(first_rows(source1)).join(ids, "entity_id", "left_semi")
    left = scratch.cut(sample_rows(left, sample_size) if sample_size else left)
    kept = truth.join(left.selectExpr("entity_id AS source1_entity_id"), "source1_entity_id", "left_semi")
    positives = explode_ids(kept).selectExpr("candidate_entity_id AS entity_id")
    right = scratch.cut(normalize(candidate_pool(first_rows(others), positives, options.per_country)))
    split = entity_split(left, val_split, "entity_id")
    features: dict[bool, DataFrame] = {}
    lists = {}
    for held in (False, True):
        part = split.where("held_out" if held else "NOT held_out").drop("held_out")
        every = part.selectExpr("entity_id AS source1_entity_id")
        lists[held] = every.join(kept, "source1_entity_id", "left")
        if held in sides:
            pairs = scratch.cut(candidate_pairs(part, right, options))
            features[held] = scratch.cut(build_features(pair_attributes(pairs, part, right)))
    return Validation(features.get(True), lists[True], features.get(False), lists[False])


def run_training(
    source1: DataFrame, others: DataFrame, truth: DataFrame, path: str | None = None, options: Options = Options(),
    sample_size: int | None = None, val_split: float = 0.2,
) -> tuple[Classifier, DataFrame]:
    """A model, and its ``macro`` scores on the held-out records."""
    data = prepare_data(source1, others, truth, options, sample_size, val_split)
    model = train(data.training, data.training_truth, path, options)
    return model, score_at_threshold(model.score(data.features), data.truth, options.threshold, options.margin)


def run_validate(model: Classifier, data: Validation, threshold: float = 0.90, margin: float = 0.0) -> DataFrame:
    """``macro`` of a model on the held-out records at one threshold."""
    return score_at_threshold(model.score(data.features), data.truth, threshold, margin)


def run_sweep(model: Classifier, data: Validation) -> DataFrame:
    """``threshold_sweep`` of a model on the held-out records."""
    scratch = Scratch(data.features.sparkSession, "sweep")
    return threshold_sweep(scratch.cut(model.score(data.features)), data.truth, sweep_grid(data.features.sparkSession))
