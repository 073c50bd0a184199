"""A boosted-tree classifier of candidate pairs."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.config import Options
from linkloom.operators.decide import class_balance, label_pairs
from linkloom.operators.features import FEATURES, backfill


class Classifier:
    """Trees on the features named at training; missing features are 0 when scoring."""

    def __init__(self, model: PipelineModel, names: tuple[str, ...], scale_pos_weight: float):
        self.model, self.names, self.scale_pos_weight = model, names, scale_pos_weight

    @staticmethod
    def fit(labelled: DataFrame, options: Options = Options()) -> Classifier:
        """Fits on pairs with ``label``; positive pairs weigh neg / pos.  Raises ValueError without pairs."""
        balance = class_balance(labelled).first()
        if balance.pos + balance.neg == 0:
            raise ValueError("no pairs to train on")
        names = tuple(f for f in FEATURES if f in labelled.columns)
        weighted = labelled.withColumn("weight", F.when(F.col("label") == 1, F.lit(float(balance.scale_pos_weight))).otherwise(1.0))
        trees = GBTClassifier(
            labelCol="label", weightCol="weight", maxIter=options.rounds, stepSize=options.step, maxDepth=options.depth,
            subsamplingRate=0.8, featureSubsetStrategy="0.8", minInstancesPerNode=20, seed=options.seed,
        )
        model = Pipeline(stages=[VectorAssembler(inputCols=list(names), outputCol="features"), trees]).fit(weighted)
        return Classifier(model, names, float(balance.scale_pos_weight))

    def score(self, features: DataFrame) -> DataFrame:
        """``source1_entity_id, candidate_entity_id, prob``."""
        scored = self.model.transform(backfill(features, self.names))
        return scored.select("source1_entity_id", "candidate_entity_id", vector_to_array("probability")[1].alias("prob"))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/trees")
        side = json.dumps({"features": self.names, "scale_pos_weight": self.scale_pos_weight})
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(side,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @staticmethod
    def load(path: str) -> Classifier:
        about = json.loads(SparkSession.getActiveSession().read.text(f"{path}/about").first().value)
        return Classifier(PipelineModel.load(f"{path}/trees"), tuple(about["features"]), about["scale_pos_weight"])


def train(features: DataFrame, truth: DataFrame, path: str | None = None, options: Options = Options()) -> Classifier:
    """Labels, fits and, given a path, saves."""
    model = Classifier.fit(label_pairs(features, truth), options)
    if path:
        model.save(path)
    return model
