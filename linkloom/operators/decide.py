"""From scores to matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkloom.functions import text as X
from linkloom.operators.blocking import collapse_ids


def label_pairs(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Adds ``label``: 1 for a pair of the exploded truth lists, else 0."""
    links = explode_ids(truth).withColumn("label", F.lit(1))
    return pairs.join(links, ["source1_entity_id", "candidate_entity_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def parse_ids(c: Column) -> Column:
    """Ids of a comma list, trimmed, without empty ones; '' and 'nan' have none."""
    parts = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: X.strip(x)), lambda x: x != "")
    return F.when(F.lower(X.strip(c)) == "nan", F.array().cast("array<string>")).otherwise(parts)


def explode_ids(lists: DataFrame, column: str = "matched_entity_ids") -> DataFrame:
    return lists.select("source1_entity_id", F.explode(parse_ids(F.col(column))).alias("candidate_entity_id")).distinct()


def class_balance(labelled: DataFrame) -> DataFrame:
    """``pos``, ``neg``, ``scale_pos_weight`` = neg / max(pos, 1)."""
    out = labelled.agg(F.coalesce(F.sum("label"), F.lit(0)).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    return out.withColumn("scale_pos_weight", F.col("neg") / F.greatest("pos", F.lit(1)))


def entity_stats(scored: DataFrame, threshold: float) -> DataFrame:
    """Per record: best and second score (0 if there is none), their difference, candidates, and scores at or above the threshold."""
    # Ranked and counted in one partitioning; no list of a record's scores is made.
    ranked = scored.withColumn("__rank", F.row_number().over(W.partitionBy("source1_entity_id").orderBy(F.desc("prob"))))
    two = ranked.groupBy("source1_entity_id").agg(
        F.max("prob").alias("top_score"),
        F.count(F.lit(1)).alias("n_candidates"),
        F.count_if(F.col("prob") >= threshold).alias("n_above"),
        F.coalesce(F.max(F.when(F.col("__rank") == 2, F.col("prob"))), F.lit(0.0)).alias("second_score"),
    )
    return two.withColumn("margin", F.col("top_score") - F.col("second_score"))


def ambiguous(threshold: float | Column, margin: float | Column, slack: float = 0.05) -> Column:
    """A sole match that leads by less than ``margin`` and lies less than ``slack`` above the threshold."""
    return (F.col("n_above") == 1) & (F.col("margin") < margin) & (F.col("top_score") < threshold + F.lit(slack))


def accept(scored: DataFrame, threshold: float, margin: float, slack: float = 0.05, stats: DataFrame | None = None) -> DataFrame:
    """Pairs at or above the threshold, without the records whose sole match is ambiguous.

    stats: ``entity_stats`` of all pairs, where ``scored`` has not all of those below the threshold.
    """
    above = scored.where(F.col("prob") >= threshold)
    if margin <= 0:
        return above
    reject = (entity_stats(scored, threshold) if stats is None else stats).where(ambiguous(F.lit(threshold), F.lit(margin), slack)).select("source1_entity_id")
    return above.join(reject, "source1_entity_id", "left_anti")


def decide_matches(scored: DataFrame, every: DataFrame, threshold: float, margin: float) -> DataFrame:
    """One match list for each id of ``every``."""
    return collapse_ids(accept(scored, threshold, margin), every)
