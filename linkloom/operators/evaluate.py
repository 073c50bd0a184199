"""Precision, recall and F of match lists, averaged over records; threshold sweeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.operators.decide import ambiguous, decide_matches, entity_stats, explode_ids, parse_ids


SWEEP = "cell int, threshold double, margin_min double, macro_precision double, macro_recall double, macro_f05 double"


def f_beta(p: Column, r: Column, beta: float = 0.5) -> Column:
    b = beta * beta
    bottom = F.lit(b) * p + r
    return F.when(bottom > 0, (1 + b) * p * r / F.when(bottom > 0, bottom).otherwise(1.0)).otherwise(0.0)


def _rates(hits: Column, predicted: Column, actual: Column) -> tuple[Column, Column]:
    """No prediction is precise; a record without truth is fully recalled."""
    p = F.when(predicted > 0, F.when(actual > 0, hits / F.greatest(predicted, F.lit(1))).otherwise(0.0)).otherwise(1.0)
    r = F.when(actual > 0, F.when(predicted > 0, hits / F.greatest(actual, F.lit(1))).otherwise(0.0)).otherwise(1.0)
    return p, r


def entity_scores(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """``source1_entity_id, p, r, f, actual`` for each row of the truth; a missing prediction is an empty list."""
    pred = predicted.select("source1_entity_id", F.array_distinct(parse_ids(F.col("matched_entity_ids"))).alias("pred"))
    both = truth.select("source1_entity_id", F.array_distinct(parse_ids(F.col("matched_entity_ids"))).alias("true")).join(pred, "source1_entity_id", "left")
    both = both.withColumn("pred", F.coalesce("pred", F.array().cast("array<string>")))
    p, r = _rates(F.size(F.array_intersect("pred", "true")), F.size("pred"), F.size("true"))
    return both.select("source1_entity_id", p.alias("p"), r.alias("r"), F.size("true").alias("actual")).withColumn("f", f_beta(F.col("p"), F.col("r")))


def macro(scores: DataFrame) -> DataFrame:
    """Averages over records, and their numbers."""
    avg = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    return scores.agg(
        avg("p").alias("macro_precision"), avg("r").alias("macro_recall"), avg("f").alias("macro_f05"),
        F.count(F.lit(1)).alias("n_entities"), F.count_if(F.col("actual") == 0).alias("n_singletons"), F.count_if(F.col("actual") > 0).alias("n_with_matches"),
    )


def score_at_threshold(scored: DataFrame, truth: DataFrame, threshold: float, margin: float = 0.0) -> DataFrame:
    """``macro`` of the decision at one threshold and margin over every record of the truth; no scores give empty lists."""
    return macro(entity_scores(decide_matches(scored, truth.select("source1_entity_id"), threshold, margin), truth))


def sweep_grid(spark, thresholds=range(50, 99, 2), margins=range(0, 21, 5)) -> DataFrame:
    """``cell, threshold, margin``, both in hundredths so that no value drifts."""
    cells = [(i, t, m) for i, (t, m) in enumerate((t, m) for t in thresholds for m in margins)]
    return spark.createDataFrame(cells, "cell int, t int, m int").select("cell", (F.col("t") / 100).alias("threshold"), (F.col("m") / 100).alias("margin_min"))


def threshold_sweep(scored: DataFrame, truth: DataFrame, grid: DataFrame) -> DataFrame:
    """``macro`` for every cell of the grid in one pass; the grid is small and fixed.

    A record's pairs and hits above a threshold change only at the grid's thresholds, and are counted there; where it has
    no pair, it scores as without a prediction, so such rows are not made: the averages start from all records
    without predictions, and each row adds what it changes.  Every record of the truth takes part; candidates of other
    records do not.
    """
    cells = [(r.cell, r.threshold, r.margin_min) for r in grid.collect()]
    levels, margins = sorted({t for _, t, _ in cells}), sorted({m for _, _, m in cells})
    reached = sum((F.when(F.col("prob") >= t, 1).otherwise(0) for t in levels), F.lit(0))
    links = explode_ids(truth).withColumn("hit", F.lit(1))
    marked = scored.join(links, ["source1_entity_id", "candidate_entity_id"], "left").select("source1_entity_id", reached.alias("up_to"), F.coalesce("hit", F.lit(0)).alias("hit"))
    steps = marked.where("up_to > 0").groupBy("source1_entity_id", "up_to").agg(F.count(F.lit(1)).alias("n"), F.sum("hit").alias("hits"))
    above = steps.select("source1_entity_id", "n", "hits", F.explode(F.sequence(F.lit(1), "up_to")).alias("level"))
    above = above.groupBy("source1_entity_id", "level").agg(F.sum("n").alias("n_above"), F.sum("hits").alias("hits"))
    stats = entity_stats(scored, 0.0).select("source1_entity_id", "top_score", "margin")
    rows = truth.select("source1_entity_id", F.size(F.array_distinct(parse_ids(F.col("matched_entity_ids")))).alias("actual"))
    p, r = _rates(F.col("hits"), F.col("n_above"), F.col("actual"))
    single = (F.col("actual") == 0).cast("double")
    scores = rows.join(above, "source1_entity_id").join(stats, "source1_entity_id").withColumns({"p": p, "r": r}).withColumn("f", f_beta(F.col("p"), F.col("r")))
    # Without a prediction precision is 1, and recall and F are 1 where there is nothing to find.
    change = {"p": F.col("p") - 1, "r": F.col("r") - single, "f": F.col("f") - single}
    at = F.element_at(F.array(*[F.lit(t) for t in levels]), F.col("level"))
    kept = [F.lit(True) if m <= 0 else ~ambiguous(at, m) for m in margins]
    sums = [F.sum(F.when(k, v).otherwise(0.0)).alias(f"{c}{i}") for i, k in enumerate(kept) for c, v in change.items()]
    changes = {x.level: x for x in scores.groupBy("level").agg(*sums).collect()}  # a row a threshold
    base = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(single).alias("single")).first()
    if not base.n:
        return truth.sparkSession.createDataFrame([], SWEEP)
    out = []
    for cell, t, m in cells:
        x, i = changes.get(levels.index(t) + 1), margins.index(m)
        d = [x[f"{c}{i}"] if x else 0.0 for c in "prf"]
        out.append((cell, t, m, (base.n + d[0]) / base.n, (base.single + d[1]) / base.n, (base.single + d[2]) / base.n))
    return truth.sparkSession.createDataFrame(out, SWEEP)


def sweep_best(sweep: DataFrame) -> DataFrame:
    """The cell of highest F; the first of equals."""
    best = F.max_by(F.struct("threshold", "margin_min", "macro_f05"), F.struct(F.round("macro_f05", 9), -F.col("cell")))
    return sweep.agg(best.alias("b")).select("b.*")
