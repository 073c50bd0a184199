"""Repeatable samples and splits: order and buckets come from hashes of ids, not from a generator's state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def hash_order(c: str, seed: int = 42):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(c)))


def sample_rows(rows: DataFrame, n: int, id_col: str = "entity_id", seed: int = 42) -> DataFrame:
    """n rows, the same ones each time."""
    return rows.orderBy(hash_order(id_col, seed), id_col).limit(n)


def in_validation(c: str, share: float, seed: int = 42):
    """Whether an id belongs to the held-out share: its hash's first eight hex digits, as a fraction."""
    return F.conv(F.substring(hash_order(c, seed), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32)) < F.lit(share)


def entity_split(rows: DataFrame, share: float, id_col: str = "source1_entity_id", seed: int = 42) -> DataFrame:
    """Adds ``held_out``; all rows of an id fall on one side."""
    return rows.withColumn("held_out", in_validation(id_col, share, seed))


def first_of_country(rows: DataFrame, room: DataFrame, seed: int = 42) -> DataFrame:
    """The first ``room`` rows (``country, __room``) of each country in the order of their ids' hashes.

    Rows are counted by ranges of the hash; whole ranges that fit are taken as they are, and only the range at the
    bound is sorted, so no task holds a country.
    """
    part = F.conv(F.substring(hash_order("entity_id", seed), 1, 3), 16, 10).cast("int")
    rows = rows.withColumn("__part", part)
    up_to = F.sum("__n").over(W.partitionBy("country").orderBy("__part"))
    parts = rows.groupBy("country", "__part").agg(F.count(F.lit(1)).alias("__n")).withColumn("__upto", up_to)
    parts = parts.withColumnsRenamed({"country": "__country", "__part": "__p"})
    room = room.withColumnRenamed("country", "__of")
    parts = parts.join(room, F.col("__country").eqNullSafe(F.col("__of"))).select("__country", "__p", "__n", (F.col("__room") - F.col("__upto") + F.col("__n")).alias("__left"))
    met = rows.join(parts.where("__left > 0"), F.col("country").eqNullSafe(F.col("__country")) & (F.col("__part") == F.col("__p")))
    whole = met.where("__n <= __left").select(*rows.columns)
    rank = F.row_number().over(W.partitionBy("country", "__part").orderBy(hash_order("entity_id", seed), "entity_id"))
    border = met.where("__n > __left").withColumn("__rank", rank).where("__rank <= __left").select(*rows.columns)
    return whole.unionByName(border).drop("__part")


def candidate_pool(candidates: DataFrame, positives: DataFrame, per_country: int | None, seed: int = 42) -> DataFrame:
    """All candidates in ``positives`` and, up to ``per_country`` rows with them (None: all), others of each country; the country as delivered.

    Adds ``positive``.  The others are the first in hash order.
    """
    pos = candidates.join(positives.select("entity_id").distinct(), "entity_id", "left_semi").withColumn("positive", F.lit(True))
    neg = candidates.join(positives.select("entity_id"), "entity_id", "left_anti").withColumn("positive", F.lit(False))
    if per_country is None:
        return pos.unionByName(neg)
    used = candidates.select("country", "entity_id").join(positives.select("entity_id").distinct().withColumn("__p", F.lit(1)), "entity_id", "left")
    room = used.groupBy("country").agg((F.lit(per_country) - F.count("__p")).alias("__room"))
    return pos.unionByName(first_of_country(neg, room, seed))


def country_sample(candidates: DataFrame, most: int | None, seed: int = 42) -> DataFrame:
    """At most ``most`` candidates of each country, the first in hash order; None, the default everywhere: all."""
    if most is None:
        return candidates
    return first_of_country(candidates, candidates.select("country").distinct().withColumn("__room", F.lit(most)), seed)
