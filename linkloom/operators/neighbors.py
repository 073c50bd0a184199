"""The most similar candidates of each record by character n-grams, within a country."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkloom.functions import text as X
from linkloom.operators.gram_search import BLOCK, encoded, gram_stats, nearest
from linkloom.runtime import Scratch


def record_grams(rows: DataFrame) -> DataFrame:
    """``country, entity_id, gram, tf`` over name, address and postal; the country as delivered, '' left out."""
    whole = F.concat_ws(" ", "clean_name", "clean_addr", "postal")
    spread = rows.where("country <> ''").select("country", "entity_id", F.explode(X.word_grams(whole)).alias("gram"))
    return spread.groupBy("country", "entity_id", "gram").agg(F.count(F.lit(1)).alias("tf"))


def gram_weights(candidate_grams: DataFrame, candidates: DataFrame, vocabulary: int | None) -> DataFrame:
    """``country, gram, idf`` of the ``vocabulary`` most frequent grams of a country's candidates (ties by gram).

    idf is ln((1 + n) / (1 + df)) + 1.
    """
    return _weights(candidate_grams.groupBy("country", "gram").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ctf")), candidates, vocabulary)


def _weights(stats: DataFrame, candidates: DataFrame, vocabulary: int | None) -> DataFrame:
    n = candidates.groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    if vocabulary is not None:
        rank = F.row_number().over(W.partitionBy("country").orderBy(F.desc("ctf"), "gram"))
        stats = stats.withColumn("rank", rank).where(F.col("rank") <= vocabulary)
    return stats.join(n, "country").select("country", "gram", "df", "ctf", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def unit_vectors(grams: DataFrame, weights: DataFrame) -> DataFrame:
    """``country, entity_id, gram, w``: (1 + ln tf) idf, divided by the record's norm."""
    raw = grams.join(weights.select("country", "gram", "idf"), ["country", "gram"]).withColumn("x", (1 + F.log("tf")) * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(W.partitionBy("country", "entity_id")))
    return raw.select("country", "entity_id", "gram", (F.col("x") / norm).alias("w"))


def tfidf_topk(rows1: DataFrame, candidates: DataFrame, k: int, vocabulary: int | None = 30_000, apart: tuple[str, ...] = ()) -> DataFrame:
    """``source1_entity_id, candidate_entity_id, sim``: the k candidates of highest cosine of the same country.

    Deduplicated records.  Pairs without a common gram have similarity 0 and are no neighbours.  Ties, at six decimals, go by id.
    apart: columns of longs of both sides; of the k neighbours those that share a value of one of them are left out.
    Neither grams nor pairs are written (``operators.gram_search``); the time still grows with the square of a country's records.
    """
    spark = rows1.sparkSession
    scratch = Scratch(spark, "neighbors")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch.base)
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()
    whole = F.regexp_replace(F.lower(F.concat_ws(" ", "clean_name", "clean_addr", "postal")), r"\s+", " ")
    one, two = (rows.where("country <> ''").select("country", "entity_id", whole.alias("text"), *apart) for rows in (rows1, candidates))
    stats = gram_stats(two.select("country", "text")).groupBy("country", "gram").agg(F.sum("df").alias("df"), F.sum("ctf").alias("ctf"))
    weights = scratch.cut(_weights(stats, two, vocabulary))
    sizes = {r.country: r.n for r in two.groupBy("country").agg(F.count(F.lit(1)).alias("n")).join(weights.select("country").distinct(), "country").collect()}
    if not sizes:
        return spark.createDataFrame([], "source1_entity_id string, candidate_entity_id string, sim double")
    numbered = [(c, i, max(1, math.ceil(sizes[c] / BLOCK))) for i, c in enumerate(sorted(sizes))]
    countries = F.broadcast(spark.createDataFrame(numbered, "country string, c int, blocks int"))
    weights.join(countries, "country").select("c", "gram", "df", "idf").repartition("c").write.option("compression", "zstd").partitionBy("c").parquet(f"{scratch.base}/vocabulary")
    scratch.drop(weights)
    wide = vocabulary is None or vocabulary > 1 << 16
    placed = two.join(countries, "country").select("c", F.pmod(F.xxhash64("entity_id"), F.col("blocks")).cast("int").alias("b"), "entity_id", "text", *apart)
    encoded(placed.repartition("c", "b"), uri, wide, apart).write.option("compression", "zstd").partitionBy("c", "b").parquet(f"{scratch.base}/candidates")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = one.join(countries, "country").select("c", "entity_id", "text", *apart).repartition(tasks, "entity_id")
    return nearest(asked, uri, {i: n for _, i, n in numbered}, k, wide, apart)
