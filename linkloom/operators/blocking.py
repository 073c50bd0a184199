"""Candidate pairs from equal keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions import text as X

KINDS = ("first_word", "postal", "sorted_2word", "sorted_nums", "soundex", "rarest_3gram")
#: Keys that common first words may not make.
FILTERED = ("first_word", "sorted_2word", "soundex")


def gram_counts(candidates: DataFrame) -> DataFrame:
    """``gram``, ``cnt``: occurrences of each name trigram over all candidates."""
    return candidates.select(F.explode(X.name_trigrams(F.col("clean_name"))).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("cnt"))


def rarest_3gram(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``entity_id``, ``rarest_3gram``: the name's least frequent trigram, the leftmost of equals; '' for names without.

    A trigram that no candidate has counts 0 and wins.
    """
    spread = rows.select("entity_id", F.posexplode_outer(X.name_trigrams(F.col("clean_name"))).alias("pos", "gram"))
    counted = spread.join(counts, "gram", "left")
    order = F.struct(F.coalesce("cnt", F.lit(0)), "pos")
    return counted.groupBy("entity_id").agg(X.text(F.min_by("gram", order)).alias("rarest_3gram"))


def with_keys(rows: DataFrame, counts: DataFrame | None) -> DataFrame:
    """The keys of deduplicated, normalized records; the rarest trigram, which takes a join, only where counts are given."""
    name = F.col("clean_name")
    keyed = rows.withColumns(
        {"country_lc": X.country_key(F.col("country")), "first_word": X.first_word(name), "sorted_2word": X.sorted_2word(name), "sorted_nums": X.sorted_nums(F.col("clean_addr"))}
    ).withColumn("soundex", X.soundex_key(F.col("first_word")))
    return keyed if counts is None else keyed.join(rarest_3gram(rows, counts), "entity_id")


def sides_keys(left: DataFrame, right: DataFrame, kinds: tuple[str, ...] = KINDS) -> tuple[DataFrame, DataFrame]:
    """Long keys of both sides; trigrams are counted over the right one."""
    counts = gram_counts(right) if "rarest_3gram" in kinds else None
    return long_keys(with_keys(left, counts), kinds), long_keys(with_keys(right, counts), kinds)


def long_keys(keyed: DataFrame, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """``entity_id, country_lc, kind, key``: one row a usable key."""
    common = F.col("first_word").isin(X.COMMON_FIRST_WORDS)
    usable = {
        "first_word": F.when(~common, F.col("first_word")),
        "soundex": F.when(~common, F.col("soundex")),
        "sorted_2word": F.when(~F.col("sorted_2word").isin(X.COMMON_FIRST_WORDS), F.col("sorted_2word")),
    }
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), usable.get(k, F.col(k)).alias("key")) for k in kinds])
    return keyed.select("entity_id", "country_lc", F.explode(pairs).alias("k")).select("entity_id", "country_lc", "k.kind", "k.key").where("key <> ''")


def block_sizes(candidate_keys: DataFrame) -> DataFrame:
    return candidate_keys.groupBy("kind", "country_lc", "key").agg(F.count(F.lit(1)).alias("n"))


def capped_block_join(left: DataFrame, right: DataFrame, cap: int | None) -> DataFrame:
    """Distinct ``source1_entity_id``, ``candidate_entity_id`` with an equal key, over keys of at most ``cap`` candidate rows.

    The cap is part of the operator's meaning: a larger block is left out as a whole, never cut.  None is the exact
    way: every block counts.
    """
    on = ["kind", "country_lc", "key"]
    kept = right if cap is None else right.join(block_sizes(right).where(F.col("n") <= cap).select(*on), on, "left_semi")
    pairs = left.withColumnRenamed("entity_id", "source1_entity_id").join(kept.withColumnRenamed("entity_id", "candidate_entity_id"), on)
    return pairs.select("source1_entity_id", "candidate_entity_id").distinct()


def collapse_ids(pairs: DataFrame, every: DataFrame, out: str = "matched_entity_ids") -> DataFrame:
    """One row for each id of ``every``: its candidates in order of their bytes, joined by commas, '' without any."""
    lists = pairs.groupBy("source1_entity_id").agg(F.array_join(F.array_sort(F.collect_set("candidate_entity_id")), ",").alias(out))
    return every.join(lists, "source1_entity_id", "left").withColumn(out, X.text(F.col(out)))


def in_order(lists: DataFrame, every: DataFrame, position: str) -> DataFrame:
    """The lists in the order of their records in the input, which ``position`` of ``every`` gives; the smallest counts.

    The sort is by ranges, over all tasks; written, the files follow each other in that order.
    """
    first = every.groupBy("source1_entity_id").agg(F.min(position).alias("__at"))
    return lists.join(first, "source1_entity_id", "left").orderBy(F.col("__at").asc_nulls_last(), "source1_entity_id").drop("__at")


def cap_pairs(pairs: DataFrame, cap: int | None) -> DataFrame:
    """The first ``cap`` pairs in order of their ids."""
    return pairs if cap is None else pairs.orderBy("source1_entity_id", "candidate_entity_id").limit(cap)
