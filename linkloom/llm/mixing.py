"""Mixes of sources in target shares of their size in tokens.

Every document gets a random key by hash; within a source documents stand in the order of their keys,
and a prefix of that order is a random sample.  Running token sums are taken in two steps, so that a
source of any size is spread over many tasks: sums of equal ranges of the keys, running sums over
those few range sums, running sums inside each range.  Each source is then cut at its budget: all its documents
the number of whole epochs that fit, and one time more those before the cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkloom.llm.tokens import default_path, encode_documents
from linkloom.runtime import Scratch

RANGE_ROWS = 50_000  #: documents of one range of keys, about
KEYS = 1 << 30


def running_sums(sized: DataFrame, seed: int = 0, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Adds ``running``, the tokens of a source up to and with each document in the order of its random key."""
    key = F.pmod(F.xxhash64(F.lit(seed), "source", "doc_id"), F.lit(KEYS))
    n = sized.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / F.lit(range_rows)).alias("ranges"))
    keyed = sized.withColumn("key", key).join(n, "source").withColumn("range", F.floor(F.col("key") * F.col("ranges") / F.lit(KEYS)))
    before = (
        keyed.groupBy("source", "range")
        .agg(F.sum("n_tokens").alias("tokens"))
        .withColumn("before", F.sum("tokens").over(W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)))
        .select("source", "range", F.coalesce("before", F.lit(0)).alias("before"))
    )
    inside = W.partitionBy("source", "range").orderBy("key", "doc_id").rowsBetween(W.unboundedPreceding, 0)
    return (
        keyed.withColumn("inside", F.sum("n_tokens").over(inside))
        .join(before, ["source", "range"])
        .select("source", "doc_id", "n_tokens", (F.col("before") + F.col("inside")).alias("running"))
    )


def mix_plan(targets: DataFrame, sizes: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """Budget of each (mix, source): ``target_share``, ``budget``, ``epochs`` (whole passes) and ``rest`` (tokens of the last, partial pass).

    A mix is as large as its scarcest source allows (``max_repeats`` times its tokens at its share), or
    ``total_tokens`` if that is less.  Shares are relative to the weights of the sources that have tokens; a
    source without any, or with a weight of 0, null or less, gets no budget.  Repeated rows of one
    (mix, source) add their weights under the largest ``max_repeats``; a null ``max_repeats`` is 1.
    """
    given = (
        targets.where("mix_name IS NOT NULL AND source IS NOT NULL")
        .groupBy("mix_name", "source")
        .agg(F.sum(F.greatest(F.coalesce("target_weight", F.lit(0.0)), F.lit(0.0))).alias("weight"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0))).alias("max_repeats"))
    )
    plan = given.join(sizes, "source", "left").withColumn("source_tokens", F.coalesce("source_tokens", F.lit(0)))
    usable = F.when((F.col("source_tokens") > 0) & (F.col("max_repeats") > 0), F.col("weight")).otherwise(0.0)
    mix = W.partitionBy("mix_name")
    plan = plan.withColumn("usable", usable).withColumn("all", F.sum("usable").over(mix))
    plan = plan.withColumn("target_share", F.when(F.col("all") > 0, F.col("usable") / F.col("all")).otherwise(0.0))
    most = F.min(F.when(F.col("target_share") > 0, F.col("source_tokens") * F.col("max_repeats") / F.col("target_share"))).over(mix)
    plan = plan.withColumn("total", F.coalesce(most if total_tokens is None else F.least(most, F.lit(float(total_tokens))), F.lit(0.0)))
    # A share below one by rounding must not cost the scarcest source its last document.
    plan = plan.withColumn("budget", F.least(F.round(F.col("total") * F.col("target_share")).cast("long"), F.col("source_tokens") * F.col("max_repeats")))
    size = F.greatest("source_tokens", F.lit(1))
    plan = plan.withColumn("epochs", F.floor(F.col("budget") / size))
    return plan.select("mix_name", "source", "weight", "max_repeats", "source_tokens", "target_share", "budget", "epochs", (F.col("budget") - F.col("epochs") * size).alias("rest"))


def mix_documents(
    documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 0, path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The documents of each mix, and the shares reached.

    First: ``mix_name, source, doc_id, n_tokens, repeats, target_share, reached_share``, one row per document of a mix; it
    appears ``repeats`` times, never more than its source's ``max_repeats``.  Second: ``mix_name, source, target_share,
    budget, tokens, reached_share, documents``, one row per named source, also without documents.

    A source falls short of its budget by less than its one document at the cut.  Documents of
    unnamed or null sources and with a null id are left out; those without tokens count as size 0 and
    go with their source.  Rows repeated under one (source, doc_id) are one document of its largest size.
    """
    scratch = Scratch(documents.sparkSession, "mix")
    named = targets.where("source IS NOT NULL").select("source").distinct()
    wanted = documents.where("doc_id IS NOT NULL AND source IS NOT NULL").join(named, "source", "left_semi")
    counted = encode_documents(wanted.select("doc_id", "text", "source"), path=path or default_path(), count_only=True, keep=["source"])
    sized = scratch.cut(counted.groupBy("source", "doc_id").agg(F.max("n_tokens").alias("n_tokens")))
    sizes = sized.groupBy("source").agg(F.sum("n_tokens").alias("source_tokens"))
    plan = scratch.cut(mix_plan(targets, sizes, total_tokens))
    taken = (
        running_sums(sized, seed)
        .join(plan.where("target_share > 0"), "source")
        .withColumn("repeats", F.least(F.col("max_repeats"), F.col("epochs") + F.when((F.col("rest") > 0) & (F.col("running") <= F.col("rest")), 1).otherwise(0)))
        .where("repeats > 0")
        .select("mix_name", "source", "doc_id", "n_tokens", F.col("repeats").cast("int").alias("repeats"))
    )
    taken = scratch.cut(taken)
    got = taken.groupBy("mix_name", "source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count(F.lit(1)).alias("documents"))
    shares = plan.join(got, ["mix_name", "source"], "left").withColumns({"tokens": F.coalesce("tokens", F.lit(0)), "documents": F.coalesce("documents", F.lit(0))})
    whole = F.sum("tokens").over(W.partitionBy("mix_name"))
    shares = shares.withColumn("reached_share", F.when(whole > 0, F.col("tokens") / whole).otherwise(0.0)).select(
        "mix_name", "source", "target_share", "budget", "tokens", "reached_share", "documents"
    )
    rows = taken.join(shares.select("mix_name", "source", "target_share", "reached_share"), ["mix_name", "source"])
    return rows.select("mix_name", "source", "doc_id", "n_tokens", "repeats", "target_share", "reached_share"), shares
