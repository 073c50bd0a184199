"""Similarities of candidate pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import text as X
from linkloom.functions.similarity import KERNELS

#: The names and their order.
FEATURES = (
    "name_jaccard", "name_first_word", "name_fuzz", "name_token_sort", "name_token_set", "name_len_diff", "name_soundex",
    "name_metaphone", "addr_jaccard", "postal_match", "country_match", "digit_jaccard", "addr_fuzz", "addr_token_set",
    "name_jaro_winkler", "name_contains", "name_sorted_tokens_exact", "name_prefix_match", "name_char_jaccard",
    "addr_jaro_winkler", "name_token_overlap_ratio", "name_length_ratio", "addr_digit_exact", "num_token_diff",
)


def pair_attributes(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs with both records' texts (name1, addr1, postal1, country1, name2, ...); '' for an unknown id."""
    fields = {"name": "clean_name", "addr": "clean_addr", "postal": "postal", "country": "country"}
    out = pairs.select("source1_entity_id", "candidate_entity_id")
    for i, rows, key in ((1, left, "source1_entity_id"), (2, right, "candidate_entity_id")):
        side = rows.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{k}{i}") for k, c in fields.items()])
        out = out.join(side, key, "left")
    names = [f"{k}{i}" for i in (1, 2) for k in fields]
    return out.select("source1_entity_id", "candidate_entity_id", *[X.text(F.col(c)).alias(c) for c in names])


def _share(part: Column, whole: Column, empty: float = 0.0) -> Column:
    return F.when(whole > 0, part / F.greatest(whole, F.lit(1))).otherwise(F.lit(empty))


def _jaccard(a: Column, b: Column, empty: float = 0.0) -> Column:
    return _share(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)), empty)


def _flag(c: Column) -> Column:
    return c.cast("double")


def build_features(attributes: DataFrame) -> DataFrame:
    """The 24 similarities of each pair of ``pair_attributes``."""
    sets = {"t": lambda i: X.tokens(F.col(f"name{i}")), "s": lambda i: X.tokens(F.col(f"addr{i}")), "d": lambda i: F.array_distinct(X.numbers(F.col(f"addr{i}"))), "g": lambda i: F.array_distinct(X.grams(F.col(f"name{i}"), 2))}
    step = attributes.withColumns({f"{k}{i}": f(i) for k, f in sets.items() for i in (1, 2)})
    step = step.withColumns({f"u{i}": F.array_distinct(F.col(f"t{i}")) for i in (1, 2)})
    c = F.col
    t1, t2, u1, u2, d1, d2 = c("t1"), c("t2"), c("u1"), c("u2"), c("d1"), c("d2")
    len1, len2 = F.length("name1"), F.length("name2")
    longest = F.greatest(len1, len2)
    both = F.size(F.array_intersect(u1, u2))
    filled = (F.size(u1) > 0) & (F.size(u2) > 0)
    first1, first2 = X.text(F.get(t1, F.lit(0))), X.text(F.get(t2, F.lit(0)))
    shortest = F.least(len1, len2)
    lead = F.coalesce(
        F.array_min(
            F.filter(F.when(shortest > 0, F.sequence(F.lit(1), shortest)).otherwise(F.array().cast("array<int>")), lambda i: F.substr("name1", i, F.lit(1)) != F.substr("name2", i, F.lit(1)))
        )
        - 1,
        shortest,
    )
    tokens_max = F.greatest(F.size(t1), F.size(t2))
    out = {
        "name_jaccard": _jaccard(u1, u2),
        "name_first_word": _flag((first1 != "") & (first1 == first2)),
        "name_len_diff": _share(F.abs(len1 - len2), longest),
        "name_soundex": _flag((first1 != "") & (X.soundex_key(first1) == X.soundex_key(first2))),
        "addr_jaccard": _jaccard(F.array_distinct("s1"), F.array_distinct("s2")),
        "postal_match": F.when((c("postal1") == "") | (c("postal2") == ""), 0.5).otherwise(_flag(c("postal1") == c("postal2"))),
        "country_match": _flag(X.country_key(c("country1")) == X.country_key(c("country2"))),
        "digit_jaccard": _jaccard(d1, d2, 1.0),
        "name_contains": _flag(filled & (both == F.least(F.size(u1), F.size(u2)))),
        "name_sorted_tokens_exact": _flag(filled & (both == F.size(u1)) & (both == F.size(u2))),
        "name_prefix_match": _share(lead, longest),
        "name_char_jaccard": _jaccard(c("g1"), c("g2")),
        "name_token_overlap_ratio": _share(both, F.least(F.size(u1), F.size(u2))),
        "name_length_ratio": _share(shortest, longest),
        "addr_digit_exact": _flag((F.size(F.array_except(d1, d2)) == 0) & (F.size(F.array_except(d2, d1)) == 0)),
        "num_token_diff": _share(F.abs(F.size(t1) - F.size(t2)), tokens_max),
    } | {k: f(f"{what}1", f"{what}2") for k, (what, f) in KERNELS.items()}
    return step.select("source1_entity_id", "candidate_entity_id", *[out[f].alias(f) for f in FEATURES])


def backfill(features: DataFrame, names: tuple[str, ...] = FEATURES) -> DataFrame:
    """The features a model knows, in its order; missing ones are 0."""
    have = set(features.columns)
    return features.select("source1_entity_id", "candidate_entity_id", *[F.col(n) if n in have else F.lit(0.0).alias(n) for n in names])
