"""Aggregates over a join without the join's rows (eager aggregation).

``SELECT key, count(*), sum(l.x), sum(r.y) FROM l JOIN r USING (key) GROUP BY ...`` makes
n_left(key) * n_right(key) rows for a key; one hot key then holds nearly all of them.  Here both
inputs are first reduced to one compact state per join key (a partial aggregation on the map side,
so a hot key costs each task one row), the states are joined, and the join's aggregates follow
algebraically: counts multiply, and a sum of one side is multiplied by the count of the other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_state(df: DataFrame, on: Sequence[str], sums: Sequence[str] = (), distinct: str | None = None, prefix: str = "") -> DataFrame:
    """One row per join key: ``{prefix}n``, and for each column x of ``sums`` ``{prefix}sum_x`` and
    ``{prefix}n_x`` (its non-null values).

    distinct: count each non-null value of this column once per key; the deduplication is hashed
        by key and value together, so that a hot key is spread over all tasks.
    Null key parts never join and are dropped, as in SQL; empty strings are values like others.
    """
    rows = df.where(reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in on]))
    if distinct is not None:
        rows = rows.where(F.col(f"`{distinct}`").isNotNull()).dropDuplicates([*on, distinct])
    aggs = [F.count(F.lit(1)).alias(f"{prefix}n")]
    for c in sums:
        aggs += [F.sum(f"`{c}`").alias(f"{prefix}sum_{c}"), F.count(f"`{c}`").alias(f"{prefix}n_{c}")]
    return rows.groupBy(*on).agg(*aggs)


def eager_join_aggregate(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    by: Sequence[str] | None = None,
    left_by: Sequence[str] = (),
    left_sums: Sequence[str] = (),
    right_sums: Sequence[str] = (),
    left_distinct: str | None = None,
    right_distinct: str | None = None,
    how: str = "inner",
) -> DataFrame:
    """Aggregates of ``left JOIN right ON on``, grouped ``by`` columns of the join key (all of it by
    default) and ``left_by``, further columns of the left input.

    Columns: the grouping columns, ``left_n``/``right_n`` (rows of each input), ``pairs`` (rows of the
    join), and for each summed column ``left_sum_x``/``right_sum_x``, its sum over the rows of the join
    (0 where all its values are null).
    left_distinct, right_distinct: count each value of this column once per key (see ``key_state``).
    how: ``inner``, ``left`` or ``full``; a key without partner that is kept has 0 pairs.
    Empty inputs give no rows.  Other columns of the inputs are not read, so clashing names do no harm.
    """
    if how not in ("inner", "left", "full"):
        raise ValueError("how is inner, left or full")
    a = key_state(left, [*on, *left_by], left_sums, left_distinct, "left_")
    b = key_state(right, on, right_sums, right_distinct, "right_")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    joined = a.join(b, list(on), how)
    out = {"left_n": zero("left_n"), "right_n": zero("right_n"), "pairs": zero("left_n") * zero("right_n")}
    for c in left_sums:
        out[f"left_sum_{c}"] = zero(f"left_sum_{c}") * zero("right_n")
    for c in right_sums:
        out[f"right_sum_{c}"] = zero(f"right_sum_{c}") * zero("left_n")
    states = joined.select(*on, *left_by, *[v.alias(k) for k, v in out.items()])
    groups = [*(on if by is None else by), *left_by]
    if len(groups) == len(on) + len(left_by):
        return states
    return states.groupBy(*groups).agg(*[F.sum(k).alias(k) for k in out])


def heavy_keys(df: DataFrame, on: Sequence[str], count_once: str, share: float) -> DataFrame:
    """Keys that hold at least ``share`` of all distinct non-null values of ``count_once``.

    Adds ``n`` (distinct values of the key) and ``total`` (distinct values of the table, also of rows whose
    key is null or empty).  Keys with a null or empty part are left out; they are compared as they stand.

    Two inputs are reduced by key and their states joined: the values of each full key, and every value once under
    one of its keys, whichever (a null part as '').  The second input's counts, rolled up over all keys, are the total; no
    state is ever larger than one row a key, however the values are spread.
    """
    full = reduce(lambda a, b: a & b, [F.col(f"`{c}`") != "" for c in on])
    left = df.where(full).select(*on, count_once)
    at = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in on]
    once = df.where(F.col(f"`{count_once}`").isNotNull()).select(*at, count_once).dropDuplicates([count_once])
    states = eager_join_aggregate(left, once, on, left_distinct=count_once, how="full")
    total = F.coalesce(states.agg(F.sum("right_n")).scalar(), F.lit(0))
    kept = states.where((F.col("left_n") > 0) & (F.col("left_n") >= F.lit(share) * total))
    return kept.select(*on, F.col("left_n").alias("n"), total.alias("total"))
