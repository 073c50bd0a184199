"""Queries of hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators.eager import eager_join_aggregate, heavy_keys
from linkloom.sources.tables import table

KEY = ["country_lc", "first_word"]


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that hold at least one hundredth of all distinct ids."""
    return heavy_keys(table(spark, sf_dir, "block_keys"), KEY, "id", 0.01).select(*KEY)


def p3_key_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every key with both parts present, the records of each side and the pairs a block join would make of them."""
    keys = table(spark, sf_dir, "block_keys").where("country_lc <> '' AND first_word <> ''")
    one = keys.where("id LIKE 'S1-%'")
    other = keys.where("id NOT LIKE 'S1-%'").withColumn("name_length", F.length("sorted_2word"))
    out = eager_join_aggregate(one, other, KEY, left_distinct="id", right_distinct=None, right_sums=["name_length"])
    return out.select(*KEY, "left_n", "right_n", "pairs", F.col("right_sum_name_length").alias("length_of_pairs"))


def p3_country_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, rolled up to countries."""
    keys = table(spark, sf_dir, "block_keys").where("country_lc <> '' AND first_word <> ''")
    out = eager_join_aggregate(keys.where("id LIKE 'S1-%'"), keys.where("id NOT LIKE 'S1-%'"), KEY, by=["country_lc"])
    return out.select("country_lc", "left_n", "right_n", "pairs")


QUERIES = {f.__name__: f for f in (p3_found, p3_key_pairs, p3_country_pairs)}

SQL = {
    "p3_found": """
SELECT country_lc, first_word FROM block_keys
WHERE country_lc <> '' AND first_word <> '' AND id IS NOT NULL
GROUP BY 1, 2 HAVING count(DISTINCT id) >= 0.01 * (SELECT count(DISTINCT id) FROM block_keys)""",
    "p3_key_pairs": """
WITH k AS (SELECT * FROM block_keys WHERE country_lc <> '' AND first_word <> ''),
l AS (SELECT DISTINCT country_lc, first_word, id FROM k WHERE id LIKE 'S1-%'),
r AS (SELECT country_lc, first_word, id, length(sorted_2word) AS n FROM k WHERE id NOT LIKE 'S1-%')
SELECT country_lc, first_word, (SELECT count(*) FROM l l2 WHERE l2.country_lc = l.country_lc AND l2.first_word = l.first_word) AS left_n,
       (SELECT count(*) FROM r r2 WHERE r2.country_lc = l.country_lc AND r2.first_word = l.first_word) AS right_n,
       count(*) AS pairs, CAST(coalesce(sum(n), 0) AS BIGINT) AS length_of_pairs
FROM l JOIN r USING (country_lc, first_word) GROUP BY country_lc, first_word""",
    "p3_country_pairs": """
WITH k AS (SELECT * FROM block_keys WHERE country_lc <> '' AND first_word <> ''),
l AS (SELECT country_lc, first_word, count(*) AS a FROM k WHERE id LIKE 'S1-%' GROUP BY 1, 2),
r AS (SELECT country_lc, first_word, count(*) AS b FROM k WHERE id NOT LIKE 'S1-%' GROUP BY 1, 2)
SELECT country_lc, CAST(sum(a) AS BIGINT) AS left_n, CAST(sum(b) AS BIGINT) AS right_n, CAST(sum(a * b) AS BIGINT) AS pairs
FROM l JOIN r USING (country_lc, first_word) GROUP BY country_lc""",
}
