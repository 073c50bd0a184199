"""Queries of this subpackage, by name, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.addresses import address_pairs
from linkloom.llm.groups import clean_id, record_groups
from linkloom.llm.matching import CONFIDENCE, match_records
from linkloom.llm.mixing import mix_documents
from linkloom.llm.names import name_pairs
from linkloom.llm.sentences import sentences
from linkloom.llm.tokens import decode_documents, default_path, encode_documents
from linkloom.sources.tables import table


def business_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the three sources."""
    parts = [table(spark, sf_dir, f"source{i}").select("entity_id", "clean_name", "clean_addr", "postal") for i in (1, 2, 3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return address_pairs(business_records(spark, sf_dir))


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_records(business_records(spark, sf_dir), table(spark, sf_dir, "train_matches"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confident matches of the source-1 records that neither list table holds."""
    lists = [table(spark, sf_dir, t).select(clean_id(F.col("source1_entity_id")).alias("source1_entity_id")) for t in ("train_matches", "matching_results")]
    listed = lists[0].unionByName(lists[1]).distinct()
    found = _matches(spark, sf_dir).where(F.col("confidence") >= CONFIDENCE)
    return found.join(listed, "source1_entity_id", "left_anti").select("source1_entity_id", "candidate_entity_id")


def p2_confidences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All candidate pairs and their confidence."""
    return _matches(spark, sf_dir)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_pairs(business_records(spark, sf_dir))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_groups(table(spark, sf_dir, "matching_results"))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), path=default_path())


def p6_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts decoded from their ids."""
    return decode_documents(p6_ids(spark, sf_dir), path=default_path())


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p2_found, p2_confidences, p4_found, p5_found, p6_ids, p6_round_trip, p7_mix, p7_shares, p8_found)}


def oracle_sql() -> dict[str, str]:
    return {
        # Groups by a recursive walk; exact, for small inputs.  An id is what is left of a list between anything but letters, digits,
        # hyphens and signs; the engine splits lists instead.
        "p5_found": r"""
WITH RECURSIVE raw AS (
  SELECT trim(upper(coalesce(source1_entity_id, '')), ' ' || chr(9) || chr(10) || chr(13) || chr(160)) AS k, upper(coalesce(matched_entity_ids, '')) AS l FROM matching_results),
items AS (SELECT k, unnest(regexp_extract_all(l, '[^,;|\s\p{Z}]+')) AS b FROM raw UNION ALL SELECT k, '' FROM raw),
marked AS (SELECT CASE WHEN k SIMILAR TO 'S[123]-[0-9]{8}' THEN k ELSE '' END AS a, CASE WHEN b SIMILAR TO 'S[123]-[0-9]{8}' THEN b ELSE '' END AS b FROM items),
arcs AS (SELECT a, b FROM marked WHERE a <> '' AND b <> '' UNION SELECT b, a FROM marked WHERE a <> '' AND b <> ''),
ids AS (SELECT a AS id FROM marked WHERE a <> '' UNION SELECT b FROM marked WHERE b <> ''),
reach AS (SELECT id, id AS other FROM ids UNION SELECT r.id, arcs.b FROM reach r JOIN arcs ON r.other = arcs.a)
SELECT id AS entity_id, min(other) AS group_id FROM reach GROUP BY id""",
        "p6_round_trip": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    }
