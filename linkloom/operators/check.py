"""Checks of match lists before they are handed over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions import text as X
from linkloom.operators.decide import parse_ids
from linkloom.runtime import Scratch
from linkloom.sources.records import exists, read_ids, read_lines


def raw_parts(c: Column) -> Column:
    """Parts of a list as they stand, untrimmed; an empty list has none."""
    return F.when(F.coalesce(c, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(c, ","))


def duplicate_rows(lists: DataFrame) -> DataFrame:
    return lists.groupBy("source1_entity_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def repeated_ids(lists: DataFrame, column: str = "matched_entity_ids") -> DataFrame:
    """Rows whose list holds an id more than once."""
    parts = raw_parts(F.col(column))
    return lists.where(F.size(parts) > F.size(F.array_distinct(parts)))


def wrong_prefixes(lists: DataFrame, column: str = "matched_entity_ids") -> DataFrame:
    """``source1_entity_id, s1_ids, other_ids``: parts that are source-1 ids, and parts of any other wrong form (empty and untrimmed ones too)."""
    parts = raw_parts(F.col(column))
    own = F.size(F.filter(parts, lambda x: x.startswith("S1-")))
    other = F.size(F.filter(parts, lambda x: ~(x.startswith("S1-") | x.startswith("S2-") | x.startswith("S3-"))))
    return lists.select("source1_entity_id", own.alias("s1_ids"), other.alias("other_ids")).where("s1_ids > 0 OR other_ids > 0")


def missing_ids(required: DataFrame, lists: DataFrame) -> DataFrame:
    return required.select("source1_entity_id").distinct().join(lists.select("source1_entity_id"), "source1_entity_id", "left_anti")


def extra_ids(required: DataFrame, lists: DataFrame) -> DataFrame:
    return lists.select("source1_entity_id").distinct().join(required.select("source1_entity_id"), "source1_entity_id", "left_anti")


def unknown_ids(lists: DataFrame, known: DataFrame, column: str = "matched_entity_ids", trimmed: bool = True) -> DataFrame:
    """Distinct (record, listed id) whose id no source holds; not trimmed, only ids that begin like one of the sources are asked."""
    ids = parse_ids(F.col(column)) if trimmed else F.filter(raw_parts(F.col(column)), lambda x: x.startswith("S2-") | x.startswith("S3-"))
    listed = lists.select("source1_entity_id", F.explode(ids).alias("entity_id")).distinct()
    return listed.join(known.select("entity_id"), "entity_id", "left_anti").select("source1_entity_id", "entity_id")


def outside_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Records with a match that is none of their candidates."""
    m = matches.select("source1_entity_id", F.explode(parse_ids(F.col("matched_entity_ids"))).alias("id"))
    c = candidates.select("source1_entity_id", F.explode(parse_ids(F.col("candidate_entity_ids"))).alias("id"))
    return m.join(c, ["source1_entity_id", "id"], "left_anti").select("source1_entity_id").distinct()


def examples(ids: DataFrame, column: str, n: int = 5) -> DataFrame:
    """``n_ids`` and the first few of them in order, without gathering the rest."""
    few = ids.select(column).distinct()
    first = few.orderBy(column).limit(n).agg(F.array_join(F.array_sort(F.collect_list(column)), ", ").alias("examples"))
    return few.agg(F.count(F.lit(1)).alias("n_ids")).crossJoin(first)


def validate_file(
    spark: SparkSession, path: str, header: tuple[str, str], required: DataFrame, known: DataFrame | None = None, counts: dict[str, int] | None = None
) -> tuple[list[str], DataFrame | None]:
    """Errors of a tab-separated list file, each with a number and a few examples, and its rows.

    A missing or unreadable file, one that is empty or no UTF-8, and a wrong header, end the check at once.  Ids and
    lists are taken as they stand, so white space around an id is an error.  counts receives ``rows`` and ``empty`` (lists).
    """
    if not exists(spark, path):
        return [f"{path}: no such file"], None
    scratch = Scratch(spark, "lists")
    try:
        lines = scratch.cut(read_lines(spark, path))
    except Exception as e:  # noqa: BLE001 - whatever the file system says
        return [f"{path}: cannot be read: {str(e).splitlines()[0]}"], None
    broken = lines.where(~F.is_valid_utf8("value")).agg(F.min("line_no")).first()[0]
    if broken is not None:
        return [f"{path}: line {broken} is no UTF-8"], None
    first = lines.where("line_no = 1").first()
    if first is None:
        return [f"{path}: empty"], None
    head = first.value.removeprefix("\ufeff")
    if "\t" not in head and "," in head:
        return ["the header is separated by commas, not tabs"], None
    if tuple(x.strip().lower() for x in head.split("\t")) != header:
        return [f"the header is {head!r}, not {header!r}"], None
    body = lines.where("line_no > 1").where(F.trim("value") != "")
    errors = []
    bare = body.where(~F.contains("value", F.lit("\t"))).orderBy("line_no")
    errors += [f"line {r.line_no}: no tab" for r in bare.limit(5).collect()]
    rest = F.substr("value", F.instr("value", "\t") + 1)
    rows = body.where(F.contains("value", F.lit("\t"))).select(
        "line_no", F.substring_index("value", "\t", 1).alias("source1_entity_id"), F.when(X.strip(rest) == "", F.lit("")).otherwise(rest).alias(header[1])
    )
    rows = scratch.cut(rows)
    if counts is not None:
        counts.update(rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(header[1]) == "").alias("empty")).first().asDict())

    def report(what: str, found: DataFrame, column: str = "source1_entity_id") -> None:
        r = examples(found, column).first()
        if r.n_ids:
            errors.append(f"{what}: {r.n_ids}, such as {r.examples}")

    report("records with more than one row", duplicate_rows(rows))
    report("lists with a repeated id", repeated_ids(rows, header[1]))
    bad = wrong_prefixes(rows, header[1])
    report("lists with source-1 ids", bad.where("s1_ids > 0"))
    report("lists with ids of another form", bad.where("other_ids > 0"))
    report("records without a row", missing_ids(required, rows))
    report("rows of unknown records", extra_ids(required, rows))
    if known is not None:
        report("unknown ids", unknown_ids(rows, known, header[1], trimmed=False), "entity_id")
    # A later row of a record replaces an earlier one.
    last = rows.groupBy("source1_entity_id").agg(F.max_by(header[1], "line_no").alias(header[1]))
    return errors, last


def validate(spark: SparkSession, matching: str, candidate: str | None, required: DataFrame, known: DataFrame | None = None) -> tuple[list[str], list[str]]:
    """Errors and warnings of a result and its candidate lists."""
    errors, matches = validate_file(spark, matching, ("source1_entity_id", "matched_entity_ids"), required, known)
    warnings: list[str] = []
    if candidate is None or not exists(spark, candidate):
        return errors, ["no candidate file: matches are not compared with candidates"]
    more, candidates = validate_file(spark, candidate, ("source1_entity_id", "candidate_entity_ids"), required, known)
    if matches is not None and candidates is not None:
        r = examples(outside_candidates(matches, candidates), "source1_entity_id").first()
        if r.n_ids:
            warnings.append(f"records with matches outside their candidates: {r.n_ids}, such as {r.examples}")
    return errors + more, warnings


def validate_folder(spark: SparkSession, matching: str, candidate: str | None, test_dir: str, check_ids: bool = False) -> tuple[list[str], list[str]]:
    """``validate`` against the records of ``test_dir``/test_source*.tsv; sources 2 and 3 are read only to check ids."""
    source = lambda i: f"{test_dir}/test_source{i}.tsv"
    if not exists(spark, source(1)):
        return [f"{source(1)}: no such file"], []
    required = read_ids(spark, source(1)).withColumnRenamed("entity_id", "source1_entity_id")
    absent = [source(i) for i in (2, 3) if not exists(spark, source(i))] if check_ids else []
    known = read_ids(spark, source(2)).unionByName(read_ids(spark, source(3))) if check_ids and not absent else None
    errors, warnings = validate(spark, matching, candidate, required, known)
    return errors, [f"{p} is absent: ids are not checked" for p in absent] + warnings
