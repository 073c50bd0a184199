"""Business records and id lists: tab-separated files in and out, and the same tables as Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions import text as X
from linkloom.sources.tables import table

RECORD = ("entity_id", "business_name", "business_address", "country")
MATCHES = ("source1_entity_id", "matched_entity_ids")
CANDIDATES = ("source1_entity_id", "candidate_entity_ids")


def read_tsv(spark: SparkSession, path: str | list[str], columns: Sequence[str], multi_line: bool = True) -> DataFrame:
    """A tab-separated file with a header; all columns are strings and an empty field is ''.

    Quoted fields may hold tabs, line breaks and doubled quotes.  Files whose fields hold no line breaks are read in
    parts, by many tasks, without ``multi_line``; with it each file is one task.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = spark.read.schema(schema).options(sep="\t", header=True, quote='"', escape='"', multiLine=multi_line, encoding="UTF-8").csv(path)
    return df.select(*[X.text(F.col(c)).alias(c) for c in columns])


def load_train(spark: SparkSession, base: str, multi_line: bool = True) -> tuple[DataFrame, ...]:
    """Three sources and the truth under ``base``/train_*.tsv."""
    return (*[read_tsv(spark, f"{base}/train_source{i}.tsv", RECORD, multi_line) for i in (1, 2, 3)], read_tsv(spark, f"{base}/train_ground_truth.tsv", MATCHES, multi_line))


def load_test(spark: SparkSession, base: str, multi_line: bool = True) -> tuple[DataFrame, ...]:
    return tuple(read_tsv(spark, f"{base}/test_source{i}.tsv", RECORD, multi_line) for i in (1, 2, 3))


def write_tsv(df: DataFrame, path: str, files: int | None = 1) -> None:
    """Tab-separated files with a header in the folder ``path``; empty lists are empty fields, not quoted ones.

    The rows are dealt to ``files`` tasks, after all other work; with None every task writes its own file, and files follow
    each other in the order of ``df`` if that is sorted.
    """
    out = df if files is None else df.repartition(files)
    out.write.mode("overwrite").options(sep="\t", header=True, emptyValue="", nullValue="", quote="").csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line_no`` (from 1), ``value`` of a text file, in the file's order.

    Lines are numbered inside each part of the file; the parts' sizes, one number each, give what comes before.
    """
    part = F.spark_partition_id()
    numbered = spark.read.text(path).select("value", part.alias("__part"), (F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33) + 1).alias("__n"))
    sizes = sorted((r["__part"], r["n"]) for r in numbered.groupBy("__part").agg(F.max("__n").alias("n")).collect())
    before, rows = 0, []
    for p, n in sizes:
        rows.append((p, before))
        before += n
    starts = spark.createDataFrame(rows, "__part int, __before long")
    return numbered.join(F.broadcast(starts), "__part").select((F.col("__before") + F.col("__n")).alias("line_no"), "value")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system the session knows."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_ids(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Distinct first columns of a tab-separated file, without its header and blank lines."""
    raw = spark.read.options(header=True, sep="\x01", quote="", inferSchema=False).csv(path)
    return ids_of(raw.select(F.col(raw.columns[0]).alias("value")))


def ids_of(lines: DataFrame) -> DataFrame:
    first = F.trim(F.substring_index(F.col("value"), "\t", 1))
    return lines.where(F.trim("value") != "").select(first.alias("entity_id")).distinct()


def records(spark: SparkSession, sf_dir: str, numbers: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Rows of the sources as delivered, nulls as ''; ``source`` is the id's prefix."""
    parts = [table(spark, sf_dir, f"source{i}").select(*RECORD, "seen_at", "loaded_at") for i in numbers]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.select(*[X.text(F.col(c)).alias(c) for c in RECORD], "seen_at", "loaded_at", F.substring("entity_id", 1, 2).alias("source"))


def first_rows(rows: DataFrame) -> DataFrame:
    """One row an id: the first that arrived; ties go by the time seen, then by the texts."""
    order = [F.col(c).asc_nulls_first() for c in ("loaded_at", "seen_at", "business_name", "business_address", "country")]
    n = F.row_number().over(W.partitionBy("entity_id").orderBy(*order))
    return rows.withColumn("__n", n).where("__n = 1").drop("__n")


def normalize(rows: DataFrame) -> DataFrame:
    """Adds ``clean_name``, ``clean_addr`` and ``postal``."""
    folded = rows.withColumns({"__name": X.ascii_fold(F.col("business_name")), "__addr": X.ascii_fold(F.col("business_address"))})
    out = folded.withColumns(
        {"clean_name": X.clean_name(F.col("__name")), "clean_addr": X.clean_addr(F.col("__addr")), "postal": X.extract_postal(F.col("business_address"))}
    )
    return out.drop("__name", "__addr")
