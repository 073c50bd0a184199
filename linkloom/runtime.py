"""Session defaults and durable intermediate results.

Iterative operators cut their lineage by writing a Parquet table into the shared folder the
cluster names in ``spark.checkpoint.dir``; every executor can read it, so a lost executor costs a
re-read and nothing else.  A folder of our own is made only where that setting is absent, which is
the case in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Bytes of a written table from which its shuffle files are removed at once.
CLEAN_BYTES = 1_000_000
#: Rows that are packed together.
PACKED_ROWS = 400_000
#: Rows of an ordered batch.
ORDERED_ROWS = 50_000


def local_session(cpus: str = "8", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches on one machine."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("linkloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder for durable intermediate tables: the cluster's own, else one made for this application."""
    given = spark.conf.get(CHECKPOINT_KEY, None)
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    own = os.path.join(tempfile.gettempdir(), f"linkloom-{spark.sparkContext.applicationId}")
    os.makedirs(own, exist_ok=True)
    return own


class Scratch:
    """Tables of one operator run in the shared folder.

    ``cut`` writes a frame and reads it back, so later steps start from files instead of from the
    whole history; ``drop`` removes a table no later step needs.  The shuffle files behind a written table
    are of no more use; Spark removes them when the driver collects garbage, which ``cut`` asks for after larger tables.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.count = 0

    def cut(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.base}/{self.count}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength() >= CLEAN_BYTES:
            jvm.System.gc()
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *frames: DataFrame | None) -> None:
        jvm = self.spark.sparkContext._jvm
        for df in frames:
            path = getattr(df, "scratch_path", None)
            if path:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
                df.scratch_path = None


def regroup(
    df: DataFrame, by: str, spread: Callable[[pa.Table], pa.Table] | None = None, schema: StructType | None = None,
    then: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None, out: str | None = None,
) -> DataFrame:
    """The rows of ``df``, those of equal ``by`` (a long) in one task, as ``repartition(by)`` gives them.

    Rows go through the shuffle as compressed columns, some hundred thousand of a task at a time, which takes a fraction
    of the disk that single rows take.  ``spread`` makes the rows (of ``schema``) from those of ``df`` before.  ``then`` takes
    a task's batches as they are unpacked and gives rows of the schema ``out``, so that unpacked rows never become rows of the JVM.
    """
    schema = schema or df.schema
    arrow = to_arrow_schema(schema)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def packed(tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        rows = pa.concat_tables(tables)
        rows = (spread(rows) if spread else rows).select(arrow.names).cast(arrow)
        if not rows.num_rows:
            return
        keys = rows.column(by).to_numpy()
        part = keys % n
        order = np.lexsort((keys, part))
        rows = rows.take(pa.array(order)).combine_chunks()
        parts, starts = np.unique(part[order], return_index=True)
        sizes, blobs = [], []
        for at, end in zip(starts, np.append(starts[1:], len(order))):
            # Taken, since a slice would be written with all its column's text.
            raw = rows.take(pa.array(np.arange(at, end))).combine_chunks().to_batches()[0].serialize()
            sizes.append(raw.size)
            blobs.append(pa.compress(raw, codec="zstd", asbytes=True))
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())], ["part", "size", "rows"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size >= PACKED_ROWS:
                yield from packed(held)
                held, size = [], 0
        if held:
            yield from packed(held)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, blob in zip(batch.column(1).to_pylist(), batch.column(2)):
                yield pa.ipc.read_record_batch(pa.decompress(blob.as_buffer(), decompressed_size=size, codec="zstd"), arrow)

    blobs = df.mapInArrow(pack, "part int, size long, rows binary")
    met = blobs.repartitionById(n, "part")
    return met.mapInArrow(lambda batches: then(unpack(batches)), out) if then else met.mapInArrow(unpack, schema)


def in_order(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in the order of ``by``, some thousand at a time."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    held.clear()
    order = np.argsort(table.column(by).to_numpy(), kind="stable")
    for at in range(0, len(order), ORDERED_ROWS):
        yield from table.take(pa.array(order[at : at + ORDERED_ROWS])).combine_chunks().to_batches()


def meetings(keys: np.ndarray, first: np.ndarray, second: np.ndarray, most: int = 1_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of rows of equal keys, one of ``first`` and one of ``second`` (masks) each, some ``most`` pairs at a time."""
    a, b = np.flatnonzero(first), np.flatnonzero(second)
    b = b[np.argsort(keys[b], kind="stable")]
    low, high = np.searchsorted(keys[b], keys[a]), np.searchsorted(keys[b], keys[a], side="right")
    a, low, many = a[high > low], low[high > low], (high - low)[high > low]
    ends = np.cumsum(many)
    cuts = np.flatnonzero(np.diff(ends // most, prepend=-1)) if len(ends) else []
    for lo, hi in zip(cuts, [*cuts[1:], len(a)]):
        n = many[lo:hi]
        yield np.repeat(a[lo:hi], n), b[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[lo:hi], n)]


def distinct_rows(*columns: np.ndarray) -> list[np.ndarray]:
    """The rows without those that are equal to another."""
    order = np.lexsort(columns)
    columns = [c[order] for c in columns]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return [c[new] for c in columns]
