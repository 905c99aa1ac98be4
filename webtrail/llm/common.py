"""What several operators share: written steps, packed integers, connected components."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of a batch of rows on its way to Python, unless the session says otherwise. Results are
#: lazy, so this stays set: a task holds a batch several times, in the JVM and in Python.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
#: Takes the place of a null id: before every real one.
NO_ID = -(2**63)


def work_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a session without one (tests) gets a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, a job's shuffle files go when its result is written, not at some later collection."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def write(df: DataFrame, name: str, by: str | None = None) -> str:
    """The folder of ``df`` as a Parquet table in the shared folder, with a folder for each value of ``by``."""
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}-{uuid4().hex}"
    small_batches(spark)
    with shuffles_removed(spark):
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: read any number of times, made once.

    A lost executor costs nothing that is written. The table is left in place, since the
    result that the caller gets is lazy and may be read later.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write(df, name))


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a written folder that no result reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def text_pieces(batch: pa.RecordBatch, column: int, most: int) -> Iterator[tuple[pa.RecordBatch, int]]:
    """(rows, bytes) of pieces whose texts have at most ``most`` bytes, or of one longer text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(sizes):
        before = int(total[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + most, side="right")))
        yield batch.slice(at, end - at), int(total[end - 1]) - before
        at = end


def planes(values: np.ndarray) -> bytes:
    """Integers byte plane by byte plane, so that small ones compress to little."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(data: memoryview, kind, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    made = np.frombuffer(data, np.uint8, n * size).reshape(size, n).T
    return np.ascontiguousarray(made).view(kind).ravel()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: ``(node, component)``, the smallest node of each.

    Alternating large-star and small-star steps; each is one aggregate with a map-side
    combine and one join, and ends in a written table. A hub costs its own edges only: nothing
    gathers its neighbours. Rounds grow with the logarithm of the longest path. Nodes that
    have no edge are not in the result; loops and repeated edges do no harm.
    """
    now = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b")
        .distinct(),
        "edges",
    )
    seen = _mark(now)
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).filter("a <> b").distinct()
        large = written(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(
            small.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(),
            "small-star",
        )
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b"), F.col("b")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
