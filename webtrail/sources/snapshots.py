"""Stored tables: queue snapshots, pages, extractions and worker metrics.

Snapshots are Parquet folders. A queue snapshot is partitioned by status, so that
claims read only the pending part of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.queue import QUEUE_COLUMNS, QUEUE_SCHEMA

METRICS_SCHEMA = (
    "worker STRING, processed_count BIGINT, failed_count BIGINT, frontier_enqueued BIGINT, "
    "avg_latency_ms DECIMAL(10,2), p95_latency_ms DECIMAL(10,2), queue_depth BIGINT, "
    "recorded_at TIMESTAMP"
)


def write_queue(queue: DataFrame, path: str) -> None:
    queue.select(*QUEUE_COLUMNS).write.partitionBy("status").parquet(path, mode="overwrite")


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(StructType.fromDDL(QUEUE_SCHEMA)).parquet(path).select(*QUEUE_COLUMNS)
    )


def append_metrics(snapshot: DataFrame, path: str) -> None:
    """Append worker metrics rows (``recorded_at`` and ``queue_depth`` may be absent)."""
    for name, kind in (("queue_depth", "bigint"), ("recorded_at", "timestamp")):
        if name not in snapshot.columns:
            snapshot = snapshot.withColumn(name, F.lit(None).cast(kind))
    columns = StructType.fromDDL(METRICS_SCHEMA).fields
    snapshot.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns]
    ).write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(StructType.fromDDL(METRICS_SCHEMA)).parquet(path)


def jdbc_table(spark: SparkSession, url: str, table: str, key: str, upper: int, parts: int = 64) -> DataFrame:
    """A table kept in a relational database, read in key ranges by many tasks."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=key,
            lowerBound="0",
            upperBound=str(upper),
            numPartitions=str(parts),
        )
        .load()
    )
