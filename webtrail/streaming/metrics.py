"""Worker metrics over time windows of an outcome stream."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import StructType

from ..params import DEFAULTS, Params


def windowed_metrics(
    outcomes: DataFrame, window: str = "1 hour", late: str = "10 minutes"
) -> DataFrame:
    """Counts, mean and approximate p95 latency per worker and window.

    The watermark is ours: a stream has no end, and only a watermark lets Spark
    close a window and drop its state. The exact p95 is the batch operator's.
    """
    done = ~F.col("failed")
    latency = F.when(done, F.col("latency_ms"))
    marked = outcomes.withWatermark("ts", late) if outcomes.isStreaming else outcomes
    return (
        marked.groupBy(F.window("ts", window).alias("w"), "worker")
        .agg(
            F.count_if(done).alias("processed_count"),
            F.count_if(F.col("failed")).alias("failed_count"),
            F.sum(F.when(done, F.col("frontier")).otherwise(0)).alias("frontier_enqueued"),
            F.avg(latency).alias("avg_latency_ms"),
            F.percentile_approx(latency, 0.95).alias("p95_approx_ms"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            "worker",
            "processed_count",
            "failed_count",
            "frontier_enqueued",
            "avg_latency_ms",
            "p95_approx_ms",
        )
    )


def final_flush(outcomes: DataFrame, out: str, window: str = "1 hour") -> None:
    """Append the windows that a stopped stream had still open.

    ``outcomes`` are all rows the stream has read, as a table. Repeating this adds nothing.
    """
    spark = outcomes.sparkSession
    made = windowed_metrics(outcomes, window)
    there = spark.read.schema(made.schema).parquet(out).select("window_start", "worker")
    made.join(there, ["window_start", "worker"], "left_anti").write.mode("append").parquet(out)


def run_metrics(outcomes: DataFrame, out: str, checkpoint: str, **windowing: str) -> StreamingQuery:
    """Append every closed window to ``out``; stops after the data at hand."""
    return (
        windowed_metrics(outcomes, **windowing)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


# ---------------------------------------------------------------------------
# Snapshots by count, and a last one from the state
# ---------------------------------------------------------------------------

_SNAPSHOT = (
    "worker STRING, outcome_id BIGINT, ts TIMESTAMP, processed_count BIGINT, failed_count BIGINT, "
    "frontier_enqueued BIGINT, timed_count BIGINT, micros BIGINT, p95_cents BIGINT, final BOOLEAN"
)
_STATE = (
    "outcome_id BIGINT, ts TIMESTAMP, processed_count BIGINT, failed_count BIGINT, frontier_enqueued BIGINT, "
    "timed_count BIGINT, micros BIGINT, codes BINARY, counts BINARY"
)


class Latencies:
    """How often each latency (in hundredths) has come; quantiles by sums of blocks of them."""

    BLOCK = 256

    def __init__(self, codes: np.ndarray, counts: np.ndarray, new: np.ndarray):
        self.codes = np.union1d(codes, new)
        size = -(-max(len(self.codes), 1) // self.BLOCK)
        self.counts = np.zeros(size * self.BLOCK, np.int64)
        self.counts[np.searchsorted(self.codes, codes)] = counts
        self.blocks = self.counts.reshape(size, self.BLOCK).sum(1)

    def add(self, codes: np.ndarray) -> None:
        at = np.searchsorted(self.codes, codes)
        np.add.at(self.counts, at, 1)
        np.add.at(self.blocks, at // self.BLOCK, 1)

    def quantile(self, q: float, n: int) -> int:
        """``sorted(values)[int(q * (n - 1))]``, 0 without values."""
        if not n:
            return 0
        rank = int(q * (n - 1))
        upto = np.cumsum(self.blocks)
        block = int(np.searchsorted(upto, rank, side="right"))
        left = rank - (int(upto[block - 1]) if block else 0)
        inside = np.cumsum(self.counts[block * self.BLOCK : (block + 1) * self.BLOCK])
        return int(self.codes[block * self.BLOCK + int(np.searchsorted(inside, left, side="right"))])


def counted_snapshots(
    outcomes: DataFrame, params: Params = DEFAULTS, late: str = "10 minutes", idle_s: int = 3600
) -> DataFrame:
    """The snapshots of :func:`webtrail.operators.workers.metric_snapshots` from an outcome stream.

    State is kept for each worker: its counts, and how often each latency came, so that p95 is exact
    for the rows so far. A snapshot is written after every outcome that leaves the processed count
    at a positive multiple of ``flush_every``. When event time has passed a worker's last outcome by
    ``idle_s`` seconds, a timer writes its closing snapshot from that state: nothing is read again. To
    stop, send a :func:`stop_row`, which moves event time on for all workers.

    Rows of a worker are taken in order of (ts, outcome_id) within a micro-batch. They pass through one
    task, as any state by key does; the batch operator spreads a worker over many.
    """
    done = ~F.col("failed")
    latency = F.when(done, F.col("latency_ms"))
    rows = outcomes.withWatermark("ts", late).select(
        "worker", "ts", "outcome_id", "failed",
        F.when(done, F.col("frontier")).otherwise(0).cast("bigint").alias("frontier"),
        (latency.cast("decimal(10,2)") * 100).cast("bigint").alias("cents"),
        (latency.cast("decimal(20,6)") * 1_000_000).cast("bigint").alias("micros"),
    )
    every = params.flush_every

    def run(key, batches, state):
        held = state.getOption
        if state.hasTimedOut:
            seen = Latencies(np.frombuffer(held[7], np.int64), np.frombuffer(held[8], np.int64), np.zeros(0, np.int64))
            yield pd.DataFrame([[key[0], *held[:7], seen.quantile(0.95, held[5]), True]], columns=_names(_SNAPSHOT))
            return
        given = pd.concat(list(batches))
        given = given[given["outcome_id"].notna()].sort_values(["ts", "outcome_id"], kind="stable")
        if not len(given):
            return
        base = held[2:7] if held else (0,) * 5
        codes, counts = (np.frombuffer(held[k], np.int64) if held else np.zeros(0, np.int64) for k in (7, 8))
        failed = given["failed"].to_numpy(bool)
        timed = given["cents"].notna().to_numpy()
        added = (~failed, failed, given["frontier"], timed, given["micros"].fillna(0))
        sums = [int(b) + np.cumsum(np.asarray(a, np.int64)) for b, a in zip(base, added)]
        cents = given["cents"].fillna(0).to_numpy(np.int64)
        seen = Latencies(codes, counts, cents[timed])
        made, at = [], 0
        for k in np.flatnonzero((sums[0] > 0) & (sums[0] % every == 0)).tolist():
            seen.add(cents[at : k + 1][timed[at : k + 1]])
            at = k + 1
            row = given.iloc[k]
            numbers = [int(s[k]) for s in sums]
            made.append([key[0], int(row["outcome_id"]), row["ts"], *numbers, seen.quantile(0.95, numbers[3]), False])
        seen.add(cents[at:][timed[at:]])
        last = given.iloc[-1]
        kept = seen.counts[: len(seen.codes)]
        state.update(
            (
                int(last["outcome_id"]), last["ts"].to_pydatetime(), *(int(s[-1]) for s in sums),
                seen.codes.astype(np.int64).tobytes(), kept.tobytes(),
            )
        )
        newest = int(last["ts"].timestamp() * 1000)
        state.setTimeoutTimestamp(max(newest, state.getCurrentWatermarkMs()) + idle_s * 1000 + 1)
        if made:
            yield pd.DataFrame(made, columns=_names(_SNAPSHOT))

    made = rows.groupBy("worker").applyInPandasWithState(
        run, _SNAPSHOT, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    mean = F.when(F.col("timed_count") > 0, F.col("micros").cast("decimal(38,6)") / 1_000_000 / F.col("timed_count"))
    return made.select(
        "worker", "outcome_id", "ts", "processed_count", "failed_count", "frontier_enqueued",
        F.coalesce(mean, F.lit(0)).cast("decimal(10,2)").alias("avg_latency_ms"),
        (F.col("p95_cents") / 100).cast("decimal(10,2)").alias("p95_latency_ms"),
        "final",
    )


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def stop_row(spark: SparkSession, schema: StructType, at: Column) -> DataFrame:
    """The row that ends an outcome stream: no worker, and a time after all timers."""
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name != "ts"]
    return spark.range(1).select(at.alias("ts"), *empty).select(*schema.names)


def run_counted_metrics(
    outcomes: DataFrame, out: str, checkpoint: str, params: Params = DEFAULTS
) -> StreamingQuery:
    """Append every snapshot to ``out``; stops after the data at hand."""
    return (
        counted_snapshots(outcomes, params)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
