"""Worker metrics from a log of page outcomes.

``outcomes``: worker, ts, outcome_id, failed, latency_ms (of successes),
frontier (links queued by the page).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import DEFAULTS, Params
from ..session import cut_lineage
from .quantiles import exact_quantile, match_on, running_quantile, running_totals

METRICS = ("processed_count", "failed_count", "frontier_enqueued")


def _done() -> Column:
    return ~F.col("failed")


def _exact(latency: Column) -> Column:
    """Decimal, so that sums do not depend on the order rows are added in."""
    return latency.cast("decimal(20,6)")


def _mean(total: Column, n: Column) -> Column:
    """Mean at the stored two decimals; 0 without any value."""
    return F.when(n > 0, total / n).otherwise(F.lit(0)).cast("decimal(10,2)")


def worker_metrics(outcomes: DataFrame, depth: Column | None = None) -> DataFrame:
    """Final numbers per worker; failures count but add no latency."""
    latency = F.when(_done(), F.col("latency_ms"))
    marked = outcomes.withColumn("latency_", latency)
    totals = marked.groupBy("worker").agg(
        F.count_if(_done()).alias("processed_count"),
        F.count_if(F.col("failed")).alias("failed_count"),
        F.sum(F.when(_done(), F.col("frontier")).otherwise(0)).alias("frontier_enqueued"),
        _mean(F.sum(_exact(F.col("latency_"))), F.count("latency_")).alias("avg_latency_ms"),
    )
    p95 = exact_quantile(marked, ["worker"], "latency_", name="p95_").select("worker", "p95_")
    out = match_on(totals, p95, ["worker"], "left").select(
        *totals.columns,
        F.coalesce("p95_", F.lit(0.0)).cast("decimal(10,2)").alias("p95_latency_ms"),
    )
    return out if depth is None else out.withColumn("queue_depth", depth)


def metric_snapshots(outcomes: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """The cumulative snapshots a worker writes while it runs, plus its final one.

    One snapshot after every outcome (also a failure) that leaves the processed
    count at a positive multiple of ``flush_every``; the last outcome of a worker
    gives the closing snapshot. p95 is exact at the stored two decimals: rounding
    keeps order, so the quantile of rounded values is the rounded quantile.
    """
    ordered = outcomes.withColumns(
        {
            "chunk_": F.date_trunc("minute", "ts"),
            "cents_": F.when(
                _done(), (F.col("latency_ms").cast("decimal(10,2)") * 100).cast("bigint")
            ),
        }
    )
    counted = running_totals(
        ordered,
        ["worker"],
        "chunk_",
        ["ts", "outcome_id"],
        {
            "processed_count": _done().cast("bigint"),
            "failed_count": F.col("failed").cast("bigint"),
            "frontier_enqueued": F.when(_done(), F.col("frontier")).otherwise(F.lit(0)),
            "timed_count": (_done() & F.col("latency_ms").isNotNull()).cast("bigint"),
            "latency_sum": F.coalesce(F.when(_done(), _exact(F.col("latency_ms"))), F.lit(0)),
        },
    )
    # Read four times below: snapshots, closing rows, latencies, their maximum.
    counted = cut_lineage(counted)
    last = outcomes.groupBy("worker").agg(
        F.max(F.struct("ts", "outcome_id")).alias("last_")
    )
    keep = [
        "worker",
        "outcome_id",
        "ts",
        *METRICS,
        "timed_count",
        _mean(F.col("latency_sum"), F.col("timed_count")).alias("avg_latency_ms"),
    ]
    flushed = counted.filter(
        (F.col("processed_count") > 0) & (F.col("processed_count") % params.flush_every == 0)
    ).select(*keep, F.lit(False).alias("final"))
    closing = (
        counted.join(
            last.select(
                "worker", F.col("last_.ts").alias("ts"), F.col("last_.outcome_id").alias("outcome_id")
            ),
            ["worker", "ts", "outcome_id"],
            "left_semi",
        ).select(*keep, F.lit(True).alias("final"))
    )
    snapshots = flushed.unionByName(closing)
    # Only successes with a latency are numbered: one without adds nothing to sort.
    successes = counted.filter(F.col("cents_").isNotNull()).select(
        "worker", F.col("timed_count").alias("seq"), F.col("cents_").alias("code")
    )
    top = successes.agg(F.max("code")).first()[0] or 0
    # Many failures in a row repeat the same count: ask once for each.
    asked = snapshots.filter("timed_count > 0").select("worker", F.col("timed_count").alias("m")).distinct()
    p95 = running_quantile(successes, asked, ["worker"], top).withColumnRenamed("m", "timed_count")
    return (
        match_on(snapshots, p95, ["worker", "timed_count"], "left")
        .withColumn(
            "p95_latency_ms",
            (F.coalesce("p95_code", F.lit(0)) / 100).cast("decimal(10,2)"),
        )
        .drop("p95_code", "timed_count")
    )


def latest_metrics(snapshots: DataFrame) -> DataFrame:
    """The newest snapshot of each worker (they are cumulative, never add them up)."""
    row = F.struct(*[c for c in snapshots.columns if c != "worker"])
    newest = F.struct("ts", "outcome_id", "final")
    return (
        snapshots.groupBy("worker").agg(F.max_by(row, newest).alias("s")).select("worker", "s.*")
    )
