"""Summaries and comparison of fetch runs and of experiment tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantile, match_on

SUMMARY_COLUMNS = [
    "name", "fetched", "total", "avg_ms", "p95_ms", "pages_per_sec", "pages_per_min",
    "pages_per_day", "mb_per_sec", "total_bytes", "extracted_docs", "total_chars",
]
# Fixed value: an old value closer to zero than this gives a lift of 0.
TINY = 1e-9
MEGABYTE = 1024.0 * 1024.0


def union_runs(runs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), runs)


def run_totals(log: DataFrame, run: str = "run") -> DataFrame:
    """Per run: ok fetches, all URLs, mean and p95 latency, bytes.

    Latency covers every row that has one, failed fetches included.
    """
    totals = log.groupBy(run).agg(
        F.count_if(F.col("status") == "ok").alias("fetched"),
        F.count(F.lit(1)).alias("total_urls"),
        F.coalesce(F.avg("ms"), F.lit(0.0)).alias("avg_ms"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
    )
    p95 = exact_quantile(log, [run], "ms", name="p95_ms").select(run, "p95_ms")
    return match_on(totals, p95, [run], "left").withColumn("p95_ms", F.coalesce("p95_ms", F.lit(0.0)))


def extraction_stats(extracted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Documents, mean and total characters (``chars`` column), per group or overall."""
    return extracted.groupBy(*by).agg(
        F.count(F.lit(1)).alias("extracted_docs"),
        F.coalesce(F.avg("chars"), F.lit(0.0)).alias("avg_chars"),
        F.coalesce(F.sum("chars"), F.lit(0)).alias("total_chars"),
    )


def run_summary(log: DataFrame, extracted: DataFrame, run: str = "run") -> DataFrame:
    """Fetch totals of each run beside its extraction totals; both sides are
    aggregated before they meet."""
    texts = extraction_stats(extracted, [run]).drop("avg_chars")
    return match_on(run_totals(log, run), texts, [run], "left").na.fill(
        0, ["extracted_docs", "total_chars"]
    )


def throughput(urls: Column, wall_ms: Column) -> Column:
    """Pages per second over all URLs, also failed ones; 0 without wall time."""
    return F.when(wall_ms > 0, urls * F.lit(1000.0) / wall_ms).otherwise(F.lit(0.0))


def with_rates(summary: DataFrame) -> DataFrame:
    """Add per-minute, per-day and MB/s rates to rows with ``pages_per_sec``.

    MB/s takes the seconds as fetched / pages_per_sec, though the latter counts
    failed pages too; the two agree when nothing fails.
    """
    pps = F.col("pages_per_sec")
    seconds = F.when(pps != 0, F.col("fetched") / pps).otherwise(F.lit(0.0))
    return summary.withColumns(
        {
            "pages_per_min": pps * 60.0,
            "pages_per_day": pps * 86400.0,
            "mb_per_sec": (F.col("total_bytes") / F.greatest(seconds, F.lit(TINY))) / MEGABYTE,
        }
    )


def same_total(summary: DataFrame, column: str = "total_chars") -> DataFrame:
    """One row: did all runs produce the same total?"""
    return summary.agg(
        F.count(F.lit(1)).alias("runs"),
        (F.min(column) == F.max(column)).alias("equal_totals"),
    )


def trial_means(trials: DataFrame, metrics: Sequence[str], policy: str = "policy") -> DataFrame:
    """Mean of every metric over the trials of each policy."""
    return trials.groupBy(policy).agg(*[F.avg(m).alias(m) for m in metrics])


def lift(
    means: DataFrame,
    baseline: str,
    metrics: Sequence[str],
    lower_better: Sequence[str] = (),
    policy: str = "policy",
) -> DataFrame:
    """``policy, metric, value, baseline, lift_pct`` against the baseline policy.

    Positive is better also for metrics where less is better.
    """
    long = means.unpivot([policy], list(metrics), "metric", "value")
    base = long.filter(F.col(policy) == baseline).select("metric", F.col("value").alias("baseline"))
    better = F.when(
        F.col("metric").isin(*lower_better) if lower_better else F.lit(False),
        F.col("baseline") - F.col("value"),
    ).otherwise(F.col("value") - F.col("baseline"))
    return (
        long.filter(F.col(policy) != baseline)
        .join(base, "metric")
        .withColumn(
            "lift_pct",
            F.when(F.abs("baseline") < TINY, F.lit(0.0)).otherwise(
                better / F.col("baseline") * 100.0
            ),
        )
        .select(policy, "metric", "value", "baseline", "lift_pct")
    )
