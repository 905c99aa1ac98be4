"""Time the headline queries: prints one JSON line.

    BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from webtrail.operators.links import expand, worth_queueing  # noqa: E402
from webtrail.plans.catalog import QUERIES  # noqa: E402
from webtrail.plans.pages import analyze_links  # noqa: E402
from webtrail.session import local_session  # noqa: E402

HEADLINE = [
    "canonical_dedup", "page_text", "main_text", "document_words", "page_payload", "geo_signals",
    "top_pages", "raw_links", "resolved_links", "link_scores", "frontier_topn", "dom_summary",
    "model_payloads", "claim_batch", "seed_enqueue", "mark_failed", "upsert_discovered",
    "delete_cascade", "queue_violations", "corpus_view", "process_discoveries", "replay_rounds",
    "p95_by_run", "run_summary", "worker_metrics", "metrics_flush", "lift", "stream_pages",
]

#: Page analysis with ranked links is also timed over the pages so many times, where planning
#: and job start no longer count.
COPIES = 20


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "webtrail-bench")
    spark.sparkContext.setLogLevel("OFF")
    QUERIES["page_payload"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    given = spark.read.parquet(f"{sf_dir}/pages.parquet")
    pages = given.count()
    many = given.selectExpr("*", f"explode(sequence(1, {COPIES})) AS copy").drop("copy")
    folder = tempfile.mkdtemp(prefix="bench-")
    many.repartition(int(cpus) * 4).write.parquet(f"{folder}/pages")
    many = spark.read.parquet(f"{folder}/pages")
    start = time.perf_counter()
    ranked = worth_queueing(expand(analyze_links(many), ["page_id"]))
    ranked.write.format("noop").mode("overwrite").save()
    warm = time.perf_counter() - start
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name,
                "cpus": int(cpus),
                "pages_per_sec": round(pages / times["frontier_topn"], 1),
                "pages_per_sec_repeated": round(COPIES * pages / warm, 1),
            }
        )
    )


if __name__ == "__main__":
    main()
