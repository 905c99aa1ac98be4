import os
import random
import re
import tempfile
import time

import plain
from pyspark.sql import functions as F

from webtrail.operators import queue as Q
from webtrail.operators import workers as W
from webtrail.plans import fixtures as X
from webtrail.plans.process import replay
from webtrail.session import cut_lineage
from webtrail.sources.queue_store import QueueStore
from webtrail.streaming import ingest as SI
from webtrail.streaming import metrics as SM
from test_queue import at, by_id, make_queue, upsert_one


def crawl_one_at_a_time(seeds, pages, rounds, batch, threshold=0.28, max_depth=2):
    """A single worker: claim, process each page, upsert its links, mark it."""
    corpus = {}
    for page_id, url, html in sorted(pages):
        corpus.setdefault(plain.canonical(url), html)
    rows, next_id = {}, 0
    for url in seeds:
        rows[url] = dict(id=next_id, url=url, status="pending", priority=0, geo_score=0.0, source="seed",
                         depth=0, parent_url_id=None, retries=0)
        next_id += 1
    for _ in range(rounds):
        open_ = [r for r in rows.values() if r["status"] == "pending" and r["retries"] < 3]
        open_.sort(key=lambda r: (-(r["priority"] + round(float32(r["geo_score"]) * 100)), r["retries"], r["id"]))
        claimed = [(r, r["depth"]) for r in open_[:batch]]
        for r, _d in claimed:
            r["status"] = "in_progress"
        for r, depth in claimed:
            html = corpus.get(r["url"])
            if html is None:
                r["retries"] += 1
                r["status"] = "failed" if r["retries"] >= 3 else "pending"
                continue
            p = plain.payload(html, r["url"])
            for href, blend, prio, reason in plain.frontier(
                r["url"], p, html, plain.page_score(r["url"], p), depth, max_depth
            ):
                if blend >= threshold:
                    upsert_one(rows, dict(url=href, priority=prio, geo_score=float32(blend),
                                          source=f"frontier:{reason}", depth=depth + 1, parent_url_id=r["id"]), next_id)
                    next_id += 1
            r["status"] = "done"
    return rows


def float32(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


def test_replay_equals_one_worker(spark, sf_dir):
    small = sf_dir.replace("sf0.01", "sf0.001")
    pages = X.derive(spark, small, X.LINKED_PAGES).cache()
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    seeds = list(dict.fromkeys(plain.canonical(u) for i, u, _ in sorted(rows) if i % 5 == 0))
    want = crawl_one_at_a_time(seeds, rows, rounds=5, batch=15)
    start = make_queue(spark, [dict(id=i, url=u) for i, u in enumerate(seeds)])
    got = {r.url: r for r in replay(start, pages, at(), 5, 15, first_id=1 << 40).collect()}
    assert set(got) == set(want)
    by_id = {r.id: r.url for r in got.values()}
    for url, w in want.items():
        g = got[url]
        assert (g.status, g.priority, g.depth, g.source, g.retries) == (
            w["status"], w["priority"], w["depth"], w["source"], w["retries"]), url
        assert abs(g.geo_score - w["geo_score"]) < 1e-6
        parent = {r["id"]: r["url"] for r in want.values()}.get(w["parent_url_id"])
        assert by_id.get(g.parent_url_id) == parent
    assert {"done", "pending"} <= {g.status for g in got.values()}


def test_repeated_batch_changes_nothing(spark, sf_dir):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    small = sf_dir.replace("sf0.01", "sf0.001")
    queue = make_queue(spark, [dict(id=1, url="https://a.example.org/1", status="done")])
    queue.write.parquet(SI.snapshot_path(folder, 0))
    pages = X.derive(spark, small, X.LINKED_PAGES)
    pages.filter("page_id < 20").write.parquet(f"{folder}/in/a")
    stream = SI.page_stream(spark, f"{folder}/in/*")
    SI.update_queue(stream, folder, f"{folder}/c1", at(), 1 << 50).awaitTermination()
    first = sorted(map(str, SI.newest_snapshot(spark, folder, 1).collect()))
    # a second stream with an empty checkpoint repeats batch 0 on the same data
    SI.update_queue(stream, folder, f"{folder}/c2", at(), 1 << 50).awaitTermination()
    assert sorted(map(str, SI.newest_snapshot(spark, folder, 1).collect())) == first
    assert any("https://a.example.org/1" in r and "pending" in r for r in first)
    # new files become batch 1
    pages.filter("page_id >= 20").write.parquet(f"{folder}/in/b")
    SI.update_queue(stream, folder, f"{folder}/c2", at(), 1 << 50).awaitTermination()
    assert SI.newest_snapshot(spark, folder, 2).count() > len(first)


def test_store_touches_only_what_changes(spark):
    """A step reads the buckets of its URLs, writes its rows, and leaves the other files alone."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rows = [dict(id=i, url=f"u{i}", priority=i % 9) for i in range(400)]
    store = QueueStore.create(make_queue(spark, rows), f"{folder}/store", buckets=16)
    assert store.version(0).next_id == 400 and store.read(0).count() == 400
    urls = spark.createDataFrame([("u5",), ("u77",), ("new",)], "url string")
    touched = store.touching(0, urls)
    assert sorted(r.url for r in touched.collect()) == ["u5", "u77"]
    plan = touched._jdf.queryExecution().executedPlan().toString()
    pruned = re.search(r"PartitionFilters: \[bucket#\d+ IN \(([\d,]+)\)\]", plan)
    assert pruned and len(pruned[1].split(",")) <= 3
    changed = touched.withColumn("status", F.lit("done")).union(make_queue(spark, [dict(id=400, url="new")]))
    assert store.commit(0, changed, 401) == 1
    version = store.version(1)
    assert {f for f, _ in version.deltas} == {"delta-00000001"} and sum(version.deltas.values()) == 3
    assert version.base == store.version(0).base and version.next_id == 401
    got = by_id(store.read(1))
    assert len(got) == 401 and {i for i, r in got.items() if r.status == "done"} == {5, 77}
    # the same step again gives the same version
    store.commit(0, changed, 401)
    assert by_id(store.read(1)) == got and store.version(1) == version


def test_store_rewrites_outgrown_buckets_and_drops_old_folders(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rows = [dict(id=i, url=f"u{i}") for i in range(120)]
    store = QueueStore.create(make_queue(spark, rows), f"{folder}/store", buckets=8)
    want = {r["url"]: 0 for r in rows}
    rnd = random.Random(4)
    number = 0
    for step in range(1, 7):
        urls = rnd.sample(sorted(want), 12) + [f"n{step}-{k}" for k in range(5)]
        want |= {u: step for u in urls}
        changed = make_queue(spark, [dict(id=1000 * step + k, url=u, priority=step) for k, u in enumerate(urls)])
        number = store.commit(number, changed, 0)
        assert {r.url: r.priority for r in store.read(number).collect()} == want
    version = store.version(number)
    assert number == store.newest() == 6 and len({f for f, _ in version.base}) > 1
    # deltas never pile up beyond their share of the base
    for b in range(8):
        size = lambda parts: sum(n for (_, k), n in parts.items() if k == b)
        assert size(version.deltas) <= 0.25 * size(version.base)
    there = set(os.listdir(f"{folder}/store"))
    needed = version.folders() | store.version(5).folders() | {"version-00000005", "version-00000006"}
    assert there == needed


def test_three_batches_equal_whole_queue_merges(spark, sf_dir):
    """Batches with common URLs, keys near 2**62: as if each batch was merged into the whole queue."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    small = sf_dir.replace("sf0.01", "sf0.001")
    pages = X.derive(spark, small, X.LINKED_PAGES)
    pages = pages.withColumn("page_id", F.col("page_id") + F.lit((1 << 62) - 7))
    start = X.derive(spark, small, X.QUEUE).filter("id % 3 <> 0")
    start.write.parquet(SI.snapshot_path(folder, 0))
    want, next_id = start, start.agg(F.max("id")).first()[0] + 1
    for n in range(3):
        part = pages.filter(F.col("page_id") % 3 == n)
        part.write.parquet(f"{folder}/in/{n}")
        SI.update_queue(
            SI.page_stream(spark, f"{folder}/in/*"), folder, f"{folder}/c", at(), 0
        ).awaitTermination()
        found = SI.batch_discoveries(part, want)
        want = Q.number_arrivals(Q.upsert_discovered(want, found, at(), None), next_id).select(*Q.QUEUE_COLUMNS)
        want = cut_lineage(want)
        next_id = want.agg(F.max("id")).first()[0] + 1
    got = SI.newest_snapshot(spark, folder, 3)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    ids = [r.id for r in got.collect()]
    assert len(set(ids)) == len(ids) and max(ids) < 100_000
    parents = {r.parent_url_id for r in got.collect()} - {None}
    assert parents and max(parents) < 100_000
    assert got.filter("depth = 2 and source like 'frontier:%'").count() > 0


def test_counted_stream_equals_the_batch_operator(spark):
    """Several micro-batches, failures at a multiple of 15, latencies that are null, and the stop."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rnd = random.Random(9)
    rows = [
        (f"w{rnd.choice([0, 0, 0, 1, 2])}", i, i, rnd.random() < 0.2,
         None if rnd.random() < 0.3 else round(rnd.choice([3.0, 900.0, 41.25]) * rnd.random(), 2), i % 4)
        for i in range(900)
    ]
    schema = "worker string, t int, outcome_id bigint, failed boolean, latency_ms double, frontier bigint"
    df = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("t") * 30)).drop("t")
    want = W.metric_snapshots(df)
    for n in range(3):
        part = df.filter((F.col("outcome_id") >= 300 * n) & (F.col("outcome_id") < 300 * (n + 1)))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        time.sleep(1.1)
    SM.stop_row(spark, df.schema, F.lit("2024-01-01").cast("timestamp")).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    SM.run_counted_metrics(stream, f"{folder}/out", f"{folder}/c").awaitTermination()
    got = spark.read.parquet(f"{folder}/out")
    columns = ["worker", "outcome_id", "final", *W.METRICS, "avg_latency_ms", "p95_latency_ms"]
    rows_of = lambda x: sorted(tuple(r) for r in x.select(*columns).collect())
    assert rows_of(got) == rows_of(want)
    assert got.filter("final").count() == 3


def test_quantiles_ignore_null_latencies(spark):
    rows = [("w", i, i, False, 10.0 if i % 2 else None, 0) for i in range(30)]
    schema = "worker string, t int, outcome_id bigint, failed boolean, latency_ms double, frontier bigint"
    df = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("t")).drop("t")
    last = W.latest_metrics(W.metric_snapshots(df)).first()
    assert (float(last.p95_latency_ms), float(last.avg_latency_ms)) == (10.0, 10.0)
    assert float(W.worker_metrics(df).first().p95_latency_ms) == 10.0
