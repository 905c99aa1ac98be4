import random
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from webtrail.operators import queue as Q
from webtrail.operators import store as ST
from webtrail.plans import fixtures as X

AT = dt.datetime(2024, 2, 1)


def at():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def queue_row(**changes):
    row = dict(
        id=1, url="u1", status="pending", priority=0, geo_score=0.0, source="seed", depth=0,
        parent_url_id=None, retries=0, max_retries=3, claimed_at=None, claimed_by=None,
        last_scored_at=None, processed_at=None, created_at=dt.datetime(2024, 1, 1),
        updated_at=dt.datetime(2024, 1, 1), error=None,
    )
    return tuple({**row, **changes}[c] for c in Q.QUEUE_COLUMNS)


def make_queue(spark, rows):
    return spark.createDataFrame([queue_row(**r) for r in rows], Q.QUEUE_SCHEMA)


def by_id(df):
    return {r.id: r for r in df.collect()}


def upsert_one(rows, arrival, new_id):
    """What a single upsert does to a dict of rows; returns whether it inserted."""
    url = arrival["url"]
    geo, depth = min(1.0, max(0.0, arrival["geo_score"])), max(0, arrival["depth"])
    if url not in rows:
        rows[url] = dict(
            id=new_id, url=url, status="pending", priority=arrival["priority"], geo_score=geo,
            source=arrival["source"], depth=depth, parent_url_id=arrival["parent_url_id"], retries=0,
        )
        return True
    old = rows[url]
    old["priority"] = max(old["priority"], arrival["priority"])
    old["geo_score"] = max(old["geo_score"], geo)
    if old["parent_url_id"] is None:
        old["parent_url_id"] = arrival["parent_url_id"]
    old["depth"] = min(old["depth"], depth)
    if old["source"] != "seed":
        old["source"] = arrival["source"]
    if old["status"] in ("done", "failed"):
        old["status"], old["retries"] = "pending", 0
    return False


@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_equals_one_at_a_time(spark, seed):
    rnd = random.Random(seed)
    start = [
        dict(id=i, url=f"u{i}", status=rnd.choice(["pending", "in_progress", "done", "failed"]),
             priority=rnd.randrange(50), geo_score=rnd.randrange(64) / 64, depth=rnd.randrange(4),
             source=rnd.choice(["seed", "frontier:a"]), retries=rnd.randrange(4),
             parent_url_id=rnd.choice([None, 7]))
        for i in range(60)
    ]
    arrivals = [
        dict(url=f"u{rnd.randrange(110)}", priority=rnd.randrange(99),
             geo_score=rnd.randrange(-8, 80) / 64, source=rnd.choice(["seed", "frontier:a", "frontier:b"]),
             depth=rnd.randrange(-1, 5), parent_url_id=rnd.choice([None, *range(50)]), ord=n)
        for n in range(400)
    ]
    rows = {r["url"]: dict(r) for r in start}
    inserted = {a["ord"]: upsert_one(rows, a, 10_000 + a["ord"]) for a in arrivals}
    found = spark.createDataFrame(
        arrivals, "url string, priority int, geo_score double, source string, depth int, parent_url_id bigint, ord bigint"
    ).repartition(7)
    queue = make_queue(spark, start)
    got = Q.upsert_discovered(queue, found, at(), 10_000).collect()
    assert len(got) == len(rows)
    for r in got:
        want = rows[r.url]
        assert {k: r[k] for k in want} == want
    report = {r.ord: r.inserted for r in Q.arrival_report(queue, found).collect()}
    assert report == inserted


def test_claims_are_ordered_bounded_and_disjoint(spark):
    rows = [dict(id=i, url=f"u{i}", priority=i % 5, geo_score=0.285 if i % 2 else 0.125, retries=i % 4)
            for i in range(200)]
    queue = make_queue(spark, rows)
    claims = Q.claim_set(queue, batch=7, workers=5).collect()
    f32 = lambda x: __import__("struct").unpack("f", __import__("struct").pack("f", x))[0]
    open_ = sorted((r for r in rows if r["retries"] < 3),
                   key=lambda r: (-(r["priority"] + round(f32(r["geo_score"]) * 100)), r["retries"], r["id"]))
    assert [c.id for c in sorted(claims, key=lambda c: c.claim_rank)] == [r["id"] for r in open_[:35]]
    assert all(c.worker == (c.claim_rank - 1) // 7 for c in claims)
    after = by_id(Q.claim(queue, 7, at(), workers=5))
    assert sum(r.status == "in_progress" for r in after.values()) == 35
    one = after[claims[0].id]
    assert (one.claimed_by, one.claimed_at, one.updated_at) == (f"worker-{claims[0].worker}", AT, AT)


def test_claims_of_hashed_ids(spark):
    """Ids all over the range, few classes, and a claim of most of the queue."""
    rows = spark.range(9000).select(
        F.xxhash64("id").alias("id"), F.concat(F.lit("u"), "id").alias("url"), F.lit("pending").alias("status"),
        (F.col("id") % 3).cast("int").alias("priority"), F.lit(0.0).cast("float").alias("geo_score"),
        (F.col("id") % 2).cast("int").alias("retries"), F.lit(3).alias("max_retries"),
    )
    plain = sorted(rows.collect(), key=lambda r: (-r.priority, r.retries, r.id))
    for batch, workers in ((10, 1), (700, 11), (20_000, 1)):
        got = sorted((r.claim_rank, r.id, r.worker) for r in Q.claim_set(rows, batch, workers).collect())
        want = [(k + 1, r.id, k // batch) for k, r in enumerate(plain[: batch * workers])]
        assert got == want


@pytest.mark.parametrize("most", [50_000, 100])
def test_claims_from_one_large_class(spark, monkeypatch, most):
    """400,000 rows of equal rank: nothing but the claimed rows is numbered or gathered."""
    monkeypatch.setattr(Q, "BROADCAST_ROWS", most)
    rows = spark.range(400_000).select(
        (F.col("id") * 1_000_003 - (1 << 40)).alias("id"), F.lit("pending").alias("status"), F.lit(5).alias("priority"),
        F.lit(0.5).cast("float").alias("geo_score"), F.lit(0).alias("retries"), F.lit(3).alias("max_retries"),
    )
    for batch in (10, 700):
        got = sorted((r.claim_rank, r.id) for r in Q.claim_set(rows, batch).collect())
        assert got == [(k + 1, k * 1_000_003 - (1 << 40)) for k in range(batch)]
    plan = Q.claim_set(rows, 10)._jdf.queryExecution().optimizedPlan().toString()
    # the window is above a filter that lets claimed ids through only
    assert re.search(r"Window.*\n(?:.*\n)*.*Filter .*<=", plan) or most == 100


def test_nth_id(spark, monkeypatch):
    monkeypatch.setattr(Q, "BROADCAST_ROWS", 5)
    rnd = random.Random(3)
    spread = [rnd.randrange(-(1 << 62), 1 << 62) for _ in range(300)]
    values = sorted({-(1 << 63), (1 << 63) - 1, 0, -1, *spread, *range(90, 140)})
    ids = spark.createDataFrame([(v,) for v in values], "id bigint")
    for n in (1, 2, 100, 180, len(values)):
        assert Q.nth_id(ids, n, len(values)) == values[n - 1]


def test_claim_windows_are_partitioned(spark, sf_dir):
    from webtrail.plans.catalog import queue_of

    plan = Q.claim_set(queue_of(spark, sf_dir), 5)._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"windowspecdefinition\(([^,]*)", plan)
    assert windows and not any(w.endswith(("FIRST", "LAST")) for w in windows)


def test_claims_of_a_named_worker(spark, sf_dir):
    from webtrail.plans.catalog import at, queue_of

    made = Q.claim(queue_of(spark, sf_dir), 10, at(), worker_id="w-7")
    assert made.filter("claimed_by = 'w-7' and status = 'in_progress'").count() == 10


def test_outcomes(spark):
    busy = dict(status="in_progress", claimed_by="w", claimed_at=dt.datetime(2024, 1, 5))
    queue = make_queue(spark, [
        dict(id=1, url="a", **busy), dict(id=2, url="b", retries=1, **busy),
        dict(id=3, url="c", retries=2, **busy), dict(id=4, url="d", **busy),
    ])
    done = by_id(Q.mark_done(queue, queue.filter("id = 1"), at()))
    assert (done[1].status, done[1].claimed_by, done[1].processed_at) == ("done", None, AT)
    assert done[4].status == "in_progress" and done[4].claimed_by == "w"
    failures = queue.filter("id in (2, 3)").select("id", F.repeat(F.lit("x"), 5000).alias("error"))
    failed = by_id(Q.mark_failed(queue, failures, at()))
    assert (failed[2].status, failed[2].retries, failed[2].claimed_by) == ("pending", 2, None)
    assert (failed[3].status, failed[3].retries, len(failed[3].error)) == ("failed", 3, 4096)
    assert failed[3].processed_at is None and failed[4].error is None


def test_seeds(spark):
    queue = make_queue(spark, [dict(id=1, url="http://a/")])
    seeds = spark.createDataFrame(
        [(1, " http://a/ "), (2, "http://b/#x"), (3, " http://b/#x\n"), (4, "  "), (5, "http://c/")],
        "pos bigint, url string",
    )
    report = {r.pos: (r.url, r.inserted) for r in Q.seed_report(queue, seeds).collect()}
    assert report == {1: ("http://a/", False), 2: ("http://b/#x", True), 3: ("http://b/#x", False), 5: ("http://c/", True)}
    after = by_id(Q.enqueue_seeds(queue, seeds, at(), 100, priority=9))
    assert set(after) == {1, 102, 105}
    assert (after[102].priority, after[102].source, after[102].status) == (9, "seed", "pending")
    assert after[1].priority == 0


def test_delete_and_violations(spark, sf_dir):
    queue = make_queue(spark, [dict(id=1, url="a"), dict(id=2, url="b", parent_url_id=1), dict(id=3, url="c", parent_url_id=2)])
    left = by_id(Q.delete_urls(queue, queue.filter("id = 1")))
    assert set(left) == {2, 3} and left[2].parent_url_id is None and left[3].parent_url_id == 2
    assert Q.queue_violations(queue).count() == 0
    rules = {r.rule for r in Q.queue_violations(
        make_queue(spark, [dict(id=1, url="a", depth=-1, geo_score=1.5), dict(id=1, url="a", parent_url_id=9)]),
        spark.createDataFrame([(1,), (1,), (8,)], "url_id bigint"),
    ).collect()}
    assert rules == {"depth", "geo_score", "id_unique", "url_unique", "parent", "page_unique", "page_url"}


def test_fold_does_not_depend_on_partitioning(spark, sf_dir):
    found = X.derive(spark, sf_dir, X.DISCOVERIES)
    a, b = (
        sorted(map(str, Q.fold_discoveries(found.repartition(n)).collect())) for n in (1, 13)
    )
    assert a == b


def test_roots_of_long_chains_and_circles(spark):
    """A chain of 70, a star, a circle with a tail, a row that is its own parent."""
    rows = [dict(id=i, url=f"c{i}", parent_url_id=i - 1 if i else None) for i in range(70)]
    rows += [dict(id=100 + i, url=f"s{i}", parent_url_id=100 if i else 999) for i in range(40)]
    rows += [dict(id=200 + i, url=f"r{i}", parent_url_id=200 + (i + 1) % 3) for i in range(3)]
    rows += [dict(id=210, url="t", parent_url_id=201), dict(id=211, url="t2", parent_url_id=210), dict(id=300, url="o", parent_url_id=300)]
    got = {r.id: (r.root_id, r.hops, r.cyclic) for r in ST.roots(make_queue(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == (0, i, False) for i in range(70))
    assert all(got[100 + i] == (100, int(i > 0), False) for i in range(40))
    assert all(got[i] == (None, None, True) for i in (200, 201, 202, 210, 211, 300))
    assert ST.roots(make_queue(spark, rows).limit(0)).collect() == []


def test_violations_scan_each_table_once_or_twice(spark, tmp_path):
    queue = make_queue(spark, [dict(id=1, url="a"), dict(id=2, url="b", parent_url_id=7)])
    queue.write.parquet(f"{tmp_path}/queue")
    pages = spark.createDataFrame([(1,), (None,), (None,)], "url_id bigint")
    pages.write.parquet(f"{tmp_path}/pages")
    made = Q.queue_violations(spark.read.parquet(f"{tmp_path}/queue"), spark.read.parquet(f"{tmp_path}/pages"))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 3 and "Join" not in plan
    assert sorted(map(tuple, made.collect()), key=str) == [("page_unique", None, 2), ("parent", "7", 1)]
