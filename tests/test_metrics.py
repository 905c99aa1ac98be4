import random

import plain
import pytest
from pyspark.sql import functions as F

from webtrail.operators import quantiles as K
from webtrail.operators import runs as R
from webtrail.operators import workers as W


@pytest.mark.parametrize("n", [1, 2, 10, 20, 21, 41, 1000])
def test_exact_quantile_small(spark, n):
    rnd = random.Random(n)
    values = [round(rnd.uniform(-50, 900), 3) for _ in range(n)]
    df = spark.createDataFrame([("k", v) for v in values], "k string, v double")
    assert K.exact_quantile(df, ["k"], "v").first().p95 == plain.floor_quantile(values)


def test_exact_quantile_with_a_hot_key_and_nulls(spark):
    rnd = random.Random(3)
    rows = [("hot", rnd.choice([5.0, 5.0, 7.25, rnd.random() * 1e6])) for _ in range(6000)]
    rows += [(f"k{i % 9}", rnd.lognormvariate(3, 2)) for i in range(500)]
    rows += [("hot", None), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    got = {r.k: (r.n, r.p95) for r in K.exact_quantile(df, ["k"], "v").collect()}
    want = {}
    for k, v in rows:
        if v is not None:
            want.setdefault(k, []).append(v)
    assert got == {k: (len(v), plain.floor_quantile(v)) for k, v in want.items()}


def test_null_keys_stay(spark):
    df = spark.createDataFrame([(None, 1.0, "ok", 5), (None, 3.0, "ok", 5), ("r", 2.0, "ok", 1)], "run string, ms double, status string, bytes bigint")
    assert {r.run: (r.total_urls, r.p95_ms) for r in R.run_totals(df).collect()} == {None: (2, 1.0), "r": (1, 2.0)}
    odd = spark.createDataFrame([("k", v) for v in (-5.0, -0.5, float("inf"), 2.0, float("-inf"))], "k string, v double")
    assert K.exact_quantile(odd, ["k"], "v").first().p95 == 2.0


def test_running_quantile_of_every_prefix(spark, monkeypatch):
    monkeypatch.setattr(K, "CHUNK", 64)
    rnd = random.Random(5)
    codes = {"a": [rnd.randrange(3000) for _ in range(700)], "b": [rnd.choice([0, 7, 4095]) for _ in range(90)]}
    values = spark.createDataFrame(
        [(k, i + 1, c) for k, v in codes.items() for i, c in enumerate(v)], "k string, seq bigint, code bigint"
    )
    asked = values.select("k", F.col("seq").alias("m"))
    for r in K.running_quantile(values, asked, ["k"], 4095).collect():
        assert r.p95_code == plain.floor_quantile(codes[r.k][: r.m])


def test_snapshots_cadence(spark):
    """A worker resting on a multiple of 15 writes again after each failure."""
    rows = [("w", i, i, i in (15, 16), float(i), 1) for i in range(20)]
    df = spark.createDataFrame(
        rows, "worker string, t int, outcome_id bigint, failed boolean, latency_ms double, frontier bigint"
    ).withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("t") * 900)).drop("t")
    shots = sorted((r.final, r.outcome_id, r.processed_count, r.failed_count) for r in W.metric_snapshots(df).collect())
    assert shots == [(False, 14, 15, 0), (False, 15, 15, 1), (False, 16, 15, 2), (True, 19, 18, 2)]
    last = W.latest_metrics(W.metric_snapshots(df)).first()
    assert last.final and last.processed_count == 18
    assert float(last.p95_latency_ms) == plain.floor_quantile([float(i) for i in range(20) if i not in (15, 16)])


def test_rates_and_lift(spark):
    rows = spark.createDataFrame([("cpp", 10, 6.3, 564197), ("none", 0, 0.0, 0)],
                                 "name string, fetched bigint, pages_per_sec double, total_bytes bigint")
    got = {r.name: r for r in R.with_rates(rows).collect()}
    assert got["cpp"].pages_per_min == pytest.approx(378.0)
    assert got["cpp"].pages_per_day == pytest.approx(544320.0)
    assert got["cpp"].mb_per_sec == pytest.approx(0.3389779186248779)
    assert got["none"].mb_per_sec == 0.0
    means = spark.createDataFrame([("base", 10.0, 4.0, 0.0), ("new", 12.0, 3.0, 5.0)], "policy string, p double, age double, z double")
    lift = {r.metric: r.lift_pct for r in R.lift(means, "base", ["p", "age", "z"], ["age"]).collect()}
    assert lift == {"p": pytest.approx(20.0), "age": pytest.approx(25.0), "z": 0.0}


def test_published_p95_index():
    """With ten values the index is 8, so the slowest is left out."""
    assert plain.floor_quantile(list(range(10))) == 8


def test_quantile_of_values_close_together(spark):
    """Time stamps, tiny values, signs, zeros, infinities: no bucket of many values is left."""
    import math
    import random

    from webtrail.operators.quantiles import exact_quantile

    r = random.Random(1)
    groups = {
        "stamps": [1.7e12 + k for k in range(3000)], "tiny": [1e-9 * r.random() for _ in range(3000)],
        "signs": [r.uniform(-5, 5) for _ in range(999)], "zeros": [0.0, -0.0, 0.0, 1.0], "one": [2.5],
        "powers": [2.0**k for k in range(-1074, 1024)] + [-(2.0**k) for k in range(-1074, 1024)],
        "ends": [math.inf, -math.inf, 1e308, -1e308, 5e-324], "near": [math.nextafter(8.0, x) for x in (0, 9)] + [8.0] * 3,
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("stamps", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    for q in (0.0, 0.5, 0.95, 1.0):
        got = {x.g: (x.n, x.p95) for x in exact_quantile(df, ["g"], "v", q).collect()}
        assert got == {g: (len(v), sorted(v)[int(q * (len(v) - 1))]) for g, v in groups.items()}


def test_sketches_merge_to_the_rank_of_all_values(spark):
    """Many small sketches of a key give about what one over all its values gives."""
    rnd = random.Random(9)
    rows = [("hot", i % 97, rnd.lognormvariate(3, 2)) for i in range(40_000)]
    rows += [("few", i, float(i)) for i in range(21)] + [(None, 0, 2.0), ("hot", 3, None), ("none", 0, None)]
    df = spark.createDataFrame(rows, "k string, part int, v double").repartition(7)
    merged = K.merged_sketches(K.quantile_sketches(df, ["k", "part"], "v"), ["k"])
    claimed = merged.select("k", K.sketch_quantile(F.col("sketch")).alias("p95")).cache()
    values = sorted(v for k, _, v in rows if k == "hot" and v is not None)
    got = {r.k: r.p95 for r in claimed.collect()}
    assert abs(sum(v <= got["hot"] for v in values) / len(values) - 0.95) <= K.SKETCH_RANK_ERROR
    assert got["few"] in (19.0, 20.0) and got[None] == 2.0 and got["none"] is None
    held = {r.k: (r.n, r.within) for r in K.ranks_hold(df, claimed, ["k"], "v", "p95").collect()}
    assert held == {"hot": (40_000, True), "few": (21, True), None: (1, True)}
    wrong = claimed.withColumn("p95", F.col("p95") * 2)
    assert not any(r.within for r in K.ranks_hold(df, wrong, ["k"], "v", "p95").collect() if r.k == "hot")
