"""The multi-index against all cosines."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from webtrail.llm import vectors as V

SHAPE = "vec_id long, embedding array<float>, label int"


def brute(rows):
    ok = [
        v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows
    ]
    unit = [np.float32(v).astype(float) / np.linalg.norm(np.float32(v).astype(float)) if o else None for (_, v), o in zip(rows, ok)]
    n = len(rows)
    link = np.zeros((n, n), bool)
    for length in {len(u) for u in unit if u is not None}:
        at = [i for i in range(n) if ok[i] and len(unit[i]) == length]
        x = np.array([unit[i] for i in at])
        link[np.ix_(at, at)] = x @ x.T >= 0.95
    np.fill_diagonal(link, False)
    least = [V.NO_ID if d is None else d for d, _ in rows]
    while True:
        new = [min([least[i], *(least[j] for j in np.flatnonzero(link[i]))]) for i in range(n)]
        if new == least:
            break
        least = new
    name = [None if x == V.NO_ID else x for x in least]
    return sorted(((d, int(link[i].sum()), name[i], d == name[i]) for i, (d, _) in enumerate(rows)), key=str)


def got(rows, **more):
    return sorted(map(tuple, V.near_vectors(rows, **more).collect()), key=str)


def test_traversal_is_in_order_of_distance():
    rng = np.random.default_rng(0)
    one, two = rng.random(9), rng.random(7)
    cells = V.visited(one, two, 63)
    sums = [one[c // 7] + two[c % 7] for c in cells]
    assert sorted(cells) == list(range(63)) and sums == sorted(sums)


def test_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    plain = brute([(r.vec_id, r.embedding) for r in rows.collect()])
    made = sorted(map(tuple, V.op3_vectors(spark, sf_dir).collect()), key=str)
    found, there = sum(r[1] for r in made), sum(r[1] for r in plain)
    assert found >= 0.99 * there
    assert all(a[0] == b[0] and a[1] <= b[1] for a, b in zip(made, plain))
    assert sum(a == b for a, b in zip(made, plain)) >= 0.99 * len(plain)


@pytest.mark.parametrize("rows_in_block", [2048, 40])
def test_clusters_and_hard_rows(spark, monkeypatch, rows_in_block):
    monkeypatch.setattr(V, "BLOCK_ROWS", rows_in_block)
    monkeypatch.setattr(V, "CELL_ROWS", 20)
    rng = np.random.default_rng(2)
    base = rng.standard_normal((12, 16))
    points = np.repeat(base, 30, 0) + rng.standard_normal((360, 16)) * rng.uniform(0, 0.25, (360, 1))
    rows = [(k * 3 % 367, [float(x) for x in p]) for k, p in enumerate(points.astype(np.float32))]
    nan, inf = float("nan"), float("inf")
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [None] + [1.0] * 15), (904, [nan] * 16), (905, [inf] + [1.0] * 15)]
    rows += [(906, [1.0]), (907, [2.0]), (908, [-1.0]), (None, rows[5][1]), (rows[6][0], rows[6][1]), (909, [3e38] * 16), (910, [1e-30] * 16)]
    rows += [(1000 + k, rows[7][1]) for k in range(50)] + [(-5, [2 * x for x in rows[40][1]])]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SHAPE).withColumn("kept", F.lit("clash"))
    made, plain = got(table, recall=1.0), brute(rows)
    found, there = sum(r[1] for r in made), sum(r[1] for r in plain)
    assert found >= 0.98 * there and [r[0] for r in made] == [r[0] for r in plain]
    assert sum(a == b for a, b in zip(made, plain)) >= 0.97 * len(plain)
    odd = {900, 901, 902, 903, 904, 905, 908}
    assert [r for r in made if r[0] in odd] == [(i, 0, i, True) for i in sorted(odd)]
    assert [r[1:3] for r in made if r[0] in (906, 907)] == [(1, 906)] * 2


def test_links_count_at_both_ends(spark, monkeypatch):
    """Few visits, so that many links are found from one side only: none counts for that side alone."""
    monkeypatch.setattr(V, "CELL_ROWS", 5)
    rng = np.random.default_rng(5)
    base = rng.standard_normal((40, 32))
    points = np.repeat(base, 25, 0) + rng.standard_normal((1000, 32)) * rng.uniform(0.1, 0.3, (1000, 1))
    rows = [(k, [float(x) for x in p]) for k, p in enumerate(points.astype(np.float32))]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SHAPE)
    plain = brute(rows)
    there = sum(r[1] for r in plain)
    for recall, least in ((0.5, 0.3), (V.TARGET_RECALL, 0.99)):
        made = got(table, recall=recall)
        found = sum(r[1] for r in made)
        assert found % 2 == 0 and least * there <= found <= there
        assert all(m[0] == p[0] and m[1] <= p[1] for m, p in zip(made, plain))
    assert there > 2000


def test_links_that_a_member_does_not_find():
    mask = np.array([[True, True, False], [False, True, False]])
    cell, cells = np.array([4, 9]), np.array([[0, 4], [1, 9], [4, 9]])
    assert V.unseen(mask, cell, cells).tolist() == [[False, True, False], [False, False, False]]


def test_forest_of_a_mask():
    mask = np.zeros((4, 5), bool)
    mask[0, [1, 3]] = mask[1, 3] = mask[2, 4] = True
    rows, cols = V.forest(mask)
    assert rows.tolist() == [1, 1, 4, -1] and cols.tolist() == [-1, 1, -1, 1, 4]


def test_no_rows(spark):
    assert V.near_vectors(spark.createDataFrame([], SHAPE)).collect() == []
