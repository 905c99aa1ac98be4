"""Collapsed conversations against plain lists."""

import pytest
from pyspark.sql import functions as F

from webtrail.llm import chat as C

SHAPE = "conv_id long, turn long, role string, text string"


def plain(rows, most):
    convs = {}
    for c, t, r, x in set(rows):
        convs.setdefault(c, []).append((-(10**20) if t is None else t, r or "", x or ""))
    convs = {c: [v[1:] for v in sorted(set(t))] for c, t in convs.items()}
    key = lambda c: -(10**20) if c is None else c
    made = []
    for c, t in convs.items():
        if any(len(o) > len(t) and o[: len(t)] == t for o in convs.values()):
            continue
        same = [o for o in convs if convs[o] == t]
        if c != min(same, key=key):
            continue
        for p in range(0, len(t), most):
            text = "".join(
                f"<|{r.replace('<|', '< |')}|>\n{x.replace('<|', '< |')}<|end|>\n" for r, x in t[p : p + most]
            )
            made.append((c, p // most, len(t), len(same), text))
    return sorted(made, key=str)


BASE = [("user", "a"), ("assistant", "b"), ("user", "c <|end|> d"), ("assistant", "e")]
ROWS = [(1, k, *x) for k, x in enumerate(BASE[:2])]
ROWS += [(2, k + 5, *x) for k, x in enumerate(BASE)]
ROWS += [(3, 10 * k - 7, *x) for k, x in enumerate(BASE)]
ROWS += [(4, k, *x) for k, x in enumerate(BASE[:3])] + [(4, 3, "assistant", "other")]
ROWS += [(5, 0, "assistant", "b"), (6, None, None, None), (6, 1, "user", None), (7, 0, "", ""), (7, 0, "", "")]
ROWS += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (8, 0, "user", "x" * 200_000), (9, 0, "user", "a"), (9, 0, "user", "b")]
ROWS += [(10, k, "user", f"t{k % 3}") for k in range(40)] + [(11, k, "user", f"t{k % 3}") for k in range(30)]


@pytest.mark.parametrize("most", [1024, 3])
def test_against_lists(spark, monkeypatch, most):
    monkeypatch.setattr(C, "PART_TURNS", most)
    table = spark.createDataFrame(ROWS, SHAPE).withColumn("block", F.lit("clash")).repartition(4)
    got = sorted(map(tuple, C.collapsed(table).collect()), key=str)
    assert got == plain(ROWS, most) and len(got) > 4


@pytest.fixture
def many_ranges(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_conversations_over_many_blocks(spark, many_ranges):
    table = spark.createDataFrame(ROWS, SHAPE).repartition(4)
    assert C.in_blocks(table).select("block").distinct().count() > 4
    assert sorted(map(tuple, C.collapsed(table).collect()), key=str) == plain(ROWS, C.PART_TURNS)


def test_a_third_of_all_rows_without_an_id(spark, many_ranges):
    """Rows of one turn number and of many, all without an id: no block has more than a few ranges' share."""
    rows = [(None, 0, "user", f"{k * 7919 % 4000} text") for k in range(2000)] + [(None, k, "user", "same") for k in range(2000)]
    rows += [(k // 4, k % 4, "user", f"t{k % 50}") for k in range(8000)]
    table = spark.createDataFrame(rows, SHAPE)
    blocks = C.in_blocks(table).groupBy("conv", "block").count()
    assert blocks.agg(F.max("count")).first()[0] <= 2 * len(rows) / 8
    got = [r for r in C.collapsed(table).collect() if r.conv_id is None]
    assert sorted((r.part, r.n_turns) for r in got) == [(p, 4000) for p in range(4)]
    want = [r for r in plain(rows[:4000], C.PART_TURNS)]
    assert sorted(map(tuple, got), key=str) == want


def test_no_rows(spark):
    assert C.collapsed(spark.createDataFrame([], SHAPE)).collect() == []


def test_no_python_in_the_plan(spark, sf_dir):
    plan = C.op4_chat(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
