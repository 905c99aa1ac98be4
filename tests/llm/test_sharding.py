import pytest
from pyspark.sql import functions as F

from webtrail.llm import sharding as S

from .conftest import documents


def test_shares_are_equal_and_stable():
    table = S.fill(S.SHARDS, S.SLOTS)
    counts = [table.count(s) for s in S.SHARDS]
    assert max(counts) - min(counts) <= 1
    fewer = S.fill(S.SHARDS[:-1], S.SLOTS)
    moved = sum(a != b for a, b in zip(table, fewer))
    assert moved <= 3 * table.count(S.SHARDS[-1])


@pytest.mark.parametrize("shards, slots", [((), 7), (("a", "a"), 7), (("a", None), 7), (("a",), 8), (("a", "b", "c"), 2)])
def test_errors(shards, slots):
    with pytest.raises(ValueError):
        S.fill(shards, slots)


def test_hard_rows(spark):
    rows = [(1, None), (1, ""), (None, "x"), (None, "y" * 100_000), (2**62, "z")]
    docs = documents(spark, rows).withColumn("slot", F.lit("clash"))
    got = S.placed(docs, "doc_id", ("a", "b"), 3)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "slot", "shard"]
    table = S.fill(("a", "b"), 3)
    want = sorted(((d, S.hash32("" if d is None else str(d)) % 3) for d, _ in rows), key=str)
    assert sorted(((r.doc_id, r.slot) for r in got.collect()), key=str) == want
    assert all(table[r.slot] == r.shard for r in got.collect())
    assert S.placed(documents(spark, []), "doc_id").collect() == []


def test_written_shards(spark, tmp_path):
    docs = documents(spark, [(k, "x") for k in range(500)])
    S.write_shards(docs, "doc_id", str(tmp_path / "out"), ("a", "b", "c"), 101, rows_most=50)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in back.collect()) == list(range(500))
    assert {(r.doc_id, r.shard) for r in back.collect()} == {
        (r.doc_id, r.shard) for r in S.placed(docs, "doc_id", ("a", "b", "c"), 101).collect()
    }
