"""The search against scores of all documents, one by one."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from webtrail.llm import lexical as X

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, top):
    held = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, total = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    made = []
    for item, text in items:
        found = []
        for doc, c, n in held:
            m = 100 - 50 + (50 * n * n_docs) // total
            score = 0
            for t in set(words(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, doc is not None, doc or 0, doc))
        found.sort(key=lambda x: x[:3])
        made += [(item, k, x[3], -x[0]) for k, x in enumerate(found[:top], 1)]
    return sorted(made, key=str)


def tables(spark, docs, items, parts=4):
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(parts),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


VOCABULARY = ["a", "B", "ab", "é", "É", "x2y", "the", "日本", "42", "İ"] + [f"w{k}" for k in range(60)]


def some(r, n, longest):
    return [
        (k if k % 17 else None, " ".join(r.choices(VOCABULARY, range(len(VOCABULARY), 0, -1), k=r.randint(0, longest))))
        for k in range(n)
    ]


@pytest.mark.parametrize("bucket, seeds, focus, top", [(8192, 20_000, 12, 50), (16, 60, 3, 5), (7, 100, 1, 3), (50, 20, 40, 1)])
def test_random_rows(spark, monkeypatch, bucket, seeds, focus, top):
    monkeypatch.setattr(X, "BUCKET", bucket)
    monkeypatch.setattr(X, "SEEDS", seeds)
    monkeypatch.setattr(X, "FOCUS", focus)
    r = random.Random(bucket)
    docs, items = some(r, 400, 60), some(r, 30, 30)
    docs += docs[:40]
    assert got(X.best_documents(*tables(spark, docs, items), top)) == plain(docs, items, top)


def test_blocks_of_items(spark, monkeypatch):
    r = random.Random(8)
    docs, items = some(r, 150, 40), some(r, 40, 20)
    monkeypatch.setattr(X, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(X, "BLOCK_TERMS", 25)
    d, i = tables(spark, docs, items)
    assert max(len(b.ids) for b in X.blocks(i)) <= 7
    assert got(X.best_documents(d, i, 4)) == plain(docs, items, 4)


def test_odd_rows_and_names(spark):
    docs = [
        (1, None), (2, ""), (3, "?!"), (None, "one two"), (None, "one two"), (5, "one two"), (5, "one two"),
        (6, "one " * 60_000 + "x" * 100_000), (7, "ONE"), (8, "three"),
    ]
    items = [(1, None), (2, "!"), (None, "one"), (4, "One ONE one two"), (4, "One ONE one two"), (5, "nothing of it"), (6, "three " * 9000)]
    d, i = tables(spark, docs, items)
    extra = {"my col": F.lit(1), "a:b": F.lit(2), "n": F.lit(3), "rank": F.lit(4), "score": F.lit(5), "terms": F.lit(6)}
    assert got(X.best_documents(d.withColumns(extra), i.withColumns(extra))) == plain(docs, items, 50)


def test_no_rows(spark):
    d, i = tables(spark, [(1, "a")], [(1, "a")])
    assert X.best_documents(d.limit(0), i).collect() == []
    assert X.best_documents(d, i.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_hold():
    r = np.random.default_rng(5)
    for _ in range(30):
        dense = r.integers(1, 10**9, (40, 12)) * (r.random((40, 12)) < 0.5)
        rows, terms = np.nonzero(dense)
        ends = np.r_[0, np.cumsum(np.bincount(rows, minlength=40))]
        lengths = np.sqrt((dense.astype(float) ** 2).sum(1))
        b = X.Bucket(np.arange(40), lengths, ends, terms, dense[rows, terms], 12)
        item = r.permutation(12)[:7]
        exact = dense[:, item].sum(1)
        assert (b.scores(item, np.ones(40, bool)) == exact).all()
        for focus in range(8):
            assert (b.bounds(item[:focus], 7 - focus) >= exact).all()
        assert (np.sqrt(7) * b.longest * (1 + 1e-9) + 1 >= exact).all()


def test_large_tables_stay_in_64_bits():
    s = X.Statistics(10**12, 10**15, np.array([3]))
    n = np.array([10**9])
    m = 50 + 50 * 10**9 * 10**12 // 10**15
    one = np.array([0, 1]), np.array([0]), np.array([10**6])
    assert X.impacts(n, *one, s).tolist() == [3 * (10**9 * 10**6 // (1000 * 10**6 + 20 * m))]
