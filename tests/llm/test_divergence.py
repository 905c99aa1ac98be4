"""The tree's sums against sums over all kept terms, term by term."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from webtrail.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(rows, least=3, top=200):
    made = []
    by_lang = defaultdict(list)
    for text, lang, source in rows:
        by_lang[lang or ""].append((source or "", words(text)))
    for lang, docs in by_lang.items():
        having = Counter(t for _, w in docs for t in set(w))
        kept = sorted(t for t, d in having.items() if d >= least)
        v = len(kept)
        counts = defaultdict(Counter)
        for source, w in docs:
            counts[source].update(t for t in w if having[t] >= least)
        whole = sum(counts.values(), Counter())

        def share(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 1) // (n + v) for t in kept}

        p = {s: share(c) for s, c in counts.items()}
        q = share(whole)
        for a in p:
            pairs = [(sum((p[a][t] - p[b][t]) ** 2 // p[b][t] for t in kept), b) for b in p if b != a]
            terms = [((p[a][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[a][t] and p[a][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                made += [(lang, a, part, x, value, k) for k, (value, x) in enumerate(found[:most], 1)]
    return sorted(made)


def table(spark, rows):
    return spark.createDataFrame(
        [(k, *r) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string"
    ).repartition(5)


def made(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_random_rows(spark):
    r = random.Random(2)
    vocabulary = ["a", "B", "ab", "é", "É", "x2y", "the", "日本", "ﬁ", "İ", "zz"] + [f"w{chr(97 + k)}" for k in range(20)]
    rows = [
        (
            " ".join(r.choices(vocabulary, k=r.choice([0, 1, 5, 40]))),
            r.choice(["en", "de", None, "en"]),
            r.choice(["s0", "s0", "s0", "s1", "s2", "s3", None, "", "é"]),
        )
        for _ in range(160)
    ]
    docs = table(spark, rows + rows[:20])
    assert made(D.audit(docs)) == plain(rows + rows[:20])
    assert made(D.audit(docs, least=1, top=2)) == plain(rows + rows[:20], 1, 2)


def test_odd_rows_and_names(spark):
    rows = [
        (None, "en", "s0"), ("", "en", "s1"), ("!!! 12", "xx", "s1"), ("one", "xx", "s2"), ("one", "xx", "s2"),
        ("long " * 50_000, "en", "s0"), ("long words", "en", "s1"), ("LONG", "en", "s2"), ("x" * 100_000, "en", "s2"),
    ]
    docs = table(spark, rows).withColumns({"my col": F.lit(1), "a:b": F.lit(2), "n": F.lit(3), "rank": F.lit(4), "term": F.lit(5)})
    assert made(D.audit(docs)) == plain(rows)


def test_no_rows(spark):
    assert D.audit(table(spark, [])).collect() == []


def test_more_terms_than_a_task_holds(spark, monkeypatch):
    monkeypatch.setattr(D, "HELD_TERMS", 3)
    rows = [(f"a b c {chr(97 + k)}{chr(97 + j)} d", "en", f"s{k % 3}") for k in range(9) for j in range(9)]
    assert made(D.audit(table(spark, rows))) == plain(rows)


@pytest.mark.parametrize("most", [1, 1 << 20])
def test_tree_of_sorted_rows(monkeypatch, most):
    """Corrections over the tree, in one batch or cut anywhere, against all pairs of every row."""
    monkeypatch.setattr(D, "COMBINATIONS", most)
    r = random.Random(6)
    none = {k: r.randint(1, 50) for k in range(6)}
    rows = Counter()
    for _ in range(300):
        path = tuple((k, none[k] * r.randint(2, 4)) for k in range(6) if r.random() < 0.6)
        rows[path] += r.choice([1, 1, 7, 10**12])
    want = defaultdict(lambda: [0, 0])
    f = lambda p, q: (p - q) ** 2 // q
    for path, m in rows.items():
        for k, (b, q) in enumerate(path):
            for a, p in path[:k]:
                p0, q0 = none[a], none[b]
                want[a, b][0] += m * (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0))
                want[a, b][1] += m * (f(q, p) - f(q, p0) - f(q0, p) + f(q0, p0))
    ordered = sorted(rows)
    for cuts in ([0, len(ordered)], [0, 3, 50, 51, len(ordered)]):
        got = defaultdict(lambda: [0, 0])
        for x, y in zip(cuts, cuts[1:]):
            part = ordered[x:y]
            flat = [e for path in part for e in path]
            offsets = np.r_[0, np.cumsum([len(path) for path in part])].astype(np.int64)
            ranks, shares = (np.array([e[k] for e in flat], np.int64) for k in (0, 1))
            zero = np.array([none[k] for k in ranks.tolist()], np.int64)
            times = np.array([rows[path] for path in part], np.int64)
            for key, both in D.corrections(offsets, ranks, shares, zero, times).items():
                for side in (0, 1):
                    got[key][side] += both[side]
        assert got == want


def test_nodes_are_shared():
    """Rows with a common beginning make its nodes once, with the multiplicity of all."""
    offsets = np.array([0, 2, 5, 7, 8])
    ranks = np.array([0, 1, 0, 1, 2, 0, 2, 3])
    shares = np.array([5, 5, 5, 5, 9, 5, 9, 9])
    common = D.paths_of(offsets, ranks, shares)
    assert common.tolist() == [0, 2, 1, 0]
    nodes = sorted(zip(*(x.tolist() for x in D.nodes_of(np.diff(offsets), common, np.array([1, 10, 100, 1000])))))
    assert nodes == [(0, 0, 111), (0, 1, 11), (1, 2, 10), (2, 1, 100), (3, 0, 1000)]
