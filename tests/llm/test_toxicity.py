"""The chain on held-out documents, and its pieces by hand."""

import numpy as np
from pyspark.sql import functions as F

from webtrail.llm import toxicity as T

from .conftest import documents

LABELS = "doc_id long, quality int, toxic int"


def made(n=300):
    docs, labels = [], []
    for k in range(n):
        bad, junk = k % 5 == 0, k % 5 == 1
        text = f"plain words number {k % 17} and {k % 13} here"
        text += " you awful creature" if bad else ""
        text += " BUY!! NOW!! ***" if junk else ""
        docs.append((k, text))
        labels.append((k, 0 if junk else 1, int(bad)))
    return docs, labels


def test_held_out_documents(spark, sf_dir):
    """Trained on the labels of even ids, judged on those of odd ids."""
    sf = sf_dir.replace("sf0.001", "sf0.1")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    chain = T.train(docs, labels.filter("doc_id % 2 = 0"), T.categories_of_labels())
    held = T.score(docs, chain).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    toxic = [r.rejected for r in held if r.toxic]
    clean = [r.rejected for r in held if not r.toxic]
    # about seven in a hundred labels of these tables say toxic of a text without any mark of it
    assert np.mean(toxic) >= 0.85 and np.mean(clean) <= 0.01


def test_chain_learns_what_earlier_links_say():
    """The second category shows only through the first one."""
    r = np.random.default_rng(0)
    first = r.random(600) < 0.5
    found = [np.array(sorted({int(x), 50 + k % 7}), np.int32) for k, x in enumerate(first)]
    chain = T.fit_chain(found, np.c_[first, first], np.arange(600) % 5, ("a", "b"))
    assert chain.links[1].earlier[0] > 0 and len(chain.links[0].earlier) == 0


def test_hard_rows(spark):
    docs, labels = made()
    labels += [(None, 1, 1), (3, None, 1), (4, 1, None), (0, 1, 1), (10_000, 1, 0)]
    chain = T.train(documents(spark, docs), spark.createDataFrame(labels, LABELS), T.categories_of_labels())
    odd = documents(spark, [
        (1, None), (2, ""), (None, "you awful creature"), (7, "fine"), (7, "fine"), (8, "awful creature " * 40_000),
    ]).withColumn("rejected", F.lit("clash")).withColumn("p_toxic", F.lit(1))
    got = T.score(odd, chain)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "p_junk", "p_toxic", "rejected"]
    rows = sorted(((r.doc_id, r.rejected) for r in got.collect()), key=str)
    assert rows == sorted([(1, False), (2, False), (None, True), (7, False), (7, False), (8, True)], key=str)


def test_a_repeated_id_counts_once(spark):
    docs, labels = made(60)
    labels = spark.createDataFrame(labels, LABELS)
    once = T.train(documents(spark, docs), labels, T.categories_of_labels())
    often = T.train(documents(spark, docs + docs[5:6] * 200), labels, T.categories_of_labels())
    for a, b in zip(once.links, often.links):
        assert a.bias == b.bias and list(a.kept) == list(b.kept) and list(a.weights) == list(b.weights)
    assert once.threshold == often.threshold


def test_scorer_agrees_with_the_fitted_features():
    docs, labels = made()
    found = [T.features(t) for _, t in docs]
    y = np.array([(1 - q, t) for _, q, t in labels])
    chain = T.fit_chain(found, y, np.arange(len(docs)) // 5 % 5, ("junk", "toxic"))
    rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
    p = np.zeros((len(found), 0))
    for link in chain.links:
        new = link.odds(T._present(link, rows, np.concatenate(found), len(found)), p)
        p = np.c_[p, T._sigmoid(new)]
    scorer = T.Scorer(chain)
    assert np.allclose([scorer.probabilities(t) for _, t in docs], p)
    assert ((p[:, 1] >= chain.threshold) == y[:, 1]).all()


def plain_link(found, y, before):
    """The same fit in plain loops: which features lean, then steps down the slope."""
    n, share = len(found), sum(y) / len(y)
    seen, with_y = {}, {}
    for f, label in zip(found, y):
        for x in f:
            seen[x] = seen.get(x, 0) + 1
            with_y[x] = with_y.get(x, 0) + label
    lean = lambda x: abs(with_y[x] - seen[x] * share) / (seen[x] * share * (1 - share)) ** 0.5
    kept = sorted(x for x in seen if seen[x] >= T.LEAST_ROWS and lean(x) >= T.LEAST_LEANING)
    d = len(before[0])
    theta, pace = [0.0] * (len(kept) + d + 1), [1e-8] * (len(kept) + d + 1)
    at = {x: k for k, x in enumerate(kept)}
    inputs = [
        [(at[x], 1.0) for x in f if x in at] + [(len(kept) + j, b) for j, b in enumerate(row)] + [(len(theta) - 1, 1.0)]
        for f, row in zip(found, before)
    ]
    for _ in range(T.STEPS):
        slope = [T.RIDGE * t for t in theta[:-1]] + [0.0]
        for given, label in zip(inputs, y):
            miss = 1 / (1 + np.exp(-sum(theta[k] * x for k, x in given))) - label
            for k, x in given:
                slope[k] += miss * x
        pace = [p + s * s for p, s in zip(pace, slope)]
        theta = [t - 0.5 * s / p**0.5 for t, s, p in zip(theta, slope, pace)]
    assert n == len(inputs)
    return kept, theta[: len(kept)], theta[len(kept) : -1], theta[-1]


def test_chain_against_plain_loops():
    """Out-of-fold probabilities of the first category go into the second one's fit."""
    docs, labels = made(120)
    found = [T.features(t).tolist() for _, t in docs]
    y = np.array([(1 - q, t) for _, q, t in labels])
    fold = np.arange(len(docs)) // 4 % 3
    chain = T.fit_chain([np.array(f, np.int32) for f in found], y, fold, ("junk", "toxic"))
    before = [[0.0] for _ in docs]
    for f in range(3):
        inside = [k for k in range(len(docs)) if fold[k] != f]
        kept, weights, _, bias = plain_link([found[k] for k in inside], y[inside, 0], [[] for _ in inside])
        weight = dict(zip(kept, weights))
        for k in np.flatnonzero(fold == f):
            before[k] = [1 / (1 + np.exp(-sum(weight.get(x, 0) for x in found[k]) - bias))]
    for link, column, given in zip(chain.links, (0, 1), ([[] for _ in docs], before)):
        kept, weights, earlier, bias = plain_link(found, y[:, column], given)
        assert link.kept.tolist() == kept
        assert np.allclose(link.weights, weights) and np.allclose(link.earlier, earlier) and np.isclose(link.bias, bias)


def test_equal_texts_share_a_fold(spark):
    """Copies of a text say nothing about a held-out one."""
    assert T.features("One two, three").tobytes() == T.features("three two, One").tobytes()


def test_names_of_other_columns(spark):
    docs, labels = made()
    chain = T.train(documents(spark, docs), spark.createDataFrame(labels, LABELS), T.categories_of_labels())
    odd = documents(spark, docs).withColumns({"my col": F.lit(1), "a:b": F.lit(2), "x`y": F.lit(3), "rejected": F.lit("mine")})
    assert T.score(odd, chain).columns[5:8] == ["my col", "a:b", "x`y"]
    kept = T.without_rejected(odd, chain)
    assert kept.columns == odd.columns and {r.rejected for r in kept.collect()} == {"mine"}
    assert kept.count() == sum(not t for *_, t in labels)


def test_labels_of_one_class_or_none(spark):
    docs = documents(spark, made(20)[0])
    for rows in ([], [(1, 1, 0), (2, 1, 0)], [(1, 1, 1)]):
        chain = T.train(docs, spark.createDataFrame(rows, LABELS), T.categories_of_labels())
        assert not any(r.rejected for r in T.score(docs, chain).collect())


def test_no_rows(spark):
    chain = T.train(documents(spark, []), spark.createDataFrame([], LABELS), T.categories_of_labels())
    assert T.score(documents(spark, []), chain).collect() == []


def test_threshold():
    assert T.best_threshold(np.array([0.9, 0.8, 0.2]), np.array([1, 1, 0])) == 0.5
    assert T.best_threshold(np.array([0.5]), np.array([0])) == 2.0
