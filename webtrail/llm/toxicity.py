"""Toxicity by a chain of classifiers.

Categories are predicted one after another. Each is a logistic model over hashed features of
the text and over the probabilities of all categories before it. While training, those are
out-of-fold: a row's earlier category is predicted by models that have not seen the row, so
the later model learns how far it can trust them.

Features are present or absent: the words of a text (folded to lower case), their first four to
seven letters, their last four, runs of two and more symbols, and the share of capitals among
A-Z in tenths. Only features that lean clearly to one side of a category are kept
(``LEAST_LEANING`` standard deviations), so the length of a text does not matter.

The models are fitted on at most ``LABELLED_MOST`` labelled rows, those with the smallest hash
of their id: a bounded sample whose features one task can hold. Everything else covers all
rows. A text is rejected when the probability of the last category is at or above a threshold
that is chosen on out-of-fold predictions.

A null text counts as empty; it has no features but its emptiness. Labels with a null id or a
null category are ignored; of repeated labels each category's largest counts. Where the labels
have one class only, that category's probability is the share of its class (0 without labels)
and nothing is rejected. Null ids and repeated rows are judged like any other.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from .common import text_pieces, written

LABELLED_MOST = 6_000
FOLDS = 5
BITS = 20
LEAST_LEANING = 4.0
LEAST_ROWS = 3
STEPS = 120
RIDGE = 0.2
NEARLY = 0.005
#: Letters at the head of a word that are features of their own.
HEADS = (4, 5, 6, 7)
#: Name of a column that is there for one step only.
VERDICT = "verdict of the chain"
#: Words whose features a worker remembers.
REMEMBERED = 300_000
LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
TOKEN = re.compile(r"\w+|[^\w\s]{2,}")


def _bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def word_features(word: str) -> tuple[int, ...]:
    made = [_bucket("w" + word)]
    made += [_bucket("<" + word[:n]) for n in HEADS if len(word) >= n]
    if len(word) >= 4:
        made.append(_bucket(">" + word[-4:]))
    return tuple(made)


def capitals(text: str) -> int:
    data = text.encode("utf-8", "surrogatepass")
    rest = len(data.translate(None, LETTERS))
    large = len(data) - len(data.translate(None, LETTERS[:26]))
    return _bucket(f"capitals {10 * large // (len(data) - rest) if len(data) > rest else 'none'}")


def features(text: str | None) -> np.ndarray:
    words = set(TOKEN.findall((text or "").lower()))
    found = {f for w in words for f in word_features(w)}
    found.add(capitals(text or ""))
    return np.sort(np.fromiter(found, np.int32, len(found)))


@dataclass
class Link:
    """One category's model: weights of kept features, of earlier probabilities, and a bias."""

    kept: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def odds(self, present: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Log odds from the sum of present weights and the earlier probabilities."""
        return present + before @ self.earlier + self.bias


@dataclass
class Chain:
    categories: tuple[str, ...]
    links: list[Link] = field(default_factory=list)
    threshold: float = 2.0

    def table(self) -> dict[int, tuple[float, ...]]:
        """Weights in each link of every feature that any link keeps."""
        made: dict[int, list[float]] = {}
        for k, link in enumerate(self.links):
            for f, w in zip(link.kept.tolist(), link.weights.tolist()):
                made.setdefault(f, [0.0] * len(self.links))[k] = w
        return {f: tuple(w) for f, w in made.items()}


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_link(rows, index, names, n, y, before) -> Link:
    """Ridge logistic regression over kept present features and earlier probabilities.

    ``rows, index`` are the present features: their text, and their place in ``names``.
    """
    share = y.mean() if n else 0.0
    if share in (0.0, 1.0):
        return Link(np.zeros(0, np.int32), np.zeros(0), np.zeros(before.shape[1]), 40.0 if share else -40.0)
    seen = np.bincount(index, minlength=len(names))
    with_y = np.bincount(index, weights=y[rows], minlength=len(names))
    leaning = np.abs(with_y - seen * share) / np.sqrt(np.maximum(seen, 1) * share * (1 - share))
    keep = (leaning >= LEAST_LEANING) & (seen >= LEAST_ROWS)
    number = np.cumsum(keep) - 1
    inside = keep[index]
    r, c = rows[inside], number[index[inside]]
    m, d = int(keep.sum()), before.shape[1]
    theta = np.zeros(m + d + 1)
    pace = np.full(len(theta), 1e-8)
    for _ in range(STEPS):
        odds = np.bincount(r, weights=theta[c], minlength=n) + before @ theta[m : m + d] + theta[-1]
        miss = _sigmoid(odds) - y
        slope = np.concatenate([np.bincount(c, weights=miss[r], minlength=m), before.T @ miss, [miss.sum()]])
        slope[:-1] += RIDGE * theta[:-1]
        pace += slope * slope
        theta -= 0.5 * slope / np.sqrt(pace)
    return Link(names[keep].astype(np.int32), theta[:m], theta[m : m + d], float(theta[-1]))


def _present(link: Link, rows, cols, n) -> np.ndarray:
    at = np.searchsorted(link.kept, cols)
    at[at == len(link.kept)] = 0
    hit = link.kept[at] == cols if len(link.kept) else np.zeros(len(cols), bool)
    return np.bincount(rows[hit], weights=link.weights[at[hit]] if len(link.kept) else None, minlength=n)


def fit_chain(found: list[np.ndarray], labels: np.ndarray, fold: np.ndarray, categories) -> Chain:
    """``labels``: a row of 0/1 for each text, in the order of ``categories``."""
    n = len(found)
    cols = np.concatenate(found) if n else np.zeros(0, np.int32)
    rows = np.repeat(np.arange(n), [len(f) for f in found])
    often = np.bincount(cols, minlength=1 << BITS) >= LEAST_ROWS
    names = np.flatnonzero(often)
    rows, index = rows[often[cols]], (np.cumsum(often) - 1)[cols[often[cols]]]
    chain = Chain(tuple(categories))
    before = np.zeros((n, 0))
    odds = np.zeros(n)
    for k in range(len(categories)):
        y = labels[:, k].astype(float) if n else np.zeros(0)
        odds = np.zeros(n)
        for f in np.unique(fold):
            out = fold == f
            held = out[rows]
            number, place = np.cumsum(~out) - 1, np.cumsum(out) - 1
            link = fit_link(number[rows[~held]], index[~held], names, int((~out).sum()), y[~out], before[~out])
            present = _present(link, place[rows[held]], names[index[held]], int(out.sum()))
            odds[out] = link.odds(present, before[out])
        chain.links.append(fit_link(rows, index, names, n, y, before))
        before = np.c_[before, _sigmoid(odds)]
    chain.threshold = best_threshold(_sigmoid(odds), labels[:, -1] if n else np.zeros(0))
    return chain


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Where to cut: the lowest of the places whose F0.5 is within ``NEARLY`` of the best.

    Precision weighs more than recall, as clean text is to stay; among places that are nearly
    equal in this, the lowest catches most. (A choice by the widest gap between two
    predictions changed with the draw of the folds.)
    """
    if not len(y) or y.min() == y.max():
        return 2.0
    order = np.argsort(-p, kind="stable")
    p, y = p[order], y[order]
    gap = p - np.r_[p[1:], 0.0]
    right = np.cumsum(y)
    measure = np.where(gap > 0, 1.25 * right / (np.arange(1, len(y) + 1) + 0.25 * y.sum()), -1)
    k = int(np.flatnonzero(measure >= measure.max() - NEARLY)[-1])
    return float(p[k] - gap[k] / 2)


def _numbered(batches):
    for batch in batches:
        for part, _ in text_pieces(batch, 1, 4 << 20):
            yield part


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], most: int = LABELLED_MOST) -> Chain:
    """Fit the chain on at most ``most`` labelled documents; ``categories``: name -> 0/1 column."""
    of = [c.cast("int").alias(f"category_{k}") for k, c in enumerate(categories.values())]
    known = labels.select(F.col("doc_id").cast("long").alias("id"), *of).dropna()
    known = known.groupBy("id").agg(*(F.max(f"category_{k}").alias(f"category_{k}") for k in range(len(of))))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(most)
    names = [f"category_{k}" for k in range(len(of))]
    chosen = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(sample), "id")
    # equal texts share a fold, or a copy would be predicted by a model that has seen it
    names.append("fold")
    chosen = chosen.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int")).select("id", "text", *names)

    def extract(batches):
        for part in _numbered(batches):
            found = [features(t).tobytes() for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(found, pa.binary()), *part.columns[2:]], ["id", "found", *names]
            )

    shape = "id long, found binary, " + ", ".join(f"{n} int" for n in names)
    # rows that share an id are one labelled document: the bound is on ids, and none outweighs others
    single = chosen.mapInArrow(extract, shape).groupBy("id", *names).agg(F.min("found").alias("found"))
    ready = written(single.select("id", "found", *names), "labelled-features")
    kinds = tuple(categories)

    def fit(batches):
        ids, found, y, fold = [], [], [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            found += [np.frombuffer(b, np.int32) for b in batch.column(1).to_pylist()]
            y.append(np.column_stack([c.to_numpy() for c in batch.columns[2:-1]]))
            fold += batch.column(len(kinds) + 2).to_pylist()
        order = np.argsort(np.array(ids, np.int64), kind="stable")
        y = np.concatenate(y)[order] if y else np.zeros((0, len(kinds)))
        of_row = np.array([fold[i] for i in order], np.int64)
        chain = fit_chain([found[i] for i in order], y, of_row, kinds)
        rows = [(k, int(f), float(w)) for k, x in enumerate(chain.links) for f, w in zip(x.kept, x.weights)]
        rows += [(k, -1 - j, float(w)) for k, x in enumerate(chain.links) for j, w in enumerate(x.earlier)]
        rows += [(k, -100, x.bias) for k, x in enumerate(chain.links)] + [(-1, -100, chain.threshold)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["link", "place", "value"])

    # one task: the sample is bounded by ``most`` rows of features
    rows = ready.repartition(1).mapInArrow(fit, "link long, place long, value double").collect()
    return chain_from(rows, kinds)


def chain_from(rows, categories) -> Chain:
    chain = Chain(tuple(categories))
    for k in range(len(categories)):
        own = sorted((r.place, r.value) for r in rows if r.link == k)
        kept = [(p, v) for p, v in own if p >= 0]
        earlier = [v for p, v in reversed(own) if -100 < p < 0]
        chain.links.append(
            Link(
                np.array([p for p, _ in kept], np.int32), np.array([v for _, v in kept]),
                np.array(earlier), next((v for p, v in own if p == -100), -40.0),
            )
        )
    chain.threshold = next((r.value for r in rows if r.link == -1), 2.0)
    return chain


class Scorer:
    """Probabilities of a text's categories; remembers which words matter."""

    def __init__(self, chain: Chain):
        self.chain, self.table = chain, chain.table()
        self.words: dict[str, tuple[int, ...] | None] = {}

    def _weighed(self, word: str):
        made = tuple(f for f in word_features(word) if f in self.table) or None
        if len(self.words) < REMEMBERED:
            self.words[word] = made
        return made

    def probabilities(self, text: str | None) -> list[float]:
        text = text or ""
        known = self.words
        found = set()
        for word in set(TOKEN.findall(text.lower())):
            weighed = known[word] if word in known else self._weighed(word)
            if weighed:
                found.update(weighed)
        found.add(capitals(text))
        present = np.zeros(len(self.chain.links))
        for f in sorted(found):
            if f in self.table:
                present += self.table[f]
        made: list[float] = []
        for k, link in enumerate(self.chain.links):
            made.append(float(_sigmoid(present[k] + np.dot(made, link.earlier) + link.bias)))
        return made


def verdict(text: Column, chain: Chain) -> Column:
    """A struct of the probability ``p_<category>`` of each category, and ``rejected``.

    Only the text goes to Python; the rest of a row waits for it on the JVM's side.
    """
    shared = SparkSession.getActiveSession().sparkContext.broadcast(chain)
    shape = StructType([StructField(f"p_{c}", DoubleType()) for c in chain.categories])
    shape = shape.add("rejected", BooleanType())

    @F.arrow_udf(shape)
    def judge(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for batch in texts:
            p = [scorer.probabilities(t.as_py()) for t in batch]
            cols = [pa.array(c, pa.float64()) for c in zip(*p)] or [pa.array([], pa.float64())] * (len(shape) - 1)
            cols.append(pa.array([x[-1] >= scorer.chain.threshold for x in p], pa.bool_()))
            yield pa.StructArray.from_arrays(cols, shape.names)

    return judge(text)


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` with ``p_<category>`` for each category and ``rejected``, in place of columns of these names."""
    names = [*(f"p_{c}" for c in chain.categories), "rejected"]
    made = docs.withColumn(VERDICT, verdict(docs["text"], chain)).drop(*names)
    return made.withColumns({n: F.col(VERDICT)[n] for n in names}).drop(VERDICT)


def without_rejected(docs: DataFrame, chain: Chain) -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, as they are."""
    return docs.filter(~verdict(docs["text"], chain)["rejected"])


def categories_of_labels() -> dict[str, Column]:
    """The chain over the given labels: unusable text first, then toxic text."""
    return {"junk": 1 - F.col("quality"), "toxic": F.col("toxic")}


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities and verdict for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    chain = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), categories_of_labels())
    return score(docs, chain).select(
        "doc_id", F.round("p_junk", 6).alias("p_junk"), F.round("p_toxic", 6).alias("p_toxic"),
        F.col("rejected").alias("toxic"),
    )
