"""Ranked lexical search: the best documents for each item, by length-ordered impact vectors.

A document is a sparse vector of *impacts*: for each term of the items that it holds, the weight
of the term times its saturated, length-normalised frequency, in integers. An item is the 0/1 vector
of its terms, so a score is an inner product. As in LEMP, large inner products need long vectors:

1. *Vectors.* Every whole text is split into terms once; of each document its terms that occur in
   the items are kept, and the statistics of the whole table are added up.
2. *Order by length.* Each task sorts its vectors by Euclidean length and cuts them into buckets of
   ``BUCKET`` vectors. (Every task has its share of long ones, so none gets all the hard work.)
3. *Buckets.* By Cauchy-Schwarz no score in a bucket exceeds the length of the item times that of the
   bucket's longest vector. If this is below an item's threshold, the bucket is skipped for it.
4. *Coordinates.* Inside, the item's weightiest terms (its focus, ``FOCUS`` of them) are looked up in the
   bucket's lists. What the other terms can add is at most the length of that part of the item times
   what the focus leaves of the vector's length. Vectors whose bound is below the threshold go.
5. *Survivors* are scored exactly, in integers, over all terms. The best ``top`` of an item in a task
   set its threshold there; at first it is the one that the longest vectors of all tables set
   (``SEEDS``, a first search over these alone).

A vector that is skipped has a score below that of ``top`` others, so the result is exact; vectors
whose bound equals the threshold stay, since equal scores are ordered by id. Bounds are doubles with a
margin for rounding.

Items are taken in blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_TERMS`` terms (one item with more
makes its own block); only one block's terms, weights and thresholds are in a worker. Documents
are never gathered: a task sends at most ``top`` rows of an item.

A null or empty text has no term: it is not counted and never found; such an item finds nothing. Each
row of the items is an item of its own and gives its own rows, whether its id is null or repeats. So is
each document; a null id precedes others, and equal rows share a score and take a rank each. Empty tables
give no rows. Other columns are not looked at. Texts of any length are read whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NO_ID, text_pieces, written

TOP = 50
BUCKET = 8192
FOCUS = 12
#: The longest vectors, about so many, set the first thresholds.
SEEDS = 20_000
BLOCK_ITEMS, BLOCK_TERMS = 2_000, 100_000
CHUNK_BYTES = 4 << 20
#: Letters A-Z in lower case, other letters, digits and all bytes from 0x80 as they are, the rest blank.
TERM_BYTES = bytes(
    c if c >= 0x80 or 0x61 <= c <= 0x7A or 0x30 <= c <= 0x39 else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


@dataclass(frozen=True)
class Block:
    """Some items: their terms by number, and each item's numbers."""

    first: int
    ids: list
    terms: dict[bytes, int]
    items: list[list[int]]


def blocks(items: DataFrame, most_items: int | None = None, most_terms: int | None = None) -> Iterator[Block]:
    """The items, a block at a time; a block's terms are all that the driver holds of them."""
    most_items, most_terms = most_items or BLOCK_ITEMS, most_terms or BLOCK_TERMS
    first, ids, terms, made = 0, [], {}, []
    for item, text in items.select("item_id", "text").toLocalIterator():
        found = sorted(set(terms_of((text or "").encode())))
        if ids and (len(ids) >= most_items or len(terms) + len(found) > most_terms):
            yield Block(first, ids, terms, made)
            first, ids, terms, made = first + len(ids), [], {}, []
        ids.append(item)
        made.append([terms.setdefault(t, len(terms)) for t in found])
    if ids:
        yield Block(first, ids, terms, made)


VECTORS = "doc_id long, n long, terms array<int>, counts array<long>"


def vectors(docs: DataFrame, block: Block) -> DataFrame:
    """Each document's number of terms, and its terms of the block with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(block.terms)

    def run(batches):
        known = shared.value
        for batch in batches:
            for piece, _ in text_pieces(batch, 1, CHUNK_BYTES):
                sizes, ends, terms, counts = [], [0], [], []
                for text in piece.column(1).to_pylist():
                    words = terms_of(text)
                    sizes.append(len(words))
                    held = Counter(words)
                    for t in held.keys() & known.keys():
                        terms.append(known[t])
                        counts.append(held[t])
                    ends.append(len(terms))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0), pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
                    ],
                    ["doc_id", "n", "terms", "counts"],
                )

    text = F.coalesce(docs["text"], F.lit("")).cast("binary").alias("text")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text).mapInArrow(run, VECTORS)


@dataclass(frozen=True)
class Statistics:
    """Of the whole table: documents with terms, all their terms, and the weight of each term."""

    documents: int
    total: int
    weights: np.ndarray


def statistics(made: DataFrame, n_terms: int) -> Statistics:
    documents, total = made.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(n_terms, np.int64)
    # one row for each term of the block
    for term, df in made.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[term] = floor(1000 * log((2 * documents + 2) / (2 * df + 1)))
    return Statistics(documents, total, weights)


def impacts(n: np.ndarray, ends: np.ndarray, terms: np.ndarray, counts: np.ndarray, s: Statistics) -> np.ndarray:
    """What each term adds to a score; ``n`` of each document, the rest of each of their terms."""
    wide = n.astype(object) if len(n) and 50 * int(n.max()) * s.documents >= 2**63 else n
    m = 50 + ((50 * wide * s.documents) // max(s.total, 1)).astype(np.int64)
    m = np.repeat(m, np.diff(ends))
    return s.weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 20 * m))


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, terms, counts) of a batch, from 0."""
    terms, counts = batch.column("terms"), batch.column("counts")
    ends = terms.offsets.to_numpy().astype(np.int64)
    where = slice(int(ends[0]), int(ends[-1]))
    other = counts.offsets.to_numpy()
    there = slice(int(other[0]), int(other[-1]))
    return ends - ends[0], terms.values.to_numpy()[where], counts.values.to_numpy()[there]


def with_length(made: DataFrame, s: Statistics) -> DataFrame:
    """Vectors that are not zero, with the impact of each term and their Euclidean length."""
    shared = made.sparkSession.sparkContext.broadcast(s)

    def run(batches):
        for batch in batches:
            ends, terms, counts = _flat(batch)
            made = impacts(batch.column("n").to_numpy(), ends, terms, counts, shared.value)
            sums = np.r_[0.0, np.cumsum(made.astype(float) ** 2)]
            length = np.sqrt(sums[ends[1:]] - sums[ends[:-1]])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(length),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(made, pa.int64())),
                ],
                ["doc_id", "length", "terms", "counts"],
            )

    shape = "doc_id long, length double, terms array<int>, counts array<long>"
    held = made.filter(F.size("terms") > 0).mapInArrow(run, shape)
    return held.sortWithinPartitions(F.col("length").desc())


class Bucket:
    """Vectors by term: for each, the rows that have it and their impacts."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, ends, terms, impacts, n_terms: int):
        self.ids, self.lengths = ids, lengths
        self.longest = float(lengths.max())
        rows = np.repeat(np.arange(len(ids)), np.diff(ends))
        order = np.argsort(terms, kind="stable")
        self.rows, self.impacts = rows[order], impacts[order]
        self.floats = self.impacts.astype(float)
        self.starts = np.searchsorted(terms[order], np.arange(n_terms + 1))

    def listed(self, terms: np.ndarray) -> np.ndarray:
        """Places of the list entries of some terms."""
        a, b = self.starts[terms], self.starts[terms + 1]
        sizes = b - a
        return np.repeat(a - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))

    def bounds(self, focus: np.ndarray, rest: int) -> np.ndarray:
        """No score is above: what the focus gives, and ``rest`` more terms in what is left of the length."""
        at = self.listed(focus)
        n = len(self.ids)
        sums = np.bincount(self.rows[at], self.floats[at], n)
        squares = np.bincount(self.rows[at], self.floats[at] ** 2, n)
        left = np.sqrt(np.maximum(self.lengths**2 * (1 + 1e-9) - squares, 0))
        return (sums + sqrt(rest) * left) * (1 + 1e-9) + 1

    def scores(self, terms: np.ndarray, keep: np.ndarray) -> np.ndarray:
        """Exact scores of the marked rows."""
        at = self.listed(terms)
        at = at[keep[self.rows[at]]]
        made = np.zeros(len(self.ids), np.int64)
        np.add.at(made, self.rows[at], self.impacts[at])
        return made


def _best(ids: np.ndarray, scores: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:top]
    return ids[order], scores[order]


def _buckets(batches, n_terms: int) -> Iterator[Bucket]:
    held, n = [], 0

    def made():
        flat = [_flat(b) for b in held]
        bases = np.cumsum([0, *(int(f[0][-1]) for f in flat)])
        ends = np.concatenate([[0], *(f[0][1:] + base for f, base in zip(flat, bases))])
        ids, lengths = (
            np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in ("doc_id", "length")
        )
        return Bucket(ids, lengths, ends, *(np.concatenate([f[k] for f in flat]) for k in (1, 2)), n_terms)

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            piece = batch.slice(at, BUCKET - n)
            held.append(piece)
            n += piece.num_rows
            at += piece.num_rows
            if n == BUCKET:
                yield made()
                held, n = [], 0
    if held:
        yield made()


HITS = "item int, doc_id long, score long"


def search(found: DataFrame, block: Block, s: Statistics, least: np.ndarray, top: int) -> DataFrame:
    """Up to ``top`` rows of an item from each task; none of those has a score below ``least``."""
    items = []
    for terms in block.items:
        terms = np.array(terms, np.int64)
        terms = terms[np.argsort(-s.weights[terms], kind="stable")] if len(terms) else terms
        items.append(terms)
    shared = found.sparkSession.sparkContext.broadcast((items, least))
    n_terms = len(block.terms)

    def run(batches):
        items, least = shared.value
        floors = least.copy()
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(items)
        for bucket in _buckets(batches, n_terms):
            for i, terms in enumerate(items):
                if sqrt(len(terms)) * bucket.longest * (1 + 1e-9) + 1 < floors[i]:
                    continue
                keep = bucket.bounds(terms[:FOCUS], max(0, len(terms) - FOCUS)) >= floors[i]
                if not keep.any():
                    continue
                scores = bucket.scores(terms, keep)
                rows = np.flatnonzero(scores >= max(1, floors[i]))
                if not len(rows):
                    continue
                ids, old = best[i]
                best[i] = _best(np.r_[ids, bucket.ids[rows]], np.r_[old, scores[rows]], top)
                if len(best[i][1]) == top:
                    floors[i] = max(floors[i], int(best[i][1][-1]))
        item = np.repeat(np.arange(len(best), dtype=np.int32), [len(b[0]) for b in best])
        if len(item):
            yield pa.RecordBatch.from_arrays(
                [pa.array(item), *(pa.array(np.concatenate([b[k] for b in best])) for k in (0, 1))],
                ["item", "doc_id", "score"],
            )

    return found.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "length", "terms", "counts").mapInArrow(
        run, HITS
    )


def ranked(hits: DataFrame, top: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)


def best_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: of each item the ``top`` documents with a score above 0."""
    spark = docs.sparkSession
    shape = f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long"
    out = None
    for block in blocks(items):
        made = written(vectors(docs, block), "vectors")
        s = statistics(made, len(block.terms))
        found = written(with_length(made, s), "lengths")
        least = np.zeros(len(block.items), np.int64)
        n = found.count()
        if n > 2 * SEEDS:
            cut = found.approxQuantile("length", [1 - SEEDS / n], 0.1 * SEEDS / n)[0]
            first = ranked(search(found.filter(F.col("length") >= cut), block, s, least, top), top)
            # one number for each item of the block
            for item, score in first.filter(F.col("rank") == top).select("item", "score").collect():
                least[item] = score
        hits = ranked(search(found, block, s, least, top), top)
        names = spark.createDataFrame(
            list(enumerate(block.ids)), f"item int, item_id {items.schema['item_id'].dataType.simpleString()}"
        )
        got = hits.join(F.broadcast(names), "item").select(
            "item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score"
        )
        got = written(got, "ranked")
        out = got if out is None else out.union(got)
    return spark.createDataFrame([], shape) if out is None else out


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return best_documents(docs, items)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = "unnest(regexp_extract_all(translate(coalesce(text, ''), '{0}', '{1}'), '{2}'))".format(
    UPPER, LOWER, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
)
ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, text FROM documents),
items AS (SELECT row_number() OVER () AS i, item_id, text FROM benchmark),
wanted AS (SELECT DISTINCT i, item_id, term FROM (SELECT i, item_id, {_TERMS} AS term FROM items)),
words AS (SELECT k, doc_id, {_TERMS} AS term FROM docs),
sizes AS (SELECT k, count(*)::BIGINT AS n FROM words GROUP BY k),
whole AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
counts AS (
    SELECT k, doc_id, term, count(*)::BIGINT AS tf FROM words
    WHERE term IN (SELECT term FROM wanted) GROUP BY k, doc_id, term
),
weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM counts, whole GROUP BY term, n_docs
),
impacts AS (
    SELECT k, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))) AS x
    FROM counts JOIN sizes USING (k) JOIN weights USING (term), whole
),
scores AS (
    SELECT i, item_id, k, doc_id, sum(x)::BIGINT AS score
    FROM wanted JOIN impacts USING (term) GROUP BY i, item_id, k, doc_id
)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (
    SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
)
WHERE rank <= 50
"""
