"""How far the term frequencies of sources differ, by a frequent-pattern tree of term rows.

Within each language, every source gives every kept term (one in at least ``LEAST_DOCUMENTS``
documents of the language) a smoothed share ``p = 1 + floor(SCALE * (count + 1) / (N + V))``: V
kept terms, N occurrences of them in the source. The divergence of a source from another one is
the sum over all kept terms of ``f(p, q) = floor((p - q) ** 2 / q)``, all in integers.

Most terms occur in few sources, so the sum over V terms is not made term by term:

* With all counts zero it would be ``V * f(p0, q0)``, p0 and q0 being the shares of count 0.
* A term that one of the two has adds ``f(p, q0) - f(p0, q0)`` or ``f(p0, q) - f(p0, q0)``. Terms of
  one share in a source are alike, so this is done once for each share that occurs.
* A term that both have adds ``f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)``. These *pair corrections*
  come from the tree. A term's row is its nonzero counts in order of sources, those with the most
  terms first; equal rows are one row with a multiplicity. Rows that begin alike share a path, and
  a node's multiplicity is that of all rows through it, so each node and each of its ancestors give
  one correction, times the multiplicity of the node, whatever number of terms pass through.

Rows are dealt to tasks in sorted order (by ranges, so a frequent beginning is spread), and a
task needs only the rows of its batch: a node is a run of rows with a common beginning. A node that
batches share is counted in each with that batch's multiplicity, which adds up to the same.
Corrections are added up in a task before they are shuffled, in 64 bits where these are proven to
suffice and in Python integers otherwise.

A source's counts are added up in tasks first, so a source or a language that holds a third of all
rows is no hot spot. Null text, lang and source count as ''. Every document is a row of its own,
whether its id is null or repeats; ids are not looked at. Other columns are not looked at either. A
group without terms has p = 1 + floor(SCALE / V); without any kept term its values are 0. Equal
values are ranked by item. An empty table gives no rows. A term of any length stays whole.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import text_pieces, written

SCALE = 1_000_000_000
LEAST_DOCUMENTS = 3
TOP_TERMS = 200
#: Terms that a task counts before it sends them on, and bytes of text it takes at a time.
HELD_TERMS = 400_000
CHUNK_BYTES = 4 << 20
#: Node-ancestor combinations that a task works on at a time.
COMBINATIONS = 1 << 20
#: Letters A-Z in lower case, other letters and all bytes from 0x80 as they are, the rest blank.
TERM_BYTES = bytes(
    c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


COUNTS = "lang string, source string, term string, n long, d long"


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, d``: occurrences of a term in a group, and documents that hold it."""

    def run(batches):
        held: dict[tuple, Counter] = defaultdict(Counter)
        having: dict[tuple, Counter] = defaultdict(Counter)

        def rows():
            cols = [[], [], [], [], []]
            for (lang, source), counts in held.items():
                d = having[lang, source]
                cols[0] += [lang] * len(counts)
                cols[1] += [source] * len(counts)
                cols[2] += [t.decode() for t in counts]
                cols[3] += counts.values()
                cols[4] += [d[t] for t in counts]
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            for a in range(0, len(cols[0]), 50_000):
                part = [pa.array(c[a : a + 50_000], k) for c, k in zip(cols, kinds)]
                yield pa.RecordBatch.from_arrays(part, ["lang", "source", "term", "n", "d"])

        for batch in batches:
            for piece, _ in text_pieces(batch, 2, CHUNK_BYTES):
                for lang, source, text in zip(*(c.to_pylist() for c in piece.columns)):
                    counts = Counter(terms_of(text))
                    held[lang, source].update(counts)
                    having[lang, source].update(counts.keys())
                if sum(map(len, held.values())) > HELD_TERMS:
                    yield from rows()
                    held.clear()
                    having.clear()
        yield from rows()

    texts = docs.select(*_group(docs), F.coalesce(docs["text"], F.lit("")).cast("binary").alias("text"))
    parts = texts.mapInArrow(run, COUNTS)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def _group(docs: DataFrame) -> list[Column]:
    return [F.coalesce(docs[c], F.lit("")).alias(c) for c in ("lang", "source")]


def share(count: Column, total: Column, kept: Column) -> Column:
    """p of a term; decimals, as the product may pass 64 bits."""
    top = (count + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.when(kept > 0, F.call_function("div", top, (total + kept).cast("decimal(20,0)")) + 1)


def gap(p: Column, q: Column) -> Column:
    """f: both are at most SCALE + 1, so the square is below 64 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def f_of(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


PATHS = "lang string, a int, b int, ab string, ba string"


def paths_of(offsets: np.ndarray, ranks: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """For sorted rows of (rank, share): how many leading elements each shares with the one before."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    common = np.zeros(n, np.int64)
    alike = np.arange(1, n)
    depth = 0
    while len(alike):
        alike = alike[(sizes[alike] > depth) & (sizes[alike - 1] > depth)]
        here, there = offsets[alike] + depth, offsets[alike - 1] + depth
        alike = alike[(ranks[here] == ranks[there]) & (shares[here] == shares[there])]
        depth += 1
        common[alike] = depth
    return common


def nodes_of(sizes: np.ndarray, common: np.ndarray, times: np.ndarray):
    """The tree's nodes: (row that makes it, depth from 0, multiplicity).

    A row makes the nodes below what it shares with the row before. The one at a depth lives on
    until a row that shares no more than that depth.
    """
    total = np.r_[0, np.cumsum(times)]
    rows, depths, counts = [], [], []
    for depth in range(int(sizes.max(initial=0))):
        cuts = np.flatnonzero(common <= depth)
        made = total[np.r_[cuts[1:], len(sizes)]] - total[cuts]
        real = sizes[cuts] > depth
        rows.append(cuts[real])
        counts.append(made[real])
        depths.append(np.full(int(real.sum()), depth))
    if not rows:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in (rows, depths, counts))


def corrections(offsets, ranks, shares, none, times) -> dict[tuple[int, int], list[int]]:
    """Pair corrections of sorted rows: ``{(a, b): [of a against b, of b against a]}``, a before b."""
    made: dict[tuple[int, int], list[int]] = defaultdict(lambda: [0, 0])
    rows, depths, counts = nodes_of(np.diff(offsets), paths_of(offsets, ranks, shares), times)
    at = np.r_[0, np.cumsum(depths)]
    first = 0
    while first < len(rows):
        end = max(first + 1, int(np.searchsorted(at, at[first] + COMBINATIONS, side="right")) - 1)
        k = depths[first:end]
        node = np.repeat(offsets[rows[first:end]] + k, k)
        ancestor = np.arange(len(node)) - np.repeat(at[first:end] - at[first], k) + np.repeat(
            offsets[rows[first:end]], k
        )
        m = np.repeat(counts[first:end], k)
        p, p0, q, q0 = shares[ancestor], none[ancestor], shares[node], none[node]
        zero = f_of(p0, q0), f_of(q0, p0)
        two = (
            f_of(p, q) - f_of(p, q0) - f_of(p0, q) + zero[0],
            f_of(q, p) - f_of(q, p0) - f_of(q0, p) + zero[1],
        )
        order = np.lexsort((ranks[node], ranks[ancestor]))
        a, b, m = ranks[ancestor][order], ranks[node][order], m[order]
        cuts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else []
        for side, value in enumerate(two):
            value = value[order]
            if len(value) and int(np.abs(value).max()) * int(m.sum()) >= 2**63:
                value, weight = value.astype(object), m.astype(object)
            else:
                weight = m
            for c, s in zip(cuts, np.add.reduceat(value * weight, cuts) if len(cuts) else ()):
                made[int(a[c]), int(b[c])][side] += int(s)
        first = end
    return made


def pair_corrections(paths: DataFrame) -> DataFrame:
    """``lang, a, b, ab, ba`` (ranks; sums of corrections) from ``lang, path, times``."""

    def run(batches):
        made: dict[str, dict] = defaultdict(lambda: defaultdict(lambda: [0, 0]))
        for batch in batches:
            langs = batch.column(0).to_pylist()
            path = batch.column(1)
            ends = path.offsets.to_numpy().astype(np.int64)
            rank, p, p0 = (path.values.field(k).to_numpy() for k in range(3))
            times = batch.column(2).to_numpy()
            bounds = [k for k in range(len(langs)) if not k or langs[k] != langs[k - 1]] + [len(langs)]
            for x, y in zip(bounds, bounds[1:]):
                for key, (ab, ba) in corrections(ends[x : y + 1], rank, p, p0, times[x:y]).items():
                    both = made[langs[x]][key]
                    both[0] += ab
                    both[1] += ba
        rows = [(lang, *key, *map(str, both)) for lang, found in made.items() for key, both in found.items()]
        for k in range(0, len(rows), 50_000):
            cols = list(zip(*rows[k : k + 50_000]))
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds)], ["lang", "a", "b", "ab", "ba"]
            )

    parts = paths.select("lang", "path", "times").mapInArrow(run, PATHS)
    return parts.groupBy("lang", "a", "b").agg(
        *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("ab", "ba")]
    )


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: every other source of the language by divergence from it. Part ``term``: the
    terms that the source has more often than the whole language, the ``top`` with the largest f.
    """
    counts = written(term_counts(docs), "term-counts")
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("d").alias("all_d"))
    kept = counts.join(terms.filter(F.col("all_d") >= least).drop("all_d"), ["lang", "term"]).drop("d")
    kept = written(kept, "kept-terms")
    # one row for each group: as many as there are sources
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    langs = kept.groupBy("lang", "term").agg(F.first("all_n").alias("n")).groupBy("lang").agg(
        F.count("*").alias("v"), F.sum("n").alias("lang_total")
    )
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "terms", "v", "lang_total")]
    by_size = Window.partitionBy("lang").orderBy(F.col("terms").desc(), "source")
    groups = (
        docs.select(*_group(docs)).distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *zero)
        .withColumn("rank", F.row_number().over(by_size))
        .withColumn("p0", share(F.lit(0), F.col("total"), F.col("v")))
    )
    groups = written(groups, "groups")
    entries = kept.join(groups.drop("terms"), ["lang", "source"]).withColumn(
        "p", share(F.col("n"), F.col("total"), F.col("v"))
    )
    entries = written(
        entries.select(
            "lang", "source", "term", "rank", "p", "p0",
            share(F.col("all_n"), F.col("lang_total"), F.col("v")).alias("q"),
        ),
        "shares",
    )
    return _ranked_pairs(groups, entries).unionByName(_ranked_terms(entries, top))


def _ranked_terms(entries: DataFrame, top: int) -> DataFrame:
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    above = entries.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        gap(F.col("p"), F.col("q")).alias("value"),
    )
    return above.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)


def _ranked_pairs(groups: DataFrame, entries: DataFrame) -> DataFrame:
    wide = "decimal(38,0)"
    rows = entries.groupBy("lang", "term").agg(
        F.sort_array(F.collect_list(F.struct("rank", "p", "p0"))).alias("path")
    )
    rows = rows.filter(F.size("path") > 1)
    rows = written(rows.groupBy("lang", "path").agg(F.count("*").alias("times")), "term-rows")
    ordered = rows.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    both = written(pair_corrections(ordered), "pair-corrections")
    two = both.select("lang", "a", "b", F.col("ab").alias("v")).union(both.select("lang", "b", "a", "ba"))

    me = groups.select("lang", F.col("rank").alias("a"), "source", "v", F.col("p0").alias("p"))
    other = groups.select("lang", F.col("rank").alias("b"), F.col("source").alias("item"), F.col("p0").alias("q"))
    base = me.join(other, "lang").filter("a <> b").select(
        "lang", "a", "b",
        F.coalesce(F.col("v").cast("decimal(19,0)") * gap(F.col("p"), F.col("q")), F.lit(0)).cast(wide).alias("v"),
    )
    # the shares that occur in a group, dealt by share as well: a language may hold most of them
    salts = 32
    alike = entries.groupBy("lang", "rank", "p", "p0").agg(F.count("*").cast("decimal(19,0)").alias("times"))
    alike = alike.withColumn("salt", F.pmod(F.hash("rank", "p"), F.lit(salts)))
    against = groups.select(
        "lang", F.col("rank").alias("other"), F.col("p0").alias("q0"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
    )
    one = (
        alike.join(against, ["lang", "salt"]).filter("other <> rank")
        .groupBy("lang", "rank", "other")
        .agg(
            *[
                F.sum(F.col("times") * (gap(x, y) - gap(x0, y0))).cast(wide).alias(name)
                for name, x, y, x0, y0 in (
                    ("has", F.col("p"), F.col("q0"), F.col("p0"), F.col("q0")),
                    ("had", F.col("q0"), F.col("p"), F.col("q0"), F.col("p0")),
                )
            ]
        )
    )
    parts = (
        base.union(two)
        .union(one.select("lang", "rank", "other", "has"))
        .union(one.select("lang", "other", "rank", "had"))
    )
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("v").cast("long").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return (
        sums.join(me.select("lang", "a", "source"), ["lang", "a"])
        .join(other.select("lang", "b", "item"), ["lang", "b"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
        .withColumn("rank", F.row_number().over(best))
    )


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS body
    FROM documents
),
words AS (
    SELECT k, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT k) >= 3),
langs AS (SELECT lang, count(*)::BIGINT AS v, sum(n)::BIGINT AS total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
    SELECT g.lang, g.source, coalesce(sum(c.n), 0)::BIGINT AS total
    FROM (SELECT DISTINCT lang, source FROM docs) AS g LEFT JOIN counts AS c USING (lang, source)
    GROUP BY g.lang, g.source
),
shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (g.total + l.v) AS p,
           1 + (1000000000 * (k.n + 1)) // (l.total + l.v) AS q
    FROM groups AS g JOIN langs AS l USING (lang) JOIN kept AS k USING (lang)
    LEFT JOIN counts AS c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM shares AS a JOIN shares AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
),
made AS (
    SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(p.value, 0)::BIGINT AS value
    FROM groups AS g JOIN groups AS o ON g.lang = o.lang AND g.source <> o.source
    LEFT JOIN pairs AS p ON p.lang = g.lang AND p.source = g.source AND p.item = o.source
    UNION ALL
    SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, rank::INT AS rank
FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM made
)
WHERE part = 'pair' OR rank <= 200
"""
