"""Near duplicates among embeddings by an inverted multi-index.

A vector is split into halves, each with a codebook of its own (k-means on a bounded sample).
The two codebooks span a grid of cells, and every vector lies in the cell of its nearest pair
of centres. To find its neighbours a vector visits cells in order of their distance, by
multi-sequence traversal: the centres of both halves are sorted by distance, and a heap yields
the sums in ascending order. How many cells it visits is set on the sample, so that
``TARGET_RECALL`` of neighbours lie in visited cells: of the neighbours found in the sample, and
of made ones whose cosine is just the threshold. In a visited cell all members are verified by
the cosine in double precision.

The number of centres follows the number of vectors, so a cell holds about ``CELL_ROWS``. A cell
of more than ``BLOCK_ROWS`` is dealt out in blocks of members and of visitors, every pair of
blocks to a task of its own. A task sends one count for each visitor and a spanning forest of
the links, not the pairs. A link that only one side finds counts for both: a member knows the cells
that it visits itself, and where the visitor's cell is not among them, it is counted for the member
too. Equal vectors are one entry of the index with a count.

Vectors that are null, empty or zero, or hold null, NaN or infinite components, link with
nothing; vectors of different lengths do not link. Rows with a null id are named by null and
precede all others as component. Repeated rows are vectors of their own that link with each
other. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NO_ID, components, written

COSINE = 0.95
TARGET_RECALL = 0.9995
SAMPLE_MOST = 8_000
CELL_ROWS = 64
CENTRES_MOST = 256
BLOCK_ROWS = 2048
ROUNDS = 8


def centres(points: np.ndarray, k: int, rng) -> np.ndarray:
    """k-means by Lloyd's steps; a centre that loses all points takes one at random."""
    k = min(k, len(points))
    made = points[rng.choice(len(points), k, replace=False)].copy()
    for _ in range(ROUNDS):
        near = np.argmin(distances(points, made), axis=1)
        for c in range(k):
            own = points[near == c]
            made[c] = own.mean(0) if len(own) else points[rng.integers(len(points))]
    return made


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all centres."""
    return (points**2).sum(1)[:, None] - 2 * points @ to.T + (to**2).sum(1)


def visited(one: np.ndarray, two: np.ndarray, most: int) -> list[int]:
    """The ``most`` nearest cells by multi-sequence traversal; cell = ``i * len(two) + j``.

    A pair of ranks is pushed once both pairs before it are out, so the heap stays small.
    """
    a, b = np.argsort(one, kind="stable").tolist(), np.argsort(two, kind="stable").tolist()
    d, e = one[a].tolist(), two[b].tolist()
    width = len(b)
    heap, out, done = [(d[0] + e[0], 0, 0)], [], set()
    while heap and len(out) < most:
        _, i, j = heapq.heappop(heap)
        out.append(a[i] * width + b[j])
        done.add((i, j))
        if i + 1 < len(a) and (j == 0 or (i + 1, j - 1) in done):
            heapq.heappush(heap, (d[i + 1] + e[j], i + 1, j))
        if j + 1 < width and (i == 0 or (i - 1, j + 1) in done):
            heapq.heappush(heap, (d[i] + e[j + 1], i, j + 1))
    return out


class Grid:
    """Two codebooks and the number of cells to visit, for vectors of one length."""

    def __init__(self, sample: np.ndarray, k: int, cosine: float, recall: float):
        rng = np.random.default_rng(7)
        self.half = sample.shape[1] // 2
        self.one = centres(sample[:, : self.half], k, rng)
        self.two = centres(sample[:, self.half :], k, rng)
        self.cells = len(self.one) * len(self.two)
        self.visits = self._visits(sample, cosine, recall, rng)

    def sums(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return distances(x[:, : self.half], self.one), distances(x[:, self.half :], self.two)

    def own(self, x: np.ndarray) -> np.ndarray:
        one, two = self.sums(x)
        return np.argmin(one, 1) * len(self.two) + np.argmin(two, 1)

    def _ranks(self, x: np.ndarray, of: np.ndarray) -> np.ndarray:
        """How many cells are nearer to each row of ``x`` than the given cell."""
        out = np.empty(len(x), np.int64)
        for at in range(0, len(x), 256):
            one, two = self.sums(x[at : at + 256])
            grid = (one[:, :, None] + two[:, None, :]).reshape(len(one), -1)
            cost = grid[np.arange(len(grid)), of[at : at + 256]]
            out[at : at + 256] = (grid < cost[:, None]).sum(1)
        return out

    def _visits(self, sample, cosine, recall, rng) -> int:
        if self.cells == 1:
            return 1
        aside = rng.standard_normal(sample.shape)
        aside -= (aside * sample).sum(1)[:, None] * sample
        aside /= np.maximum(np.linalg.norm(aside, axis=1), 1e-12)[:, None]
        made = cosine * sample + math.sqrt(1 - cosine**2) * aside
        ranks = [self._ranks(sample, self.own(made))]
        own = self.own(sample)
        for at in range(0, len(sample), 500):
            rows, cols = np.nonzero(sample[at : at + 500] @ sample.T >= cosine)
            keep = np.flatnonzero(rows + at != cols)[:20_000]
            if len(keep):
                ranks.append(self._ranks(sample[rows[keep] + at], own[cols[keep]]))
        need = max(int(np.quantile(r, recall, method="higher")) for r in ranks)
        return min(self.cells, need + 1)


def unit(raw: list[bytes]) -> np.ndarray:
    """Rows of float32 bytes as double-precision unit vectors."""
    x = np.frombuffer(b"".join(raw), "<f4").reshape(len(raw), -1).astype(np.float64)
    x /= np.abs(x).max(1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _distinct(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with the key of their vector, distinct vectors with count and smallest id)."""
    fine = "embedding IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND abs(x) < float('inf')) AND exists(embedding, x -> x <> 0)"
    keyed = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.expr(fine), F.col("embedding").cast("array<float>")).alias("embedding"),
    ).withColumns({"k": F.xxhash64("embedding"), "l": F.xxhash64(F.lit(1), "embedding")})
    keyed = keyed.withColumns({x: F.when(F.col("embedding").isNotNull(), F.col(x)) for x in "kl"})
    distinct = keyed.filter("k is not null").groupBy("k", "l").agg(
        F.min(F.coalesce("vec_id", F.lit(NO_ID))).alias("first"),
        F.count("*").alias("n"),
        F.first("embedding").alias("embedding"),
    )
    return keyed, distinct


def _assigned(distinct: DataFrame, grids: dict[int, Grid]) -> DataFrame:
    shared = distinct.sparkSession.sparkContext.broadcast(grids)

    def run(batches):
        for batch in batches:
            raw = [np.array(x, "<f4").tobytes() for x in batch.column(2).to_pylist()]
            size = np.array([len(r) // 4 for r in raw], np.int64)
            cell = np.zeros(len(raw), np.int64)
            for s in np.unique(size):
                at = np.flatnonzero(size == s)
                cell[at] = shared.value[int(s)].own(unit([raw[i] for i in at]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(raw, pa.binary()), pa.array(size), pa.array(cell)],
                ["k", "n", "raw", "size", "cell"],
            )

    shape = "k long, n long, raw binary, size long, cell long"
    return distinct.select("k", "n", "embedding").mapInArrow(run, shape)


def _visits(assigned: DataFrame, grids: dict[int, Grid], blocks: dict) -> DataFrame:
    """Members and visitors of each (size, cell, block of members, block of visitors)."""
    shared = assigned.sparkSession.sparkContext.broadcast((grids, blocks))
    names = ["place", "visitor", "k", "n", "raw", "cell", "cells"]

    def run(batches):
        grids, blocks = shared.value
        for batch in batches:
            k = batch.column(0).to_numpy()
            n = batch.column(1).to_numpy()
            raw = batch.column(2).to_pylist()
            size, cell = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            out = []
            for s in np.unique(size):
                at = np.flatnonzero(size == s)
                grid = grids[int(s)]
                ones, twos = grid.sums(unit([raw[i] for i in at]))
                for i, one, two in zip(at.tolist(), ones, twos):
                    cells = visited(one, two, grid.visits)
                    spread = blocks[int(s), int(cell[i])]
                    own = int(k[i]) % spread
                    known = np.sort(np.array(cells, "<i4")).tobytes()
                    out += [(f"{s} {cell[i]} {own} {v}", known, i) for v in range(spread)]
                    for c in cells:
                        if spread := blocks.get((int(s), c)):
                            own = int(k[i]) // 7 % spread
                            out += [(f"{s} {c} {m} {own}", None, i) for m in range(spread)]
            for a in range(0, len(out), 20_000):
                part = out[a : a + 20_000]
                rows = np.array([i for _, _, i in part])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p for p, _, _ in part]), pa.array([c is None for _, c, _ in part]),
                        pa.array(k[rows]), pa.array(n[rows]), pa.array([raw[i] for i in rows], pa.binary()),
                        pa.array(cell[rows]), pa.array([c for _, c, _ in part], pa.binary()),
                    ],
                    names,
                )

    shape = "place string, visitor boolean, k long, n long, raw binary, cell long, cells binary"
    return assigned.mapInArrow(run, shape)


def unseen(mask: np.ndarray, cell: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """The links (rows visit, columns are members) that the member does not find by its own visits.

    ``cell`` is the cell of each row, ``cells`` the sorted cells that each column visits.
    """
    cols = np.flatnonzero(mask.any(0))
    there, at = np.unique(cell, return_inverse=True)
    width = max(int(there[-1]), int(cells.max())) + 1
    own = (np.arange(len(cols))[:, None] * width + cells[cols]).ravel()
    asked = np.arange(len(cols))[:, None] * width + there
    sees = own[np.minimum(np.searchsorted(own, asked), len(own) - 1)] == asked
    out = np.zeros(mask.shape, bool)
    out[:, cols] = mask[:, cols] & ~sees[:, at].T
    return out


def forest(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For links between rows and columns: the smallest column of the component of each row and column.

    Rows and columns without links get -1.
    """
    rows, cols = np.flatnonzero(mask.any(1)), np.flatnonzero(mask.any(0))
    part = mask[np.ix_(rows, cols)]
    label = np.arange(len(cols))
    none = len(cols)
    while True:
        of_rows = np.where(part, label, none).min(1, initial=none)
        new = np.where(part, of_rows[:, None], none).min(0, initial=none)
        if (new == label).all():
            break
        label = new
    row_out, col_out = np.full(mask.shape[0], -1), np.full(mask.shape[1], -1)
    row_out[rows], col_out[cols] = cols[of_rows], cols[label]
    return row_out, col_out


def _verified(visits: DataFrame, cosine: float) -> DataFrame:
    """``(a, b, links)``: counts of links (b null), and links enough to join all components."""

    def judged(members, visitors):
        mk, mn, mx, cells = members
        vk, vn, vx, cell = visitors
        mask = (vx @ mx.T >= cosine) & (vk[:, None] != mk)
        if not mask.any():
            return None
        counts = mask @ mn
        of_rows, of_cols = forest(mask)
        r, c = np.flatnonzero(of_rows >= 0), np.flatnonzero(of_cols >= 0)
        back = vn @ unseen(mask, cell, cells)
        f = np.flatnonzero(back)
        a = np.concatenate([vk[r], mk[f], vk[r], mk[c]])
        b = np.concatenate([np.zeros(len(r) + len(f), np.int64), mk[of_rows[r]], mk[of_cols[c]]])
        links = np.concatenate([counts[r], back[f], np.zeros(len(r) + len(c), np.int64)])
        keep = (links > 0) | (a != b)
        return pa.RecordBatch.from_arrays(
            [pa.array(a[keep]), pa.array(b[keep], mask=links[keep] > 0), pa.array(links[keep])], ["a", "b", "links"]
        )

    def run(batches):
        place, held, members = None, [], None
        for batch in batches:
            places = batch.column(0).to_pylist()
            visitor = batch.column(1).to_numpy(zero_copy_only=False)
            k, n = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            raw, cell, cells = batch.column(4).to_pylist(), batch.column(5).to_numpy(), batch.column(6)
            cuts = [i for i in range(1, len(places)) if places[i] != places[i - 1] or visitor[i] != visitor[i - 1]]
            for a, b in zip([0, *cuts], [*cuts, len(places)]):
                if places[a] != place:
                    place, held, members = places[a], [], None
                if not visitor[a]:
                    known = np.frombuffer(b"".join(cells.slice(a, b - a).to_pylist()), "<i4")
                    held.append((k[a:b], n[a:b], unit(raw[a:b]), known.reshape(b - a, -1).astype(np.int64)))
                    continue
                if members is None and held:
                    members = tuple(np.concatenate(x) for x in zip(*held))
                if members is None:
                    continue
                for at in range(a, b, BLOCK_ROWS):
                    end = min(b, at + BLOCK_ROWS)
                    made = judged(members, (k[at:end], n[at:end], unit(raw[at:end]), cell[at:end]))
                    if made is not None:
                        yield made

    sorted_in = visits.repartition("place").sortWithinPartitions("place", "visitor")
    return sorted_in.mapInArrow(run, "a long, b long, links long")


def near_vectors(rows: DataFrame, cosine: float = COSINE, recall: float = TARGET_RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    keyed, distinct = _distinct(rows)
    distinct = written(distinct, "distinct-vectors")
    sizes = {r.size: r.n for r in distinct.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n")).collect()}
    grids = {}
    for size, n in sizes.items():
        sample = distinct.filter(F.size("embedding") == size).orderBy("k").limit(SAMPLE_MOST).select("embedding")
        raw = [np.array(r[0], "<f4").tobytes() for r in sample.collect()]
        k = max(1, min(CENTRES_MOST, math.ceil(math.sqrt(n / CELL_ROWS))))
        grids[size] = Grid(unit(raw), k, cosine, recall)
    assigned = written(_assigned(distinct, grids), "assigned-vectors")
    # at most CENTRES_MOST squared cells for each length
    full = assigned.groupBy("size", "cell").agg(F.count("*").alias("n")).collect()
    blocks = {(r["size"], r.cell): math.ceil(r.n / BLOCK_ROWS) for r in full}
    found = written(_verified(_visits(assigned, grids, blocks), cosine), "vector-links")
    counts = found.filter("b is null").groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "k")
    joined = components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "k")
    nodes = distinct.select("k", "l", "n", "first").join(joined, "k", "left").join(counts, "k", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "k"))
    names = nodes.groupBy("component").agg(F.min("first").alias("least"))
    nodes = nodes.join(names, "component").select(
        "k", "l", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "least"
    )
    made = keyed.select("vec_id", "k", "l").join(nodes, ["k", "l"], "left")
    component = F.when(F.col("least").isNull(), F.col("vec_id")).when(F.col("least") != NO_ID, F.col("least"))
    return made.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op3_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
