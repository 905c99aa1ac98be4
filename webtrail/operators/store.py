"""Stored pages and extractions, and views that join them with the queue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

PAGE_SCHEMA = (
    "id BIGINT, url_id BIGINT, url STRING, html STRING, status_code INT, "
    "content_type STRING, fetched_at TIMESTAMP"
)


def latest_by(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The newest row of every key, a null key being one of them.

    Nulls in ``order`` come first. Rows that are equal in it are told apart by a hash
    of all their columns, and of repeated rows one stays. Only key, order and hash are
    aggregated (combined before the shuffle); the wide rows are then picked by joining on
    all of them, so neither a key with very many versions nor the page text piles up in
    one task.
    """
    marked = df.withColumn("o_", F.struct(*order, F.xxhash64(*df.columns).alias("hash_")))
    newest = marked.groupBy(F.col(key).alias("k_")).agg(F.max("o_").alias("n_"))
    same = F.col(key).eqNullSafe(F.col("k_")) & F.col("o_").eqNullSafe(F.col("n_"))
    picked = marked.join(newest, same, "left_semi").drop("o_")
    return picked.dropDuplicates([key])


def store_latest(stored: DataFrame, incoming: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Stored rows after writing the incoming ones: the latest per key wins, and of equally
    late ones the incoming.

    ``stored`` has one row per key, as this leaves it. It is only probed with the narrow keys
    of the incoming rows: what is stored is not aggregated anew for each batch.
    """
    def keys(df: DataFrame) -> DataFrame:
        return df.select(F.col(key).alias("k_"), F.struct(*order).alias("n_"))

    same, own = F.col(key).eqNullSafe(F.col("k_")), F.struct(*order)
    newest = latest_by(incoming, key, order)
    stays = stored.join(keys(newest), same & ~_later(own, F.col("n_"), order), "left_anti")
    comes = newest.join(keys(stored), same & _later(F.col("n_"), own, order), "left_anti")
    return stays.unionByName(comes, allowMissingColumns=True)


def _later(a: Column, b: Column, order: Sequence[str]) -> Column:
    """Is ``a`` after ``b`` in the columns of ``order``? Nulls come first."""
    made = F.lit(False)
    for c in reversed(order):
        x, y = a.getField(c), b.getField(c)
        after = F.coalesce(x > y, x.isNotNull() & y.isNull())
        made = after | (x.eqNullSafe(y) & made)
    return made


def corpus_view(queue: DataFrame, pages: DataFrame, extractions: DataFrame) -> DataFrame:
    """Queue rows with their stored page and extraction, over the foreign keys."""
    return (
        queue.select(F.col("id").alias("url_id"), "status", "depth", "source")
        .join(pages.select(F.col("id").alias("page_id"), "url_id", "url"), "url_id")
        .join(extractions.drop("id"), ["url_id", "page_id"])
    )


def lineage(queue: DataFrame) -> DataFrame:
    """Every URL with its parent's URL and status, if it has a parent."""
    parents = queue.select(
        F.col("id").alias("parent_url_id"),
        F.col("url").alias("parent_url"),
        F.col("status").alias("parent_status"),
    )
    rows = queue.select("id", "url", "depth", "source", "parent_url_id")
    # Seeds have no parent. They stay out of the join, where they would meet in one task.
    return (
        rows.filter("parent_url_id IS NOT NULL")
        .join(parents, "parent_url_id", "left")
        .unionByName(rows.filter("parent_url_id IS NULL"), allowMissingColumns=True)
    )


def roots(queue: DataFrame) -> DataFrame:
    """``id, root_id, hops, cyclic``: the URL that each one was found from in the end, and how many
    links away it is. A URL without a parent, or whose parent is gone, is its own root. Where parents go
    round in a circle, ``root_id`` and ``hops`` are NULL and ``cyclic`` is true, also for what hangs on it.

    By pointer doubling: each round replaces the ancestor of a URL by that one's ancestor, so rounds grow
    with the logarithm of the longest chain. URLs that have reached their root leave the join, where
    all children of one root would meet; after ``log2`` of the number of URLs the rest is cyclic.
    """
    rows = queue.select("id", F.col("parent_url_id").alias("at"))
    known = queue.select(F.col("id").alias("at"), F.lit(1).cast("bigint").alias("hops"))
    with_parent = rows.filter("at IS NOT NULL").join(known, "at", "left_semi")
    first = cut_lineage(
        rows.join(with_parent.select("id"), "id", "left_anti").select("id", F.col("id").alias("at"), F.lit(0).cast("bigint").alias("hops"))
    )
    settled, n = first, queue.count()
    open_ = cut_lineage(with_parent.select("id", "at", F.lit(1).cast("bigint").alias("hops")))
    length = 1
    while length <= n and not open_.isEmpty():
        steps = settled.withColumn("end_", F.lit(True)).unionByName(open_.withColumn("end_", F.lit(False)))
        steps = steps.select(F.col("id").alias("at"), F.col("at").alias("next_"), F.col("hops").alias("more_"), "end_")
        moved = cut_lineage(
            open_.join(steps, "at").select("id", F.col("next_").alias("at"), (F.col("hops") + F.col("more_")).alias("hops"), "end_")
        )
        settled = cut_lineage(settled.unionByName(moved.filter("end_").drop("end_")))
        open_ = moved.filter("NOT end_").drop("end_")
        length *= 2
    none = F.lit(None).cast("bigint")
    return settled.select("id", F.col("at").alias("root_id"), "hops", F.lit(False).alias("cyclic")).unionByName(
        open_.select("id", none.alias("root_id"), none.alias("hops"), F.lit(True).alias("cyclic"))
    )
