"""Continuous page analysis and queue updates with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.urls import canonicalize_url
from ..operators import queue as Q
from ..operators.links import expand, with_candidates, worth_queueing
from ..params import DEFAULTS, Params
from ..plans.pages import analyze_pages
from ..plans.process import as_discoveries
from ..session import cut_lineage
from ..sources.queue_store import QueueStore

PAGE_STREAM_SCHEMA = "page_id BIGINT, url STRING, html STRING"


def page_stream(
    spark: SparkSession, folder: str, schema: str = PAGE_STREAM_SCHEMA, files: str | None = None
) -> DataFrame:
    """Pages from Parquet files as they arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("pathGlobFilter", files)
    return reader.parquet(folder)


def ingest(
    pages: DataFrame, out: str, checkpoint: str, params: Params = DEFAULTS
) -> StreamingQuery:
    """Analyse new pages and append the results; stateless, so no watermark.

    ``availableNow`` works through everything present and then stops cleanly;
    start it again (or with another trigger) to go on from the checkpoint.
    """
    analyzed = analyze_pages(pages, params=params).drop("anchors")
    return (
        analyzed.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def parents_of(pages: DataFrame, queue: DataFrame, key: str = "page_id") -> DataFrame:
    """``key, id, depth``: the queue row of each page's URL in canonical form, the one with the
    smallest id. Pages that are not in the queue are not in the result. The queue is probed with the
    URLs of the pages; only rows that match are grouped."""
    named = pages.select(key, canonicalize_url(F.col("url")).alias("canonical_")).filter("canonical_ <> ''")
    rows = queue.select(canonicalize_url(F.col("url")).alias("canonical_"), F.struct("id", "depth").alias("row_"))
    known = rows.join(named.select("canonical_").distinct(), "canonical_", "left_semi")
    least = known.groupBy("canonical_").agg(F.min("row_").alias("row_"))
    return named.join(least, "canonical_").select(key, "row_.id", "row_.depth")


def batch_discoveries(
    pages: DataFrame, queue: DataFrame, params: Params = DEFAULTS, key: str = "page_id"
) -> DataFrame:
    """What a batch of pages links to, in order of page key and place.

    Id and depth of a page are those of its queue row; a page that is not queued counts as one of
    depth 0 without id. The HTML is analysed where it lies: only links are joined.
    """
    made = with_candidates(analyze_pages(pages, params=params), params=params).select(key, "candidates")
    placed = made.join(parents_of(pages, queue, key), key, "left").withColumn(
        "depth", F.coalesce("depth", F.lit(0))
    )
    found = expand(placed.filter(F.col("depth") < params.max_depth), [key, "id"], "depth", params)
    arrival = F.struct(key, F.col("ord").cast("bigint").alias("place"))
    return as_discoveries(worth_queueing(found, params), params, arrival)


def update_queue(
    pages: DataFrame,
    queue_folder: str,
    checkpoint: str,
    at: Column,
    first_id: int,
    params: Params = DEFAULTS,
) -> StreamingQuery:
    """Merge what every batch of new pages links to into the queue.

    The queue is a :class:`QueueStore` beside its starting snapshot (see :func:`snapshot_path`,
    number 0). Batch ``n`` reads version ``n``, of which only the buckets of the URLs it found and,
    for the pages' own rows, three narrow columns; and it writes what changes as version
    ``n + 1``. A batch that is repeated after a failure writes its own version again. New URLs
    are numbered in order of arrival, whatever the keys of the pages are.
    """
    spark = pages.sparkSession
    store = store_of(spark, queue_folder)
    if not store.exists():
        start = spark.read.schema(Q.QUEUE_SCHEMA).parquet(snapshot_path(queue_folder, 0))
        QueueStore.create(start, store.folder, first_id)

    def merge(batch: DataFrame, number: int) -> None:
        store = store_of(batch.sparkSession, queue_folder)
        found = cut_lineage(batch_discoveries(batch, store.read(number), params))
        urls = cut_lineage(found.select("url").distinct())
        changed = Q.upsert_discovered(store.touching(number, urls), found, at, None)
        next_id = store.version(number).next_id
        numbered = cut_lineage(Q.number_arrivals(cut_lineage(changed), next_id))
        new = numbered.filter(F.col("id") >= next_id).count()
        store.commit(number, numbered, next_id + new)

    return (
        pages.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def snapshot_path(folder: str, number: int) -> str:
    return f"{folder}/snapshot-{number:08d}"


def store_of(spark: SparkSession, folder: str) -> QueueStore:
    return QueueStore(spark, f"{folder}/store")


def newest_snapshot(spark: SparkSession, folder: str, number: int) -> DataFrame:
    return store_of(spark, folder).read(number)
