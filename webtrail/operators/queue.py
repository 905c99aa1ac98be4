"""The ranked URL queue as table snapshots.

Every operator takes a queue DataFrame and returns the next one; nothing is
changed in place. Times come in as a parameter, so a step that is run again
after a lost executor writes the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import queue_rank
from ..functions.text import clamp, head, strip
from ..session import cut_lineage

# Fixed value: the columns of the queue.
QUEUE_SCHEMA = (
    "id BIGINT, url STRING, status STRING, priority INT, geo_score FLOAT, source STRING, "
    "depth INT, parent_url_id BIGINT, retries INT, max_retries INT, claimed_at TIMESTAMP, "
    "claimed_by STRING, last_scored_at TIMESTAMP, processed_at TIMESTAMP, "
    "created_at TIMESTAMP, updated_at TIMESTAMP, error STRING"
)
QUEUE_COLUMNS = [part.split()[0] for part in QUEUE_SCHEMA.split(", ")]
# Fixed value: stored length of an error message.
ERROR_CHARS = 4096
# A table known to hold at most this many narrow rows (a few MB) is broadcast.
BROADCAST_ROWS = 50_000


def bounded(rows: DataFrame, bound: int | None) -> DataFrame:
    """Broadcast rows whose number has a proven small bound; others join as Spark
    decides from their measured size."""
    return F.broadcast(rows) if bound is not None and bound <= BROADCAST_ROWS else rows


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def with_rank(queue: DataFrame) -> DataFrame:
    """Add ``rank_score``, the value the claim order goes by."""
    return queue.withColumn("rank_score", queue_rank(F.col("priority"), F.col("geo_score")))


def claimable(queue: DataFrame) -> DataFrame:
    return queue.filter((F.col("status") == "pending") & (F.col("retries") < F.col("max_retries")))


def queue_depth(
    queue: DataFrame, statuses: Iterable[str] = ("pending", "in_progress")
) -> DataFrame:
    """One row: how many URLs are in one of the statuses."""
    return queue.filter(F.col("status").isin(*statuses)).agg(
        F.count(F.lit(1)).alias("queue_depth")
    )


# ---------------------------------------------------------------------------
# Seeds
# ---------------------------------------------------------------------------


def seed_report(queue: DataFrame, seeds: DataFrame) -> DataFrame:
    """``pos, url, inserted`` for every non-blank seed (columns ``pos``, ``url``).

    Only the first of equal seeds can be inserted. The winners are found by a
    pre-aggregated minimum and joined back on (url, pos), so a seed that is
    repeated very often does not end up in one task.
    """
    clean = seeds.select("pos", strip(F.col("url")).alias("url")).filter(F.col("url") != "")
    winners = (
        clean.groupBy("url")
        .agg(F.min("pos").alias("pos"))
        .join(queue.select("url"), "url", "left_anti")
        .withColumn("inserted", F.lit(True))
    )
    return clean.join(winners, ["url", "pos"], "left").select(
        "pos", "url", F.coalesce("inserted", F.lit(False)).alias("inserted")
    )


def enqueue_seeds(
    queue: DataFrame, seeds: DataFrame, at: Column, first_id: int, priority: int = 0
) -> DataFrame:
    """Queue plus the seeds it does not hold yet; ids follow the seed positions."""
    new = (
        seeds.select("pos", strip(F.col("url")).alias("url"))
        .filter(F.col("url") != "")
        .groupBy("url")
        .agg(F.min("pos").alias("pos"))
        .join(queue.select("url"), "url", "left_anti")
    )
    return queue.unionByName(
        new.select(
            (F.lit(first_id) + F.col("pos")).cast("bigint").alias("id"),
            "url",
            F.lit(priority).alias("priority"),
            F.lit(0.0).cast("float").alias("geo_score"),
            F.lit("seed").alias("source"),
            F.lit(0).alias("depth"),
            _null("bigint").alias("parent_url_id"),
            *_fresh_columns(at),
        ).select(*QUEUE_COLUMNS)
    )


def _fresh_columns(at: Column) -> list[Column]:
    return [
        F.lit("pending").alias("status"),
        F.lit(0).alias("retries"),
        F.lit(3).alias("max_retries"),
        _null("timestamp").alias("claimed_at"),
        _null("string").alias("claimed_by"),
        _null("timestamp").alias("last_scored_at"),
        _null("timestamp").alias("processed_at"),
        at.alias("created_at"),
        at.alias("updated_at"),
        _null("string").alias("error"),
    ]


# ---------------------------------------------------------------------------
# Claims and outcomes
# ---------------------------------------------------------------------------


def claim_set(queue: DataFrame, batch: int, workers: int = 1) -> DataFrame:
    """``id, claim_rank, worker``: the next ``batch`` URLs for each of the workers.

    The order is by rank score, retries and id. A histogram over (rank score, retries) tells
    which of these classes are due, and in which one the claim ends. The last id that it
    takes of that class is found by :func:`nth_id`, from counts alone; so the claimed rows
    come out of a plain filter of the queue, whatever the size of a class. Only they are
    numbered, in classes or, where the claim is large, in ranges. Workers get disjoint runs
    of ranks.
    """
    wanted = batch * workers
    of_class = ["rank_score", "retries"]
    open_ = with_rank(claimable(queue)).select("id", *of_class)
    # one row for each class: few, as both columns are small numbers
    ahead = Window.orderBy(F.col("rank_score").desc(), "retries").rowsBetween(
        Window.unboundedPreceding, -1
    )
    due = cut_lineage(
        open_.groupBy(*of_class)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("start", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
        .filter(F.col("start") < wanted)
    )
    last = due.filter(F.col("start") + F.col("n") > wanted).first()
    claimed = open_
    if last is not None:
        rank, retries = F.col("rank_score"), F.col("retries")
        of_last = (rank == last.rank_score) & (retries == last.retries)
        end = nth_id(open_.filter(of_last).select("id"), wanted - last.start, last.n)
        before = (rank > last.rank_score) | ((rank == last.rank_score) & (retries < last.retries))
        claimed = open_.filter(before | (of_last & (F.col("id") <= end)))
    if wanted <= BROADCAST_ROWS:
        within = Window.partitionBy(*of_class).orderBy("id")
        ranked = claimed.join(due.drop("n"), of_class).withColumn(
            "claim_rank", F.row_number().over(within) + F.col("start")
        )
    else:
        ranked = _in_order(claimed, [F.col("rank_score").desc(), F.col("retries"), F.col("id")])
        ranked = ranked.withColumn("claim_rank", F.col("number_") + 1)
    rank = F.col("claim_rank").cast("bigint")
    return ranked.select(
        "id", rank.alias("claim_rank"), F.floor((rank - 1) / batch).cast("bigint").alias("worker")
    )


# An id is looked for by so many of its bits at a time.
DIGIT_BITS = 16


def nth_id(ids: DataFrame, n: int, size: int) -> int:
    """The ``n``-th smallest of ``size`` different ids, by radix selection.

    Each pass counts the ids left by their next bits and goes on with the value that holds the
    wanted one, until at most ``BROADCAST_ROWS`` are left: these are sorted. No pass sorts or
    gathers more than that, or than ``2 ** DIGIT_BITS`` counts.
    """
    shift = 64
    while size > BROADCAST_ROWS and shift > 0:
        shift -= DIGIT_BITS
        upto = Window.orderBy("digits_").rowsBetween(Window.unboundedPreceding, 0)
        counts = ids.groupBy(F.shiftright("id", shift).alias("digits_")).agg(F.count(F.lit(1)).alias("c_"))
        found = (
            counts.withColumn("upto_", F.sum("c_").over(upto)).filter(F.col("upto_") >= n).orderBy("digits_").first()
        )
        ids = ids.filter(F.shiftright("id", shift) == found.digits_)
        n, size = n - (found.upto_ - found.c_), found.c_
    return ids.orderBy("id").limit(n).agg(F.max("id")).first()[0]


def _in_order(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``number_``, the place of each row in this order, from 0.

    Rows are sorted in ranges; a row's number is its place in its range after the sizes of the
    ranges before. Only these sizes, one for each task, are added up.
    """
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(sorted_.withColumn("place_", F.monotonically_increasing_id()))
    # a task's rows are numbered from its own number times 2**33
    placed = placed.withColumn("range_", F.shiftright("place_", 33))
    earlier = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("range_").agg(F.count(F.lit(1)).alias("n_"))
    before = cut_lineage(
        sizes.select("range_", F.coalesce(F.sum("n_").over(earlier), F.lit(0)).alias("before_"))
    )
    inside = F.col("place_").bitwiseAND((1 << 33) - 1)
    made = placed.join(before, "range_").withColumn("number_", F.col("before_") + inside)
    return made.drop("place_", "range_", "before_")


def apply_claims(
    queue: DataFrame, claims: DataFrame, at: Column, bound: int, worker_id: str | None = None
) -> DataFrame:
    """Mark the claimed rows in progress. ``bound`` is the size limit of ``claims``.

    They carry ``worker_id``, or else the number of their worker as ``worker-N``.
    """
    hit = F.col("claim_rank").isNotNull()
    numbered = F.concat(F.lit("worker-"), F.col("worker").cast("string"))
    by = numbered if worker_id is None else F.lit(worker_id)
    joined = queue.join(bounded(claims, bound), "id", "left")
    return joined.select(
        *_updated(
            {
                "status": F.when(hit, F.lit("in_progress")).otherwise(F.col("status")),
                "claimed_at": F.when(hit, at).otherwise(F.col("claimed_at")),
                "claimed_by": F.when(hit, by).otherwise(F.col("claimed_by")),
                "updated_at": F.when(hit, at).otherwise(F.col("updated_at")),
            }
        )
    )


def claim(
    queue: DataFrame, batch: int, at: Column, workers: int = 1, worker_id: str | None = None
) -> DataFrame:
    return apply_claims(queue, claim_set(queue, batch, workers), at, batch * workers, worker_id)


def _updated(changes: dict[str, Column], extra: Iterable[str] = ()) -> list[Column]:
    return [
        changes[c].alias(c) if c in changes else F.col(c) for c in [*QUEUE_COLUMNS, *extra]
    ]


def apply_outcomes(
    queue: DataFrame,
    outcomes: DataFrame,
    at: Column,
    extra: Iterable[str] = (),
    bound: int | None = None,
) -> DataFrame:
    """Settle processed URLs: ``outcomes`` has unique ``id`` and ``failure``
    (NULL when the page was done, else the message).

    Done clears the claim and stamps the time. A failure counts one retry, and
    the URL goes back to pending until its retries are used up. ``bound`` is a
    size limit of ``outcomes`` where one is known, such as the claim batch.
    """
    marked = outcomes.select("id", F.col("failure"), F.lit(True).alias("hit_"), *extra)
    hit = F.col("hit_").isNotNull()
    done = hit & F.col("failure").isNull()
    failed = hit & F.col("failure").isNotNull()
    spent = F.col("retries") + 1 >= F.col("max_retries")
    return queue.join(bounded(marked, bound), "id", "left").select(
        *_updated(
            {
                "status": F.when(done, F.lit("done"))
                .when(failed & spent, F.lit("failed"))
                .when(failed, F.lit("pending"))
                .otherwise(F.col("status")),
                "retries": F.when(failed, F.col("retries") + 1).otherwise(F.col("retries")),
                "claimed_at": F.when(~hit, F.col("claimed_at")),
                "claimed_by": F.when(~hit, F.col("claimed_by")),
                "processed_at": F.when(done, at).otherwise(F.col("processed_at")),
                "updated_at": F.when(hit, at).otherwise(F.col("updated_at")),
                "error": F.when(failed, head(F.col("failure"), ERROR_CHARS)).otherwise(
                    F.col("error")
                ),
            },
            extra,
        )
    )


def mark_done(queue: DataFrame, ids: DataFrame, at: Column) -> DataFrame:
    return apply_outcomes(queue, ids.select("id", _null("string").alias("failure")), at)


def mark_failed(queue: DataFrame, failures: DataFrame, at: Column) -> DataFrame:
    return apply_outcomes(queue, failures.select("id", F.col("error").alias("failure")), at)


# ---------------------------------------------------------------------------
# Discovered URLs
# ---------------------------------------------------------------------------


def fold_discoveries(found: DataFrame) -> DataFrame:
    """One row per discovered URL, equal to applying the arrivals one by one.

    ``found``: url, priority, geo_score, source, depth, parent_url_id and ``ord``,
    the unique arrival order (a number, or a struct of them). Every part is a plain aggregate, so a URL that half
    the web links to is combined before the shuffle.
    """
    return found.groupBy("url").agg(
        F.max("priority").alias("f_priority"),
        F.max(clamp(F.col("geo_score").cast("float"))).cast("float").alias("f_geo"),
        F.min(F.greatest(F.col("depth"), F.lit(0))).alias("f_depth"),
        F.min_by(
            "parent_url_id", F.when(F.col("parent_url_id").isNotNull(), F.col("ord"))
        ).alias("f_parent"),
        F.bool_or(F.col("source") == "seed").alias("f_seed"),
        F.max_by("source", "ord").alias("f_source"),
        F.min("ord").alias("first_ord"),
        F.max("ord").alias("last_ord"),
    )


def upsert_discovered(
    queue: DataFrame,
    found: DataFrame,
    at: Column,
    first_id: int | None,
    settled: str | None = None,
    revisit: bool = True,
) -> DataFrame:
    """Merge discoveries into the queue.

    Known URLs keep the better priority and score, the smaller depth and their
    first parent; a finished one is opened again. New URLs are appended with id
    ``first_id + ord``, which keeps arrival order without numbering all rows. Without
    ``first_id`` they have no id yet but their ``arrival`` (see :func:`number_arrivals`).
    ``settled`` names a queue column with the arrival order at which a URL of the
    current batch was finished: only later arrivals open it again.
    """
    known = F.col("id").isNotNull()
    found_now = F.col("first_ord").isNotNull()
    ended = F.col("status").isin("done", "failed")
    if settled is not None:
        ended = ended & (
            F.col(settled).isNull() | (F.col("last_ord") > F.col(settled))
        )
    reopened = found_now & ended if revisit else F.lit(False)
    source = F.when(
        (F.coalesce("source", F.lit("")) == "seed") | F.col("f_seed"), F.lit("seed")
    ).otherwise(F.col("f_source"))
    changes = {
        "status": F.when(~known | reopened, F.lit("pending")).otherwise(F.col("status")),
        "priority": F.greatest("priority", "f_priority"),
        "geo_score": F.greatest("geo_score", "f_geo"),
        "source": F.when(found_now, source).otherwise(F.col("source")),
        "depth": F.least("depth", "f_depth"),
        "parent_url_id": F.coalesce("parent_url_id", "f_parent"),
        "retries": F.when(~known | reopened, F.lit(0)).otherwise(F.col("retries")),
        "max_retries": F.coalesce("max_retries", F.lit(3)),
        "claimed_at": F.when(known & ~F.coalesce(reopened, F.lit(False)), F.col("claimed_at")),
        "claimed_by": F.when(known & ~F.coalesce(reopened, F.lit(False)), F.col("claimed_by")),
        "created_at": F.coalesce("created_at", at),
        "updated_at": F.when(found_now, at).otherwise(F.col("updated_at")),
    }
    if first_id is not None:
        changes["id"] = F.coalesce("id", (F.lit(first_id) + F.col("first_ord")).cast("bigint"))
    columns = _updated(changes)
    if first_id is None:
        columns.append(F.when(~known, F.col("first_ord")).alias("arrival"))
    return queue.join(fold_discoveries(found), "url", "full_outer").select(*columns)


def number_arrivals(rows: DataFrame, next_id: int) -> DataFrame:
    """Ids for the rows that have none: ``next_id`` and on, without gaps, in order of ``arrival``."""
    new = _in_order(rows.filter("id IS NULL"), [F.col("arrival")])
    made = new.withColumn("id", F.lit(next_id) + F.col("number_"))
    return rows.filter("id IS NOT NULL").unionByName(made.select(*rows.columns))


def arrival_report(queue: DataFrame, found: DataFrame) -> DataFrame:
    """``ord, url, inserted``: true for the first arrival of a URL new to the queue."""
    winners = (
        found.groupBy("url")
        .agg(F.min("ord").alias("ord"))
        .join(queue.select("url"), "url", "left_anti")
        .withColumn("inserted", F.lit(True))
    )
    return found.select("url", "ord").join(winners, ["url", "ord"], "left").select(
        "ord", "url", F.coalesce("inserted", F.lit(False)).alias("inserted")
    )


# ---------------------------------------------------------------------------
# Removal and integrity
# ---------------------------------------------------------------------------


def delete_urls(queue: DataFrame, doomed: DataFrame) -> DataFrame:
    """Queue without the ids in ``doomed``; children lose that parent."""
    gone = doomed.select("id").distinct()
    parents = gone.select(F.col("id").alias("parent_url_id"), F.lit(True).alias("gone_"))
    kept = queue.join(gone, "id", "left_anti")
    # Rows without a parent stay out of the join, where they would meet in one task.
    joined = kept.filter("parent_url_id IS NOT NULL").join(parents, "parent_url_id", "left")
    settled = joined.select(
        *_updated({"parent_url_id": F.when(F.col("gone_").isNull(), F.col("parent_url_id"))})
    )
    return settled.unionByName(kept.filter("parent_url_id IS NULL").select(*settled.columns))


def delete_children(rows: DataFrame, doomed: DataFrame) -> DataFrame:
    """Stored pages or extractions without those of removed URLs."""
    return rows.join(doomed.select(F.col("id").alias("url_id")), "url_id", "left_anti")


def queue_violations(
    queue: DataFrame, pages: DataFrame | None = None, extractions: DataFrame | None = None
) -> DataFrame:
    """``rule, key, n``: every broken rule of the stored tables.

    Two scans of the queue and one of each other table: one emits the broken rules of each row, the
    other one aggregate over all keys, from which uniqueness and missing parents are read.
    """
    statuses = ("pending", "in_progress", "done", "failed")
    geo = (F.col("geo_score") < 0) | (F.col("geo_score") > 1) | F.isnan("geo_score")
    row_rules = {
        "status": ~F.coalesce(F.col("status").isin(*statuses), F.lit(False)),
        "geo_score": F.coalesce(geo, F.lit(True)),
        "depth": F.coalesce(F.col("depth") < 0, F.lit(True)),
        "url_null": F.col("url").isNull(),
    }
    broken = F.array_compact(F.array(*(F.when(c, F.lit(rule)) for rule, c in row_rules.items())))
    by_row = queue.select(
        F.explode(broken).alias("rule"), F.col("id").cast("string").alias("key"), F.lit(1).cast("bigint").alias("n")
    )

    def use(space: str, kind: str, key: Column) -> Column:
        return F.struct(F.lit(space).alias("space"), F.lit(kind).alias("kind"), key.cast("string").alias("key"))

    uses = F.array(
        use("id", "own", F.col("id")),
        F.when(F.col("url").isNotNull(), use("url", "own", F.col("url"))),
        F.when(F.col("parent_url_id").isNotNull(), use("id", "parent", F.col("parent_url_id"))),
    )
    keys = queue.select(F.explode(F.array_compact(uses)).alias("use")).select("use.*")
    tables = {name: t for name, t in (("page", pages), ("extraction", extractions)) if t is not None}
    for name, table in tables.items():
        keys = keys.unionByName(table.select(use("id", name, F.col("url_id")).alias("use")).select("use.*"))
    counts = keys.groupBy("space", "key").agg(
        *(F.count_if(F.col("kind") == kind).alias(kind) for kind in ("own", "parent", *tables))
    )

    def found(rule: Column, n: str, when: Column) -> Column:
        return F.when(when, F.struct(rule.alias("rule"), F.col(n).alias("n")))

    orphan = (F.col("own") == 0) & F.col("key").isNotNull()
    key_rules = [
        found(F.concat("space", F.lit("_unique")), "own", F.col("own") > 1),
        found(F.lit("parent"), "parent", orphan & (F.col("parent") > 0)),
    ]
    for name in tables:
        key_rules.append(found(F.lit(f"{name}_unique"), name, F.col(name) > 1))
        key_rules.append(found(F.lit(f"{name}_url"), name, orphan & (F.col(name) > 0)))
    by_key = counts.select("key", F.explode(F.array_compact(F.array(*key_rules))).alias("f"))
    return by_row.unionByName(by_key.select("f.rule", "key", "f.n"))
