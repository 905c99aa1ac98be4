"""Processing claimed pages, and replaying a crawl over a stored corpus."""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.payload import PAYLOAD_TYPE, heuristic_payload, model_payload
from ..functions.scoring import priority
from ..functions.signals import with_signals
from ..functions.urls import canonicalize_url
from ..operators import queue as Q
from ..operators.links import expand, with_candidates, worth_queueing
from ..operators.store import store_latest
from ..params import DEFAULTS, SCHEMA_NAME, Params
from ..session import cut_lineage, shared_dir
from ..sources.queue_store import QueueStore
from .pages import analyze_links

# Fixed value: message of a URL that could not be fetched.
NO_PAGE = "fetch failed or timeout"
# A text column of the stored tables holds no character 0, nor does a stored JSON document.
NOT_STORED = "insert raw_page failed: text holds a character 0"
NOT_SAVED = "insert extraction failed: payload holds a character 0"
# Steps whose failure ends a page, in order.
STEPS = ("fetch", "store", "analysis", "save")


def stride(params: Params) -> int:
    """Arrival order is the rank of the page times this, plus the link's place: a
    power of two with room for all links of a page and for its own settling."""
    return 1 << (params.max_links + 1).bit_length()


def page_by_url(pages: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """``url, page_id``: one page per canonical URL, the lowest key of all copies.

    Only keys are aggregated, so a page with very many copies costs one counter. Pages whose
    URL is unusable have no canonical one and are not found by it.
    """
    named = pages.select(canonicalize_url(F.col(url)).alias("url"), key).filter("url <> ''")
    return named.groupBy("url").agg(F.min(key).alias(key))


def fetch_lookup(claims: DataFrame, pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Claimed rows with the stored page for their URL, NULL when there is none."""
    lookup = page_by_url(pages, key).withColumnRenamed("url", "canonical_url")
    wanted = claims.withColumn("canonical_url", canonicalize_url(F.col("url")))
    usable = F.coalesce(F.col("canonical_url") != "", F.lit(False))
    found = wanted.filter(usable).join(lookup, "canonical_url", "left")
    return found.unionByName(wanted.filter(~usable), allowMissingColumns=True).drop("canonical_url")


@dataclass(frozen=True)
class Processed:
    """What one batch of pages leaves behind. ``analyzed`` is the table the other four are read from."""

    analyzed: DataFrame
    outcomes: DataFrame
    pages: DataFrame
    extractions: DataFrame
    discoveries: DataFrame


def process_pages(
    batch: DataFrame,
    at: Column,
    html: str = "html",
    params: Params = DEFAULTS,
    response: str | None = None,
) -> Processed:
    """Fetch, store, analyse, score, save and expand claimed pages.

    ``batch``: id, url, depth, claim_rank, page_id and html (NULL when the fetch gave nothing);
    ``fetch_error``, ``status_code`` and ``content_type`` may be there. ``response`` names a column of
    stored model answers: pages that have one take payload and confidence from it. Each step has a
    column with its own message, and the first one that is not NULL is the page's failure; a
    step that fails takes nothing from the steps before it, so the page of a URL whose analysis
    failed stays stored. Expansion takes no part in success. Depth only gates and adds a
    constant to the priority.

    The pages are analysed once, into a table of the shared folder; HTML is not in it, and stored
    pages are cut from the batch itself.
    """
    given = {c: F.col(c) if c in batch.columns else F.lit(None) for c in ("fetch_error", "status_code", "content_type")}
    fetched = batch.withColumns(
        {
            "fetch_error": F.coalesce(
                given["fetch_error"].cast("string"), F.when(F.col(html).isNull(), F.lit(NO_PAGE))
            ),
            "store_error": F.when(F.contains(F.col(html), F.lit("\0")), F.lit(NOT_STORED)),
        }
    )
    stored = F.col("fetch_error").isNull() & F.col("store_error").isNull()
    pages = fetched.filter(stored).select(
        F.col("id").alias("url_id"),
        "url",
        F.col(html).alias("html"),
        given["status_code"].cast("int").alias("status_code"),
        given["content_type"].cast("string").alias("content_type"),
        at.alias("fetched_at"),
    )
    keep = ["id", "claim_rank", "url", "depth", "page_id", "fetch_error", "store_error"]
    seen = fetched.filter(stored).select(*keep, html, *([response] if response else []))
    made = heuristic_payload(seen, html, params=params).withColumn("analysis_error", F.lit(None).cast("string"))
    if response is not None:
        made = _with_answers(made, response)
    scored = with_signals(made.drop(html), params=params)
    saved = with_candidates(scored, params=params).drop("anchors")
    saved = saved.withColumn("save_error", F.when(F.contains(_texts_of("payload"), F.lit("\0")), F.lit(NOT_SAVED)))
    lost = fetched.filter(~stored).select(*keep)
    analyzed = cut_lineage(saved.unionByName(lost, allowMissingColumns=True))
    analyzed = analyzed.withColumn("failure", F.coalesce(*(f"{step}_error" for step in STEPS)))
    done = analyzed.filter("failure IS NULL")
    extractions = done.select(
        F.col("id").alias("url_id"),
        "page_id",
        F.lit(SCHEMA_NAME).alias("schema_name"),
        "payload",
        F.col("confidence").cast("decimal(5,4)").alias("confidence"),
        F.col("page_score").cast("float").alias("geo_score"),
        "signals",
        at.alias("extracted_at"),
    )
    links = done.filter(F.col("depth") < params.max_depth)
    discoveries = as_discoveries(
        worth_queueing(expand(links, ["id", "claim_rank"], "depth", params), params), params
    )
    outcomes = analyzed.select("id", "claim_rank", "failure")
    return Processed(analyzed, outcomes, pages, extractions, discoveries)


def _texts_of(payload: str) -> Column:
    """All text of a payload."""
    single = ("title", "main_content", "description", "article_date", "author")
    links = F.transform(F.col(payload)["links"], lambda a: F.concat(a["href"], a["text"]))
    lists = (F.col(payload)["geo_entities"], F.col(payload)["location_hints"], links)
    return F.concat_ws("", *(F.col(payload)[c] for c in single), *(F.array_join(c, "") for c in lists))


def _with_answers(made: DataFrame, response: str) -> DataFrame:
    """Payload and confidence of the model's answer where there is one, or its error."""
    own = made.withColumnsRenamed({"payload": "own_payload", "confidence": "own_confidence"}).drop("analysis_error")
    answered = F.col(response).isNotNull()
    both = model_payload(own, response)
    return both.withColumns(
        {
            "analysis_error": F.when(answered, F.col("error")),
            "payload": F.when(answered, F.col("payload")).otherwise(F.col("own_payload").cast(PAYLOAD_TYPE)),
            "confidence": F.when(answered, F.col("confidence")).otherwise(F.col("own_confidence")),
        }
    ).drop("own_payload", "own_confidence", "parse_error", "outcome", "error", response)


def as_discoveries(
    candidates: DataFrame, params: Params = DEFAULTS, arrival: Column | None = None
) -> DataFrame:
    """Candidates of claimed pages in the form :func:`upsert_discovered` takes.

    They arrive in order of ``arrival``, or else of their page's claim rank and their place."""
    if arrival is None:
        arrival = (F.col("claim_rank") * stride(params) + F.col("ord")).cast("bigint")
    return candidates.select(
        F.col("child").alias("url"),
        "priority",
        F.col("geo_score").cast("float").alias("geo_score"),
        F.concat(F.lit("frontier:"), F.col("reason")).alias("source"),
        (F.col("depth") + 1).alias("depth"),
        F.col("id").alias("parent_url_id"),
        arrival.alias("ord"),
    )


def corpus_edges(pages: DataFrame, key: str = "page_id", params: Params = DEFAULTS) -> DataFrame:
    """``page_id, child, geo_score, reason, ord`` of a whole corpus, threshold applied.

    Link scores do not depend on depth, so this one pass over the HTML serves all
    rounds of a replay; afterwards only this narrow table is touched. The page
    text never crosses a shuffle: copies of a page are analysed where they lie,
    and their edges stay unused because the lookup names one page per URL.
    """
    named = pages.withColumn("url", canonicalize_url(F.col("url")))
    return worth_queueing(expand(analyze_links(named, params=params), [key]), params)


def round_changes(
    store: QueueStore,
    number: int,
    lookup: DataFrame,
    edges: DataFrame,
    at: Column,
    batch: int,
    key: str = "page_id",
    params: Params = DEFAULTS,
    revisit: bool = True,
) -> DataFrame:
    """Claim a batch, look its pages up, settle it, and merge what it links to: the rows that
    change, and new ones. Of the queue, all open rows are looked at for the claim (their narrow
    columns), and otherwise the buckets of the claimed and the found URLs."""
    # Both large tables are only probed: the batch, bounded by its size, is broadcast
    # to them. (A left join from the batch would shuffle the whole lookup.)
    queue = store.read(number)
    due = cut_lineage(
        queue.select("id", "url", "depth").join(Q.bounded(Q.claim_set(queue, batch), batch), "id")
    )
    # Seeds are queued as they were given and looked up in canonical form.
    due = due.withColumn("canonical_", canonicalize_url(F.col("url")))
    wanted = Q.bounded(due.select(F.col("canonical_").alias("url")).distinct(), batch)
    found_pages = lookup.join(wanted, "url").withColumnRenamed("url", "canonical_")
    claims = cut_lineage(
        due.join(Q.bounded(found_pages, batch), "canonical_", "left").drop("canonical_")
    )
    parents = claims.filter(F.col(key).isNotNull() & (F.col("depth") < params.max_depth))
    found = as_discoveries(
        edges.join(
            Q.bounded(parents.select(key, "id", "depth", "claim_rank"), batch), key
        ).withColumn("priority", priority(F.col("geo_score"), F.col("depth"))),
        params,
    )
    found = cut_lineage(found)
    urls = cut_lineage(claims.select("url").union(found.select("url")).distinct())
    touched = store.touching(number, urls)
    claimed = Q.apply_claims(touched, claims.select("id", "claim_rank", "worker"), at, batch)
    outcomes = claims.select(
        "id",
        F.when(F.col(key).isNull(), F.lit(NO_PAGE)).alias("failure"),
        # a page is settled after all its own links have arrived
        ((F.col("claim_rank") + 1) * stride(params) - 1).cast("bigint").alias("settled_ord"),
    )
    settled = Q.apply_outcomes(claimed, outcomes, at, extra=["settled_ord"], bound=batch)
    first_id = store.version(number).next_id
    return Q.upsert_discovered(settled, found, at, first_id, settled="settled_ord", revisit=revisit)


def replay(
    queue: DataFrame,
    pages: DataFrame,
    at: Column,
    max_rounds: int,
    batch: int,
    first_id: int,
    key: str = "page_id",
    params: Params = DEFAULTS,
    revisit: bool = True,
    folder: str | None = None,
) -> DataFrame:
    """Crawl a stored corpus: rounds of claim, lookup, settle and merge.

    Links may open finished URLs again, so a cyclic web never drains by itself;
    ``max_rounds`` always bounds the loop. The driver keeps only the loop: a round writes
    the rows it has changed to a :class:`QueueStore` in ``folder`` (one in the shared folder
    unless given), whose newest version is returned.
    """
    lookup = cut_lineage(page_by_url(pages.filter("html IS NOT NULL"), key))
    edges = cut_lineage(corpus_edges(pages, key, params))
    folder = folder or f"{shared_dir(queue.sparkSession)}/replay-{uuid4().hex}"
    store, number = QueueStore.create(queue, folder, first_id), 0
    for _ in range(max_rounds):
        changed = round_changes(store, number, lookup, edges, at, batch, key, params, revisit)
        # a page's links have arrival numbers below this
        next_id = store.version(number).next_id + (batch + 2) * stride(params)
        number = store.commit(number, changed, next_id)
        if Q.claimable(store.read(number)).isEmpty():
            break
    return store.read(number)


def store_extractions(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Extractions after a batch: the newest per URL replaces all columns.

    A batch that is stored again leaves the same rows."""
    return store_latest(stored, fresh, "url_id", ["extracted_at", "page_id"])
