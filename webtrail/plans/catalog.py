"""All registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each runs a library operator over whole given tables, or over tables that
``fixtures`` derives from them. Doubles are rounded to six decimals.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import scoring as S
from ..functions import urls as U
from ..functions.payload import heuristic_payload, model_payload, model_requests
from ..functions.signals import SIGNALS, with_signals
from ..functions.text import char_count, word_count
from ..operators import links as L
from ..operators import queue as Q
from ..operators import runs as R
from ..operators import store as ST
from ..operators import workers as W
from ..operators.quantiles import exact_quantile, merged_sketches, quantile_sketches, ranks_hold, sketch_quantile
from ..params import DEFAULTS
from ..session import shared_dir, spread
from ..sources import files as SF
from ..sources import snapshots as SN
from ..sources.row_store import RowStore
from ..streaming import ingest as SI
from ..streaming import metrics as SM
from . import fixtures as X
from . import pages as P
from . import process as T

Query = Callable[[SparkSession, str], DataFrame]


def at() -> Column:
    """The time stamped on every step of the checks."""
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


QUERIES: dict[str, Query] = {}
CLAIM_BATCH, WORKERS = DEFAULTS.claim_batch, 4
# A replay claims a quarter as many URLs in each round as the queue had at first.
REPLAY_ROUNDS, REPLAY_SHARE = 3, 4


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def pages_of(spark: SparkSession, sf: str) -> DataFrame:
    return spread(X.table(spark, sf, "pages"), "page_id")


def linked_of(spark: SparkSession, sf: str) -> DataFrame:
    return X.derive(spark, sf, X.LINKED_PAGES)


def r6(name: str) -> Column:
    return F.round(F.col(name), 6).alias(name)


def big(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid4().hex}"


# --- URLs ------------------------------------------------------------------


@query
def canonical_urls(spark, sf):
    return X.table(spark, sf, "pages").select(
        "page_id", U.canonicalize_url(F.col("url")).alias("canonical_url")
    )


@query
def canonical_dedup(spark, sf):
    return T.page_by_url(X.table(spark, sf, "pages")).withColumnRenamed("url", "canonical_url")


@query
def resolved_links(spark, sf):
    found = L.extract_links(linked_of(spark, sf))
    return found.select(
        "page_id", F.posexplode_outer("links").alias("pos", "link")
    ).filter(F.col("pos").isNotNull()).select("page_id", big("pos"), "link.href", "link.text")


@query
def host_pairs(spark, sf):
    found = L.extract_links(linked_of(spark, sf)).withColumn("parent_host", U.host_of(F.col("url")))
    pairs = found.select("parent_host", F.explode_outer("links").alias("link")).filter(
        F.col("link").isNotNull()
    )
    host = F.regexp_extract("link.href", U.PARTS, U.NETLOC)
    return (
        pairs.withColumn("affinity", U.host_affinity(F.col("parent_host"), host))
        .groupBy("affinity")
        .agg(F.count(F.lit(1)).alias("links"))
    )


# --- page text and payload ---------------------------------------------------


@query
def page_text(spark, sf):
    made = pages_of(spark, sf).select("page_id", H.page_text(F.col("html")).alias("text"))
    return made.select(
        "page_id",
        char_count(F.col("text")).alias("chars"),
        word_count(F.col("text")).alias("words"),
        F.md5("text").alias("text_md5"),
    )


@query
def document_words(spark, sf):
    docs = spread(X.table(spark, sf, "documents"), "doc_id")
    return docs.select(
        "doc_id",
        char_count(F.col("text")).alias("chars"),
        word_count(F.col("text")).alias("words"),
    )


@query
def main_text(spark, sf):
    docs = SF.extract_documents(pages_of(spark, sf).select("page_id", "html"))
    return docs.select("page_id", "chars", "words", F.md5("text").alias("text_md5"))


def _payload_row(df: DataFrame) -> DataFrame:
    p = F.col("payload")
    return df.select(
        "page_id",
        p["title"].alias("title"),
        p["description"].alias("description"),
        F.md5(p["main_content"]).alias("content_md5"),
        F.size(p["links"]).cast("bigint").alias("links"),
        F.array_join(p["geo_entities"], ",").alias("geo_entities"),
        F.round(p["vps_relevance"], 6).alias("vps_relevance"),
        F.round(p["reconstruction_relevance"], 6).alias("reconstruction_relevance"),
        p["recency_signal"].alias("recency_signal"),
        "confidence",
    )


@query
def page_payload(spark, sf):
    return _payload_row(heuristic_payload(pages_of(spark, sf)))


@query
def linked_payload(spark, sf):
    return _payload_row(heuristic_payload(linked_of(spark, sf)))


@query
def location_hints(spark, sf):
    made = heuristic_payload(pages_of(spark, sf))
    return made.select("page_id", F.to_json("payload.location_hints").alias("location_hints"))


@query
def raw_links(spark, sf):
    made = linked_of(spark, sf).select(
        "page_id", H.raw_links(H.anchors(F.col("html"))).alias("links")
    )
    return made.select(
        "page_id", F.posexplode_outer("links").alias("pos", "link")
    ).filter(F.col("pos").isNotNull()).select("page_id", big("pos"), "link.href", "link.text")


@query
def link_counts(spark, sf):
    return pages_of(spark, sf).select(
        "page_id", F.size(H.raw_links(H.anchors(F.col("html")))).cast("bigint").alias("links")
    )


@query
def dom_summary(spark, sf):
    made = pages_of(spark, sf).select("page_id", H.dom_summary(F.col("html")).alias("s"))
    return made.select("page_id", char_count(F.col("s")).alias("chars"), F.md5("s").alias("md5"))


@query
def model_request_table(spark, sf):
    made = model_requests(pages_of(spark, sf))
    return made.select(
        "page_id", char_count(F.col("request")).alias("chars"), F.md5("request").alias("md5")
    )


@query
def model_payloads(spark, sf):
    made = model_payload(X.derive(spark, sf, X.RESPONSES))
    p = F.col("payload")
    return made.select(
        "conv_id",
        "turn",
        "outcome",
        "parse_error",
        "confidence",
        "error",
        p["title"].alias("title"),
        F.length(p["main_content"]).cast("bigint").alias("content_chars"),
        F.array_join(F.transform(p["links"], lambda a: a["href"]), ",").alias("hrefs"),
        p["author"].alias("author"),
        p["vps_relevance"].alias("vps_relevance"),
        p["recency_signal"].alias("recency_signal"),
    )


# --- signals and link scores ------------------------------------------------


def _signal_row(df: DataFrame) -> DataFrame:
    return df.select(
        "page_id",
        *[F.round(F.col("signals")[s], 6).alias(s) for s in SIGNALS],
        r6("page_score"),
    )


@query
def geo_signals(spark, sf):
    return _signal_row(P.analyze_pages(pages_of(spark, sf)))


@query
def linked_signals(spark, sf):
    return _signal_row(P.analyze_pages(linked_of(spark, sf)))


@query
def top_pages(spark, sf):
    return P.top_pages(pages_of(spark, sf))


@query
def link_scores(spark, sf):
    """Score and reason of every resolved link, before any cut."""
    found = L.extract_links(linked_of(spark, sf))
    scored = found.withColumn("parent_host", U.host_of(F.col("url"))).withColumn(
        "scored", L.scored_links(F.col("links"), F.col("parent_host"))
    )
    return scored.select("page_id", F.inline_outer("scored")).filter(
        F.col("href").isNotNull()
    ).select("page_id", "href", r6("link_score"), "reason")


def _frontier(spark: SparkSession, sf: str) -> DataFrame:
    depth = (F.col("page_id") % 3).cast("int")
    analyzed = P.analyze_pages(linked_of(spark, sf)).withColumn("depth", depth)
    return L.frontier_candidates(analyzed, ["page_id"])


@query
def frontier_topn(spark, sf):
    return _frontier(spark, sf).select(
        "page_id", "child", big("ord"), r6("geo_score"), "reason", big("priority"), big("depth")
    )


@query
def reason_counts(spark, sf):
    kept = L.worth_queueing(_frontier(spark, sf))
    return kept.groupBy("reason").agg(
        F.count(F.lit(1)).alias("candidates"), F.max("priority").cast("bigint").alias("top_priority")
    )


# --- queue -------------------------------------------------------------------


def queue_of(spark: SparkSession, sf: str) -> DataFrame:
    return X.derive(spark, sf, X.QUEUE)


def _queue_row(df: DataFrame) -> DataFrame:
    return df.select(
        "id", "url", "status", big("priority"), r6d("geo_score"), "source", big("depth"),
        "parent_url_id", big("retries"), "claimed_by", "error",
        F.col("updated_at").cast("string").alias("updated_at"),
        F.col("processed_at").cast("string").alias("processed_at"),
    )


def r6d(name: str) -> Column:
    return F.round(F.col(name).cast("double"), 6).alias(name)


def outcomes_of(queue: DataFrame) -> DataFrame:
    """Outcome of every pending URL; those with a low score got no answer."""
    return queue.filter("status = 'pending'").select(
        "id",
        F.when(F.col("geo_score") < 0.25, F.concat(F.lit("no answer from "), F.col("url"))).alias(
            "error"
        ),
    )


@query
def queue_rank(spark, sf):
    return Q.with_rank(queue_of(spark, sf)).select("id", big("rank_score"))


@query
def queue_depth(spark, sf):
    return Q.queue_depth(queue_of(spark, sf))


@query
def claim_batch(spark, sf):
    return _queue_row(Q.claim(queue_of(spark, sf), CLAIM_BATCH, at()))


@query
def claim_workers(spark, sf):
    return Q.claim_set(queue_of(spark, sf), CLAIM_BATCH, WORKERS)


def _seeds(spark: SparkSession, sf: str) -> DataFrame:
    """Raw page URLs as seeds, each again with spaces around it, and blank ones."""
    pages = X.table(spark, sf, "pages")
    blank = pages.select((-1 - F.col("page_id")).alias("pos"), F.lit(" \t").alias("url"))
    again = pages.select(
        (F.col("page_id") * 2 + 1).alias("pos"), F.concat(F.lit("  "), "url", F.lit("\t")).alias("url")
    )
    given = pages.select((F.col("page_id") * 2).alias("pos"), F.col("url"))
    return given.unionByName(again).unionByName(blank)


@query
def seed_report(spark, sf):
    return Q.seed_report(queue_of(spark, sf), _seeds(spark, sf))


@query
def seed_enqueue(spark, sf):
    return _queue_row(Q.enqueue_seeds(queue_of(spark, sf), _seeds(spark, sf), at(), 1_000_000_000))


@query
def mark_done(spark, sf):
    q = queue_of(spark, sf)
    return _queue_row(Q.mark_done(q, outcomes_of(q).filter("error IS NULL"), at()))


@query
def mark_failed(spark, sf):
    q = queue_of(spark, sf)
    return _queue_row(Q.mark_failed(q, outcomes_of(q).filter("error IS NOT NULL"), at()))


@query
def upsert_discovered(spark, sf):
    found = X.derive(spark, sf, X.DISCOVERIES)
    return _queue_row(Q.upsert_discovered(queue_of(spark, sf), found, at(), 1_000_000_000))


@query
def discovery_report(spark, sf):
    return Q.arrival_report(queue_of(spark, sf), X.derive(spark, sf, X.DISCOVERIES))


@query
def delete_cascade(spark, sf):
    q = queue_of(spark, sf)
    return _queue_row(Q.delete_urls(q, q.filter("status = 'failed'").select("id")))


@query
def delete_pages(spark, sf):
    doomed = queue_of(spark, sf).filter("status = 'failed'").select("id")
    stored = X.table(spark, sf, "pages").select(F.col("page_id").alias("url_id"), "url")
    return Q.delete_children(stored, doomed)


@query
def queue_violations(spark, sf):
    """The queue joined by rows that break each rule, checked as a whole."""
    q = queue_of(spark, sf)
    broken = q.filter("status = 'failed'").select(
        "id",
        "url",
        F.lit("lost").alias("status"),
        "priority",
        (F.col("geo_score") + 1.5).cast("float").alias("geo_score"),
        "source",
        (F.col("depth") - 3).alias("depth"),
        (-F.col("id")).alias("parent_url_id"),
        *[c for c in Q.QUEUE_COLUMNS if c not in
          ("id", "url", "status", "priority", "geo_score", "source", "depth", "parent_url_id")],
    )
    pages = X.table(spark, sf, "pages").select((F.col("page_id") + 5).alias("url_id"))
    return Q.queue_violations(q.unionByName(broken), pages)


@query
def lineage(spark, sf):
    return ST.lineage(queue_of(spark, sf)).select(
        "id", "url", "parent_url_id", "parent_url", "parent_status"
    )


@query
def lineage_roots(spark, sf):
    """Root and distance of every URL; some chains are closed to circles, some parents are gone."""
    parent = F.when(F.col("id") % 35 == 0, F.col("id") + 2).when(F.col("id") % 35 == 10, F.lit(-1)).otherwise(F.col("parent_url_id"))
    return ST.roots(queue_of(spark, sf).withColumn("parent_url_id", parent.cast("bigint")))


@query
def store_extractions(spark, sf):
    """Extractions of all pages, then twice a later batch for every third one."""
    pages = X.table(spark, sf, "pages")
    version = lambda day, rows: rows.select(
        F.col("page_id").alias("url_id"), "page_id", F.lit(f"v{day}").alias("schema_name"),
        F.lit(f"2024-02-0{day} 00:00:00").cast("timestamp").alias("extracted_at"),
    )
    fresh = version(2, pages.filter("page_id % 3 = 0"))
    made = T.store_extractions(version(1, pages), fresh)
    made = T.store_extractions(made, fresh.unionByName(fresh))
    return made.select("url_id", "page_id", "schema_name", F.col("extracted_at").cast("string").alias("extracted_at"))


@query
def store_latest(spark, sf):
    """Two versions of every page; the later one stays."""
    pages = X.table(spark, sf, "pages")
    version = lambda n: pages.select(
        F.col("page_id").alias("url_id"),
        "url",
        F.lit(n).cast("bigint").alias("seq"),
        (F.lit(n) * 10 + F.col("page_id") % 13).alias("fetched"),
        F.length("html").cast("bigint").alias("chars"),
    )
    return ST.store_latest(version(1), version(2), "url_id", ["fetched", "seq"])


@query
def stored_pages(spark, sf):
    """Pages in three batches: all, every third one anew, every fifth one late; the second is written twice."""
    pages = X.table(spark, sf, "pages")
    version = lambda n, fetched: pages.select(
        F.col("page_id").alias("url_id"), "url", "html", F.lit(n).cast("bigint").alias("seq"),
        F.lit(fetched).cast("bigint").alias("fetched"),
    )
    first, again, late = version(1, 10), version(2, 20).filter("url_id % 3 = 0"), version(3, 5).filter("url_id % 5 = 0")
    store = RowStore(spark, fresh_folder(spark, "stored-pages"), first.schema, "url_id", ["fetched"], 8)
    for number, rows in ((1, first), (2, again), (2, again), (3, late)):
        store.add(number, rows)
    made = store.compacted(fresh_folder(spark, "stored-pages")).read()
    return made.select("url_id", "url", "seq", "fetched", F.length("html").cast("bigint").alias("chars"))


@query
def corpus_view(spark, sf):
    pages = pages_of(spark, sf).withColumns({"id": F.col("page_id"), "url_id": F.col("page_id")})
    analyzed = P.analyze_pages(pages).select(
        "id", "url_id", "page_id", "confidence", "page_score"
    )
    view = ST.corpus_view(queue_of(spark, sf), X.table(spark, sf, "pages").select(
        F.col("page_id").alias("id"), F.col("page_id").alias("url_id"), "url"), analyzed)
    return view.select("url_id", "page_id", "url", "status", "source", "confidence", r6("page_score"))


@query
def snapshot_roundtrip(spark, sf):
    """Queue written partitioned by status; the pending part read back."""
    folder = fresh_folder(spark, "queue")
    SN.write_queue(queue_of(spark, sf), folder)
    return _queue_row(Q.claimable(SN.read_queue(spark, folder)))


# --- processing and replay -----------------------------------------------------


@query
def fetch_lookup(spark, sf):
    pages = X.table(spark, sf, "pages")
    found = X.derive(spark, sf, X.DISCOVERIES).select("url", "ord")
    return T.fetch_lookup(found, pages).select("ord", "url", "page_id")


def _batch(spark: SparkSession, sf: str) -> DataFrame:
    """Every queued URL as one batch; URLs of failed rows have no page."""
    q = Q.with_rank(queue_of(spark, sf)).select("id", "url", "depth", "status")
    pages = linked_of(spark, sf).select("page_id", "html")
    return q.withColumn("claim_rank", F.col("id") + 1).join(
        pages, F.col("id") == F.col("page_id")
    ).withColumn("html", F.when(F.col("status") != "failed", F.col("html")))


def _answered(spark: SparkSession, sf: str) -> DataFrame:
    """The same batch with failing fetches, pages that cannot be stored, and model answers."""
    kind = F.col("id") % 16
    number = F.col("id").cast("string")
    links = F.when(kind == 9, F.lit('[{"href": "/next", "text": "next"}]')).otherwise(F.lit("[]"))
    answer = F.concat(
        F.lit('{"title": "Answer '), number, F.lit('", "main_content": "about '), number, F.lit('", "links": '), links, F.lit("}")
    )
    return _batch(spark, sf).withColumns(
        {
            "fetch_error": F.when(kind == 8, F.lit("connection reset")),
            "html": F.when(kind == 4, F.concat("html", F.lit("\0"))).otherwise(F.col("html")),
            "response": F.when(kind == 1, F.lit("[1, 2]"))
            .when(kind == 5, F.lit('{"title": "a\\u0000b"}'))
            .when(kind.isin(9, 13), answer),
            "status_code": F.lit(200),
            "content_type": F.lit("text/html"),
        }
    )


@query
def process_outcomes(spark, sf):
    """Every step fails for some pages."""
    done = T.process_pages(_answered(spark, sf), at(), response="response")
    return done.outcomes.select("id", "failure")


@query
def process_stored(spark, sf):
    """Pages as they are stored; those whose analysis fails are among them."""
    done = T.process_pages(_answered(spark, sf), at(), response="response")
    return done.pages.select("url_id", "url", F.length("html").cast("bigint").alias("chars"), "status_code", "content_type")


@query
def process_answers(spark, sf):
    """Extractions by heuristics, or from the model's answer where there is one."""
    done = T.process_pages(_answered(spark, sf), at(), response="response")
    return done.extractions.select(
        "url_id", F.col("confidence").cast("double").alias("confidence"), F.col("payload.title").alias("title")
    )


@query
def process_extractions(spark, sf):
    done = T.process_pages(_batch(spark, sf), at())
    return done.extractions.select(
        "url_id",
        "schema_name",
        F.col("confidence").cast("double").alias("confidence"),
        F.round(F.col("geo_score").cast("double"), 5).alias("geo_score"),
        F.col("payload.title").alias("title"),
    )


@query
def process_discoveries(spark, sf):
    done = T.process_pages(_batch(spark, sf), at())
    return done.discoveries.select(
        "url", big("priority"), F.round(F.col("geo_score").cast("double"), 5).alias("geo_score"),
        "source", big("depth"), "parent_url_id",
    )


@query
def replay_rounds(spark, sf):
    """Three rounds over the stored corpus."""
    start = queue_of(spark, sf)
    batch = max(1, start.count() // REPLAY_SHARE)
    end = T.replay(start, linked_of(spark, sf), at(), REPLAY_ROUNDS, batch, first_id=1 << 40)
    return end.select(
        "url", "status", big("priority"), r6d("geo_score"), "source", big("depth"), big("retries")
    )


# --- fetch runs --------------------------------------------------------------


def log_of(spark: SparkSession, sf: str) -> DataFrame:
    return X.derive(spark, sf, X.FETCH_LOG)


def _extracted(spark: SparkSession, sf: str) -> DataFrame:
    docs = X.table(spark, sf, "documents")
    return docs.select(
        F.concat(F.lit("run-"), (F.col("doc_id") % 2).cast("string")).alias("run"),
        char_count(F.col("text")).alias("chars"),
    ).filter("chars > 0")


def _wall(log: DataFrame) -> DataFrame:
    """Run totals with throughput from the first to the last fetch."""
    wall = log.groupBy("run").agg(
        ((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 1000.0).alias("wall_ms")
    )
    totals = R.run_totals(log).join(wall, "run")
    return totals.withColumn(
        "pages_per_sec", R.throughput(F.col("total_urls"), F.col("wall_ms"))
    )


@query
def p95_by_run(spark, sf):
    p95 = exact_quantile(log_of(spark, sf), ["run", "status"], "ms")
    return p95.select("run", "status", "n", "p95")


@query
def p95_merged(spark, sf):
    """Sketches of every minute, stored and merged to runs: is the rank of their p95 within the error?"""
    log, keys = log_of(spark, sf), ["run", "status"]
    minutes = log.withColumn("minute", F.date_trunc("minute", "ts"))
    folder = fresh_folder(spark, "sketches")
    quantile_sketches(minutes, [*keys, "minute"], "ms").write.parquet(folder)
    merged = merged_sketches(spark.read.parquet(folder), keys)
    return ranks_hold(log, merged.select(*keys, sketch_quantile(F.col("sketch")).alias("p95")), keys, "ms", "p95")


@query
def run_summary(spark, sf):
    made = R.run_summary(log_of(spark, sf), _extracted(spark, sf))
    return made.select(
        "run", "fetched", "total_urls", r6("avg_ms"), "p95_ms", "total_bytes", "extracted_docs",
        "total_chars",
    )


@query
def rates(spark, sf):
    made = R.with_rates(_wall(log_of(spark, sf)))
    return made.select(
        "run", r6("wall_ms"), r6("pages_per_sec"), r6("pages_per_min"), r6("pages_per_day"),
        F.round("mb_per_sec", 9).alias("mb_per_sec"),
    )


@query
def run_equal(spark, sf):
    return R.same_total(R.extraction_stats(_extracted(spark, sf), ["run"]))


@query
def extraction_stats(spark, sf):
    docs = X.table(spark, sf, "documents")
    made = R.extraction_stats(
        docs.select("lang", char_count(F.col("text")).alias("chars")), ["lang"]
    )
    return made.select("lang", "extracted_docs", r6("avg_chars"), "total_chars")


@query
def parse_lines(spark, sf):
    """Result lines printed from run totals by user, parsed back; some are cut short."""
    log = log_of(spark, sf)
    per = log.groupBy((F.col("id") % 50).alias("k")).agg(
        F.count_if(F.col("status") == "ok").alias("ok"),
        F.count(F.lit(1)).alias("n"),
        F.sum("bytes").alias("b"),
    )
    line = F.concat(
        F.when(F.col("k") % 2 == 0, F.lit("> cpp")).otherwise(F.lit("rust")),
        F.lit(" fetched="), F.col("ok").cast("string"), F.lit("/"), F.col("n").cast("string"),
        F.lit("  avg_ms="), F.col("k").cast("string"), F.lit(".5 p95_ms=265.4 pages_per_sec=6.25"),
        F.when(F.col("k") % 10 == 3, F.lit("")).otherwise(
            F.concat(F.lit("\ttotal_bytes="), F.col("b").cast("string"))
        ),
    )
    return SF.parse_run_lines(per.select("k", line.alias("line"))).drop("line")


@query
def fetch_log_roundtrip(spark, sf):
    """The log written as TSV per run, read back and counted."""
    folder = fresh_folder(spark, "fetchlog")
    log = log_of(spark, sf)
    for run in ("run-0", "run-1"):
        SF.write_fetch_log(log.filter(F.col("run") == run), f"{folder}/{run}/index.tsv")
    back = SF.fetch_log(spark, [f"{folder}/{run}/index.tsv" for run in ("run-0", "run-1")])
    return back.select(
        "run", "id", "url", "status", big("code"), F.round("ms", 2).alias("ms"), "bytes",
        F.coalesce("html_path", F.lit("")).alias("html_path"),
        F.coalesce("error", F.lit("")).alias("error"),
    )


@query
def url_table(spark, sf):
    """A list of all page URLs in files with blank lines between, numbered as it is read."""
    folder = fresh_folder(spark, "urls")
    pages = X.table(spark, sf, "pages").repartitionByRange(4, "page_id").sortWithinPartitions("page_id")
    blank = F.when(F.col("page_id") % 3 == 0, F.array(F.lit(""), F.lit(" \t"))).otherwise(F.array())
    lines = F.concat(blank.cast("array<string>"), F.array("url"))
    pages.select(F.explode(lines).alias("value")).write.text(folder)
    return SF.url_table(spark, folder)


@query
def extracted_table(spark, sf):
    """Main texts written as a table and read back."""
    folder = fresh_folder(spark, "extracted")
    pages = X.table(spark, sf, "pages").select(F.col("page_id").alias("id"), "url", "html")
    SF.write_extracted(SF.extract_documents(pages), folder)
    back = spark.read.schema(SF.EXTRACTED_SCHEMA).parquet(folder)
    return back.select("id", "url", "chars", "words", F.md5("text").alias("text_md5"))


@query
def saved_pages(spark, sf):
    """Pages saved one to a file, read back by the paths of a log: blank, relative and whole ones."""
    folder = fresh_folder(spark, "saved")
    pages = X.table(spark, sf, "pages").select("page_id", "html")
    SF.write_html(pages, folder)
    saved = SF.saved_html(spark, folder)
    number = F.regexp_extract("html_path", r"/page_id=(-?\d+)[./]", 1).try_cast("bigint")
    below = F.regexp_extract("html_path", r"(part=\d+/page_id=.*)", 1)
    # a page without an id has no path either
    path = F.when(number.isNull() | (number % 7 == 0), F.lit("  ")).when(number % 2 == 0, below).otherwise(F.col("html_path"))
    log = saved.select(number.alias("id"), path.alias("html_path"))
    base = SF.plain_path(F.lit(folder))
    found = SF.attach_html(log, saved, spark.range(1).select(base).first()[0])
    return found.select("id", F.length("html").cast("bigint").alias("chars"), F.md5("html").alias("html_md5"))


@query
def summary_table(spark, sf):
    """Twelve-column run summary, written as TSV and read back."""
    folder = fresh_folder(spark, "summary")
    log = log_of(spark, sf)
    totals = R.with_rates(_wall(log)).join(
        R.extraction_stats(_extracted(spark, sf), ["run"]).drop("avg_chars"), "run"
    )
    SF.write_summary(totals.withColumnsRenamed({"run": "name", "total_urls": "total"}), folder)
    back = SF.read_summary(spark, folder)
    return back.select(
        "name", "fetched", "total", r6("avg_ms"), "p95_ms", r6("pages_per_sec"), r6("pages_per_min"),
        r6("pages_per_day"), F.round("mb_per_sec", 9).alias("mb_per_sec"), "total_bytes",
        "extracted_docs", "total_chars",
    )


@query
def fetch_status(spark, sf):
    log = log_of(spark, sf)
    return (
        log.withColumn("made", H.fetch_status(F.col("error"), F.col("code")))
        .groupBy("made", "status")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def html_guess(spark, sf):
    pages = X.table(spark, sf, "pages")
    body = F.concat(F.repeat(F.lit("é"), (F.col("page_id") % 200).cast("int")), F.col("html"))
    kind = F.when(F.col("page_id") % 3 == 0, F.lit("text/html; charset=utf-8")).when(
        F.col("page_id") % 3 == 1, F.lit("image/png")
    )
    return pages.select(
        "page_id",
        H.looks_like_html(kind, body).alias("whole_body"),
        H.looks_like_html(kind, body, 256).alias("first_bytes"),
        H.media_type(kind).alias("media_type"),
    )


# --- workers and experiments --------------------------------------------------


def worker_log(spark: SparkSession, sf: str) -> DataFrame:
    return X.derive(spark, sf, X.OUTCOMES)


def _metric_row(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        "worker", *extra, "processed_count", "failed_count", "frontier_enqueued",
        F.col("avg_latency_ms").cast("double").alias("avg_latency_ms"),
        F.col("p95_latency_ms").cast("double").alias("p95_latency_ms"),
    )


@query
def worker_metrics(spark, sf):
    return _metric_row(W.worker_metrics(worker_log(spark, sf)))


@query
def metrics_flush(spark, sf):
    return _metric_row(W.metric_snapshots(worker_log(spark, sf)), "outcome_id", "final")


@query
def latest_metrics(spark, sf):
    snapshots = W.metric_snapshots(worker_log(spark, sf))
    return _metric_row(W.latest_metrics(snapshots), "outcome_id")


@query
def metrics_append(spark, sf):
    """Final metrics appended twice to a metrics table, read back."""
    folder = fresh_folder(spark, "metrics")
    depth = Q.queue_depth(queue_of(spark, sf)).first()[0]
    final = W.worker_metrics(worker_log(spark, sf), F.lit(depth).cast("bigint")).withColumn(
        "recorded_at", at()
    )
    for _ in range(2):
        SN.append_metrics(final, folder)
    back = SN.read_metrics(spark, folder)
    return back.groupBy("worker").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("processed_count").alias("processed_count"),
        F.max("queue_depth").alias("queue_depth"),
    )


METRIC_NAMES = ["processed", "latency", "gain"]


def _trials(spark: SparkSession, sf: str) -> DataFrame:
    """Per event type (policy) and day (trial) a few made metrics."""
    events = X.table(spark, sf, "events")
    return events.groupBy(F.col("event_type").alias("policy"), F.to_date("ts").alias("trial")).agg(
        F.count(F.lit(1)).cast("double").alias("processed"),
        F.avg("value").alias("latency"),
        F.sum(F.col("user_id") % 7).cast("double").alias("gain"),
    )


@query
def trial_means(spark, sf):
    made = R.trial_means(_trials(spark, sf), METRIC_NAMES)
    return made.select("policy", *[r6(m) for m in METRIC_NAMES])


@query
def lift(spark, sf):
    made = R.lift(
        R.trial_means(_trials(spark, sf), METRIC_NAMES), "view", METRIC_NAMES, ["latency"]
    )
    return made.select("policy", "metric", r6("value"), r6("baseline"), r6("lift_pct"))


# --- streams -------------------------------------------------------------------


@query
def stream_pages(spark, sf):
    """Pages analysed by a stream that stops after the files at hand."""
    out = fresh_folder(spark, "stream-pages")
    # a pattern, since a stream takes the path of one file only as such
    pages = SI.page_stream(spark, f"{sf}/pages.parque[t]")
    SI.ingest(pages, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return _signal_row(spark.read.parquet(f"{out}/rows"))


@query
def stream_queue(spark, sf):
    """Queue snapshot after a stream merged the links of all pages into it."""
    out = fresh_folder(spark, "stream-queue")
    queue_of(spark, sf).write.parquet(SI.snapshot_path(out, 0))
    # pages whose links are absolute, as a folder that a stream can watch
    X.derive(spark, sf, X.LINKED_PAGES).write.parquet(f"{out}/pages")
    stream = SI.update_queue(
        SI.page_stream(spark, f"{out}/pages"), out, f"{out}/checkpoint", at(), 1 << 50
    )
    stream.awaitTermination()
    done = stream.lastProgress["batchId"] + 1 if stream.lastProgress else 0
    merged = SI.newest_snapshot(spark, out, done)
    return merged.select(
        "url", "status", big("priority"), r6d("geo_score"), "source", big("depth"), "parent_url_id"
    )


@query
def stream_metrics(spark, sf):
    """Hourly worker metrics by a stream, with a last flush of the windows open at its end."""
    out = fresh_folder(spark, "stream-metrics")
    worker_log(spark, sf).write.parquet(f"{out}/outcomes")
    schema = spark.read.parquet(f"{out}/outcomes").schema
    rows = spark.readStream.schema(schema).parquet(f"{out}/outcomes")
    SM.run_metrics(rows, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    # a stream's own folder lists its files in a log, so the flush has one of its own
    streamed = spark.read.parquet(f"{out}/rows")
    streamed.write.parquet(f"{out}/all")
    SM.final_flush(spark.read.parquet(f"{out}/outcomes"), f"{out}/all")
    made = spark.read.parquet(f"{out}/all")
    return made.select(
        F.col("window_start").cast("string").alias("window_start"),
        "worker", "processed_count", "failed_count", "frontier_enqueued", r6("avg_latency_ms"),
        r6("p95_approx_ms"),
    )


@query
def stream_flush(spark, sf):
    """Snapshots by count from the state of a stream, and a last one of each worker at its stop."""
    out = fresh_folder(spark, "stream-flush")
    log = worker_log(spark, sf)
    log.write.parquet(f"{out}/outcomes")
    rows = spark.read.parquet(f"{out}/outcomes")
    later = F.lit(rows.agg(F.max("ts")).first()[0]) + F.expr("INTERVAL 1 DAY")
    SM.stop_row(spark, rows.schema, later).write.mode("append").parquet(f"{out}/outcomes")
    stream = spark.readStream.schema(rows.schema).parquet(f"{out}/outcomes")
    SM.run_counted_metrics(stream, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return _metric_row(spark.read.parquet(f"{out}/rows"), "outcome_id", "final")
