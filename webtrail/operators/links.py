"""From a page to its best outgoing links, without leaving the page's row.

All links of a page live in one row, so resolving, deduplicating, scoring and
the top-N cut are array operations: nothing is shuffled, and a hub page costs no
more than its own size. Only the few links that survive are exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import scoring as S
from ..functions.text import carry, each, let
from ..functions.urls import (
    NETLOC,
    PARTS,
    PATH,
    canonical_links,
    host_affinity,
    resolved_links,
    settled_links,
    split_url,
)
from ..params import DEFAULTS, Params


def dedup_first(links: Column) -> Column:
    """Keep the first link of every address, in page order.

    Sorting by (address, position) puts equal addresses side by side, so one
    look at the neighbour decides: n log n also for pages with very many links.
    """

    def first_of_run(ordered: Column) -> Column:
        return F.filter(
            ordered,
            lambda a, i: (i == 0) | (F.get(ordered, i - 1)["href"] != a["href"]),
        )

    keyed = F.transform(
        links,
        lambda a, i: F.struct(a["href"].alias("href"), i.alias("pos"), a["text"].alias("text")),
    )
    by_position = F.transform(
        let(F.sort_array(keyed), first_of_run),
        lambda a: F.struct(a["pos"].alias("pos"), a["href"].alias("href"), a["text"].alias("text")),
    )
    return F.transform(
        F.sort_array(by_position),
        lambda a: F.struct(a["href"].alias("href"), a["text"].alias("text")),
    )


def _usable(links: Column) -> Column:
    return F.filter(links, lambda a: a["href"] != "")


def page_links(found: Column, base: Column, max_links: int = 80) -> Column:
    """First ``max_links`` different addresses among the anchors ``found``, resolved
    against ``base`` (a ``split_url`` struct)."""
    return F.slice(dedup_first(_usable(resolved_links(found, base))), 1, max_links)


def extract_links(
    df: DataFrame, html: str = "html", url: str = "url", max_links: int = 80
) -> DataFrame:
    """Add ``links``: the page's outgoing links, resolved and without repeats."""
    return (
        df.withColumns({"_found": H.anchors(F.col(html)), "_base": split_url(F.col(url))})
        .withColumn("links", page_links(F.col("_found"), F.col("_base"), max_links))
        .drop("_found", "_base")
    )


def scored_links(links: Column, parent_host: Column, params: Params = DEFAULTS) -> Column:
    """Canonical links with ``link_score`` and ``reason``, in the same order."""

    def look(a: Column) -> Column:
        return F.struct(
            *carry(a, ["href", "text"]),
            F.lower(F.concat_ws(" ", a["href"], a["text"])).alias("blob"),
        )

    def measure(a: Column) -> Column:
        return F.struct(
            *carry(a, ["href", "text"]),
            S.geo_part(a["blob"], params).alias("geo"),
            S.noise_part(a["blob"], params).alias("noise"),
            host_affinity(parent_host, F.regexp_extract(a["href"], PARTS, NETLOC)).alias("host"),
            S.slash_penalty(F.regexp_extract(a["href"], PARTS, PATH)).alias("penalty"),
        )

    def score(a: Column) -> Column:
        return F.struct(
            *carry(a, ["href", "text"]),
            S.link_score(a["geo"], a["noise"], a["host"], a["penalty"], params).alias("link_score"),
            S.link_reason(a["geo"], a["noise"], a["host"]).alias("reason"),
        )

    return each(links, look, measure, score)


def with_candidates(
    df: DataFrame,
    *,
    url: str = "url",
    payload: str = "payload",
    anchors: str = "anchors",
    page_score: str = "page_score",
    params: Params = DEFAULTS,
) -> DataFrame:
    """Add ``candidates``: the best ``max_links`` links, best first.

    ``array<struct<url, geo_score, reason, ord>>``. The payload's own links come
    first; the links found in the HTML join them only when fewer than half of
    ``max_links`` are usable. Depth plays no part here (see :func:`expand`), so
    one pass over a corpus serves every round of a crawl.
    """
    base = df.withColumns(
        {
            "_base": split_url(F.col(url)),
            "_own": _usable(canonical_links(F.col(payload)["links"])),
        }
    )
    some = F.when(
        F.size("_own") < params.max_links // 2,
        F.concat("_own", page_links(F.col(anchors), F.col("_base"), params.max_links)),
    ).otherwise(F.col("_own"))
    parent_host = F.lower(F.col("_base")["netloc"])
    scored = (
        base.withColumn("_pool", some)
        .withColumn("_unique", dedup_first(_usable(settled_links(F.col("_pool")))))
        .withColumn(
            "_scored",
            scored_links(F.col("_unique"), parent_host, params),
        )
        .withColumn(
            "_ranked",
            F.sort_array(
                F.transform(
                    "_scored",
                    lambda a, i: F.struct(
                        (-S.blend(a["link_score"], F.col(page_score), params)).alias("worst"),
                        i.alias("pos"),
                        a["href"].alias("url"),
                        a["reason"].alias("reason"),
                    ),
                )
            ),
        )
    )
    return scored.withColumn(
        "candidates",
        F.transform(
            F.slice("_ranked", 1, params.max_links),
            lambda a, i: F.struct(
                a["url"].alias("url"),
                (-a["worst"]).alias("geo_score"),
                a["reason"].alias("reason"),
                i.alias("ord"),
            ),
        ),
    ).drop("_base", "_own", "_pool", "_unique", "_scored", "_ranked")


def expand(df: DataFrame, keep: list[str], depth: str | None = None, params: Params = DEFAULTS) -> DataFrame:
    """One row per candidate: the kept columns plus child, geo_score, reason, ord.

    With a depth column, pages at ``max_depth`` give nothing and every candidate
    gets its ``priority``.
    """
    if depth is not None:
        df = df.filter(F.col(depth) < params.max_depth)
        keep = [*keep, depth] if depth not in keep else keep
    # The outer form: for a plain inline Spark derives the filter size(candidates) > 0 and
    # pushes it down to the scan, which would run the whole page analysis twice.
    out = df.select(
        *keep, F.inline_outer("candidates").alias("child", "geo_score", "reason", "ord")
    ).filter(F.col("child").isNotNull())
    if depth is not None:
        out = out.withColumn("priority", S.priority(F.col("geo_score"), F.col(depth)))
    return out


def frontier_candidates(
    df: DataFrame,
    keep: list[str],
    depth: str = "depth",
    params: Params = DEFAULTS,
    **columns: str,
) -> DataFrame:
    """Depth gate, link union, dedup, scores, priority and top-N in one step."""
    open_pages = df.filter(F.col(depth) < params.max_depth)
    return expand(with_candidates(open_pages, params=params, **columns), keep, depth, params)


def worth_queueing(candidates: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Candidates that reach the score threshold (applied after the top-N cut)."""
    return candidates.filter(F.col("geo_score") >= params.score_threshold)
