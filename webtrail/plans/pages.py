"""Page analysis: HTML in, payload, confidence, signals and score out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.payload import heuristic_payload
from ..functions.signals import with_signals
from ..operators.links import with_candidates
from ..params import DEFAULTS, Params


def analyze_pages(
    pages: DataFrame, html: str = "html", url: str = "url", params: Params = DEFAULTS
) -> DataFrame:
    """Add anchors, payload, confidence, signals and page_score; drop the HTML."""
    return with_signals(heuristic_payload(pages, html, url, params), url, params=params).drop(html)


def analyze_links(
    pages: DataFrame, html: str = "html", url: str = "url", params: Params = DEFAULTS
) -> DataFrame:
    """Page analysis plus the ranked ``candidates`` of each page."""
    return with_candidates(analyze_pages(pages, html, url, params), url=url, params=params).drop(
        "anchors"
    )


def top_pages(pages: DataFrame, n: int = 20, key: str = "page_id") -> DataFrame:
    """The ``n`` best pages by score; a bounded top-k, not a full sort."""
    scored = analyze_pages(pages)
    return (
        scored.select(
            key,
            "url",
            F.round("page_score", 6).alias("page_score"),
            F.col("payload.title").alias("title"),
        )
        .orderBy(F.col("page_score").desc(), F.col(key))
        .limit(n)
    )
