"""Topical page signals and their weighted score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import DEFAULTS, JSON_LD_MARK, STRUCTURED_TERMS, Params
from .text import clamp, element_has_any, has_any, head, keyword_hits, recent_year, term_count

SIGNALS = (
    "geo_term_density",
    "freshness_signal",
    "structured_data_signal",
    "link_quality_signal",
)
SIGNALS_TYPE = "struct<" + ",".join(f"{s}:double" for s in SIGNALS) + ">"

# Text looked at, and the level each finding gives.
SCORED_CHARS = 5000
DATED, RECENT = 0.65, 0.8
JSON_LD, STRUCTURED = 0.7, 0.6
COUNTED_LINKS = 15


def aggregate_score(signals: Column, params: Params = DEFAULTS) -> Column:
    """Weighted sum of the four signals, in list order, clamped to [0, 1]."""
    total = None
    for name, weight in zip(SIGNALS, params.signal_weights):
        part = signals[name] * F.lit(weight)
        total = part if total is None else total + part
    return clamp(total)


def with_signals(
    df: DataFrame, url: str = "url", payload: str = "payload", params: Params = DEFAULTS
) -> DataFrame:
    """Add ``signals`` and ``page_score`` to rows that carry a payload."""
    page = F.col(payload)
    content = F.coalesce(page["main_content"], F.lit(""))
    blob = F.concat_ws(
        "\n",
        F.col(url),
        F.coalesce(page["title"], F.lit("")),
        F.coalesce(page["description"], F.lit("")),
        head(content, SCORED_CHARS),
    )
    staged = df.withColumns({"_blob": blob, "_content": F.lower(content)}).withColumn(
        "_lowered", F.lower("_blob")
    )
    strong = F.size(
        F.filter(
            F.transform(page["links"], lambda a: F.lower(F.concat_ws(" ", a["href"], a["text"]))),
            lambda text: element_has_any(text, params.geo_terms),
        )
    )
    counted = F.greatest(F.lit(1), F.least(F.size(page["links"]), F.lit(COUNTED_LINKS)))
    signals = F.struct(
        clamp(
            keyword_hits(term_count(F.col("_lowered"), params.geo_terms), params.geo_terms)
            * F.lit(params.density_gain)
        ).alias(SIGNALS[0]),
        F.greatest(
            F.when(F.coalesce(page["article_date"], F.lit("")) != "", F.lit(DATED)).otherwise(0.0),
            F.when(recent_year(F.col("_blob")), F.lit(RECENT)).otherwise(0.0),
        ).alias(SIGNALS[1]),
        F.greatest(
            F.when(F.contains("_content", F.lit(JSON_LD_MARK)), F.lit(JSON_LD)).otherwise(0.0),
            F.when(has_any(F.col("_content"), STRUCTURED_TERMS), F.lit(STRUCTURED)).otherwise(0.0),
        ).alias(SIGNALS[2]),
        clamp(strong / counted).alias(SIGNALS[3]),
    )
    return (
        staged.withColumn("signals", signals)
        .drop("_blob", "_content", "_lowered")
        .withColumn("page_score", aggregate_score(F.col("signals"), params))
    )
