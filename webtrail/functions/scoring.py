"""Link score, blend, priority and queue rank."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import DEFAULTS, Params
from .text import clamp, element_term_count, keyword_hits

# Path-depth penalty, reason levels, priority bonus.
FREE_SLASHES, SLASH_PENALTY, MAX_PENALTY = 5, 0.05, 0.28
GEO_DENSE, SAME_HOST, NOISY = 0.7, 0.9, 0.3
REASONS = ("geo-dense", "host-affinity", "likely-noise", "explore")
DEPTH_BONUS, DEPTH_STEP = 20, 6


def geo_part(lowered: Column, params: Params = DEFAULTS) -> Column:
    found = element_term_count(lowered, params.geo_terms)
    return clamp(keyword_hits(found, params.geo_terms) * F.lit(params.link_geo_gain))


def noise_part(lowered: Column, params: Params = DEFAULTS) -> Column:
    found = element_term_count(lowered, params.noise_terms)
    return clamp(keyword_hits(found, params.noise_terms) * F.lit(params.link_noise_gain))


def slash_penalty(path: Column) -> Column:
    slashes = F.length(path) - F.length(F.replace(path, F.lit("/")))
    return F.when(
        slashes > FREE_SLASHES,
        F.least(F.lit(MAX_PENALTY), (slashes - FREE_SLASHES) * F.lit(SLASH_PENALTY)),
    ).otherwise(F.lit(0.0))


def link_score(
    geo: Column, noise: Column, host: Column, penalty: Column, params: Params = DEFAULTS
) -> Column:
    w_geo, w_host, w_clean = params.link_weights
    return clamp(
        geo * F.lit(w_geo)
        + host * F.lit(w_host)
        + (F.lit(1.0) - noise) * F.lit(w_clean)
        - penalty
    )


def link_reason(geo: Column, noise: Column, host: Column) -> Column:
    """First rule that applies names the link."""
    return (
        F.when(geo > GEO_DENSE, F.lit(REASONS[0]))
        .when(host > SAME_HOST, F.lit(REASONS[1]))
        .when(noise > NOISY, F.lit(REASONS[2]))
        .otherwise(F.lit(REASONS[3]))
    )


def blend(link: Column, page: Column, params: Params = DEFAULTS) -> Column:
    w_link, w_page = params.blend_weights
    return clamp(link * F.lit(w_link) + page * F.lit(w_page))


def priority(blended: Column, depth: Column) -> Column:
    """Percent of the blend, rounded up, plus a bonus that shrinks with depth."""
    bonus = F.greatest(F.lit(0), F.lit(DEPTH_BONUS) - depth * F.lit(DEPTH_STEP))
    return (F.ceil(blended * F.lit(100.0)) + bonus).cast("int")


def queue_rank(prio: Column, geo_score: Column) -> Column:
    """Priority plus the 32-bit score in percent, rounded half to even."""
    return prio + F.rint(geo_score.cast("double") * 100).cast("int")
