"""Settings, term lists and weights shared by the operators.

Everything that a caller may want to change lives in :class:`Params`, so the
topic is not tied to geography: pass other term lists or weights and every
operator follows.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values (must be exactly these for the scores to come out right)
# ---------------------------------------------------------------------------

GEO_TERMS = (
    "map", "mapping", "geospatial", "geography", "terrain", "satellite", "imagery",
    "street", "city", "urban", "vps", "localization", "positioning", "ar", "xr",
    "robot", "robotics", "autonomous", "drone", "navigation", "wayfinding", "3d",
    "reconstruction", "sfm", "gaussian", "splatting", "mesh", "pointcloud",
    "coordinate", "gis", "lidar",
)

NOISE_TERMS = (
    "login", "signup", "privacy", "terms", "careers", "contact", "cookie",
    "advertise", "sponsor",
)

# Entities looked for in a page, in reporting order.
ENTITY_TERMS = (
    "map", "mapping", "geospatial", "city", "street", "vps", "localization",
    "positioning", "navigation", "3d", "reconstruction", "sfm", "mesh", "pointcloud",
    "ar", "xr", "robot",
)
VPS_TERMS = ("vps", "localization", "positioning", "ar", "xr")
RECONSTRUCTION_TERMS = ("3d", "reconstruction", "sfm", "mesh", "pointcloud")

STRUCTURED_TERMS = ("schema.org", "geo", "latitude", "longitude")
JSON_LD_MARK = "application/ld+json"

QUEUE_STATUSES = ("pending", "in_progress", "done", "failed")
SCHEMA_NAME = "spatial-default-v2"


@dataclass(frozen=True)
class Params:
    """Crawl settings; the defaults are the published ones."""

    # frontier
    max_links: int = 16
    max_depth: int = 2
    score_threshold: float = 0.28
    # queue and metrics
    claim_batch: int = 10
    max_retries: int = 3
    flush_every: int = 15
    # topic
    geo_terms: tuple[str, ...] = GEO_TERMS
    noise_terms: tuple[str, ...] = NOISE_TERMS
    entity_terms: tuple[str, ...] = ENTITY_TERMS
    vps_terms: tuple[str, ...] = VPS_TERMS
    reconstruction_terms: tuple[str, ...] = RECONSTRUCTION_TERMS
    # page score: term density, freshness, structured data, link quality
    density_gain: float = 3.4
    signal_weights: tuple[float, float, float, float] = (0.42, 0.18, 0.22, 0.18)
    # link score
    link_geo_gain: float = 3.7
    link_noise_gain: float = 2.6
    link_weights: tuple[float, float, float] = (0.62, 0.28, 0.10)
    # blend of link score and page score
    blend_weights: tuple[float, float] = (0.72, 0.28)


DEFAULTS = Params()
