from dataclasses import replace

import plain
import pytest
from pyspark.sql import functions as F

from webtrail.functions.payload import PAYLOAD_TYPE
from webtrail.functions.signals import with_signals
from webtrail.operators import links as L
from webtrail.params import DEFAULTS
from webtrail.plans.pages import analyze_pages


def test_candidates_match_plain_statement(pages):
    analyzed = analyze_pages(pages).withColumn("depth", (F.col("page_id") % 3).cast("int"))
    got = {}
    for r in L.frontier_candidates(analyzed, ["page_id"]).collect():
        got.setdefault(r.page_id, []).append((r.ord, r.child, r.geo_score, r.priority, r.reason))
    seen = 0
    for r in pages.collect():
        p = plain.payload(r.html, r.url)
        want = plain.frontier(r.url, p, r.html, plain.page_score(r.url, p), r.page_id % 3)
        have = sorted(got.get(r.page_id, []))
        assert [(h[1], h[3], h[4]) for h in have] == [(w[0], w[2], w[3]) for w in want], r.url
        assert [h[2] for h in have] == pytest.approx([w[1] for w in want], abs=1e-12)
        seen += len(want)
    assert seen > 1000


def test_extract_links_keeps_first_and_stops(pages):
    for limit in (80, 5):
        for r in L.extract_links(pages, max_links=limit).collect():
            assert [(a.href, a.text) for a in r.links] == plain.html_links(r.html, r.url, limit)


def _payload_row(spark, **fields):
    names = ["title", "main_content", "links", "description", "article_date", "author",
             "geo_entities", "location_hints", "vps_relevance", "reconstruction_relevance", "recency_signal"]
    defaults = {"main_content": "", "links": [], "geo_entities": [], "location_hints": [],
                "vps_relevance": 0.0, "reconstruction_relevance": 0.0, "recency_signal": 0.0}
    row = tuple({**defaults, **fields}.get(n) for n in names)
    return spark.createDataFrame([(row,)], f"payload {PAYLOAD_TYPE}")


def test_topical_payload_scores_well(spark):
    page = _payload_row(
        spark,
        title="Lidar survey of a harbour",
        description="Terrain meshes from drone imagery",
        main_content="Each street is a gis layer; robots use the coordinate grid for navigation.",
        links=[("https://maps.test/terrain", "satellite tiles")],
        article_date="3 May",
    ).withColumn("url", F.lit("https://survey.test/urban/positioning"))
    row = with_signals(page).first()
    assert row.page_score > 0.35
    assert row.signals.freshness_signal == 0.65


@pytest.mark.parametrize("limit", [1, 3])
def test_pages_at_the_depth_limit_are_not_expanded(spark, limit):
    links = [("https://atlas.test/terrain", "Terrain grid"), ("https://atlas.test/about", "Who we are")]
    page = _payload_row(spark, title="Atlas", main_content="Grids.", links=links).select(
        "payload", F.lit("https://atlas.test/start").alias("url"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("depth"),
        F.lit(0.4).alias("page_score"),
        F.array().cast("array<struct<href:string,text:string>>").alias("anchors"),
    )
    found = L.frontier_candidates(page, ["url"], params=replace(DEFAULTS, max_depth=limit))
    assert found.groupBy("depth").count().count() == limit and found.count() == 2 * limit


def test_page_analysis_has_no_shuffle_and_reads_html_once(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    made = L.worth_queueing(L.expand(L.with_candidates(analyze_pages(pages)), ["page_id"]))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("<title[^>]*>") == 1, "page patterns must not be evaluated twice"
