import plain
import pytest
from pyspark.sql import functions as F

from webtrail.functions import html as H
from webtrail.functions import text as T
from webtrail.functions import urls as U
from webtrail.functions.payload import heuristic_payload, model_payload
from webtrail.functions.signals import with_signals

HREFS = [
    "", "  ", "HTTP://A.B:80/x;p?q#f", "//h/p", "?q", "#f", "../a/./b", "mailto:x", "http://u@H/",
    "http://h?", "http://[bad", "http://[::1]:8/x", "http://[1:2:3:4:5:6:7:8]/", "http://[1.2.3.4]/",
    "http://[1::2:3:4:5:6:7:8]/", "http://[::ffff:1.2.3.4]/", "http://[v1.x]/", "http://[fe80::1%e0]/",
    "a b", " /x ", "/x y", "http:foo", "https:foo", "http:/x", "http:////x", "http:///y", "http:",
    "http:?q", "/../x", "..", "../..", "../../..", "./", "a//b//c", "/a//b", "/a//../b", "//", "///x",
    ";x", ";", "?", "a;b/c", "/a;b;c", "/a;b/c;d", "a;b?c;d#e;f", "http://h/a #f", "http://h/? #f",
    "http://h/ ? #f", "x:y", "javascript:void(0)", "1http://a", "ht\ttp://a\n/b", "/ x",
    "/x; ", "HTTP://É.com/É", "http://h/p?a=http://b/c?d#e", "http://a℀b/", "http://::1]/",
    "..;x", "/.", "/..", "/a/.", "/a/..", "/a/.x", "/..x", "a/../..", "\x00\x01/x", "//H:80",
    "\x1fhttp://a/b", "http://h/\x85#f",
]
BASES = [
    "http://h.com/a/b/c?x=1#f", "https://H.com", "http://h.com/", "http://h.com/a;p/b;q?z",
    "ftp://x/y", "http:/nohost/x", "http://h.com/a//b/", "https://u@h:1/x/..", "", "http://[bad/x",
]


def test_urls_match_standard_library(spark):
    rows = spark.createDataFrame([(b, h) for b in BASES for h in HREFS], "b string, h string")
    got = rows.repartition(8).select(
        "b", "h",
        U.canonicalize_url(F.col("h")).alias("c"),
        U.resolve_url(U.split_url(F.col("b")), F.col("h")).alias("r"),
        U.settled_links(F.array(F.struct(U.canonicalize_url(F.col("h")).alias("href"))), ())[0][
            "href"
        ].alias("twice"),
    ).collect()
    for r in got:
        assert r.c == plain.canonical(r.h), r.h
        assert r.r == plain.resolve(r.b, r.h), (r.b, r.h)
        assert r.twice == plain.canonical(plain.canonical(r.h)), r.h


def test_known_canonical_url(spark):
    row = spark.range(1).select(
        U.canonicalize_url(F.lit("https://Example.com/maps/path#frag")).alias("u")
    ).first()
    assert row.u == "https://example.com/maps/path"


def test_host_affinity(spark):
    pairs = [("http://a.x.org/", "http://b.x.org/"), ("http://x.org", "http://x.org/1"),
             ("http://h", "http://h2"), ("http:/p", "http://x.org"), ("http://x.org", "http://y.org")]
    rows = spark.createDataFrame(pairs, "a string, b string")
    got = rows.select("a", "b", U.host_affinity(U.host_of(F.col("a")), U.host_of(F.col("b"))).alias("s"))
    for r in got.collect():
        assert r.s == plain.affinity(r.a, r.b)


def test_payload_matches_plain_statement(pages):
    made = heuristic_payload(pages).collect()
    assert len(made) > 500
    for r in made:
        want = plain.payload(r.html, r.url)
        got = r.payload.asDict()
        assert [(a.href, a.text) for a in got["links"]] == want["links"], r.url
        for name in ("title", "description", "main_content", "geo_entities", "location_hints",
                     "vps_relevance", "reconstruction_relevance", "recency_signal"):
            assert got[name] == want[name], (r.url, name)
        assert r.confidence == want["confidence"]


def test_scores_match_plain_statement(pages):
    for r in with_signals(heuristic_payload(pages)).collect():
        assert r.page_score == pytest.approx(plain.page_score(r.url, plain.payload(r.html, r.url)), abs=1e-12)


def test_dom_summary(pages):
    for limit in (50000, 300):
        for r in pages.withColumn("s", H.dom_summary(F.col("html"), limit)).collect():
            assert r.s == plain.dom_summary(r.html, limit), r.url


def test_word_count_and_strip(spark):
    texts = ["", " ", "a", " a b\x1cc ", " x\x85", "é è"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in rows.select(
        "t", T.word_count(F.col("t")).alias("n"), T.strip(F.col("t")).alias("s"), T.squeeze(F.col("t")).alias("q")
    ).collect():
        assert (r.n, r.s, r.q) == (len(r.t.split()), r.t.strip(), " ".join(r.t.split()))


def test_unit_float(spark):
    def want(text):
        try:
            value = float(text)
        except ValueError:
            return 0.5
        return max(0.0, min(1.0, value))

    texts = ["1", "0.25", " .5 ", "-3", "1e-1", "1_0.5", "nan", "inf", "-inf", "x", "", "0.5d", "1f", "0x1", "1.", "+.5", "1__0"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in rows.select("t", T.unit_float(F.col("t"), 0.5).alias("v")).collect():
        assert r.v == want(r.t), r.t


def test_model_payload_shapes(spark):
    cases = {
        "null": '"x"',
        "number": "7",
        "text": "not json",
        "two": '{"title": "a"} {"title": "b"}',
        "comma": '{"title": "a"}, {"title": "b"}',
        "close": '1], [2',
        "odd": '```\n{"title": "  ", "main_content": 0, "links": {"a": 1}, "geo_entities": [1, null, true, "x"],'
               ' "vps_relevance": true, "recency_signal": "7", "reconstruction_relevance": [1]}\n```',
        "full": '{"title": " T ", "main_content": "m", "links": [{"href": " /a ", "text": null}, 3,'
                ' {"href": ""}], "article_date": 2024, "author": false}',
    }
    rows = spark.createDataFrame(list(cases.items()), "k string, response string")
    got = {r.k: r for r in model_payload(rows).collect()}
    assert got["null"].outcome == got["number"].outcome == "failed"
    assert "'str' object" in got["null"].error and "'int' object" in got["number"].error
    for k in ("text", "two", "comma", "close"):
        assert (got[k].outcome, got[k].parse_error, got[k].confidence) == ("ok", True, 0.62), k
    odd = got["odd"].payload
    assert (odd.title, odd.main_content, odd.links) == ("", "", [])
    assert odd.geo_entities == ["1", "None", "True", "x"]
    assert (odd.vps_relevance, odd.recency_signal, odd.reconstruction_relevance) == (1.0, 1.0, 0.0)
    full = got["full"]
    assert full.confidence == 0.95 and full.payload.title == "T"
    assert [(a.href, a.text) for a in full.payload.links] == [("/a", "")]
    assert full.payload.article_date == "2024" and full.payload.author is None
