"""Inputs that would kill an executor or hold a task for minutes, and rows easily lost."""

import time

import pytest
from pyspark.sql import functions as F

from webtrail.functions import html as H
from webtrail.functions import text as T
from webtrail.functions import urls as U
from webtrail.operators import queue as Q
from webtrail.operators import store as ST
from webtrail.plans import process as P


def one(spark, fn, value):
    row = spark.createDataFrame([(value,)], "v string").repartition(2).select(fn(F.col("v")).alias("r"))
    start = time.time()
    made = row.first()[0]
    assert time.time() - start < 60
    return made


@pytest.mark.parametrize("text, value", [
    ("1" * 1_000_000, 1.0), ("0." + "1" * 1_000_000 + "x", 0.5), ("." + "0" * 1_000_000, 0.0), ("1_" * 400_000, 0.5),
    ("0_0.2_5", 0.25), ("1__0", 0.5), ("_1", 0.5), ("1_", 0.5), ("1_.0", 0.5), (".5e-1", 0.05), ("2.", 1.0), (".", 0.5),
    ("1e_1", 0.5), ("1e1_0", 1.0), ("-inf", 0.0), ("Infinity", 1.0), ("0x1", 0.5), ("", 0.5), (None, 0.5),
])
def test_numbers(spark, text, value):
    assert one(spark, lambda c: T.unit_float(c, 0.5), text) == pytest.approx(value)


@pytest.mark.parametrize("host, good", [
    (":".join(["1"] * 9000), False), ("1::" + ":".join(["1"] * 9000), False), ("::", True), ("::1", True), ("1::", True),
    ("1:::2", False), (":1::2", False), ("1::2:", False), ("1::2::3", False), ("1:2:3:4:5:6:7::", True),
    ("1:2:3:4:5:6:7:8::", False), ("1:2:3:4:5:6:7:8", True), ("12345::", False), ("g::", False), ("::1.2.3.4", True), (":", False),
])
def test_bracketed_hosts(spark, host, good):
    url = f"http://[{host}]/x"
    assert one(spark, U.canonicalize_url, url) == (url if good else "")


@pytest.mark.parametrize("fn, page, made", [
    (lambda c: F.size(H.anchors(c)), '<a href="x">' * 90_000, 0),
    (lambda c: F.size(H.anchors(c)), '<a href="x">t</a>' + '<a href="x">' * 90_000, 1),
    (H.page_text, "a" + "<script>" * 130_000, "a"), (H.page_text, "a<STYLE>x</style>" + "<style>" * 130_000 + "b", "a b"),
    (H.main_text, "a" + "<nav>" * 200_000 + "b<footer>c</footer >d", "a b d"), (H.main_text, "<!-- x -->a" + "<!-- >" * 150_000, "a"),
    (lambda c: H.dom_summary(c, 20), "a<script>x</script>" + "<script>" * 130_000, "a<script><script><sc\n... [truncated]"),
])
def test_unclosed_blocks(spark, fn, page, made):
    assert one(spark, fn, page) == made


MB = 1_000_000


@pytest.mark.parametrize("fn, page, made", [
    (H.page_text, "<" * MB, "<" * MB), (H.page_text, "a<b>c" + "<" * MB, "a c" + "<" * MB),
    (H.main_text, "x" + "<!-" * (MB // 3), "x" + "<!-" * (MB // 3)),
    (H.page_text, "<script" * (MB // 7) + ">b", None), (H.main_text, "<nav " * (MB // 5) + ">b", "b"),
    (lambda c: F.size(H.anchors(c)), "<a " * (MB // 3), 0),
    (lambda c: F.size(H.anchors(c)), "<a " * (MB // 3) + "</a>", 0),
    (lambda c: F.size(H.anchors(c)), "<a " * (MB // 3) + 'href="x">t</a>', 1),
    (lambda c: H.anchors(c)[0]["text"], '<a href="x">t' + "<" * MB + "</a>", "t" + "<" * 219),
    (H.title, "<title" * (MB // 6), None), (H.title, "<title" * (MB // 6) + "><title>t</title>", "t"),
    (H.description, "<meta " * (MB // 6), None),
    (H.description, '<meta name="description" ' * (MB // 25), None),
    (H.description, '<meta name="description" ' * (MB // 25) + '><meta name="description" content="d">', "d"),
    (lambda c: F.length(H.dom_summary(c, 2 * MB)), "<a " * (MB // 3), 3 * (MB // 3)),
])
def test_tags_that_never_end(spark, fn, page, made):
    got = one(spark, fn, page)
    assert made is None and got in (None, "<script" * (MB // 7) + ">b", "b") or got == made


SHAPE = "k long, at long, seq long, v string"


def test_latest_rows(spark):
    rows = [(1, None, 1, "a"), (2, 5, None, "b"), (2, 5, 1, "c"), (None, 1, 1, "d"), (None, 2, 1, "e"), (3, 1, 1, "f"), (3, 1, 1, "f")]
    got = ST.latest_by(spark.createDataFrame(rows, SHAPE), "k", ["at", "seq"]).collect()
    assert sorted(((r.k, r.v) for r in got), key=str) == sorted([(1, "a"), (2, "c"), (None, "e"), (3, "f")], key=str)
    tied = [(1, 1, 1, "x"), (1, 1, 1, "y")]
    assert ST.latest_by(spark.createDataFrame(tied, SHAPE), "k", ["at", "seq"]).count() == 1


def test_stored_rows(spark):
    stored = spark.createDataFrame([(1, 5, 1, "old"), (2, 5, 1, "old"), (3, None, 1, "old"), (None, 1, 1, "old")], SHAPE)
    fresh = spark.createDataFrame([(1, 4, 9, "new"), (2, 5, 1, "new"), (2, 5, 1, "new"), (3, 1, None, "new"), (4, None, None, "new"), (None, 1, 2, "new")], SHAPE)
    got = ST.store_latest(stored, fresh, "k", ["at", "seq"])
    want = {(1, "old"), (2, "new"), (3, "new"), (4, "new"), (None, "new")}
    assert {(r.k, r.v) for r in got.collect()} == want and got.count() == 5
    assert {(r.k, r.v) for r in ST.store_latest(got, fresh, "k", ["at", "seq"]).collect()} == want


def test_unusable_urls_find_no_page(spark):
    pages = spark.createDataFrame([(1, "ftp://z/"), (2, "http://a.org/x")], "page_id long, url string")
    claims = spark.createDataFrame([(1, "mailto:x"), (2, None), (3, "HTTP://A.org/x#f")], "id long, url string")
    assert {(r.id, r.page_id) for r in P.fetch_lookup(claims, pages).collect()} == {(1, None), (2, None), (3, 2)}


def test_repeated_removals(spark, sf_dir):
    from webtrail.plans.catalog import queue_of

    queue = queue_of(spark, sf_dir)
    ids = queue.select("id").filter("id % 7 = 0")
    once, twice = Q.delete_urls(queue, ids), Q.delete_urls(queue, ids.union(ids))
    assert once.count() == twice.count() == queue.count() - ids.count()
    assert once.exceptAll(twice).isEmpty()
