import datetime as dt
import tempfile
from pathlib import Path

import pytest

from webtrail.functions import html as H
from webtrail.sources import files as SF
from webtrail.sources.row_store import RowStore
from pyspark.sql import functions as F


def folder():
    return Path(tempfile.mkdtemp(prefix="run-", dir="/tmp"))


def test_url_lists(spark):
    path = folder() / "urls.txt"
    path.write_text("http://a/\n\n   \nhttp://b/ \r\nhttp://c/")
    empty = [(r.pos, r.url) for r in SF.url_list(spark, str(path)).collect()]
    assert empty == [(1, "http://a/"), (2, "   "), (3, "http://b/ "), (4, "http://c/")]
    white = [(r.pos, r.url) for r in SF.url_list(spark, str(path), "white").collect()]
    assert white == [(1, "http://a/"), (2, "http://b/ "), (3, "http://c/")]
    assert {r.url.strip() for r in SF.url_table(spark, str(path)).collect()} == {"http://a/", "http://b/", "http://c/"}


def test_fetch_logs(spark):
    assert SF.fetch_log(spark, []).count() == 0
    base = folder()
    for run in ("cpp", "rust"):
        (base / run).mkdir()
        (base / run / "index.tsv").write_text(
            "id\turl\tfinal_url\tstatus\tcode\tms\tbytes\thtml_path\terror\n"
            f"1\thttp://{run}/\thttp://{run}/\tok\t200\t12.50\t10\t{base}/p.html\t\n"
            "2\thttp://x/\t\terror\t0\t\t0\t\ttimed out\n"
        )
    rows = SF.fetch_log(spark, [str(base / r / "index.tsv") for r in ("cpp", "rust")]).orderBy("run", "id").collect()
    assert [(r.run, r.id, r.ms, r.status) for r in rows] == [
        ("cpp", 1, 12.5, "ok"), ("cpp", 2, None, "error"), ("rust", 1, 12.5, "ok"), ("rust", 2, None, "error")]


def test_saved_html_ignores_bad_bytes(spark):
    base = folder()
    (base / "a.html").write_bytes(b"caf\xc3\xa9 \xff<b>x</b>")
    row = SF.saved_html(spark, str(base)).first()
    assert row.html == b"caf\xc3\xa9 \xff<b>x</b>".decode("utf-8", "ignore")
    log = spark.createDataFrame([(1, row.html_path), (2, " ")], "id bigint, html_path string")
    assert [r.id for r in SF.attach_html(log, SF.saved_html(spark, str(base))).collect()] == [1]


def test_run_lines(spark):
    lines = spark.createDataFrame(
        [("cpp fetched=10/10 avg_ms=307.2 p95_ms=265.4 pages_per_sec=6.3 total_bytes=564197",), ("go fetched=1/1",)],
        "line string",
    )
    good, bad = SF.parse_run_lines(lines).orderBy("rejected").collect()
    assert (good.name, good.fetched, good.total, good.avg_ms, good.p95_ms, good.pages_per_sec, good.total_bytes) == (
        "cpp", 10, 10, 307.2, 265.4, 6.3, 564197)
    assert bad.rejected and bad.name is None


def test_main_text_and_documents(spark):
    rows = spark.createDataFrame(
        [(1, "<header>H</header><nav a=1>n</nav><p>Body  text</p><!-- c --><footer>f</footer>"), (2, "<nav>only</nav>")],
        "id bigint, html string",
    )
    got = SF.extract_documents(rows).collect()
    assert [(r.id, r.text, r.chars, r.words) for r in got] == [(1, "Body text", 9, 2)]


def test_html_guess_and_status(spark):
    rows = spark.createDataFrame(
        [(None, "x" * 300 + "<html"), ("text/html", ""), ("image/png", "<!DOCTYPE html>"), (None, "plain")],
        "ct string, body string",
    )
    got = rows.select(
        H.looks_like_html(F.col("ct"), F.col("body")).alias("a"), H.looks_like_html(F.col("ct"), F.col("body"), 256).alias("b")
    ).collect()
    assert [(r.a, r.b) for r in got] == [(True, False), (True, True), (True, True), (False, False)]
    row = spark.range(1).select(
        H.fetch_status(F.lit("boom"), F.lit(200)).alias("x"), H.fetch_status(F.lit(""), F.lit(404)).alias("y"),
        H.fetch_status(F.lit(None), F.lit(399)).alias("z"), H.media_type(F.lit(" text/html ; q=1")).alias("m"),
    ).first()
    assert tuple(row) == ("error", "http_error", "ok", "text/html")


def test_extracted_documents_are_kept_as_rows(spark):
    base = folder()
    rows = spark.createDataFrame([(1, "http://a/", "<p>one two</p>"), (2, "http://b/", "")], "id bigint, url string, html string")
    SF.write_extracted(SF.extract_documents(rows), str(base / "out"))
    back = spark.read.schema(SF.EXTRACTED_SCHEMA).parquet(str(base / "out")).collect()
    assert [(r.id, r.url, r.chars, r.words, r.text) for r in back] == [(1, "http://a/", 7, 2, "one two")]


def test_newest_extraction_replaces_the_row(spark):
    from webtrail.plans.process import store_extractions

    schema = "url_id bigint, page_id bigint, payload string, extracted_at timestamp_ntz"
    old = spark.createDataFrame([(1, 10, "old", dt.datetime(2024, 1, 1)), (2, 20, "kept", dt.datetime(2024, 1, 1))], schema)
    new = spark.createDataFrame([(1, 11, "new", dt.datetime(2024, 1, 2))], schema)
    got = {r.url_id: (r.page_id, r.payload) for r in store_extractions(old, new).collect()}
    assert got == {1: (11, "new"), 2: (20, "kept")}


def test_log_paths_find_saved_pages(spark, tmp_path):
    """A log has plain or relative paths, the reader gives URIs."""
    (tmp_path / "html").mkdir()
    for k in (1, 2):
        (tmp_path / "html" / f"{k}.html").write_text(f"page {k}")
    log = spark.createDataFrame(
        [(1, f" {tmp_path}/html/1.html "), (2, "html/2.html"), (3, " "), (4, "html/none.html")],
        "id long, html_path string",
    )
    got = SF.attach_html(log, SF.saved_html(spark, str(tmp_path / "html")), str(tmp_path)).collect()
    assert sorted((r.id, r.html) for r in got) == [(1, "page 1"), (2, "page 2")]


def test_row_store_never_shuffles_what_is_stored(spark):
    """Batches out of order, equal rows, a null key, a batch written twice, missing and other columns."""
    path = folder()
    rows = lambda *r: spark.createDataFrame(r, "url_id bigint, html string, seq int")
    schema = rows().schema
    store = RowStore(spark, f"{path}/a", schema, "url_id", ["seq"], 4)
    assert store.read().collect() == []
    store.add(1, rows((1, "a", 1), (1, "b", 2), (2, "c", 5), (None, "n", 1), (3, "x", None)))
    again = rows((1, "d", 2), (2, "late", 4), (4, "e", 0), (4, "e", 0), (3, "y", 0))
    store.add(2, again)
    store.add(2, again)
    store.add(3, spark.createDataFrame([(None, 9, "o")], "url_id bigint, seq int, other string"))
    want = [(1, "d", 2), (2, "c", 5), (3, "y", 0), (4, "e", 0), (None, None, 9)]
    assert sorted(map(tuple, store.read().collect()), key=str) == want
    reopened = RowStore(spark, f"{path}/a", schema, "url_id", ["seq"], 4)
    assert sorted(map(tuple, reopened.compacted(f"{path}/b").read().collect()), key=str) == want
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = reopened.read()._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


ODD_PAGES = [(7, b"seven"), (8, None), (8, None), (-9, b"caf\xc3\xa9 \xff\n<b>"), (10, b"x"), (10, b"x"), (None, b"no id"), (11, b"")]
ODD_FILES = {"7": b"seven\n", "8": b"\n\n", "-9": b"caf\xc3\xa9 \xff\n<b>\n", "10": b"x\nx\n", "__HIVE_DEFAULT_PARTITION__": b"no id\n", "11": b"\n"}


def odd_pages(spark):
    return spark.createDataFrame(ODD_PAGES, "page_id long, html binary").withColumn("html", F.col("html").cast("string"))


def test_pages_are_saved_one_to_a_file_without_other_files(spark):
    """A checksum file or a folder for each page costs a process of its own in a local file system."""
    base = folder()
    SF.write_html(odd_pages(spark), f"file://{base}/saved")
    files = [p for p in (base / "saved").rglob("*") if p.is_file()]
    assert {p.name.removeprefix("page_id=").removesuffix(".html"): p.read_bytes() for p in files} == ODD_FILES
    assert len(files) == len(ODD_FILES)
    assert len([p for p in (base / "saved").rglob("*") if p.is_dir()]) <= SF.SAVED_PARTS
    SF.write_html(odd_pages(spark).limit(0), f"{base}/none")
    assert SF.saved_html(spark, f"{base}/none").count() == 0


def test_pages_are_saved_in_other_stores(spark):
    base = folder()
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.saved.link./in", f"file://{base}")
    SF.write_html(odd_pages(spark), "viewfs://saved/in/a")
    SF.write_html(odd_pages(spark), f"{base}/b")
    one, other = (
        SF.saved_html(spark, path).select(F.regexp_extract("html_path", "/page_id=([^/.]+)", 1), "html").collect()
        for path in ("viewfs://saved/in/a", f"{base}/b")
    )
    assert sorted(map(tuple, one)) == sorted(map(tuple, other)) and len(one) == len(ODD_FILES)


@pytest.mark.parametrize("store", ["", "file://", "viewfs://found/in"])
def test_saved_pages_with_odd_ids(spark, monkeypatch, store):
    """Ids below zero are found by their paths; a page without an id has none."""
    from webtrail.plans import catalog
    from webtrail.plans.catalog import QUERIES

    base = folder()
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.found.link./in", "file:///")
    monkeypatch.setattr(catalog, "shared_dir", lambda _: f"{store}{base}")
    rows = [(-14, "a"), (-9, "b"), (-8, "c"), (7, "d"), (8, "e"), (9, "f"), (None, "g")]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(f"{base}/pages.parquet")
    got = QUERIES["saved_pages"](spark, str(base)).collect()
    assert sorted((r.id, r.chars) for r in got) == [(-9, 2), (-8, 2), (8, 2), (9, 2)]
