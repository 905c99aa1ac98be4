"""Pages laid out by hand, and pages that would be costly for a careless parser."""

import time

import pytest
from pyspark.sql import functions as F

from webtrail.llm import rendering as R

PAGES = [
    (None, ""), ("", ""), (" \n ", ""), ("plain  text\n here", "plain text here"), ("a &amp; b &lt;c&gt; &eacute;", "a & b <c> é"),
    ("<p>one<p>two", "one\n\ntwo"), ("<div>a</div><div>b</div>c", "a\nb\nc"), ("x<br>y<br/>z", "x\ny\nz"),
    ("a<b>b</b> <i> c</i>", "ab c"), ("<h1>T</h1>x", "T\n\nx"),
    ("<ul><li>a<li>b<ol><li>c<li>d</ol></ul>e", "- a\n- b\n  1. c\n  2. d\n\ne"),
    ("<ol start=7><li>a</li><li>b</li></ol>", "7. a\n8. b"),
    ("<table><tr><th>Name<th>N<tr><td>alpha<td>12</table>", "Name   N\nalpha  12"),
    ("<table><caption>C</caption><td>a</td><td>b</td><tr><td colspan=2>wide cell</td></tr></table>", "C\na  b\nwide cell"),
    ("<table><tr><td><p>a<p>b</td><td>c</td></tr></table>", "a\n\nb\nc"),
    ("<table><tr><td>x<table><tr><td>1<td>2</table></td><td>y</table>", "x\n\n1  2\ny"),
    ("<pre>a\n  b</pre>c", "a\n  b\n\nc"), ("<blockquote>q</blockquote>", "  q"), ("<dl><dt>t<dd>d</dl>", "t\n  d"),
    ("<title>T</title><style>p{}</style><script>if(a<b){'</p>'}</script>seen<!-- <p>no</p> -->", "seen"),
    ("<p hidden>a</p><div aria-hidden=TRUE>b</div><i style='color:red; DISPLAY : none'>c</i><b style='visibility:hidden'>d</b>e", "e"),
    ("<b style='display:nonexistent'>x</b>", "x"), ("</p></li>a</td>b", "ab"), ("a < b <3", "a < b <3"),
    ("<a href=\"x>y\" title='&quot;'>t</a>", "t"), ("<a href=\"open>t</a>u", "tu"), ("<!doctype html><?php x ?>y", "y"),
    ("<textarea>no</textarea><SCRIPT>x</SCRIPT >y", "y"), ("<li>loose<li>items", "loose\nitems"), ("<p>a<hr>b", "a\n\nb"),
    ("<select><option>a<option>b</select>c", "c"), ("<script>never closed <p>x", ""), ("a<", "a<"), ("a<b", "a"),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_layout(page, text):
    assert R.render(page) == text


STRAY = [
    ("<table>Note<tr><td>a</table>", "Note\n\na"), ("x<table><tr><td>a<td>b</tr>late</table>y", "x\n\nlate\n\na  b\n\ny"),
    ("<table><p>one</p><tbody><div>two</div><tr><form>three</form><td>a</table>", "one\n\ntwo\nthree\n\na"),
    ("<table><tr><table><tr><td>1<td>2</table><td>a</table>", "1  2\n\na"),
    ("<table><tr><table>Note<tr><td>1</table></table>", "Note\n\n1"),
    ("<table><caption>C</caption>Note<tr><td>a</table>", "Note\n\nC\na"),
    ("<ul><li>i<table>Note<tr><td>a</table></ul>", "- i\n\n  Note\n\n  a"), ("<table>\n<tr>\n<td>a\n</table>b", "a\n\nb"),
    ("<table>Note", "Note"),
]


@pytest.mark.parametrize("page, text", STRAY)
def test_text_in_a_table_outside_of_cells(page, text):
    assert R.render(page) == text


FORMULAS = [
    ("<p>so <math><mi>a</mi><mo>=</mo><mn>2</mn></math> holds", "so a=2 holds"),
    ("<math><semantics><mi>x</mi><annotation encoding='application/x-tex'>no</annotation></semantics></math>y", "xy"),
    ("<math><mtext>if <b>all</b></mtext><mphantom>no</mphantom></math>.", "if all."), ("<math><mspace/><mtext/><mi>&alpha;</mi></math>b", "αb"),
    ("a<svg><title>no</title><desc>no</desc><g>no<path d='x'/><text>one <tspan>two</tspan></text><text>three</text></g></svg>b", "a one two three b"),
    ("<svg><style/><desc/><text><![CDATA[1 < 2 &amp;]]></text></svg>y", "1 < 2 &amp; y"), ("<svg/>a<math/>b", "ab"),
    ("<svg><defs><text>no</text></defs><text display=none>no</text><foreignObject><p>seen<div/>too</foreignObject></svg>z", "seen\n\ntoo\nz"),
    ("<svg><path><p>broken out</p>of it", "broken out\n\nof it"), ("<desc>a</desc> <metadata>b</metadata> <g>c</g>", "a b c"),
    ("<math style='display:none'><mi>x</mi></math><svg aria-hidden=true><text>x</text></svg>y", "y"), ("<br/><script/>no</script>y", "y"),
]


@pytest.mark.parametrize("page, text", FORMULAS)
def test_formulas_and_drawings(page, text):
    assert R.render(page) == text


@pytest.mark.parametrize("page", ["<svg><g>" * 50_000 + "x", "<svg>" + "<path/><text>a</text>" * 50_000, "<math><mi>" * 50_000 + "<p>" * 50_000, "<svg><![CDATA[" * 50_000])
def test_costly_drawings(page):
    test_costly_pages(page)


HEADS = [
    ("<html><head><title>T</title></head><body><p>x</body></html>", "x"), ("<html><head><title>T</title><body><p>x", "x"),
    ("<head><meta charset=utf-8> \n <p>x</p>y", "x\n\ny"), ("<head><title>T</title>text <b>b</b>", "text b"),
    ("<head><style>s</style><script>t</script><div>x</div>", "x"), ("<head><link rel=a><span>x</span></head>y", "xy"),
    ("<head><head><p>x", "x"), ("a<head>b", "ab"), ("<head></br>x", "x"),
    ("<head><noscript><link rel=a><p>no</p></noscript><template>no</template><body>x", "x"),
]


@pytest.mark.parametrize("page, text", HEADS)
def test_head_without_end_tag(page, text):
    assert R.render(page) == text


@pytest.mark.parametrize("page", [
    "<div>" * 200_000 + "x", '<a href="x' * 100_000, "<script>" * 100_000, "<p><li><td></b>" * 30_000,
    "<b><p>" * 30_000 + "</i></b></p>" * 30_000, "<ul><li>" * 5_000 + "x", "<table><tr><td>" * 3_000 + "x",
    "<li><ul>" + "<b>" * 40_000 + "<li></li>" * 40_000, "<!--" * 100_000, "&" * 500_000, "<x y='" * 50_000,
    "<table>" + "<tr><td colspan=1000>x" * 3_000, "x" * 5_000_000,
], ids=range(13))
def test_costly_pages(page):
    start = time.process_time()
    R.render(page)
    assert time.process_time() - start < 20


def test_rows(spark):
    rows = [(k if k else None, p) for k, (p, _) in enumerate(PAGES)]
    pages = spark.createDataFrame(rows + rows[:3], "page_id long, html string").withColumn("text", F.lit("clash")).withColumn("rest", F.lit(1))
    got = R.rendered(pages)
    assert got.columns == ["page_id", "rest", "text"]
    want = [(i, 1, PAGES[i or 0][1]) for i, _ in rows + rows[:3]]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert R.rendered(pages.limit(0)).collect() == []


def test_whole_table(spark, sf_dir):
    rows = R.op1_rendering(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    assert all(r.text and "<p>" not in r.text and "track(0)" not in r.text for r in rows)
