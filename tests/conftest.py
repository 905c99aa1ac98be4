import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from webtrail.session import local_session

    session = local_session(8, "webtrail-tests")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def pages(spark, sf_dir):
    """Given pages, the made linked pages, and hand-written hard cases."""
    from webtrail.plans import fixtures as X

    hard = [
        ("http://h.com/a/", ""),
        ("http://h.com/a/b?x=1#f", "<p>no links</p>"),
        ("http://h.com/;p", '<TITLE a="1">  \n </title><title>x</title><a href=" ">blank</a>'),
        (
            "https://a.b.c.org/x/y/z/../w",
            "<title>" + "t" * 600 + "</title><META name='description' x content='" + "d" * 700
            + "'><script>var a='<a href=\"/no\">no</a>'</script >x</script><STYLE>p{}</STYLE>"
            "<a href=\"../q r#f\">  A B <i>c</i>\x85</a><a class='k' href='?z=1'>q\n</a>"
            "<A HREF=/noquote>n</A><a href='http://[bad'>bad</a><a href='//H2.com;x'>h2</a>"
            "<a href='mailto:x'>m</a><a href='javascript:void(0)'>j</a><p>In 2031 Geo latitude",
        ),
        ("http://many.org/", "".join(
            f'<a href="{"" if i % 3 else "http://many.org"}/p{i % 40}/{"x" * (i % 7)}?i={i % 11}">'
            f'{"map " * (i % 4)}login {i}</a>' for i in range(150))),
        ("http://long.org/", '<a href="http://long.org/' + "y" * 2100 + '">' + "w " * 150 + "</a>"
         + "Zürich New York City is in 2024. ǅa Éa Áb Ab_c New_York "
         + "lorem ipsum geo " * 900),
        ("ftp://not.web/", '<a href="/x">x</a><a href="http://web.org/robot/vps/3d">y</a>'),
    ]
    made = spark.createDataFrame(
        [(10_000 + i, u, h) for i, (u, h) in enumerate(hard)], "page_id bigint, url string, html string"
    )
    given = spark.read.parquet(f"{sf_dir}/pages.parquet")
    linked = X.derive(spark, sf_dir, X.LINKED_PAGES).selectExpr("page_id + 20000", "url", "html")
    return given.union(linked).union(made).repartition(8, "page_id").cache()
