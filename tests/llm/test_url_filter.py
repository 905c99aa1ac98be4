"""The trie against a plain scan of all entries."""

import random

import pytest
from pyspark.sql import functions as F

from webtrail.llm import url_filter as U


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for c in "/?#" if (i := rest.find(c)) >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    end = min([i for c in "?#" if (i := path.find(c)) >= 0], default=len(path))
    return host, path[:end]


def scan(url, rules):
    host, path = parts(url)
    fits = []
    for verdict, rule in rules:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h) or not h) and path.startswith(slash + p):
            fits.append(U.rank(verdict, rule))
    best = max(fits, default=None)
    return host, path, best and best[2], "block" if best and best[1] else "allow"


HARD = [
    None, "", "no scheme", "://", "http://", "http://ORG", "http://a.ORG/", "HTTP://Éx.Com/FR/x", "http://org?x/y",
    "http://org#/es/", "a://b://c/d", "http://example.org/en/1", "http://example.org/en/12?q", "http://x.example.org/es/",
    "http://example.org/es", "http://notexample.org/es/", "http://org./", "http://a..org/", "http://com/de/" + "x/" * 30_000,
    "http://" + "a." * 3000 + "com/fr/", "line\nbreak://h.org/a\nb", "http://org:80/", "http://com/fr", "http://com//fr/",
]


def test_hard_urls(spark):
    rows = [(k if k % 5 else None, u) for k, u in enumerate(HARD + HARD[:3])]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("best", F.lit(1))
    got = U.judged(pages, U.RULES)
    made = sorted(((r.url, r.host, r.path, r.rule, r.verdict) for r in got.collect()), key=str)
    assert made == sorted(((u, *scan(u, U.RULES)) for _, u in rows), key=str)


@pytest.mark.parametrize("most", [200_000, 7])
def test_random_entries(spark, monkeypatch, most):
    monkeypatch.setattr(U, "BLOCK_RULES", most)
    r = random.Random(1)
    label = lambda: r.choice(["a", "b", "ab", "com"])
    path = lambda n: "".join(r.choice(["/", "a", "b", "ab/"]) for _ in range(r.randint(0, n)))
    host = lambda: ".".join(label() for _ in range(r.randint(1, 3)))
    rules = [(r.choice(["allow", "block"]), host() + r.choice(["", "/" + path(4)])) for _ in range(60)]
    urls = [f"http://{host()}{r.choice(['', '/' + path(6)])}" for _ in range(400)]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {(x.url, x.host, x.path, x.rule, x.verdict) for x in U.judged(pages, rules).collect()}
    assert got == {(u, *scan(u, rules)) for u in urls}


def test_errors_and_no_rows(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert U.judged(none, U.RULES).collect() == []
    assert U.judged(spark.createDataFrame([("http://a.b/",)], "url string"), []).first().verdict == "allow"
    for rules in ([("allow", "")], [("deny", "a/")]):
        with pytest.raises(ValueError):
            U.build(rules)
