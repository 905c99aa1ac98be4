"""Benchmark matches against a full table of edit distances."""

import random

from webtrail.llm import decontaminate as D

from .conftest import documents

SHAPE = "item_id long, text string"


def fewest(pattern, text):
    """Fewest edits from the pattern to any part of the text, by the full table."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for j, p in enumerate(pattern, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row = new
        best = min(best, row[-1])
    return best


def edited(r, text, n):
    for _ in range(n):
        i = r.randrange(max(1, len(text)))
        text = text[:i] + r.choice(["", "q", text[i : i + 1] + "z"]) + text[i + 1 :]
    return text


def test_myers_is_the_edit_distance():
    r = random.Random(1)
    for _ in range(150):
        pattern = "".join(r.choice("abc ") for _ in range(r.randint(1, 70)))
        text = "".join(r.choice("abc ") for _ in range(r.randint(0, 30)))
        text += edited(r, pattern, r.randint(0, 5)) + "".join(r.choice("abc") for _ in range(r.randint(0, 30)))
        assert D.Item(1, pattern, 0.1).distance(text)[0] == fewest(pattern, text)


def test_every_match_within_the_budget(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdé") for _ in range(r.randint(1, 7)))
    items = [(k, " ".join(word() for _ in range(r.randint(8, 40)))) for k in range(12)]
    items += [(12, None), (13, ""), (14, "too short"), (15, "a" * 60), (0, items[0][1]), (None, items[1][1])]
    docs = []
    for d in range(80):
        own = edited(r, items[d % 12][1], r.randint(0, 25)) if d % 3 else ""
        docs.append((d, " ".join([word() for _ in range(20)] + [own.upper(), "\n\t"] + [word() for _ in range(20)])))
    docs += [(100, None), (101, ""), (102, "a" * 5000), (103, items[2][1]), (103, items[2][1]), (None, items[3][1])]
    table = spark.createDataFrame(items, SHAPE)
    got = D.matches(documents(spark, docs).selectExpr("*", "0 as item_id", "1 as distance"), table)
    want = []
    for d, text in docs:
        for i, t in set(items):
            p = D.plain(t)
            if len(p) >= D.LEAST_CHARS and (n := fewest(p, D.plain(text))) <= int(len(p) * D.EDIT_RATE):
                want.append((d, i, n, int(len(p) * D.EDIT_RATE)))
    made = [(x.doc_id, x.item_id, x.distance, x.budget) for x in got.collect()]
    assert sorted(made, key=str) == sorted(want, key=str) and len(want) > 15


def test_short_items_as_they_stand(spark):
    items = [(1, "Who  was Ada?"), (2, "42"), (3, "a" * (D.LEAST_CHARS - 1)), (4, " "), (5, None), (6, "$x = 1$"), (7, "Über")]
    docs = [(1, "so: who was\nADA? she"), (2, "1423 x42 42nd 42"), (3, "1423 x42 42nd"), (4, "who was adam?"), (5, "a" * 40),
            (6, "b " + "a" * (D.LEAST_CHARS - 1)), (7, "y$x = 1$2 (42)."), (8, "überall"), (9, "\u00dcber"), (10, None), (None, "42")]
    table = spark.createDataFrame(items, SHAPE)
    got = [(x.doc_id, x.item_id, x.distance, x.budget, x.end) for x in D.matches(documents(spark, docs), table).collect()]
    want = [(1, 1, 0, 0, 16), (2, 2, 0, 0, 16), (6, 3, 0, 0, 33), (7, 2, 0, 0, 13), (7, 6, 0, 0, 8), (9, 7, 0, 0, 4), (None, 2, 0, 0, 2)]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = D.without(documents(spark, docs), table).collect()
    assert sorted(x.doc_id for x in kept) == [3, 4, 5, 8, 10]


def test_items_in_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(k, f"the item number {k} of a small benchmark table") for k in range(20)], SHAPE)
    docs = documents(spark, [(k, f"x the item number {k} of a small benchmark table y") for k in range(20)])
    whole = sorted(map(tuple, D.matches(docs, items).collect()))
    monkeypatch.setattr(D, "BLOCK_CHARS", 200)
    assert sorted(map(tuple, D.matches(docs, items).collect())) == whole and len(whole) >= 20


def test_no_rows(spark):
    none, item = spark.createDataFrame([], SHAPE), spark.createDataFrame([(1, "i" * 50)], SHAPE)
    assert D.matches(documents(spark, [(1, "x" * 100)]), none).collect() == []
    assert D.matches(documents(spark, []), item).collect() == []


def test_whole_table(spark, sf_dir):
    """Each document that has an item as it stands is found at distance 0."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()
    got = {(r.doc_id, r.item_id): r.distance for r in D.op9_decontamination(spark, sf_dir).collect()}
    whole = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text}
    assert whole == {k for k, n in got.items() if n == 0}
