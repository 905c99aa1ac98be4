"""Each stage against a plain statement of it over the same input."""

from pyspark.sql import functions as F

import corpus_pipeline as C
from webtrail.llm import decontaminate as D
from webtrail.llm import packing as P

from .conftest import documents
from .test_packing import plain_pieces, sound
from .test_simhash import plain_groups
from .test_suffixes import plain


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(spark, sf_dir):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept, before = {}, docs
    for name, stage in C.STAGES:
        made = C.written(stage(spark, before, sf_dir), name)
        if name != C.STAGES[-1][0]:
            assert made.columns == docs.columns
        kept[name], before = made, made
    first = rows_of(kept["toxicity"])
    second = rows_of(kept["simhash_near_dedup"])
    stays = {d for d, _, c in plain_groups(first) if d == c}
    assert sorted(second) == sorted((d, t) for d, t in first if d in stays)
    third = rows_of(kept["suffix_array_dedup"])
    want = {d: n - gone for d, n, gone, _, _ in plain(second)}
    assert len(third) == len(second) and all(want[d] - 6 <= len(t.encode()) <= want[d] for d, t in third)
    items = [D.Item(r.item_id, D.plain(r.text), D.EDIT_RATE)
             for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    held = {d for d, t in third if any(i.distance(D.plain(t))[0] <= i.budget for i in items)}
    fourth = rows_of(kept["benchmark_decontamination"])
    assert sorted(fourth) == sorted((d, t) for d, t in third if d not in held)
    last = kept["best_fit_packing"].collect()
    tokenizer = Tokenizer.from_file(P.tokenizer_path())
    got = sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in last), key=str)
    assert got == plain_pieces(tokenizer, fourth)
    assert sound(last) <= -(-sum(r.length for r in last) // 2048) + 1


def test_toxic_documents_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("toxic = 1")
    kept = C.toxicity(spark, docs, sf_dir)
    assert kept.join(labels, "doc_id").count() < 0.6 * docs.join(labels, "doc_id").count()
    assert kept.count() >= 0.7 * docs.count()


def test_no_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in C.STAGES:
        docs = C.written(stage(spark, docs, sf_dir), name)
    assert docs.collect() == []


def test_rows_without_an_id_of_their_own(spark, sf_dir, monkeypatch):
    """Null and repeated ids: one row of each group stays, and only rows that hold an item go."""
    words = [" ".join(f"w{k}x{j}" for j in range(40)) for k in range(6)]
    rows = [(None, words[0]), (None, words[0]), (None, words[1]), (7, words[2]), (7, words[2]), (7, words[3]),
            (3, words[4]), (9, words[4]), (9, words[4]), (None, words[5]), (2, words[5]), (None, None), (4, "")]
    got = C.simhash(spark, documents(spark, rows), sf_dir)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    want = [(None, words[0]), (None, words[1]), (7, words[2]), (7, words[3]), (3, words[4]), (None, words[5]), (None, None)]
    assert sorted(rows_of(got), key=str) == sorted(want, key=str)
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    rows = [(None, f"a {item} b"), (None, "clean"), (None, "clean"), (5, f"{item} c"), (5, "clean too"), (6, None), (8, "")]
    want = [r for r in rows if item not in (r[1] or "")]
    for most in (D.BLOCK_CHARS, 500):
        monkeypatch.setattr(D, "BLOCK_CHARS", most)
        got = C.decontamination(spark, documents(spark, rows), sf_dir)
        assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted(rows_of(got), key=str) == sorted(want, key=str)


def test_names_of_other_columns(spark, sf_dir):
    """Columns that are named like something a stage makes come through with their own values."""
    names = ["my col", "a:b", "x`y", "kept", "n_removed", "n_bytes", "rejected", "p_toxic", "_row", "best", "rest"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.withColumns({n: F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")) for n in names})
    before = docs
    for name, stage in C.STAGES[:-1]:
        made = C.written(stage(spark, before, sf_dir), name)
        assert made.columns == docs.columns
        rows = made.collect()
        assert rows and all(r[n] == f"{n} {r.doc_id}" for r in rows for n in names)
        before = made
    assert C.packing(spark, before, sf_dir).count() >= before.count()


def test_null_empty_and_very_long_texts(spark, sf_dir):
    long = " ".join(f"word{k}" for k in range(60_000))
    docs = documents(spark, [(1, None), (2, ""), (3, long), (None, long + " and"), (5, None)])
    before = docs
    for name, stage in C.STAGES[:-1]:
        before = C.written(stage(spark, before, sf_dir), name)
    # empty texts are near duplicates of one another, and so are the two long ones
    assert sorted(r.doc_id or 0 for r in before.collect()) == [0, 1]
    last = C.packing(spark, before, sf_dir)
    assert last.count() > 60
