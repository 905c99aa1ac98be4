"""Counts by parts against the tokenizer on whole texts."""

import random

import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from webtrail.llm import token_counts as T

from .conftest import documents


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=T.tokenizer_path())


ODD = [
    None, "", " ", "  ", "a ", " a", "a  b", "\n", "\r\n\t", "a\x00b", "<s>x</s> <unk>", "▁a ▁", "<0x0A>",
    "é é ﬁ 　x", "日本語のテキスト 全角", "😀😀 a😀", "x" * 3000, "ab " * 4000, "a\n" * 4000, " " * 3000, "日本" * 3000,
]


def test_parts_of_any_size(model):
    r = random.Random(3)
    texts = ODD + ["".join(r.choice("aeth  \n▁.é日\t1,") for _ in range(r.randint(0, 300))) for _ in range(300)]
    want = [len(model.encode(t or "")) for t in texts]
    for most, batch in ((1, 10), (7, 1 << 20), (64, 500), (T.PART_BYTES, T.BATCH_BYTES)):
        assert T.counter(T.tokenizer_path())(pa.array(texts), most, batch).tolist() == want


def test_no_part_is_much_longer_than_asked(model):
    cut = T.counter(T.tokenizer_path()).boundaries.cut
    parts = [p for p, _ in cut("some words of a text, " * 4000, 100)]
    assert len(parts) > 700 and max(map(len, parts)) < 130


def test_whole_table(spark, sf_dir, model):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = T.op11_token_counts(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    for r in rows:
        n = len(model.encode(docs[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 4096)
    assert any(r.over_limit for r in rows) and not all(r.over_limit for r in rows)


def test_odd_rows_and_names(spark, model):
    rows = [(k if k % 4 else None, t) for k, t in enumerate(ODD)] + [(3, "same"), (3, "same")]
    docs = documents(spark, rows).withColumns({"my col": F.lit(1), "a:b": F.lit(2), "n_tokens": F.lit(-1), "x`y": F.lit(3)})
    got = T.with_token_counts(docs)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "my col", "a:b", "n_tokens", "x`y", "n_bytes", "over_limit"]
    made = sorted(((r.doc_id, r.text, r.n_bytes, r.n_tokens) for r in got.collect()), key=str)
    assert made == sorted(((i, t, len((t or "").encode()), len(model.encode(t or ""))) for i, t in rows), key=str)


def test_no_rows(spark):
    assert T.with_token_counts(documents(spark, [])).collect() == []
