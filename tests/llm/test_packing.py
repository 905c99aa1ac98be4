"""Packing against the tokenizer on whole texts, and its plan against a search."""

import random
import zlib
from itertools import product

import numpy as np
import pytest
from tokenizers import Tokenizer

from webtrail.llm import packing as P

from .conftest import documents


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(P.tokenizer_path())


ODD = [
    None, "", " ", "\n\t \r", "A b\x1cc\x85d\xa0e f", "<|endoftext|> x<|startoftext|>y", "é ́x ÉÀ İ ẞ Σς",
    "it's we'll I'D", "12 345,6!! ***", "x" * 5000, "日本語のテキスト　全角", "\x00﻿ a\x0bb\x0cc", "y " * 9000,
    "İ, x̂. a'. naïve!! ’. don't, 'S'. (A) \"B\" <|endoftext|>. <|startoftext|>, ÉÉ?! ß. Ⅻ. ²: a_b_ _ __, <|x|>.",
]


def test_words_give_the_ids_of_the_text(tokenizer, spark, sf_dir):
    texts = ODD + [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    made = P.Encoder(P.tokenizer_path()).encode(texts)
    for text, ids in zip(texts, made):
        want = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want


def plain_pieces(tokenizer, rows, capacity=2048):
    made = []
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            made.append((doc, k // capacity, k, len(part), crc))
    return sorted(made, key=str)


def sound(rows, capacity=2048):
    """Gapless sequences within the capacity; returns how many."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_whole_table(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = P.op10_packing(spark, sf_dir).collect()
    got = sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str)
    assert got == plain_pieces(tokenizer, [tuple(r) for r in docs.collect()])
    total = sum(r.length for r in rows)
    assert sound(rows) <= -(-total // 2048) + 1


def test_odd_rows(spark, tokenizer):
    rows = list(enumerate(ODD)) + [(None, "a b"), (3, "same"), (3, "same")]
    docs = documents(spark, rows).repartition(4)
    got = P.pack(docs.selectExpr("*", "1 as piece", "2 as length", "'x' as ord"), capacity=64).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == plain_pieces(
        tokenizer, rows, 64
    )
    sound(got, 64)


def test_no_rows(spark):
    assert P.pack(documents(spark, [])).collect() == []


def test_fullest_combination():
    r = random.Random(4)
    for _ in range(200):
        counts = {r.randint(1, 20): r.randint(1, 3) for _ in range(4)}
        room = r.randint(0, 40)
        best = max(
            s for c in product(*(range(n + 1) for n in counts.values()))
            if (s := sum(k * n for k, n in zip(c, counts))) <= room
        )
        got = P.fullest(counts, room)
        assert sum(n * c for n, c in got) == best and all(c <= counts[n] for n, c in got)


def test_bins_use_each_piece_once():
    r = random.Random(5)
    histogram = {r.randint(1, 2048): r.randint(1, 900) for _ in range(700)}
    plan = P.bins(histogram)
    used = {}
    for times, combination in plan:
        assert sum(n * c for n, c in combination) <= 2048
        for n, c in combination:
            used[n] = used.get(n, 0) + times * c
    assert used == histogram
    total = sum(n * c for n, c in histogram.items())
    big = sum(c for n, c in histogram.items() if n > 1024)
    assert sum(t for t, _ in plan) <= 1.03 * max(big, -(-total // 2048)) + 1
