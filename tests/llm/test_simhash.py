"""SimHash groups against a comparison of all pairs."""

from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from webtrail.llm import simhash as S
from webtrail.llm.common import components

from .conftest import documents


def plain_fingerprint(text):
    words, word = [], b""
    for b in (text or "").encode() + b" ":
        if b == 0x20 or 9 <= b <= 13:
            words += [word] if word else []
            word = b""
        else:
            word += bytes([b + 32 if 65 <= b <= 90 else b])
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= 4:
            group[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        t = top(i)
        least[t] = None if d is None or least.get(t, 0) is None else min(d, least.get(t, d))
    return sorted(
        ((d, f"{fps[i]:016x}", least[top(i)]) for i, (d, _) in enumerate(rows)), key=str
    )


def test_any_four_positions_hold_a_triple():
    assert len(S.TRIPLES) == 20
    assert all(any(set(t) <= set(q) for t in S.TRIPLES) for q in combinations(range(8), 4))


def test_fingerprint_is_the_engine_hash(spark):
    """One shingle: the fingerprint is the hash itself, which the engine also computes."""
    got = spark.sql("select xxhash64('ab c d é')").first()[0]
    assert S.fingerprint("AB\tc \n D é") == got % 2**64


def test_forest_joins_what_pairs_join():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 20, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (400, 5)).astype(np.uint64)
    values = np.unique(np.bitwise_xor.reduce(flips, axis=1) ^ np.repeat(base, 20))
    found = {(int(a), int(b)) for x, y in S.forest(values, 4) for a, b in zip(x, y)}
    near = [(int(a), int(b)) for a, b in combinations(values, 2) if int(a ^ b).bit_count() <= 4]
    assert all(int(a ^ b).bit_count() <= 4 for a, b in map(lambda p: (np.uint64(p[0]), np.uint64(p[1])), found))
    assert len(found) < len(values) and _sets(found) == _sets(near)


def _sets(pairs):
    sets = []
    for a, b in pairs:
        joined = [s for s in sets if a in s or b in s]
        sets = [s for s in sets if s not in joined] + [set().union({a, b}, *joined)]
    return sorted(map(sorted, sets))


HARD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "a b c d e"), (6, "a b c d e"),
    (None, "a b c d e"), (7, "é É ß"), (8, "word " * 3000), (9, "Word\x0bword\x0c" * 1500), (-3, "x y z"),
]


def test_hard_rows(spark):
    docs = documents(spark, HARD).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(0))
    got = S.near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == plain_groups(HARD)


def test_no_rows(spark):
    assert S.near_duplicates(documents(spark, [])).collect() == []


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = S.op8_simhash(spark, sf_dir)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_groups(rows)


@pytest.mark.parametrize("most", [2, 2048])
def test_lists_in_blocks(spark, monkeypatch, most):
    """A close group of many different fingerprints, with lists dealt out in blocks or not."""
    monkeypatch.setattr(S, "LIST_MOST", most)
    rng = np.random.default_rng(3)
    values = {int(1 << int(a) | 1 << int(b)) for a, b in rng.integers(0, 62, (60, 2))} | {2**63 - 1, 2**62 - 1}
    distinct = spark.createDataFrame([(v,) for v in values], "fp long")
    got = S.links(distinct).collect()
    near = [(a, b) for a, b in combinations(values, 2) if (a ^ b).bit_count() <= 4]
    assert _sets(map(tuple, got)) == _sets(near)


def test_components_of_a_path_a_star_and_loops(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)] + [(3, 230)]
    edges = spark.createDataFrame(path + star + [(5, 5), (300, 299), (299, 300)], "a long, b long")
    got = dict(map(tuple, components(edges).collect()))
    want = {i: 100 for i in range(100, 141)} | {i: 3 for i in [3, 7, *range(200, 260)]} | {299: 299, 300: 299}
    assert got == want
