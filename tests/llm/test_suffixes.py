"""Removal of repeated passages against a dictionary of all windows."""

import hashlib
import random
from pathlib import Path

import numpy as np
import pytest

from webtrail.llm import suffixes as S
from webtrail.llm.common import work_folder

from .conftest import documents


def plain(rows):
    """Result of each row: every window of every text, earliest (id, start) first."""
    key = lambda d: S.NO_ID if d is None else d
    first = {}
    texts = [(key(d), (t or "").encode(), d) for d, t in rows]
    for d, b, _ in texts:
        for i in range(len(b) - 99):
            w = b[i : i + 100]
            if w not in first or (d, i) < first[w]:
                first[w] = (d, i)
    out = []
    for d, b, shown in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 99):
            if first[b[i : i + 100]] < (d, i):
                gone[i : i + 100] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((shown, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(docs, **more):
    rows = S.remove_repeats(docs, **more).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted(map(tuple, rows.collect()), key=str)


def test_cover_holds_every_difference():
    d = {(a - b) % S.PERIOD for a in S.COVER for b in S.COVER}
    assert d == set(range(S.PERIOD))


def made_rows(seed, n=60):
    """Texts of words and shared passages, with cuts at every alignment."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdé") for _ in range(r.randint(1, 6)))
    passages = [" ".join(word() for _ in range(r.randint(10, 80))) for _ in range(6)]
    rows = []
    for d in range(n):
        parts = []
        for _ in range(r.randint(0, 5)):
            if r.random() < 0.6:
                p = r.choice(passages)
                a = r.randint(0, len(p) // 2)
                parts.append(p[a : r.randint(a, len(p))])
            else:
                parts.append(" ".join(word() for _ in range(r.randint(0, 30))))
        rows.append((d * 7 % 61, "".join(parts)))
    rows += [(5, "x" * 350), (200, "ab" * 200), (201, None), (202, ""), (None, rows[3][1]), (203, passages[0] * 3)]
    rows += [rows[4], rows[4], (rows[6][0], passages[1] + "!"), (rows[6][0], passages[1] + "?"), (-4, passages[2])]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_windows(spark, seed):
    rows = made_rows(seed)
    assert got(documents(spark, rows).repartition(5)) == plain(rows)


def test_many_buckets(spark, monkeypatch):
    rows = made_rows(3)
    monkeypatch.setattr(S, "BUCKET_BYTES", 900)
    assert got(documents(spark, rows).repartition(3)) == plain(rows)


def test_hashing_in_segments():
    x = S.Layout(np.array([1]), np.array([1]), [bytes(range(256)) * 9000])
    at = np.arange(S.SIDE, 2_300_000, 997)
    (whole,) = S.rolling(1).of(x.layout, at, [(0, 100)])
    again = np.concatenate([S.rolling(1).of(x.layout, at[i : i + 1], [(0, 100)])[0] for i in range(0, len(at), 50)])
    assert (whole[::50] == again).all()


def test_carried_columns_and_kept_text(spark):
    docs = documents(spark, [(1, "a" * 150), (2, "b" + "a" * 120), (3, "c")])
    rows = S.remove_repeats(docs, carry=["lang", "n_chars"]).orderBy("doc_id").collect()
    assert [r.kept for r in rows] == ["a", "b", "c"]
    assert [(r.lang, r.n_chars) for r in rows] == [("en", 150), ("en", 121), ("en", 1)]


def test_rows_without_an_id_are_dealt_out(spark):
    """Many rows of no id, and of one id, go to many parts, the same on both sides; results stay exact."""
    rows = [(None, f"{k} " * 40) for k in range(80)] + [(3, f"{k % 20} x" * 40) for k in range(60)] + [(1, "7 " * 60)]
    docs = documents(spark, rows).repartition(4)
    no_rows = spark.createDataFrame([], S.ROWS)
    placed = {(r.id, r.tag): r.part for r in S._beside(docs, no_rows, 16).collect()}
    for one in (S.NO_ID, 3):
        assert len({part for (i, _), part in placed.items() if i == one}) > 8
    ids, tags = (np.array(x) for x in zip(*placed))
    tags = tags.astype(np.int32)
    dealt = S._to_documents(ids, tags, np.arange(len(ids)), 16, S.REMOVED)
    found = {}
    for part, _, blob in dealt:
        d, i, t, _ = S.unpack(blob)
        found |= {(int(a), int(b)): part for a, b in zip(i[d], t[d])}
    assert found == placed
    assert got(docs) == plain(rows)


def test_windows_are_on_disk_once(spark, monkeypatch):
    """Windows are shuffled a range at a time, and ranked ones do not stay beside the texts of the last step."""
    rows = made_rows(4)
    monkeypatch.setattr(S, "BUCKET_BYTES", 900)
    ranked, rank = [], S._window_ranks
    monkeypatch.setattr(S, "_window_ranks", lambda windows, q: ranked.append(windows.filter(f"kind = {S.WINDOWS}").count()) or rank(windows, q))
    folder = Path(work_folder(spark).removeprefix("file:"))
    before = set(folder.glob("windows-*"))
    assert got(documents(spark, rows).repartition(5)) == plain(rows)
    assert sum(n > 0 for n in ranked) == S.RANGES and max(ranked) < 0.5 * sum(ranked)
    made = set(folder.glob("windows-*")) - before
    assert made
    for table in made:
        kept = spark.read.schema(S.ROWS).parquet(str(table))
        assert kept.filter(f"kind = {S.WINDOWS}").count() == 0


def test_copies_of_long_rows_in_several_layouts(spark):
    """Rows that repeat, so long that each copy is laid out by itself."""
    r = random.Random(5)
    long = "".join(r.choice("abcdefgh ") for _ in range(S.CHUNK_BYTES * 3 // 4))
    rows = [(1, long), (2, "x" + long[5000:9000] + "y" + long), (2, "x" + long[5000:9000] + "y" + long), (None, long[-700:])]
    out = S.remove_repeats(documents(spark, rows).repartition(3)).orderBy("doc_id", "n_bytes").collect()
    # the first 700 bytes of the end stay with the null id; both copies of row 2 keep their own two letters and cuts
    assert [(x.doc_id, x.n_removed) for x in out[:2]] == [(None, 0), (1, 700)]
    assert len({tuple(x) for x in out[2:]}) == 1 and out[2].n_bytes - out[2].n_removed == 2
    assert out[2].kept == "xy"


def test_places_are_gathered():
    dealt = []
    g = S.Gathered(lambda a, b: dealt.append((a, b)) or [(int(x), S.DECIDED, bytes(S.BATCH // 2)) for x in a[:5]])
    assert list(g.add(np.arange(3), np.arange(3))) == [] and list(g.add(np.zeros(0, int), np.zeros(0, int))) == []
    assert list(g.add(np.arange(S.GATHERED), np.arange(S.GATHERED))) and len(dealt) == 1 and len(dealt[0][0]) == S.GATHERED + 3
    assert list(g.rest()) == []
    list(g.add(np.arange(3), np.arange(3)))
    assert [b.num_rows for b in g.rest()] == [2, 1]


def test_no_rows(spark):
    assert got(documents(spark, [])) == []


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = sorted(map(tuple, S.op2_suffixes(spark, sf_dir).collect()), key=str)
    assert rows == plain([tuple(r) for r in docs.collect()])
