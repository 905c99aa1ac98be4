"""Packing documents into sequences by minimum bin slack.

Bins are filled one after another: the longest piece left opens the bin, and a subset-sum
program over bitsets, taking each length as often as it is left, finds the fullest combination
for the rest of the room. That combination is removed, and removed again as often as its
lengths last. Only lengths matter for this, so the plan is made from a histogram of at most
``capacity`` rows, the one thing that reaches the driver; its size does not depend on the
data. Pieces then take their places by rank: a piece's rank among all of its length is its
number within its task plus the pieces of that length in earlier tasks, which is one count per
task and length. No sort and no gathering of pieces is needed, and a length that a third of
all pieces have is no hot spot.

A null or empty text is a document of the end id alone. Rows with a null id, and repeated
rows, are packed like any other. Other columns are not looked at.
"""

from __future__ import annotations

import os
import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import text_pieces, written

CAPACITY = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
#: Bytes of text whose words are numbered together.
CHUNK_BYTES = 16 << 20
#: Words that are encoded in one call.
TOGETHER = 2_000
#: How the tokenizer marks the last token of a run (fixed value).
WORD_END = "</w>"
#: Special tokens begin so (fixed value); their words are encoded as they stand.
SPECIAL = "<|"
#: Letters that stay one letter in lower case, and ASCII symbols but the apostrophe, which can begin
#: an ending; as in a regular expression.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-įı-ɏ"
SYMBOLS = r"""!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~"""


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of many texts, each different word encoded once.

    The tokenizer never merges across white space and drops it, so a text's ids are those of
    its words one after another. It does not merge letters with symbols either, so the symbols
    that end a word have ids of their own. Words are numbered in Arrow, those of letters (and of letters and
    symbols) are taken apart and encoded many at a time, and ids are put in place by arrays.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        #: Ids that end a run of letters, digits or symbols.
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def _apart(self, texts: list[str]) -> Ragged:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return Ragged.of_sizes(np.array([i for ids in found for i in ids], "<u4"), sizes)

    def _runs(self, texts: list[str]) -> Ragged:
        """Runs of one kind, encoded as one text: each has one id that ends a run, its last."""
        found = self.tokenizer.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0]
        ids = np.array(found.ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        return Ragged(ids, np.r_[0, stops]) if len(stops) == len(texts) else self._apart(texts)

    def _words(self, words: pa.Array) -> Ragged:
        """Ids of different words."""
        plain = pc.match_substring_regex(words, f"^[{LETTERS}]+[{SYMBOLS}]*$")
        plain = pc.and_not(plain, pc.match_substring(words, SPECIAL))
        simple, rest = words.filter(plain), words.filter(pc.invert(plain))
        heads = pc.ascii_lower(pc.replace_substring_regex(simple, f"[{SYMBOLS}]+$", ""))
        tails = pc.replace_substring_regex(simple, f"^[{LETTERS}]+", "")
        heads, tails = heads.dictionary_encode(), tails.dictionary_encode()
        runs = [x.dictionary.to_pylist() for x in (heads, tails)]
        parts = [self._runs(runs[0][k : k + TOGETHER]) for k in range(0, len(runs[0]), TOGETHER)]
        parts += [self._apart(runs[1][k : k + TOGETHER]) for k in range(0, len(runs[1]), TOGETHER)]
        parts += [self._apart(rest.slice(k, TOGETHER).to_pylist()) for k in range(0, len(rest), TOGETHER)]
        made = Ragged.joined(parts)
        n, m = len(runs[0]), len(runs[0]) + len(runs[1])
        pairs = np.empty((len(words), 2), np.int64)
        mask = plain.to_numpy(zero_copy_only=False)
        pairs[mask, 0] = heads.indices.to_numpy()
        pairs[mask, 1] = n + tails.indices.to_numpy()
        pairs[~mask, 0] = m + np.arange(len(rest))
        pairs[~mask, 1] = made.size
        return made.with_empty().taken(pairs.ravel()).merged(2)

    def encode_all(self, texts: pa.Array) -> Ragged:
        """Ids of each text; null counts as empty."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = lists.flatten().dictionary_encode()
        ends = lists.offsets.to_numpy().astype(np.int64)
        return self._words(words.dictionary).taken(words.indices.to_numpy()).grouped(ends - ends[0])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        made = self.encode_all(pa.array(texts, pa.string()))
        return [made.ids[a:b].tobytes() for a, b in zip(made.ends, made.ends[1:])]


class Ragged:
    """Rows of ids one after another; row k is ``ids[ends[k] : ends[k + 1]]``."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray):
        self.ids, self.ends = ids, ends

    @staticmethod
    def of_sizes(ids: np.ndarray, sizes: np.ndarray) -> Ragged:
        return Ragged(ids, np.r_[0, np.cumsum(sizes, dtype=np.int64)])

    @staticmethod
    def joined(parts: list[Ragged]) -> Ragged:
        sizes = [np.diff(p.ends) for p in parts] or [np.zeros(0, np.int64)]
        return Ragged.of_sizes(np.concatenate([p.ids for p in parts] or [np.zeros(0, "<u4")]), np.concatenate(sizes))

    @property
    def size(self) -> int:
        return len(self.ends) - 1

    def with_empty(self) -> Ragged:
        return Ragged(self.ids, np.r_[self.ends, self.ends[-1]])

    def taken(self, rows: np.ndarray) -> Ragged:
        """These rows, in their order, any number of times."""
        first, sizes = self.ends[rows], self.ends[rows + 1] - self.ends[rows]
        made = Ragged.of_sizes(np.zeros(0, "<u4"), sizes)
        at = np.repeat(first - made.ends[:-1], sizes)
        at += np.arange(len(at))
        made.ids = self.ids[at]
        return made

    def merged(self, n: int) -> Ragged:
        """Every ``n`` rows as one."""
        return Ragged(self.ids, self.ends[::n])

    def grouped(self, ends: np.ndarray) -> Ragged:
        """Rows ``ends[k]`` to ``ends[k + 1]`` as one."""
        return Ragged(self.ids, self.ends[ends])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, ord long"


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Token pieces, each with its number among those of its length in its task."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        encode = encoder(path).encode_all
        task = TaskContext.get().partitionId()
        made = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part, _ in text_pieces(batch, 1, CHUNK_BYTES):
                rows = []
                found = encode(part.column(1))
                data, ends = memoryview(found.ids).cast("B"), (4 * found.ends).tolist()
                for doc, a, b in zip(part.column(0).to_pylist(), ends, ends[1:]):
                    n = (b - a) // 4 + 1
                    for k, start in enumerate(range(0, n, capacity)):
                        length = min(capacity, n - start)
                        crc = zlib.crc32(data[a + 4 * start : min(b, a + 4 * (start + length))])
                        if start + length == n:
                            crc = zlib.crc32(end, crc)
                        rows.append((doc, k, start, length, crc, task, int(made[length])))
                        made[length] += 1
                cols = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "task", "ord"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, copies) of a fullest combination that fits ``room``; of equals, with long lengths."""
    lengths = sorted((n for n in counts if n <= room and counts[n]), reverse=True)
    mask = (1 << (room + 1)) - 1
    reach, before = 1, []
    for n in lengths:
        before.append(reach)
        left, step = min(counts[n], room // n), 1
        while left:
            take = min(step, left)
            reach |= (reach << (n * take)) & mask
            left -= take
            step *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    made = []
    for n, was in zip(reversed(lengths[: len(before)]), reversed(before)):
        copies = 0
        while not was >> total & 1:
            total -= n
            copies += 1
        if copies:
            made.append((n, copies))
    return made[::-1]


def bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """(times, combination) of all bins: minimum bin slack over a histogram of lengths."""
    left = {n: c for n, c in histogram.items() if c}
    made = []
    while left:
        longest = max(left)
        left[longest] -= 1
        rest = dict(fullest(left, capacity - longest))
        left[longest] += 1
        rest[longest] = rest.get(longest, 0) + 1
        times = min(left[n] // c for n, c in rest.items())
        made.append((times, sorted(rest.items(), reverse=True)))
        for n, c in rest.items():
            left[n] -= times * c
            if not left[n]:
                del left[n]
    return made


def slots(plan) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank, copies in a bin, first sequence and offset of its slots."""
    made: dict[int, list[tuple]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for times, combination in plan:
        offsets = accumulate((n * c for n, c in combination), initial=0)
        for (n, copies), offset in zip(combination, offsets):
            first = used.get(n, 0)
            made.setdefault(n, []).append((first, copies, sequence, offset))
            used[n] = first + times * copies
        sequence += times
    return {n: tuple(np.array(c, np.int64) for c in zip(*rows)) for n, rows in made.items()}


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: a row for each piece."""
    made = written(pieces(docs, path or tokenizer_path(), capacity), "pieces")
    counts = written(made.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = slots(bins(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = made.join(before, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("ord")).alias("rank")
    )

    def place(batches):
        for batch in batches:
            length = batch.column(3).to_numpy()
            rank = batch.column(5).to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length):
                first, copies, base, at = places[int(n)]
                rows = np.flatnonzero(length == n)
                k = np.searchsorted(first, rank[rows], side="right") - 1
                inside = rank[rows] - first[k]
                sequence[rows] = base[k] + inside // copies[k]
                offset[rows] = at[k] + inside % copies[k] * n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    shape = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(place, shape)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces in sequences of at most 2048 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
