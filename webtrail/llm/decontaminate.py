"""Benchmark items in documents, exact or with a few edits: pigeonhole pieces, then Myers.

With a budget of ``k`` edits an item is split into ``k + 1`` pieces; a passage within the
budget keeps at least one of them whole. One Aho-Corasick pass over a text finds all pieces of
all items; around the hits the bit-parallel distance of Myers tells the fewest edits that turn
the item into some part of the text. Windows of an item that overlap are joined first, so a
text costs at most its length for each item that it hits.

Texts and items are compared in lower case with runs of white space as one blank. The budget
is ``EDIT_RATE`` of an item's length. Items shorter than ``LEAST_CHARS`` with edits cannot be told
from chance: they are searched as they stand, where no letter or digit goes on at either end. Null
and empty items are not searched. Items are taken in blocks of
``BLOCK_CHARS``, so a benchmark of any size never meets a worker as a whole. A null or empty
text holds nothing. Null ids are reported as null; repeated rows of either table are reported
as often as the document is there, and once for equal items.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from .common import text_pieces

EDIT_RATE = 1 / 12
LEAST_CHARS = 32
BLOCK_CHARS = 4_000_000


def plain(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def cuts(length: int, budget: int) -> list[tuple[int, int]]:
    """Bounds of ``budget + 1`` pieces of about equal length."""
    n = budget + 1
    return [(length * i // n, length * (i + 1) // n) for i in range(n)]


class Item:
    def __init__(self, item_id, text: str, rate: float):
        self.item_id, self.text, self.size = item_id, text, len(text)
        self.budget = int(len(text) * rate)
        self.masks: dict[str, int] = defaultdict(int)
        for i, c in enumerate(text):
            self.masks[c] |= 1 << i

    def stands_at(self, text: str, at: int) -> bool:
        """Whether the item, found at ``at``, cuts no word of ``text`` at its ends."""
        end = at + self.size
        left = at > 0 and text[at - 1].isalnum() and text[at].isalnum()
        return not left and not (end < len(text) and text[end - 1].isalnum() and text[end].isalnum())

    def distance(self, text: str) -> tuple[int, int]:
        """(fewest edits to some part of ``text``, where the first such part ends)."""
        if (at := text.find(self.text)) >= 0:
            return 0, at + self.size
        full, top = (1 << self.size) - 1, 1 << (self.size - 1)
        plus, minus, score = full, 0, self.size
        best, end = self.size, 0
        masks = self.masks
        for i, c in enumerate(text):
            same = masks.get(c, 0)
            down = same | minus
            across = (((same & plus) + plus) ^ plus) | same
            more = minus | (full & ~(across | plus))
            less = plus & across
            if more & top:
                score += 1
            elif less & top:
                score -= 1
                if score < best:
                    best, end = score, i + 1
            more = more << 1 & full
            less = less << 1 & full
            plus = less | (full & ~(down | more))
            minus = more & down
        return best, end


class Matcher:
    """All items of a block, with one automaton over their pieces."""

    def __init__(self, items: list[tuple], rate: float):
        import ahocorasick

        self.items = [Item(i, t, rate if len(t) >= LEAST_CHARS else 0) for i, t in items]
        places = defaultdict(list)
        for k, item in enumerate(self.items):
            for a, b in cuts(item.size, item.budget):
                places[item.text[a:b]].append((k, b))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, found)
        self.automaton.make_automaton()

    def search(self, text: str) -> list[tuple]:
        """(item_id, distance, budget, end) of each item within its budget."""
        hits = defaultdict(set)
        for last, found in self.automaton.iter(text):
            for k, stop in found:
                hits[k].add(last + 1 - stop)
        made = []
        for k, starts in hits.items():
            item = self.items[k]
            if item.size < LEAST_CHARS:
                ends = [s + item.size for s in starts if item.stands_at(text, s)]
                if ends:
                    made.append((item.item_id, 0, 0, min(ends)))
                continue
            best, at, region = item.budget + 1, 0, None
            for s in [*sorted(starts), None]:
                a, b = (s - item.budget, s + item.size + item.budget) if s is not None else (math.inf, 0)
                if region and a > region[1]:
                    low = max(0, region[0])
                    d, end = item.distance(text[low : region[1]])
                    if d < best:
                        best, at = d, low + end
                    region = None
                region = (region[0] if region else a, b)
            if best <= item.budget:
                made.append((item.item_id, best, item.budget, at))
        return made


def matches(docs: DataFrame, items: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """``doc_id, item_id, distance, budget, end``: every item that a document holds.

    ``end`` is where the best match ends in the compared form of the text.
    """
    made = None
    for rows in _blocks(items):
        part = _of_block(docs, rows, rate)
        made = part if made is None else made.union(part)
    return made


def without(docs: DataFrame, items: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """The rows of ``docs`` that hold no item; each row is searched and kept or dropped by itself."""
    for rows in _blocks(items):
        docs = _rest_of_block(docs, rows, rate) if rows else docs
    return docs


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """The searched items as (item_id, plain text), one block after another; at least one block."""
    found = items.select(F.col("item_id").cast("long"), "text").distinct()
    chars = found.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / BLOCK_CHARS))
    for b in range(blocks):
        of_block = found.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        rows = {(r.item_id, t) for r in of_block.collect() if (t := plain(r.text))}
        yield sorted(rows, key=str)


def _rest_of_block(docs: DataFrame, rows: list[tuple], rate: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    @F.arrow_udf(BooleanType())
    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(shared.value, rate)
        for batch in texts:
            yield pa.array([not matcher.search(plain(t.as_py())) for t in batch], pa.bool_())

    return docs.filter(clean(docs["text"]))


def _of_block(docs: DataFrame, rows: list[tuple], rate: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    def run(batches):
        matcher = Matcher(shared.value, rate) if shared.value else None
        for batch in batches:
            out = []
            for part, _ in text_pieces(batch, 1, 4 << 20) if matcher else ():
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    out += [(doc, *m) for m in matcher.search(plain(text))]
            if out:
                cols = list(zip(*out))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds)],
                    ["doc_id", "item_id", "distance", "budget", "end"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, item_id long, distance int, budget int, end long"
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) within the edit budget."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
