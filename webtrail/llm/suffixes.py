"""Removal of repeated passages: blockwise suffix sorting with a difference cover.

A byte is removed when some string of ``WINDOW`` bytes that covers it also starts earlier:
in a document with a smaller id, or earlier in the same one. Strings are judged on the input.

Sorting every suffix of a corpus would move many times its size, so a difference cover does
the long comparisons. ``COVER`` is a set of residues modulo ``PERIOD`` in which every
difference occurs: for any two positions there is a common shift below ``PERIOD`` that brings
both onto cover positions. Two equal windows therefore always share an aligned pair of cover
positions whose next ``SAMPLE`` bytes are equal.

1. *Cover ranks.* The cover suffixes (8 of 57 positions) are dealt into buckets by the leading
   bits of the hash of their next ``SAMPLE`` bytes, and each bucket is sorted by itself. Its
   classes are the ranks of the cover suffixes to that depth; a second key ranks them to the
   full reach of all windows that can meet there (``SAMPLE`` and ``PERIOD - 1`` bytes to either
   side). A suffix whose rank repeats an earlier one of the same reach is decided: all windows
   through it are repeats. This settles long ties without looking at their bytes again. A rank
   that occurs once cannot hold a repeat. The rest, near the ends of repeats, is *contested*.
   ``PASSES`` ranges of buckets are sorted one after the other, which bounds the disk.
2. *Contested suffixes.* Only windows through contested cover positions are themselves put
   into buckets, by a key of 96 bits over all their bytes; each bucket is sorted, and all but
   the earliest of equal windows are repeats. Windows are the bulk of the disk: they are made
   for one of ``PASSES`` shares of the documents after the other, written once by ranges of
   buckets, and a range is removed when it is ranked.

Each task first settles what repeats within its own rows and sends one row of a key, so a
passage that a third of all documents share costs a bucket one row per task. Keys are hashes:
48 and more bits decide within classes of equal 40-bit keys, 96 bits decide windows. The 40 bits
are others than those that choose the bucket, so chance meetings stay as rare when buckets get more.

A null text counts as empty. A null id precedes all others. Rows that share an id are separate
texts at the same place in the order: none precedes the other at the same start. Repeated rows
come out repeated, each with the same result.
"""

from __future__ import annotations

import functools
import hashlib
import math
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from .common import NO_ID, discard, from_planes, planes, text_pieces, write, written

WINDOW = 100
PERIOD = 57
#: Every difference modulo 57 occurs once among these (fixed values; a perfect difference set).
COVER = (0, 1, 3, 13, 32, 36, 43, 52)
SIDE = PERIOD - 1
SAMPLE = WINDOW - SIDE
PASSES = 2
#: Ranges of buckets that windows are ranked by, one after the other.
RANGES = 4
#: Bytes of text whose suffixes make one bucket, and that a task settles by itself.
BUCKET_BYTES = 4 << 20
CHUNK_BYTES = 3 << 20
#: Places that a task gathers before it deals them to buckets or documents: with few to a row, rows take more than places.
GATHERED = 1 << 19
BATCH = 4 << 20
SEGMENT = 1 << 18
PAD = 256


class Rolling:
    """Polynomial hashes modulo 2**64 of any spans, from running sums over a segment."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.symbols = rng.integers(0, 2**64, 257, dtype=np.uint64)
        base = int(rng.integers(2**61, 2**62)) * 4 + 1 + 2 * seed % 4
        self.power, self.inverse = (self._powers(x) for x in (base, pow(base, -1, 2**64)))

    @staticmethod
    def _powers(x: int) -> np.ndarray:
        made = np.full(SEGMENT + 4 * WINDOW, x, np.uint64)
        made[0] = 1
        return np.multiply.accumulate(made)

    def of(self, layout: np.ndarray, starts: np.ndarray, spans: list[tuple[int, int]]):
        """For each (shift, length): the mixed hashes of ``layout[start + shift :][:length]``.

        ``starts`` ascend; shifts are within ``WINDOW`` of them.
        """
        out = [np.empty(len(starts), np.uint64) for _ in spans]
        low, reach = min(s for s, _ in spans), max(s + n for s, n in spans)
        at = 0
        while at < len(starts):
            first = int(starts[at])
            end = int(np.searchsorted(starts, first + SEGMENT))
            a, b = first + low, min(len(layout), int(starts[end - 1]) + reach)
            values = self.symbols[layout[a:b]]
            values *= self.power[: b - a]
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum(values, out=sums[1:])
            here = starts[at:end] - a
            for (shift, length), into in zip(spans, out):
                s = here + shift
                into[at:end] = _mixed((sums[s + length] - sums[s]) * self.inverse[s])
            at = end
        return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


_ROLLING: dict[int, Rolling] = {}


def rolling(seed: int) -> Rolling:
    """Made once in each worker."""
    if seed not in _ROLLING:
        _ROLLING[seed] = Rolling(seed)
    return _ROLLING[seed]


class Layout:
    """Texts side by side, with ``SIDE`` pad symbols before, between and after them."""

    def __init__(self, ids: np.ndarray, tags: np.ndarray, texts: list[bytes]):
        order = np.argsort(ids, kind="stable")
        self.order = order
        self.ids, self.tags = ids[order], tags[order]
        self.rows: dict[tuple, list[int]] | None = None
        seen = set()
        #: False for repetitions of a row.
        self.single = np.array([not (k in seen or seen.add(k)) for k in zip(self.ids, self.tags)], bool)
        texts = [texts[i] for i in order]
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum(self.sizes + SIDE) - self.sizes
        self.layout = np.full(int(self.starts[-1] + self.sizes[-1]) + SIDE if texts else SIDE, PAD, np.uint16)
        for at, text in zip(self.starts.tolist(), texts):
            self.layout[at : at + len(text)] = np.frombuffer(text, np.uint8)

    def cover(self) -> tuple[np.ndarray, np.ndarray]:
        """(document, offset) of the cover positions that windows can run through."""
        longest = int(self.sizes.max(initial=0))
        turns = np.arange(0, longest + PERIOD, PERIOD)[:, None]
        pattern = (turns + np.array(COVER)).ravel()
        counts = np.searchsorted(pattern, self.sizes - SAMPLE, side="right")
        counts[self.sizes < WINDOW] = 0
        docs = np.repeat(np.arange(len(counts)), counts)
        offs = np.concatenate([pattern[:n] for n in counts.tolist()] or [pattern[:0]])
        return docs, offs

    def spread(self, docs, first, last) -> np.ndarray:
        """True where ``first <= position <= last`` of any of the given ranges, over the layout."""
        ends = np.zeros(len(self.layout) + 1, np.int32)
        np.add.at(ends, self.starts[docs] + first, 1)
        np.add.at(ends, self.starts[docs] + last + 1, -1)
        return np.cumsum(ends[:-1], dtype=np.int32) > 0

    def windows_through(self, docs, offs) -> np.ndarray:
        """Starts (marked over the layout) of the windows that hold the sample at each offset."""
        return self.spread(docs, np.maximum(0, offs - SIDE), np.minimum(offs, self.sizes[docs] - WINDOW))

    def places(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        docs = np.searchsorted(self.starts, starts, side="right") - 1
        return docs, starts - self.starts[docs]

    def find(self, ids: np.ndarray, tags: np.ndarray) -> np.ndarray:
        """For each (id, tag): pairs (row of the request, document here); repeated rows all match."""
        if self.rows is None:
            self.rows = {}
            for k, key in enumerate(zip(self.ids.tolist(), self.tags.tolist())):
                self.rows.setdefault(key, []).append(k)
        known = self.rows.get
        made = [(i, k) for i, key in enumerate(zip(ids.tolist(), tags.tolist())) for k in known(key, ())]
        return np.array(made, np.int64).reshape(-1, 2)


def pack(ids, tags, offs, *more: np.ndarray) -> bytes:
    """Places in order of (id, tag, offset), each document once; ``more`` goes along as it is."""
    new = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])]) if len(ids) else []
    counts = np.diff(np.r_[new, len(ids)]).astype(np.int32)
    steps = np.diff(offs, prepend=0).astype(np.int32)
    steps[new] = offs[new]
    ids = ids[new]
    return b"".join(
        [
            struct.pack("<qq", len(offs), len(new)),
            planes(np.diff(ids, prepend=0) if len(ids) else ids),
            planes(tags[new]),
            planes(counts),
            planes(steps),
            *(np.ascontiguousarray(x).tobytes() for x in more),
        ]
    )


def unpack(blob: bytes, *more: tuple) -> tuple[np.ndarray, ...]:
    """(document of each place, ids, tags, offsets, ...): ``more`` has (kind, width) of the rest."""
    n, m = struct.unpack_from("<qq", blob)
    data, at = memoryview(blob), 16
    out = []
    for kind, k in ((np.int64, m), (np.int32, m), (np.int32, m), (np.int32, n)):
        out.append(from_planes(data[at:], kind, k))
        at += np.dtype(kind).itemsize * k
    ids, tags, counts, steps = out
    ids = np.cumsum(ids)
    docs = np.repeat(np.arange(m), counts)
    total = np.cumsum(steps.astype(np.int64))
    heads = np.cumsum(counts) - counts
    offs = total - np.repeat(total[heads] - steps[heads] if m else total, counts)
    rest = []
    for kind, width in more:
        size = np.dtype(kind).itemsize * width * n
        rest.append(np.frombuffer(data[at : at + size], kind).reshape(n, width))
        at += size
    return docs, ids, tags, offs, *rest


def _wide(part: np.ndarray) -> np.ndarray:
    """Little-endian bytes as unsigned longs."""
    out = np.zeros((len(part), 8), np.uint8)
    out[:, : part.shape[1]] = part
    return out.view("<u8").ravel()


def _bytes(values: np.ndarray, width: int) -> np.ndarray:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]


def judged(key, reach, ids, offs, flag):
    """Sort cover suffixes and judge them: (order, later, contested, first, alone).

    ``order`` are the rows whose key repeats or is flagged, sorted; ``later``: an earlier row
    has the same reach; ``contested``: the key has rows of different reach; ``first``: first row
    of its key.
    """
    if not len(key):
        none = np.zeros(0, bool)
        return np.zeros(0, np.int64), none, none, none
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    keep = np.r_[False, same] | np.r_[same, False] | flag[order]
    order = order[keep]
    order = order[np.lexsort((offs[order], ids[order], reach[order], key[order]))]
    k, r = key[order], reach[order]
    new_key = np.r_[True, k[1:] != k[:-1]] if len(k) else np.zeros(0, bool)
    new_reach = new_key | np.r_[True, r[1:] != r[:-1]] if len(k) else new_key
    lead = np.maximum.accumulate(np.where(new_reach, np.arange(len(k)), 0))
    later = (ids[order] > ids[order][lead]) | (
        (ids[order] == ids[order][lead]) & (offs[order] > offs[order][lead])
    )
    group = np.cumsum(new_key) - 1
    kinds = np.bincount(group, weights=new_reach) if len(k) else np.zeros(0)
    flagged = np.bincount(group, weights=flag[order]) if len(k) else np.zeros(0)
    contested = ((kinds > 1) | (flagged > 0))[group] if len(k) else new_key
    return order, later, contested, new_key


def _rows(made: list[tuple]):
    """Batches of about ``BATCH`` bytes."""
    at = size = 0
    for k, m in enumerate(made, 1):
        size += len(m[2])
        if size >= BATCH or k == len(made):
            part, kind, blob = zip(*made[at:k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())],
                ["part", "kind", "blob"],
            )
            at, size = k, 0


class Gathered:
    """Columns of places from several pieces; ``deal(*columns)`` makes rows of them once there are enough."""

    def __init__(self, deal):
        self.deal, self.held, self.n = deal, [], 0

    def add(self, *columns: np.ndarray):
        if len(columns[0]):
            self.held.append(columns)
            self.n += len(columns[0])
        if self.n >= GATHERED:
            yield from self.rest()

    def rest(self):
        if self.held:
            columns = [np.concatenate(c) for c in zip(*self.held)]
            self.held, self.n = [], 0
            yield from _rows(self.deal(*columns))


ROWS = "part long, kind int, blob binary"
NUMBERS = ("n_bytes", "n_removed", "n_spans")
#: Kinds of rows.
BUCKET, DECIDED, CONTESTED, REMOVED, WINDOWS = range(5)
NO_RANGE = -1


def _dealt(parts: np.ndarray, kind: int, make) -> list[tuple]:
    """One packed row for each part; ``make(rows)`` packs these rows."""
    order = np.argsort(parts, kind="stable")
    p = parts[order]
    cuts = np.flatnonzero(np.r_[True, p[1:] != p[:-1]]) if len(p) else []
    return [
        (int(p[a]), kind, make(order[a:b])) for a, b in zip(cuts, [*cuts[1:], len(p)])
    ]


#: A document's part follows from its id and the hash of its text, so rows that share an id, or have none, are
#: dealt out as well. The factor is below 2**32: its product with a 32-bit hash does not overflow.
MIX = 2654435761


def _to_documents(ids, tags, offs, q: int, kind: int) -> list[tuple]:
    order = np.lexsort((offs, tags, ids))
    ids, tags, offs = ids[order], tags[order], offs[order]
    return _dealt(np.mod(ids ^ tags.astype(np.int64) * MIX, q), kind, lambda r: pack(ids[r], tags[r], offs[r]))


def _texts(batches, sizes=CHUNK_BYTES):
    """Layouts of about ``sizes`` bytes from batches of (id, tag, text)."""
    held, n = [], 0

    def made():
        table = pa.Table.from_batches(held)
        return Layout(
            table["id"].to_numpy(), table["tag"].to_numpy(), [x or b"" for x in table["text"].to_pylist()]
        )

    for batch in batches:
        for piece, size in text_pieces(batch, 2, CHUNK_BYTES):
            held.append(piece)
            n += size
            if n >= sizes:
                yield made()
                held, n = [], 0
    if held:
        yield made()


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.hash(text).alias("tag"),
        text.cast("binary").alias("text"),
    )


def _cover_ranks(docs: DataFrame, lo: float, hi: float, buckets: int, q: int) -> DataFrame:
    """One pass: decided and contested cover positions of the keys in ``[lo, hi)``."""
    low, high = int(lo * 2**40), int(hi * 2**40)

    def decided():
        return [Gathered(lambda i, t, o, k=k: _to_documents(i, t, o, q, k)) for k in (DECIDED, CONTESTED)]

    def to_buckets(ids, tags, offs, key, reach, flag):
        order = np.lexsort((offs, tags, ids))
        ids, tags, offs, key, reach, flag = (c[order] for c in (ids, tags, offs, key, reach, flag))
        parts = ((key >> np.uint64(24)) * np.uint64(buckets) >> np.uint64(40)).astype(np.int64)
        return _dealt(
            parts,
            BUCKET,
            lambda r: pack(ids[r], tags[r], offs[r], _bytes(key[r], 5), _bytes(reach[r], 6), flag[r]),
        )

    def deal(batches):
        sent, (repeats, open_) = Gathered(to_buckets), decided()
        for x in _texts(batches):
            docs, offs = x.cover()
            key, reach = rolling(1).of(x.layout, x.starts[docs] + offs, [(0, SAMPLE), (-SIDE, SAMPLE + 2 * SIDE)])
            reach >>= np.uint64(16)
            lead = key >> np.uint64(24)
            mine = np.flatnonzero((lead >= low) & (lead < high))
            key, reach, docs, offs = key[mine], reach[mine], docs[mine], offs[mine]
            ids, tags = x.ids[docs], x.tags[docs].astype(np.int32)
            none = np.zeros(len(key), bool)
            order, later, contested, first = judged(key, reach, ids, offs, none)
            d, c = order[later], order[~later & contested]
            yield from repeats.add(ids[d], tags[d], offs[d])
            yield from open_.add(ids[c], tags[c], offs[c])
            send = np.ones(len(key), bool)
            send[order] = (~later & ~contested) | (contested & first)
            flag = none.copy()
            flag[order] = contested & first
            s = np.flatnonzero(send)
            yield from sent.add(ids[s], tags[s], offs[s], key[s], reach[s], flag[s])
        for g in (sent, repeats, open_):
            yield from g.rest()

    def rank(batches):
        repeats, open_ = decided()
        for kind, blobs in _by_part(batches):
            if kind != BUCKET:
                yield from _rows([(p, kind, b) for p, b in blobs])
                continue
            rows = []
            for _, b in blobs:
                d, i, t, o, k, r, f = unpack(b, (np.uint8, 5), (np.uint8, 6), (bool, 1))
                rows.append((i[d], t[d], o, _wide(k), _wide(r), f.ravel()))
            ids, tags, offs, key, reach, flag = (np.concatenate(c) for c in zip(*rows))
            order, later, contested, _ = judged(key, reach, ids, offs, flag)
            d, c = order[later], order[~later & contested & ~flag[order]]
            yield from repeats.add(ids[d], tags[d], offs[d])
            yield from open_.add(ids[c], tags[c], offs[c])
        for g in (repeats, open_):
            yield from g.rest()

    dealt = _keyed(docs).mapInArrow(deal, ROWS)
    return dealt.repartition("kind", "part").sortWithinPartitions("kind", "part").mapInArrow(rank, ROWS)


def _by_part(batches):
    """Runs of equal (kind, part) in sorted rows: (kind, [(part, blob), ...])."""
    last, held = None, []
    for batch in batches:
        for part, kind, blob in zip(*(c.to_pylist() for c in batch.columns)):
            if (kind, part) != last or (kind != BUCKET and kind != WINDOWS and len(held) >= 64):
                if held:
                    yield last[0], held
                last, held = (kind, part), []
            held.append((part, blob))
    if held:
        yield last[0], held


def _beside(
    docs: DataFrame, rows: DataFrame, q: int, carry: list[str] = (), share: tuple[int, int] = (0, 1)
) -> DataFrame:
    """Texts and packed rows that concern them, sorted so that the rows of a part come first.

    ``share``: (k, n) for the parts that leave ``k`` when divided by ``n``.
    """
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.hash(F.coalesce("text", F.lit(""))).alias("tag"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
        F.struct(*(docs[f"`{c.replace('`', '``')}`"].alias(f"c{k}") for k, c in enumerate(["doc_id", *carry]))).alias("rest"),
    )
    texts = keyed.select(
        F.pmod(F.col("id").bitwiseXOR(F.col("tag").cast("long") * F.lit(MIX)), F.lit(q)).alias("part"), F.lit(9).alias("kind"), F.lit(None).cast("binary").alias("blob"), "*"
    )
    return (
        texts.unionByName(rows.select("part", "kind", "blob"), allowMissingColumns=True)
        .filter(F.col("part") % share[1] == share[0])
        .repartition("part")
        .sortWithinPartitions("part", "kind")
    )


def _groups(batches):
    """(packed rows of the part, texts with what they carry), in pieces of bounded size."""
    part, blobs, held, n = None, [], [], 0
    for batch in batches:
        parts = batch.column(0).to_numpy()
        kinds = batch.column(1).to_numpy()
        cuts = np.flatnonzero((parts[1:] != parts[:-1]) | ((kinds[1:] == 9) != (kinds[:-1] == 9))) + 1
        bounds = [0, *cuts.tolist(), len(parts)]
        for a, b in zip(bounds, bounds[1:]):
            if a == b:
                continue
            if held and parts[a] != part:
                yield blobs, pa.Table.from_batches(held)
                held, n = [], 0
            if parts[a] != part:
                part, blobs = parts[a], []
            piece = batch.slice(a, b - a)
            if kinds[a] != 9:
                blobs += list(zip(piece.column(1).to_pylist(), piece.column(2).to_pylist()))
            else:
                for some, size in text_pieces(piece, 5, CHUNK_BYTES):
                    if held and n + size > CHUNK_BYTES:
                        yield blobs, pa.Table.from_batches(held)
                        held, n = [], 0
                    held.append(some)
                    n += size
    if held:
        yield blobs, pa.Table.from_batches(held)


def _layout_of(table: pa.Table) -> Layout:
    return Layout(table["id"].to_numpy(), table["tag"].to_numpy(), table["text"].to_pylist())


def _at(x: Layout, blobs, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """(document here, offset) of the packed places of a kind."""
    docs, offs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, blob in blobs:
        if k != kind:
            continue
        d, ids, tags, o = unpack(blob)
        bounds = np.searchsorted(d, np.arange(len(ids) + 1))
        rows, here = x.find(ids, tags).T
        first, sizes = bounds[rows], bounds[rows + 1] - bounds[rows]
        before = np.cumsum(sizes) - sizes
        offs.append(o[np.arange(int(sizes.sum())) + np.repeat(first - before, sizes)])
        docs.append(np.repeat(here, sizes))
    return np.concatenate(docs), np.concatenate(offs)


def _contested_windows(docs: DataFrame, ranks: DataFrame, buckets: int, q: int, share: tuple[int, int]) -> DataFrame:
    """Windows through contested positions, by bucket, and the removed ranges known so far.

    ``range`` is that of the bucket, or ``NO_RANGE`` in rows of removed ranges.
    """

    def to_buckets(ids, tags, offs, one, two):
        order = np.lexsort((offs, tags, ids))
        ids, tags, offs, one, two = (c[order] for c in (ids, tags, offs, one, two))
        parts = ((one >> np.uint64(24)) * np.uint64(buckets) >> np.uint64(40)).astype(np.int64)
        return _dealt(parts, WINDOWS, lambda r: pack(ids[r], tags[r], offs[r], one[r], two[r]))

    def run(batches):
        sent = Gathered(to_buckets)
        for blobs, table in _groups(batches):
            if not blobs:
                continue
            x = _layout_of(table)
            known = x.windows_through(*_at(x, blobs, DECIDED))
            asked = x.windows_through(*_at(x, blobs, CONTESTED)) & ~known
            starts = np.flatnonzero(asked)
            (one,), (two,) = (rolling(s).of(x.layout, starts, [(0, WINDOW)]) for s in (2, 3))
            two >>= np.uint64(32)
            docs, offs = x.places(starts)
            ids, tags = x.ids[docs], x.tags[docs].astype(np.int32)
            none = np.zeros(len(one), bool)
            order, later, _, _ = judged(one, two, ids, offs, none)
            known[starts[order[later]]] = True
            send = np.ones(len(one), bool)
            send[order[later]] = False
            s = np.flatnonzero(send)
            yield from sent.add(ids[s], tags[s], offs[s], one[s], two[s].astype("<u4"))
            d, o = x.places(_edges(known))
            d, o = d[x.single[d]], o[x.single[d]]
            # each layout by itself: copies of a row in two of them would mix the ends of their ranges
            yield from _rows(_to_documents(x.ids[d], x.tags[d].astype(np.int32), o, q, REMOVED))
        yield from sent.rest()

    made = _beside(docs, ranks, q, share=share).mapInArrow(run, ROWS)
    of_bucket = F.floor(F.col("part") * RANGES / buckets).cast("int")
    return made.withColumn("range", F.when(F.col("kind") == WINDOWS, of_bucket).otherwise(NO_RANGE))


def _edges(marks: np.ndarray) -> np.ndarray:
    """First and last position of each run of marks, in turn."""
    steps = np.diff(np.r_[False, marks, False].astype(np.int8))
    return np.c_[np.flatnonzero(steps == 1), np.flatnonzero(steps == -1) - 1].ravel()


def _window_ranks(windows: DataFrame, q: int) -> DataFrame:
    """All but the earliest of equal windows."""

    def rank(batches):
        repeats = Gathered(lambda i, t, o: _to_documents(i, t, o, q, DECIDED))
        for _, blobs in _by_part(batches):
            rows = []
            for _, b in blobs:
                d, i, t, o, one, two = unpack(b, ("<u8", 1), ("<u4", 1))
                rows.append((i[d], t[d], o, one.ravel(), two.ravel()))
            ids, tags, offs, one, two = (np.concatenate(c) for c in zip(*rows))
            order, later, _, _ = judged(one, two, ids, offs, np.zeros(len(one), bool))
            d = order[later]
            yield from repeats.add(ids[d], tags[d], offs[d])
        yield from repeats.rest()

    return windows.repartition("part").sortWithinPartitions("part").mapInArrow(rank, ROWS)


def _of_range(spark: SparkSession, folders: list[str], r: int) -> DataFrame:
    """Rows of a range, of what stands in the folders now."""
    read = spark.read.schema(f"{ROWS}, range int")
    tables = [read.parquet(f).filter(F.col("range") == r).select("part", "kind", "blob") for f in folders]
    return functools.reduce(DataFrame.union, tables)


def remove_repeats(docs: DataFrame, carry: list[str] = (), keep: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` and the columns named in ``carry``.

    A carried column of the name of a result is not returned.
    ``kept`` has the text that stays (null unless ``keep``), without the parts of characters
    that a cut has left; the hash is over all bytes that stay. One row for each input row.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    few = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, math.ceil(total / BUCKET_BYTES), min(few, total // (1 << 18)))
    q = buckets | 1
    ranks = None
    for p in range(PASSES):
        made = written(_cover_ranks(docs, p / PASSES, (p + 1) / PASSES, buckets * PASSES, q), "cover-ranks")
        ranks = made if ranks is None else ranks.union(made)
    shares = min(PASSES, q)
    windows = [
        write(_contested_windows(docs, ranks, buckets, q, (k, shares)), "windows", "range") for k in range(shares)
    ]
    more = []
    for r in range(RANGES):
        more.append(written(_window_ranks(_of_range(spark, windows, r), q), "window-ranks"))
        for folder in windows:
            discard(spark, f"{folder}/range={r}")
    removed = functools.reduce(DataFrame.union, more, _of_range(spark, windows, NO_RANGE))
    carry = list(carry)

    def run(batches):
        for blobs, table in _groups(batches):
            x = _layout_of(table)
            d, o = _at(x, blobs, REMOVED)
            marks = x.spread(d[::2], o[::2], o[1::2])
            d, o = _at(x, blobs, DECIDED)
            marks[x.starts[d] + o] = True
            starts = np.flatnonzero(marks)
            d, o = x.places(starts)
            gone = x.spread(d, o, o + WINDOW - 1) if len(d) else np.zeros(len(x.layout), bool)
            rows = []
            for k, (at, size) in enumerate(zip(x.starts.tolist(), x.sizes.tolist())):
                out = gone[at : at + size]
                kept = x.layout[at : at + size][~out].astype(np.uint8).tobytes()
                spans = int(np.count_nonzero(np.diff(np.r_[False, out].astype(np.int8)) == 1))
                rows.append((size, size - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if keep else None))
            rest = table["rest"].combine_chunks().take(pa.array(x.order))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [
                    rest.chunk(0) if isinstance(rest, pa.ChunkedArray) else rest,
                    *(pa.array(c, pa.int64()) for c in cols[:3]),
                    pa.array(cols[3], pa.string()),
                    pa.array(cols[4], pa.string()),
                ],
                ["rest", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    beside = _beside(docs, removed, q, carry)
    shape = StructType([beside.schema["rest"]])
    for name, kind in (*((n, LongType()) for n in NUMBERS), ("kept_sha256", StringType()), ("kept", StringType())):
        shape = shape.add(name, kind)
    out = beside.mapInArrow(run, shape)
    made = [*NUMBERS, "kept_sha256", "kept"]
    others = [(k, c) for k, c in enumerate(carry, 1) if c not in ("doc_id", *made)]
    return out.select(
        F.col("rest.c0").alias("doc_id"), *made, *(F.col(f"rest.c{k}").alias(c) for k, c in others)
    )


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is removed from every document, and the hash of what stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs, keep=False).drop("kept")
