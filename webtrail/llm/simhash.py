"""Near duplicates by SimHash: a byte-position inverted index with count filtering.

Two fingerprints of 64 bits that differ in at most four bits agree in at least four of their
eight bytes. The index therefore lists fingerprints by the values of byte *positions*, and a
pair is a candidate when the tally of positions with equal bytes reaches four. Lists of one
position would hold a 256th of all fingerprints, so the lists are keyed by three positions. Of
the 56 triples 20 are enough for every set of four positions to hold one (``TRIPLES``), so
each pair that can reach the tally meets in a list. In a list the pairs are tallied and then
verified by bit distance, and only a spanning forest of the links leaves the task: at most one
link per member, never all pairs. Lists of more than ``LIST_MOST`` members are dealt out in
blocks of members, two blocks to a task.

Nulls count as empty texts; an empty text has fingerprint zero and links like any other. Rows
with a null id take part and are named by null (it precedes every other id as component).
Repeated rows come out repeated. Other columns of the input are not looked at.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, written

SHINGLE = 4
MOST_BITS = 4
SEED = 42
BYTES = 8
LIST_MOST = 2048
#: Bits of this many shingles are unpacked at a time; their counts fit 16 bits.
STEP = 1 << 15


def covering_triples() -> list[tuple[int, int, int]]:
    """Triples of byte positions such that any four positions hold one of them.

    Three groups in a ring: the triples inside a group, and those with two positions in one
    group and the third in the next.
    """
    group = [0, 0, 0, 1, 1, 1, 2, 2]
    made = []
    for t in combinations(range(BYTES), 3):
        g = sorted(group[i] for i in t)
        twice = next((x for x in set(g) if g.count(x) == 2), None)
        single = next((x for x in set(g) if g.count(x) == 1), None)
        if len(set(g)) == 1 or (twice is not None and single == (twice + 1) % 3):
            made.append(t)
    return made


TRIPLES = covering_triples()


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """SimHash over XXH64 of the shingles of whole lower-cased (A-Z) words, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - width + 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:n].tolist()
    stops = ends[len(words) - n :].tolist()
    one = xxhash.xxh64_intdigest
    tally = np.zeros(64, np.int64)
    for at in range(0, n, STEP):
        hashes = np.fromiter(
            [one(joined[a:b], SEED) for a, b in zip(starts[at : at + STEP], stops[at : at + STEP])],
            np.uint64,
        )
        tally += bit_counts(hashes)
    return int(((tally * 2 > n).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set, lowest bit first."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
    return np.add.reduce(bits, axis=0, dtype=np.uint16)


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` for every row; ``fp`` is the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(fps.view(np.int64))], ["doc_id", "fp"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def forest(values: np.ndarray, most_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links among distinct fingerprints.

    Breadth first: each reached fingerprint is tallied against those not yet reached, so a
    close group costs little more than one pass.
    """
    need = BYTES - most_bits
    made, rest = [], values
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            one = queue.pop()
            apart = rest ^ one
            shared = (apart.view(np.uint8).reshape(-1, BYTES) == 0).sum(1) >= need
            near = shared & (np.bitwise_count(apart) <= most_bits)
            if near.any():
                found = rest[near]
                made.append((np.full(len(found), one, np.uint64), found))
                queue.extend(found)
                rest = rest[~near]
    return made


def links(distinct: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """``(a, b)``: enough of the links of the distinct fingerprints ``fp`` to join every component."""
    if not 0 <= most_bits <= BYTES - 4:
        raise ValueError("lists of three positions serve distances up to four")
    masks = [sum(0xFF << (8 * i) for i in t) for t in TRIPLES]
    entries = [
        F.struct(
            F.lit(k).cast("tinyint").alias("list"),
            F.col("fp").bitwiseAND(F.lit(m - 2**64 if m >= 2**63 else m)).alias("value"),
        )
        for k, m in enumerate(masks)
    ]
    index = distinct.select("fp", F.explode(F.array(*entries)).alias("e")).select("fp", "e.list", "e.value")
    sizes = index.groupBy("list", "value").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / LIST_MOST).cast("int")
    met = (
        index.join(sizes, ["list", "value"])
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("list", "value", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
            "fp",
        )
    )

    def run(batches):
        kept_cell, kept = None, []
        for batch in batches:
            cells = batch.column(0).to_numpy(zero_copy_only=False)
            fps = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            cuts = np.flatnonzero(np.diff(cells)) + 1
            bounds = [0, *cuts.tolist(), len(cells)]
            out = []
            for a, b in zip(bounds, bounds[1:]):
                if a == b:
                    continue
                if cells[a] != kept_cell:
                    out += forest(np.concatenate(kept), most_bits) if kept else []
                    kept_cell, kept = cells[a], []
                kept.append(fps[a:b])
            if out:
                yield _pairs(out)
        if kept:
            if out := forest(np.concatenate(kept), most_bits):
                yield _pairs(out)

    def _pairs(out):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([x[i] for x in out]).view(np.int64)) for i in (0, 1)], ["a", "b"]
        )

    return met.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, most_bits: int = MOST_BITS) -> DataFrame:
    """``(doc_id, fp, component_id)``: the smallest id that links of at most ``most_bits`` reach."""
    made = written(fingerprints(docs, width), "fingerprints")
    distinct = written(
        made.groupBy("fp").agg(
            F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("unnamed")
        ),
        "distinct-fingerprints",
    )
    joined = components(links(distinct.select("fp"), most_bits))
    named = (
        distinct.join(joined.withColumnRenamed("node", "fp"), "fp", "left")
        .withColumn("component", F.coalesce("component", "fp"))
    )
    names = named.groupBy("component").agg(
        F.min("first").alias("first"), F.max("unnamed").alias("unnamed")
    )
    of_fp = named.select("fp", "component").join(names, "component").select(
        "fp", F.when(~F.col("unnamed"), F.col("first")).alias("component_id")
    )
    return made.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
