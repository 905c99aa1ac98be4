"""Shards by a permutation-filled lookup table.

Each shard prefers the slots of a prime-sized table in an order of its own: an offset and a
stride from the hash of its name. The shards take turns, each claiming the first slot of its
order that is still free, until the table is full; so shards get equal shares, and when a
shard comes or goes few other slots change hands. A key's slot is its hash modulo the size,
and its shard is what the table says there: one look up in a broadcast table whose size is a
parameter with an upper bound (``SLOTS_MOST``), whatever the data.

A null key counts as the empty string. Equal keys land together, repeated rows included; other
columns pass through. An empty table stays empty. No shards, repeated or null names, or a size
that is not prime or below the number of shards are errors.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 1021
SLOTS_MOST = 1 << 20
SHARDS = tuple(f"shard-{k:02d}" for k in range(16))


def hash32(text: str, part: int = 0) -> int:
    """32 bits of the MD5 of ``text``; SQL engines have the same."""
    return int(hashlib.md5(text.encode()).hexdigest()[8 * part : 8 * part + 8], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(shards, slots: int) -> list[str]:
    """The shard of each slot."""
    shards = list(shards)
    if not shards or None in shards or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names")
    if not is_prime(slots) or not len(shards) <= slots <= SLOTS_MOST:
        raise ValueError(f"{slots} slots: a prime from the number of shards to {SLOTS_MOST} is needed")
    turns = [(hash32(s) % slots, hash32(s, 1) % (slots - 1) + 1 if slots > 2 else 1) for s in shards]
    at = [offset for offset, _ in turns]
    table: list[str | None] = [None] * slots
    left = slots
    while left:
        for k, (_, stride) in enumerate(turns):
            if not left:
                break
            while table[at[k]] is not None:
                at[k] = (at[k] + stride) % slots
            table[at[k]] = shards[k]
            left -= 1
    return table


def slot_of(key: Column, slots: int) -> Column:
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % slots).cast("int")


def placed(rows: DataFrame, key: str, shards=SHARDS, slots: int = SLOTS) -> DataFrame:
    """``rows`` with ``slot`` and ``shard``."""
    table = rows.sparkSession.createDataFrame(list(enumerate(fill(shards, slots))), "slot int, shard string")
    clean = rows.drop("slot", "shard").withColumn("slot", slot_of(F.col(key), slots))
    return clean.join(F.broadcast(table), "slot").select(*[c for c in clean.columns if c != "slot"], "slot", "shard")


def write_shards(rows: DataFrame, key: str, folder: str, shards=SHARDS, slots: int = SLOTS, rows_most: int = 1_000_000) -> None:
    """One folder of Parquet files for each shard.

    The rows of a shard are dealt by slot, so a shard is not one task, and a file has at most
    ``rows_most`` rows.
    """
    made = placed(rows, key, shards, slots).repartition("shard", "slot")
    made.write.option("maxRecordsPerFile", rows_most).partitionBy("shard").parquet(folder)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    return placed(docs, "doc_id")


def _sql() -> str:
    names = ", ".join(f"({k}, '{s}')" for k, s in enumerate(SHARDS))
    n = len(SHARDS)
    return f"""
WITH RECURSIVE shards(k, shard) AS (VALUES {names}),
turns AS (
    SELECT k, shard,
           CAST('0x' || substr(md5(shard), 1, 8) AS BIGINT) % {SLOTS} AS first,
           CAST('0x' || substr(md5(shard), 9, 8) AS BIGINT) % {SLOTS - 1} + 1 AS stride
    FROM shards
),
prefers AS (
    SELECT k, list((first + j * stride) % {SLOTS} ORDER BY j) AS wanted
    FROM turns, range({SLOTS}) AS r(j) GROUP BY k
),
claims(turn, slot, taken) AS (
    SELECT 0, wanted[1], set_bit(repeat('0', {SLOTS})::BIT, wanted[1]::INT, 1) FROM prefers WHERE k = 0
    UNION ALL
    SELECT turn + 1, slot, set_bit(taken, slot::INT, 1)
    FROM (
        SELECT turn, taken, list_filter(wanted, lambda x: get_bit(taken, x::INT) = 0)[1] AS slot
        FROM claims JOIN prefers ON k = (turn + 1) % {n} WHERE turn + 1 < {SLOTS}
    )
)
SELECT doc_id, p.slot::INT AS slot, shard
FROM (SELECT doc_id, CAST('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8) AS BIGINT) % {SLOTS} AS slot
      FROM documents) p
JOIN claims c ON c.slot = p.slot
JOIN shards s ON s.k = c.turn % {n}
"""


ORACLE = _sql()
