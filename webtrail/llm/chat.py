"""Chat formatting: cumulative snapshots collapse to the longest, then are rendered.

A conversation is often logged anew after every turn, so that one log is a prefix of the next.
Each turn gets two 64-bit hashes over its position, role and text; their running exclusive-or
is the hash of the prefix that ends there. A conversation whose last prefix is an inner prefix
of some other is dropped by an anti join, and of equal conversations the smallest id stays.
What stays is rendered, a row for every ``PART_TURNS`` turns.

Everything is DataFrame operations. Positions and running hashes are made in two levels: inside
blocks, which are ranges of about equally many rows in the order of the turns, and over the totals of the
blocks. So a conversation that holds a third of all rows, null ids and equal turn numbers included, is
spread over many tasks, as are very common conversations and turns: what repeats is aggregated
before it is joined. The ranges look at the first ``RANGE_CHARS`` of role and text only, as samples of
them pass through the driver; turns that agree in all that lie in one block.

Turns are in order of ``turn``, then role, then text; nulls come first. Repeated rows count once. A
null role or text counts as empty, and rows with a null id are one conversation. Markers inside
a text are taken apart (``<|`` becomes ``< |``). Other columns are not looked at; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NO_ID, written

PART_TURNS, RANGE_CHARS = 1024, 64


def rendered_turn(role: Column, text: Column) -> Column:
    def whole(c):
        return F.replace(c, F.lit("<|"), F.lit("< |"))

    return F.concat(F.lit("<|"), whole(role), F.lit("|>\n"), whole(text), F.lit("<|end|>\n"))


def _before(value, by: str = "conv") -> Column:
    """Over the blocks of a conversation: ``value`` of all earlier blocks."""
    order = Window.partitionBy(by).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(value.over(order), F.lit(0).cast("long"))


def in_blocks(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, text, block``: the distinct turns; of a conversation, later blocks have later turns."""
    clean = rows.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(NO_ID)).alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).distinct()
    heads = [F.substring(c, 1, RANGE_CHARS) for c in ("role", "text")]
    ordered = clean.repartitionByRange("conv", "turn", *heads)
    # written, so that a turn has the same block whenever it is read
    return written(ordered.withColumn("block", F.spark_partition_id().cast("long")), "turns-in-blocks")


def prefixes(rows: DataFrame) -> DataFrame:
    """``conv, position, role, text, one, two``: the turns in order with their prefix hashes."""
    clean, blocks = in_blocks(rows), ["conv", "block"]
    inside = Window.partitionBy(*blocks).orderBy("turn", "role", "text")
    local = clean.withColumn("local", F.row_number().over(inside))
    sizes = clean.groupBy(*blocks).agg(F.count("*").alias("n"))
    starts = sizes.select(*blocks, _before(F.sum("n")).alias("start"))
    placed = local.join(starts, blocks).withColumn("position", F.col("start") + F.col("local"))
    placed = placed.withColumns(
        {"h": F.xxhash64("position", "role", "text"), "g": F.xxhash64(F.lit(7), "position", "role", "text")}
    )
    placed = written(placed.select(*blocks, "position", "role", "text", "h", "g"), "turns")
    totals = placed.groupBy(*blocks).agg(F.bit_xor("h").alias("h"), F.bit_xor("g").alias("g"))
    earlier = totals.select(*blocks, _before(F.bit_xor("h")).alias("h0"), _before(F.bit_xor("g")).alias("g0"))
    upto = Window.partitionBy(*blocks).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    running = placed.withColumns({"h": F.bit_xor("h").over(upto), "g": F.bit_xor("g").over(upto)})
    return running.join(earlier, blocks).select(
        "conv", "position", "role", "text",
        F.col("h").bitwiseXOR(F.col("h0")).alias("one"), F.col("g").bitwiseXOR(F.col("g0")).alias("two"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """``conv, n_turns, copies`` of the conversations that no longer one begins with."""
    key = ["n_turns", "one", "two"]
    ends = turns.groupBy("conv").agg(
        F.max("position").alias("n_turns"),
        F.max_by("one", "position").alias("one"),
        F.max_by("two", "position").alias("two"),
    )
    inner = (
        turns.select("conv", "position", "one", "two")
        .join(ends.select("conv", "n_turns"), "conv")
        .filter("position < n_turns")
        .select(F.col("position").alias("n_turns"), "one", "two")
        .distinct()
    )
    heads = ends.groupBy(*key).agg(F.min("conv").alias("conv"), F.count("*").alias("copies"))
    return heads.join(inner, key, "left_anti").select("conv", "n_turns", "copies")


def collapsed(rows: DataFrame) -> DataFrame:
    """``conv_id, part, n_turns, copies, text``: the maximal conversations, rendered in parts."""
    turns = written(prefixes(rows), "prefixes")
    kept = turns.select("conv", "position", "role", "text").join(maximal(turns), "conv")
    parts = kept.groupBy(
        "conv", F.floor((F.col("position") - 1) / PART_TURNS).cast("int").alias("part"), "n_turns", "copies"
    ).agg(F.sort_array(F.collect_list(F.struct("position", "role", "text"))).alias("turns"))
    text = F.array_join(F.transform("turns", lambda t: rendered_turn(t["role"], t["text"])), "")
    return parts.select(
        F.when(F.col("conv") != NO_ID, F.col("conv")).alias("conv_id"), "part", "n_turns", "copies", text.alias("text")
    )


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All maximal conversations as text."""
    return collapsed(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE = f"""
WITH clean AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
),
turns AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS position FROM clean
),
heads AS (
    SELECT conv_id, position,
           list([role, text]) OVER (PARTITION BY conv_id ORDER BY position) AS head,
           count(*) OVER (PARTITION BY conv_id) AS n_turns
    FROM turns
),
whole AS (
    SELECT head, n_turns, min(conv_id) AS conv_id, count(*) AS copies
    FROM heads WHERE position = n_turns GROUP BY head, n_turns
),
kept AS (
    SELECT * FROM whole WHERE head NOT IN (SELECT head FROM heads WHERE position < n_turns)
)
SELECT k.conv_id, ((position - 1) // {PART_TURNS})::INT AS part, k.n_turns, k.copies,
       string_agg('<|' || replace(role, '<|', '< |') || '|>' || chr(10) || replace(text, '<|', '< |')
                  || '<|end|>' || chr(10), '' ORDER BY position) AS text
FROM kept k JOIN turns t ON t.conv_id IS NOT DISTINCT FROM k.conv_id
GROUP BY ALL
"""
