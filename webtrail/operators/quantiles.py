"""Exact floor-index quantiles that survive a key holding most of the rows.

The quantile wanted is ``sorted(values)[int(q * (n - 1))]``. It is neither
``percentile`` (interpolates) nor ``percentile_disc`` (another index), and a
``row_number`` over the key would sort a hot key in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# Bits of the fraction that buckets tell apart at first, and when the right one is refined.
FIRST_BITS, NEXT_BITS = 10, 31
# Size of a quantile sketch, and the error of its ranks that holds for practically every sketch of that size.
SKETCH_SIZE, SKETCH_RANK_ERROR = 400, 0.0133

def floor_index(q: float, n: Column) -> Column:
    """Zero-based index ``int(q * (n - 1))``."""
    return F.floor(F.lit(q) * (n - 1)).cast("bigint")


def _exponent(value: Column) -> Column:
    """Sign and binary exponent as one number that grows with the value."""
    size = F.floor(F.log2(F.abs(value))).cast("int") + 2000
    infinite = F.abs(value) == float("inf")
    return (
        F.when(F.isnan(value), F.lit(9000))
        .when(value == 0, F.lit(0))
        .when(infinite, F.when(value > 0, F.lit(8000)).otherwise(F.lit(-8000)))
        .when(value < 0, -size)
        .otherwise(size)
    )


def _fraction(value: Column, exponent: Column, bits: int) -> Column:
    """The value by the power of two of its exponent, to so many bits; grows with the value."""
    plain = F.abs(exponent).between(1, 7999)
    scale = F.pow(F.lit(2.0), (F.abs(exponent) - 2000).cast("double"))
    return F.when(plain, F.floor(value / scale * float(1 << bits)).cast("bigint")).otherwise(F.lit(0))


def match_on(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on equal keys where NULL equals NULL, so no group gets lost. (It also
    keeps Spark from deriving key filters, which would stop it from sharing a
    shuffle that both sides come from.)"""
    renamed = right.withColumnsRenamed({k: f"{k}__r" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"{k}__r"]) for k in keys]
    return left.join(renamed, on, how).drop(*[f"{k}__r" for k in keys])


def exact_quantile(
    df: DataFrame, keys: Sequence[str], value: str, q: float = 0.95, name: str = "p95"
) -> DataFrame:
    """``keys, n, <name>`` over the non-null values of each key.

    Equal values are counted before the shuffle, which spreads on (key, value). Then the
    bucket that holds the wanted rank is narrowed down: by sign, exponent and some bits of the
    fraction, and by more bits. Each time only bucket counts are added up in order. Whatever the
    values are like, these are at most a few million of a key, and so many different doubles
    are in the last bucket at most. So no task ever sorts a whole key.
    """
    keys = list(keys)
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("v_"))
        .agg(F.count(F.lit(1)).alias("c_"))
        .withColumn("e_", _exponent(F.col("v_")))
    )
    first, more = (_fraction(F.col("v_"), F.col("e_"), bits) for bits in (FIRST_BITS, NEXT_BITS))
    levels = [F.struct("e_", first.alias("f_")), more]
    left: DataFrame | None = None
    for level in levels:
        counts = counts.withColumn("b_", level)
        wanted = _holding(counts, left, keys, q)
        counts = match_on(counts, wanted.select(*keys, "b_"), [*keys, "b_"]).drop("b_")
        left = wanted.drop("b_")
    inside = Window.partitionBy(*keys).orderBy("v_").rowsBetween(Window.unboundedPreceding, 0)
    ranked = match_on(counts, left, keys).withColumn("rank_", F.sum("c_").over(inside))
    return (
        ranked.filter(F.col("rank_") > F.col("left_"))
        .groupBy(*keys)
        .agg(F.first("n").alias("n"), F.min("v_").alias(name))
    )


def _holding(counts: DataFrame, left: DataFrame | None, keys: list[str], q: float) -> DataFrame:
    """``keys, b_, n, left_``: the bucket that holds the wanted rank of each key, and how many
    values of the bucket come before it. ``left`` has the rank to look for, at first none."""
    per_key = Window.partitionBy(*keys)
    so_far = per_key.orderBy("b_").rowsBetween(Window.unboundedPreceding, 0)
    buckets = (
        counts.groupBy(*keys, "b_")
        .agg(F.sum("c_").alias("bc_"))
        .withColumn("upto_", F.sum("bc_").over(so_far))
    )
    if left is None:
        buckets = buckets.withColumn("n", F.sum("bc_").over(per_key))
        buckets = buckets.withColumn("left_", floor_index(q, F.col("n")))
    else:
        buckets = match_on(buckets, left, keys)
    before = F.col("upto_") - F.col("bc_")
    return buckets.filter((F.col("upto_") > F.col("left_")) & (before <= F.col("left_"))).select(
        *keys, "b_", "n", (F.col("left_") - before).alias("left_")
    )


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    chunk: str,
    order: Sequence[str],
    sums: dict[str, Column],
) -> DataFrame:
    """Running sums per key in two levels, so that a hot key is shared by many tasks.

    ``chunk`` cuts each key into consecutive pieces of bounded size. Piece totals
    are accumulated over the pieces (few rows), then rows only within a piece.
    """
    keys = list(keys)
    parts = df.withColumns({f"x_{n}": c for n, c in sums.items()})
    totals = parts.groupBy(*keys, chunk).agg(*[F.sum(f"x_{n}").alias(f"t_{n}") for n in sums])
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        chunk,
        *[F.coalesce(F.sum(f"t_{n}").over(before), F.lit(0)).alias(f"o_{n}") for n in sums],
    )
    within = (
        Window.partitionBy(*keys, chunk)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    joined = match_on(parts, offsets, [*keys, chunk])
    return joined.select(
        *df.columns,
        *[(F.sum(f"x_{n}").over(within) + F.col(f"o_{n}")).alias(n) for n in sums],
    )


# The running quantile reads values as digits of this base, one pass per digit.
BASE = 16
CHUNK = 4096


def running_quantile(
    values: DataFrame,
    asked: DataFrame,
    keys: Sequence[str],
    max_code: int,
    q: float = 0.95,
    name: str = "p95_code",
) -> DataFrame:
    """Exact quantile of growing prefixes, without comparing all pairs.

    ``values``: keys, ``seq`` (1, 2, ... per key) and an integer ``code >= 0``.
    ``asked``: keys and ``m``: the quantile of the codes with ``seq <= m`` is
    wanted; other columns are kept. The answer is built digit by digit from the
    top: a pass counts, for the codes that share the digits known so far, how many
    arrived up to ``m`` with each next digit, and picks the digit where the wanted
    rank falls. Passes: ``log_16`` of the largest code. Work is cut into pieces of
    4096 arrivals, so a hot key is spread over many tasks.
    """
    keys = list(keys)
    digits = 1
    while BASE**digits <= max_code:
        digits += 1
    kept = [c for c in asked.columns if c not in keys]
    values = cut_lineage(values.select(*keys, "seq", "code"))
    open_ = asked.withColumns(
        {"node_": F.lit(0).cast("bigint"), "left_": floor_index(q, F.col("m"))}
    )
    below = [f"below{j}_" for j in range(1, BASE)]
    for level in range(digits - 1, -1, -1):
        # Each pass reads the open requests twice, so they are kept as a table.
        open_ = cut_lineage(open_)
        shown = F.floor(F.col("code") / BASE**level).cast("bigint")
        arrivals = values.select(
            *keys,
            F.floor(shown / BASE).cast("bigint").alias("node_"),
            F.col("seq").alias("at_"),
            (shown % BASE).cast("int").alias("digit_"),
        )
        rows = arrivals.unionByName(
            open_.withColumn("at_", F.col("m")), allowMissingColumns=True
        ).withColumns(
            {
                "chunk_": F.floor(F.col("at_") / CHUNK).cast("bigint"),
                "late_": F.col("left_").isNotNull(),
            }
        )
        # belowJ_: codes so far, in this node, whose next digit is smaller than J
        counted = running_totals(
            rows,
            [*keys, "node_"],
            "chunk_",
            ["at_", "late_"],
            {b: (F.coalesce(F.col("digit_"), F.lit(BASE)) < j).cast("bigint")
             for j, b in enumerate(below, start=1)},
        ).filter(F.col("late_"))
        step = counted.withColumn("below_", F.array(F.lit(0).cast("bigint"), *below)).withColumn(
            "pick_", F.size(F.filter("below_", lambda c: c <= F.col("left_"))) - 1
        )
        open_ = step.select(
            *keys,
            *kept,
            (F.col("node_") * BASE + F.col("pick_")).alias("node_"),
            (F.col("left_") - F.get("below_", F.col("pick_"))).alias("left_"),
        )
    return open_.withColumnRenamed("node_", name).drop("left_")


# ---------------------------------------------------------------------------
# Approximate quantiles that can be merged
# ---------------------------------------------------------------------------


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, name: str = "sketch") -> DataFrame:
    """``keys, <name>``: a quantile sketch of the non-null values of each key, to be stored with its metrics.

    Sketches are of bounded size and merge: those of windows give that of a run, those of runs give that of all.
    """
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), SKETCH_SIZE).alias(name))


def merged_sketches(sketches: DataFrame, keys: Sequence[str], name: str = "sketch") -> DataFrame:
    """``keys, <name>``: the sketches of all rows of a key as one."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double(name, SKETCH_SIZE).alias(name))


def sketch_quantile(sketch: Column, q: float = 0.95) -> Column:
    """A value whose rank is ``q`` to within ``SKETCH_RANK_ERROR``; NULL where the sketch has no values."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(q)))


def ranks_hold(df: DataFrame, claimed: DataFrame, keys: Sequence[str], value: str, at: str, q: float = 0.95) -> DataFrame:
    """``keys, n, within``: is the rank of the claimed value ``at`` of each key within the error of ``q``?"""
    both = match_on(df.filter(F.col(value).isNotNull()), claimed.select(*keys, at), keys)
    n = F.count(F.lit(1))
    below, upto = F.count_if(F.col(value) < F.col(at)) / n, F.count_if(F.col(value) <= F.col(at)) / n
    within = (below <= q + SKETCH_RANK_ERROR) & (upto >= q - SKETCH_RANK_ERROR)
    return both.groupBy(*keys).agg(n.alias("n"), within.alias("within"))
