"""From documents to training sequences: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and, but for the last, returns the columns of
``documents``. The stages that drop whole documents decide by row: rows that share an id, or
have none, stay or go each on its own. No stage can be expressed in SQL as a whole, so there is
no ``ORACLE_SQL``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webtrail.llm.common import written
from webtrail.llm.decontaminate import without
from webtrail.llm.packing import pack
from webtrail.llm.simhash import near_duplicates
from webtrail.llm.suffixes import remove_repeats
from webtrail.llm.toxicity import categories_of_labels, train, without_rejected

ORACLE_SQL = None
#: The number of a row in the SimHash stage; no column of the documents has this name.
ROW = "number of the row"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    chain = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), categories_of_labels())
    return without_rejected(docs, chain)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: one with the smallest id (null comes first)."""
    # written, so that a row has the same number whenever it is read
    rows = written(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered-rows")
    found = near_duplicates(rows.select(F.col(ROW).alias("doc_id"), "text"))
    groups = found.select(F.col("doc_id").alias(ROW), "component_id").join(rows.select(ROW, "doc_id"), ROW)
    first = groups.groupBy("component_id").agg(F.min(F.struct("doc_id", ROW)).alias("least"))
    return rows.join(first.select(F.col("least")[ROW].alias(ROW)), ROW, "left_semi").drop(ROW)


def suffix_array(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones have; ``n_chars`` follows the text."""
    own = {"doc_id", "text", "n_chars"}
    rest = {c: f"other column {k}" for k, c in enumerate(docs.columns) if c not in own}
    kept = remove_repeats(docs.withColumnsRenamed(rest), carry=list(rest.values()))
    made = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return kept.select(*(made[c] if c in own else F.col(rest[c]) for c in docs.columns)).toDF(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its edit budget."""
    return without(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents and their places in sequences."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", simhash),
    ("suffix_array_dedup", suffix_array),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
