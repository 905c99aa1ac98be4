"""Stored pages or extractions as a bucketed table that batches are only added to.

The latest row of each key counts. A batch is written as new files of the buckets by key; what is
stored is neither read nor written again for it. Reading finds the latest version of each key from
the narrow columns and picks the wide rows inside their buckets, so page text is never shuffled.
``compacted`` writes the rows that count to a new folder, bucket by bucket.

Of rows that are equally late by ``order`` (nulls first) the one of the later batch counts. A batch
that is written twice, after a failure, counts once.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.store import latest_by

BUCKETS = 64
# Columns of its own, before those of the rows.
OWN = StructType([StructField("k_", StringType()), StructField("batch_", LongType()), StructField("write_", StringType())])


def _text_of(key: Column) -> Column:
    """A key as text that is never null: a null key is one of the keys."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))


class RowStore:
    def __init__(
        self, spark: SparkSession, folder: str, schema: StructType, key: str, order: Sequence[str], buckets: int = BUCKETS
    ):
        """The store in ``folder``, which may hold rows already; ``buckets`` stays as it was at first."""
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self.key, self.order, self.buckets = key, list(order), buckets
        self.table = f"rows_{uuid4().hex}"
        columns = spark.createDataFrame([], StructType([*OWN.fields, *schema.fields]))._jdf.schema().toDDL()
        spark.sql(
            f"CREATE TABLE {self.table} ({columns}) USING parquet "
            f"CLUSTERED BY (k_) SORTED BY (k_) INTO {buckets} BUCKETS LOCATION '{self.folder}'"
        )

    def add(self, number: int, incoming: DataFrame) -> None:
        """Write batch ``number``; columns that it lacks are NULL, others are left out."""
        there = set(incoming.columns)
        rows = incoming.select(
            *((F.col(f"`{f.name}`") if f.name in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema)
        )
        newest = latest_by(rows, self.key, self.order)
        self._write(
            newest.select(
                _text_of(F.col(self.key)).alias("k_"),
                F.lit(number).cast("bigint").alias("batch_"),
                F.lit(uuid4().hex).alias("write_"),
                *(F.col(f"`{f.name}`") for f in self.schema),
            )
        )

    def read(self) -> DataFrame:
        """The latest row of every key."""
        return self._rows().select(*(F.col(f"`{f.name}`") for f in self.schema))

    def compacted(self, folder: str) -> RowStore:
        """A store of the rows that count, in another folder."""
        made = RowStore(self.spark, folder, self.schema, self.key, self.order, self.buckets)
        made._write(self._rows())
        return made

    def _rows(self) -> DataFrame:
        place = F.struct(*self.order, "batch_", "write_")
        newest = self.spark.table(self.table).groupBy(F.col("k_").alias("key_")).agg(F.max(place).alias("newest_"))
        # no version is later than the newest: "at least as late" leaves that one, and is no key of the join
        same = (F.col("k_") == F.col("key_")) & (place >= F.col("newest_"))
        return self.spark.table(self.table).join(newest, same, "left_semi")

    def _write(self, rows: DataFrame) -> None:
        rows.repartition(self.buckets, "k_").write.insertInto(self.table)
