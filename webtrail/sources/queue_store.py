"""The queue as a store of buckets, so that a step reads and writes only what it touches.

Rows lie in buckets by the hash of their URL. A version of the store is a *base* (each bucket in one
of several folders) and *deltas*: new versions of the rows that a step has changed, and its new rows.
Reading overlays the base with the newest delta row of each id; only the ids of deltas are
gathered for it, the base is probed. When the deltas of a bucket outgrow a share of its base, that
bucket alone is written anew.

Version ``n`` is a small file that names the folders and buckets it is made of; it is written last. A
step that is repeated after a failure starts from the same version and writes the same one again.
Folders that neither the new version nor the one before it names are removed.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.queue import QUEUE_COLUMNS, QUEUE_SCHEMA

ROWS_OF_BUCKET, LEAST_BUCKETS, MOST_BUCKETS = 1_000_000, 8, 4096
# A bucket is written anew when its deltas have more rows than this share of its base.
DELTA_SHARE = 0.25
VERSION_SCHEMA = "kind STRING, folder STRING, bucket INT, n BIGINT"


@dataclass(frozen=True)
class Version:
    """Rows of each (folder, bucket), the number of buckets, and the next free id."""

    buckets: int
    next_id: int
    base: dict[tuple[str, int], int] = field(default_factory=dict)
    deltas: dict[tuple[str, int], int] = field(default_factory=dict)

    def folders(self) -> set[str]:
        return {folder for folder, _ in [*self.base, *self.deltas]}


class QueueStore:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    @classmethod
    def create(cls, queue: DataFrame, folder: str, first_id: int = 0, buckets: int | None = None) -> QueueStore:
        """A store that holds ``queue`` as version 0; new rows get ids from ``first_id`` on, or
        from the largest id on if that is more."""
        store = cls(queue.sparkSession, folder)
        n, largest = queue.agg(F.count(F.lit(1)), F.max("id")).first()
        buckets = buckets or min(MOST_BUCKETS, max(LEAST_BUCKETS, n // ROWS_OF_BUCKET))
        next_id = max(first_id, 0 if largest is None else largest + 1)
        name = "base-00000000"
        sizes = store._write(queue, name, buckets)
        store._settle(0, Version(buckets, next_id, {(name, b): k for b, k in sizes.items()}))
        return store

    # --- reading ---------------------------------------------------------------

    def version(self, number: int) -> Version:
        rows = self.spark.read.schema(VERSION_SCHEMA).json(self._of(number)).collect()
        one = {r.kind: r.n for r in rows}
        of = lambda kind: {(r.folder, r.bucket): r.n for r in rows if r.kind == kind}
        return Version(one["buckets"], one["next_id"], of("base"), of("delta"))

    def exists(self) -> bool:
        return self._system().exists(self._path(self.folder)) and self.newest() >= 0

    def newest(self) -> int:
        """Number of the newest version, -1 without any."""
        names = [s.getPath().getName() for s in self._system().listStatus(self._path(self.folder))]
        return max((int(n.removeprefix("version-")) for n in names if n.startswith("version-")), default=-1)

    def read(self, number: int, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a version, or only those of some buckets."""
        return self._read(self.version(number), buckets)

    def touching(self, number: int, urls: DataFrame) -> DataFrame:
        """The rows of some URLs; only their buckets are read. ``urls`` is read twice."""
        version = self.version(number)
        # at most one row for each bucket
        due = urls.select(bucket_of(F.col("url"), version.buckets).alias("b")).distinct().collect()
        rows = self._read(version, [r.b for r in due])
        return rows.join(urls.select("url"), "url", "left_semi").select(*QUEUE_COLUMNS)

    def _read(self, version: Version, buckets: list[int] | None) -> DataFrame:
        base = self._parts(version.base, buckets)
        deltas = self._parts(version.deltas, buckets)
        if deltas is None:
            rows = base if base is not None else self.spark.createDataFrame([], QUEUE_SCHEMA)
            return rows.select(*QUEUE_COLUMNS)
        others = [c for c in QUEUE_COLUMNS if c != "id"]
        newest = deltas.groupBy("id").agg(F.max_by(F.struct(*others), "folder_").alias("row_"))
        newest = newest.select("id", "row_.*").select(*QUEUE_COLUMNS)
        if base is None:
            return newest
        return base.join(newest.select("id"), "id", "left_anti").select(*QUEUE_COLUMNS).unionByName(newest)

    def _parts(self, parts: dict[tuple[str, int], int], buckets: list[int] | None) -> DataFrame | None:
        wanted: dict[str, list[int]] = {}
        for folder, bucket in parts:
            if buckets is None or bucket in buckets:
                wanted.setdefault(folder, []).append(bucket)
        made = None
        for folder, of_folder in sorted(wanted.items()):
            rows = self.spark.read.schema(QUEUE_SCHEMA + ", bucket INT").parquet(f"{self.folder}/{folder}")
            rows = rows.filter(F.col("bucket").isin(of_folder)).withColumn("folder_", F.lit(folder))
            made = rows if made is None else made.unionByName(rows)
        return made

    # --- writing ---------------------------------------------------------------

    def commit(self, number: int, changed: DataFrame, next_id: int) -> int:
        """Version ``number + 1``: ``changed`` has the new rows and whole new versions of others."""
        before = self.version(number)
        name = f"delta-{number + 1:08d}"
        sizes = self._write(changed.select(*QUEUE_COLUMNS), name, before.buckets)
        deltas = before.deltas | {(name, b): k for b, k in sizes.items()}
        after = replace(before, next_id=next_id, deltas=deltas)
        due = _outgrown(after)
        if due:
            name = f"base-{number + 1:08d}"
            sizes = self._write(self._read(after, due), name, after.buckets)
            kept = {k: n for k, n in after.base.items() if k[1] not in due}
            after = replace(
                after,
                base=kept | {(name, b): k for b, k in sizes.items()},
                deltas={k: n for k, n in after.deltas.items() if k[1] not in due},
            )
        self._settle(number + 1, after)
        self._sweep(before.folders() | after.folders(), number)
        return number + 1

    def _write(self, rows: DataFrame, name: str, buckets: int) -> dict[int, int]:
        """Rows of each bucket written."""
        path = f"{self.folder}/{name}"
        dealt = rows.withColumn("bucket", bucket_of(F.col("url"), buckets)).repartition("bucket")
        dealt.write.partitionBy("bucket").parquet(path, mode="overwrite")
        back = self.spark.read.schema(QUEUE_SCHEMA + ", bucket INT").parquet(path)
        return {r.bucket: r["count"] for r in back.groupBy("bucket").count().collect()}

    def _settle(self, number: int, version: Version) -> None:
        rows = [("buckets", None, None, version.buckets), ("next_id", None, None, version.next_id)]
        rows += [("base", f, b, n) for (f, b), n in version.base.items()]
        rows += [("delta", f, b, n) for (f, b), n in version.deltas.items()]
        made = self.spark.createDataFrame(rows, VERSION_SCHEMA).coalesce(1)
        made.write.json(self._of(number), mode="overwrite")

    def _sweep(self, kept: set[str], number: int) -> None:
        """Remove folders and versions that neither version ``number`` nor the next one needs."""
        system = self._system()
        for status in system.listStatus(self._path(self.folder)):
            name = status.getPath().getName()
            old = name.startswith("version-") and int(name.removeprefix("version-")) < number
            if old or (name.startswith(("base-", "delta-")) and name not in kept):
                system.delete(status.getPath(), True)

    def _of(self, number: int) -> str:
        return f"{self.folder}/version-{number:08d}"

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self):
        return self._path(self.folder).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())


def bucket_of(url: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(buckets)).cast("int")


def _outgrown(version: Version) -> list[int]:
    base: dict[int, int] = {}
    for (_, bucket), n in version.base.items():
        base[bucket] = base.get(bucket, 0) + n
    deltas: dict[int, int] = {}
    for (_, bucket), n in version.deltas.items():
        deltas[bucket] = deltas.get(bucket, 0) + n
    return sorted(b for b, n in deltas.items() if n > DELTA_SHARE * base.get(b, 0))
