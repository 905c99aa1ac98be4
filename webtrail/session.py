"""Session helpers: a local session for tests, and the shared folder of a cluster."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "webtrail", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or given to ``setCheckpointDir``.

    A session in one process without either makes a temporary folder its setting; on a
    cluster such a folder would vanish with its machine, so there it is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="webtrail-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        folder = shared_dir(spark)
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread rows over all cores before heavy per-row work, if the scan is too coarse.

    A large table already arrives in more splits than there are cores and passes
    through untouched (its wide rows are never shuffled); only a table of a few
    files is redistributed. Use it on a table as read: asking a plan with joins for
    its partitions would already run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)
