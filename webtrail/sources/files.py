"""Files of a crawl: URL lists, fetch logs, saved HTML, extraction and summary tables.

All readers have fixed schemas; nothing is inferred.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import html as H
from ..functions.text import WS, char_count, word_count
from ..operators.runs import SUMMARY_COLUMNS

# The columns of the three tables.
FETCH_LOG_SCHEMA = (
    "id BIGINT, url STRING, final_url STRING, status STRING, code INT, ms DOUBLE, "
    "bytes BIGINT, html_path STRING, error STRING"
)
EXTRACTED_SCHEMA = "id BIGINT, url STRING, chars BIGINT, words BIGINT, text STRING"
SUMMARY_SCHEMA = (
    "name STRING, fetched BIGINT, total BIGINT, avg_ms DOUBLE, p95_ms DOUBLE, "
    "pages_per_sec DOUBLE, pages_per_min DOUBLE, pages_per_day DOUBLE, mb_per_sec DOUBLE, "
    "total_bytes BIGINT, extracted_docs BIGINT, total_chars BIGINT"
)
# Fixed value: the printed result line of a fetch run.
RUN_LINE = (
    r"(cpp|rust)\s+fetched=(\d+)/(\d+)\s+avg_ms=([0-9.]+)\s+p95_ms=([0-9.]+)\s+"
    r"pages_per_sec=([0-9.]+)\s+total_bytes=(\d+)"
)
# Folders that saved pages are dealt out to, so that they are listed in parallel.
SAVED_PARTS = 64


# ---------------------------------------------------------------------------
# URL lists
# ---------------------------------------------------------------------------


def url_list(spark: SparkSession, path: str, blank_lines: str = "empty") -> DataFrame:
    """``pos, url``: one URL per line, numbered from 1 after blank lines are left out.

    ``blank_lines='empty'`` leaves out empty lines only, ``'white'`` also lines of
    whitespace. Meant for hand-kept seed lists, which are one small file: the file is
    read as one value so that line order is certain. Use :func:`url_table` for
    lists of any size.
    """
    keep = "." if blank_lines == "empty" else f"{WS[:1]}^{WS[1:]}"
    lines = F.split(F.regexp_replace("value", "\r?\n\\z", ""), "\r?\n", -1)
    kept = F.filter(lines, lambda line: line.rlike(f"(?s){keep}"))
    return (
        spark.read.text(path, wholetext=True)
        .select(F.posexplode(kept).alias("pos", "url"))
        .select((F.col("pos") + 1).cast("bigint").alias("pos"), "url")
    )


def url_table(spark: SparkSession, path: str) -> DataFrame:
    """``pos, url`` from list files of any number and size, numbered from 1 in the order of
    file names and lines; lines of whitespace are left out.

    Lines are numbered within their split of a file, and the sizes of splits added up."""
    split = ["file_", "block_"]
    lines = spark.read.text(path).select(
        F.col("value").alias("url"),
        F.col("_metadata.file_path").alias("file_"),
        F.col("_metadata.file_block_start").alias("block_"),
        F.monotonically_increasing_id().alias("line_"),
    ).filter(F.col("url").rlike(f"{WS[:1]}^{WS[1:]}"))
    # one row for each split of the files
    ahead = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    starts = lines.groupBy(*split).agg(F.count(F.lit(1)).alias("n_")).select(
        *split, F.coalesce(F.sum("n_").over(ahead), F.lit(0)).alias("start_")
    )
    within = F.row_number().over(Window.partitionBy(*split).orderBy("line_"))
    return lines.withColumn("n_", within).join(starts, split).select(
        (F.col("start_") + F.col("n_")).cast("bigint").alias("pos"), "url"
    )


# ---------------------------------------------------------------------------
# Tab-separated logs
# ---------------------------------------------------------------------------


def _tsv(spark: SparkSession, schema: str):
    return (
        spark.read.schema(StructType.fromDDL(schema))
        .option("sep", "\t")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", False)
    )


def fetch_log(spark: SparkSession, paths: str | Sequence[str], run: Column | None = None) -> DataFrame:
    """Fetch logs of one or many runs; ``run`` is the folder that holds a log
    (a ``.tsv`` file, or a folder of that name as Spark writes it).

    An empty list of paths gives an empty log.
    """
    schema = StructType.fromDDL(FETCH_LOG_SCHEMA)
    if not paths:
        return spark.createDataFrame([], schema).withColumn("run", F.lit(None).cast("string"))
    rows = _tsv(spark, FETCH_LOG_SCHEMA).csv(paths if isinstance(paths, str) else list(paths))
    if run is None:
        run = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+\.tsv(?:/[^/]+)?\z", 1)
    return rows.withColumn("run", run)


def write_fetch_log(log: DataFrame, path: str) -> None:
    """Fetch log as TSV: two decimals for ms, no tabs or line breaks inside error texts."""
    log.select(
        "id", "url", "final_url", "status", "code",
        F.format_string("%.2f", F.col("ms")).alias("ms"),
        "bytes", "html_path",
        F.translate("error", "\t\r\n", "   ").alias("error"),
    ).write.option("sep", "\t").option("header", True).option("escape", '"').csv(
        path, mode="overwrite"
    )


def write_summary(rows: DataFrame, path: str) -> None:
    """The 12-column run summary; a handful of rows, so one file."""
    rows.select(*SUMMARY_COLUMNS).coalesce(1).write.option("sep", "\t").option(
        "header", True
    ).csv(path, mode="overwrite")


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, SUMMARY_SCHEMA).csv(path)


def parse_run_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Seven typed fields per result line; a line that does not fit gives NULL
    fields and ``rejected = true``."""
    text = F.col(line)
    names = ["name", "fetched", "total", "avg_ms", "p95_ms", "pages_per_sec", "total_bytes"]
    kinds = ["string", "bigint", "bigint", "double", "double", "double", "bigint"]
    fits = text.rlike(RUN_LINE)
    return lines.select(
        "*",
        *[
            F.when(fits, F.regexp_extract(text, RUN_LINE, i + 1)).try_cast(kind).alias(name)
            for i, (name, kind) in enumerate(zip(names, kinds))
        ],
        (~fits).alias("rejected"),
    )


# ---------------------------------------------------------------------------
# Saved pages and extracted text
# ---------------------------------------------------------------------------


def _local_path(spark: SparkSession, folder: str) -> str | None:
    """The plain path of a folder in a (shared) local file system; None if it is in another store."""
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]+):", folder)
    store = scheme[1] if scheme else spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").split(":")[0]
    return os.path.abspath(re.sub(r"^file:(?://[^/]*)?", "", folder)) if store == "file" else None


def write_html(pages: DataFrame, folder: str) -> None:
    """``page_id, html`` saved one page to a file, ``part=<n>/page_id=<id>.html`` in a new folder.

    A file has a line for each row of its id, an empty one where ``html`` is null. In a local file
    system the tasks write the files themselves, as Spark's writer starts a ``chmod`` process there for
    every folder, file and checksum. Each file is put in place whole, so a repeated task writes it again.
    Other stores get Spark's writer, with a folder ``page_id=<id>`` for the file.
    """
    local = _local_path(pages.sparkSession, folder)
    part = F.pmod(F.xxhash64("page_id"), F.lit(SAVED_PARTS)).alias("part")
    dealt = pages.select(part, "page_id", "html").repartition("page_id")
    if local is None:
        dealt.write.partitionBy("part", "page_id").text(folder)
        return
    os.makedirs(local)

    def save(rows):
        # by value to the executors: nothing of this package is imported there
        from itertools import groupby
        from uuid import uuid4

        for (part, page_id), same in groupby(rows, key=lambda row: (row["part"], row["page_id"])):
            name = "__HIVE_DEFAULT_PARTITION__" if page_id is None else page_id
            below = f"{local}/part={part}"
            os.makedirs(below, exist_ok=True)
            # hidden from readers if its task is lost
            begun = f"{below}/.{uuid4().hex}"
            with open(begun, "wb") as file:
                for row in same:
                    file.write((row["html"] or b"") + b"\n")
            os.replace(begun, f"{below}/page_id={name}.html")

    # bytes, as Python's strings would change those that are no UTF-8
    dealt.withColumn("html", F.col("html").cast("binary")).sortWithinPartitions("page_id").foreachPartition(save)


def saved_html(spark: SparkSession, folder: str) -> DataFrame:
    """``html_path, html`` of saved page files; bytes that are no UTF-8 are ignored."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    text = F.coalesce(
        F.try_validate_utf8(F.col("content").cast("string")),
        F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "�", ""),
    )
    return raw.select(F.col("path").alias("html_path"), text.alias("html"))


def plain_path(path: Column, base: str = "") -> Column:
    """A path without scheme, host and blank ends; a relative one is below ``base``."""
    bare = F.regexp_replace(F.trim(path), r"^[A-Za-z][A-Za-z0-9+.-]+:(?://[^/]*)?", "")
    return F.when(F.startswith(bare, F.lit("/")), bare).otherwise(
        F.concat(F.lit(base.rstrip("/") + "/" if base else ""), bare)
    )


def attach_html(log: DataFrame, pages: DataFrame, base: str = "") -> DataFrame:
    """Log rows that saved a page, with its text; rows with a blank path drop out.

    The log has plain paths (relative ones below ``base``) and the reader of the pages
    gives URIs, so both are compared without their scheme.
    """
    saved = pages.withColumn("path_", plain_path(F.col("html_path"), base)).drop("html_path")
    named = log.filter(F.trim("html_path") != "").withColumn("path_", plain_path(F.col("html_path"), base))
    return named.join(saved, "path_").drop("path_")


def extract_documents(pages: DataFrame, html: str = "html") -> DataFrame:
    """``chars, words, text`` of the main text; pages without any are dropped.

    The text is computed in one column and emitted through a generator, so that
    the emptiness filter cannot be pushed below it and run the patterns twice.
    """
    made = pages.withColumn("text", H.main_text(F.col(html))).drop(html)
    cols = [c for c in made.columns if c != "text"]
    held = made.select(*cols, F.explode_outer(F.array("text")).alias("text"))
    return held.filter(F.col("text") != "").withColumns(
        {"chars": char_count(F.col("text")), "words": word_count(F.col("text"))}
    )


def write_extracted(docs: DataFrame, path: str) -> None:
    """Extracted documents as Parquet, text kept as a column."""
    docs.select("id", "url", "chars", "words", "text").write.parquet(path, mode="overwrite")
