"""URL filters: a broadcast trie over reversed host labels and path segments.

An entry is ``host/path``. It fits a URL whose host is the entry's host or a subdomain of it,
and whose path starts with the entry's path, character by character. The trie first descends
the labels of a host from the last to the first, then the complete segments of a path; an
entry hangs where its last complete segment ends, under the beginning of the next one. A look
up costs one step for each label and segment, whatever the number of entries. The longest
fitting entry decides, and of equally long ones a block. What no entry fits is allowed: a
filter takes out only what an entry names.

The trie is broadcast in blocks of at most ``BLOCK_RULES`` entries. More entries are judged block
by block and the longest of all blocks' answers wins, so their number has no bound.

A null URL, or one without ``://``, has an empty host and path. Null or empty entries, and those
with another verdict than allow and block, are errors. Repeated entries do no harm. Repeated
rows, null ids and other columns pass through.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
AFTER_SCHEME = "(?s)^.*?://([^/?#]*)([^?#]*)"
BLOCK_RULES = 200_000
ALLOW, BLOCK = "allow", "block"
#: The entries of the registered query.
RULES = (
    (ALLOW, "org/"),
    (BLOCK, "example.org/es/"),
    (BLOCK, "example.org/en/1"),
    (ALLOW, "com/fr/"),
    (BLOCK, "com/de/"),
)


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, AFTER_SCHEME, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, AFTER_SCHEME, 2), F.lit(""))


class Node:
    __slots__ = ("labels", "segments", "begins", "entry")

    def __init__(self):
        self.labels: dict[str, Node] = {}
        self.segments: dict[str, Node] = {}
        #: Length of a beginning -> beginning -> entry.
        self.begins: dict[int, dict[str, tuple]] = {}
        self.entry: tuple | None = None


def rank(verdict: str, rule: str) -> tuple:
    """Compares entries that fit one URL: longer first, then a block."""
    return (len(rule), verdict == BLOCK, rule)


def build(rules) -> Node:
    root = Node()
    for verdict, rule in rules:
        if not rule or verdict not in (ALLOW, BLOCK):
            raise ValueError(f"no such entry: {verdict} {rule}")
        host, slash, path = rule.partition("/")
        node = root
        for label in reversed(host.split(".")) if host else ():
            node = node.labels.setdefault(label, Node())
        made = rank(verdict, rule)
        if not slash:
            node.entry = max(node.entry or made, made)
            continue
        *whole, begin = path.split("/")
        for segment in whole:
            node = node.segments.setdefault(segment, Node())
        held = node.begins.setdefault(len(begin), {})
        held[begin] = max(held.get(begin, made), made)
    return root


def longest(root: Node, host: str, path: str) -> tuple | None:
    """The entry that decides, as ``rank``."""
    best = None
    nodes = [root]
    for label in reversed(host.split(".")) if host else ():
        node = nodes[-1].labels.get(label)
        if node is None:
            break
        nodes.append(node)
    segments = path[1:].split("/") if path.startswith("/") else None
    for node in nodes:
        if node.entry and (best is None or node.entry > best):
            best = node.entry
        if segments is None:
            continue
        for segment in segments:
            for n, held in node.begins.items():
                found = held.get(segment[:n]) if len(segment) >= n else None
                if found and (best is None or found > best):
                    best = found
            node = node.segments.get(segment)
            if node is None:
                break
    return best


def judged(pages: DataFrame, rules) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``."""
    rules = sorted(set(rules))
    made = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    answers = []
    for at in range(0, max(1, len(rules)), BLOCK_RULES):
        shared = pages.sparkSession.sparkContext.broadcast(build(rules[at : at + BLOCK_RULES]))
        answers.append(_answer(shared)("host", "path"))
    best = F.greatest(*answers) if len(answers) > 1 else answers[0]
    made = made.withColumn("best", F.when(best["size"].isNotNull(), best))
    return made.withColumns(
        {
            "rule": F.col("best.rule"),
            "verdict": F.when(F.col("best.block"), BLOCK).otherwise(ALLOW),
        }
    ).drop("best")


def _answer(shared):
    @F.pandas_udf("size int, block boolean, rule string")
    def answer(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        root = shared.value
        found = [longest(root, h, p) or (None, None, None) for h, p in zip(host, path)]
        return pd.DataFrame(found, columns=["size", "block", "rule"]).astype(
            {"size": "Int32", "block": "boolean", "rule": "object"}
        )

    return answer


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entry and verdict of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judged(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    entries = ", ".join(f"('{v}', '{r}')" for v, r in RULES)
    return f"""
WITH entries(verdict, rule) AS (VALUES {entries}),
split AS (
    SELECT verdict, rule, substr(rule, 1, instr(rule, '/') - 1) AS rule_host,
           substr(rule, instr(rule, '/')) AS rule_path
    FROM entries
),
parts AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), ''),
                     '{UPPER}', '{LOWER}') AS host,
           coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages
)
SELECT page_id, host, path,
       max_by(rule, length(rule) * 2 + (verdict = 'block')::INT) AS rule,
       coalesce(max_by(verdict, length(rule) * 2 + (verdict = 'block')::INT), 'allow') AS verdict
FROM parts
LEFT JOIN split ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY page_id, host, path
"""


ORACLE = _sql()
