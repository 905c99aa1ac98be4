"""Queue, log and page tables derived from the given tables by one SELECT each.

The same text runs in Spark and in the checking database; ``{pages}``,
``{events}``, ``{conversations}`` and ``{documents}`` stand for the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import spread

QUEUE = """
SELECT page_id AS id,
       regexp_replace(url, '#.*$', '') AS url,
       CASE page_id % 4 WHEN 2 THEN 'done' WHEN 3 THEN 'failed' ELSE 'pending' END AS status,
       CAST(page_id % 20 AS INT) AS priority,
       CAST((page_id % 101) / 100.0 AS FLOAT) AS geo_score,
       CASE WHEN page_id % 5 = 0 THEN 'seed' ELSE 'frontier:explore' END AS source,
       CAST(page_id % 3 AS INT) AS depth,
       CASE WHEN page_id % 5 = 0 THEN NULL ELSE page_id - 1 END AS parent_url_id,
       CAST(page_id % 4 AS INT) AS retries,
       CAST(3 AS INT) AS max_retries,
       CAST(NULL AS TIMESTAMP) AS claimed_at,
       CAST(NULL AS STRING) AS claimed_by,
       CAST(NULL AS TIMESTAMP) AS last_scored_at,
       CAST(NULL AS TIMESTAMP) AS processed_at,
       TIMESTAMP '2024-01-01 00:00:00' AS created_at,
       TIMESTAMP '2024-01-01 00:00:00' AS updated_at,
       CAST(NULL AS STRING) AS error
FROM {pages}
"""

# Every page finds two other pages and one URL that is new to the queue.
DISCOVERIES = """
SELECT t.url, f.priority, f.geo_score, f.source, f.depth, f.parent_url_id, f.ord
FROM (
  SELECT (CASE k WHEN 0 THEN 7 * page_id + 1 ELSE 3 * page_id + 2 END)
           % (SELECT count(*) FROM {pages}) AS target,
         CAST((page_id * 13 + k * 7) % 120 AS INT) AS priority,
         CAST(((page_id * 17 + k * 5) % 101) / 100.0 AS FLOAT) AS geo_score,
         CASE WHEN page_id % 37 = 0 AND k = 1 THEN 'seed' WHEN page_id % 2 = 0
              THEN 'frontier:explore' ELSE 'frontier:geo-dense' END AS source,
         CAST(page_id % 3 + 1 AS INT) AS depth,
         CASE WHEN page_id % 11 = 0 THEN NULL ELSE page_id END AS parent_url_id,
         3 * page_id + k AS ord
  FROM (SELECT page_id, 0 AS k FROM {pages} UNION ALL SELECT page_id, 1 AS k FROM {pages}) AS two
) AS f
JOIN (
  SELECT page_id AS target, regexp_replace(url, '#.*$', '') AS url FROM {pages}
) AS t ON t.target = f.target
UNION ALL
SELECT concat('https://found.example.org/new/', CAST(page_id % 50 AS STRING)) AS url,
       CAST((page_id * 13 + 14) % 120 AS INT) AS priority,
       CAST(((page_id * 17 + 10) % 101) / 100.0 AS FLOAT) AS geo_score,
       CASE WHEN page_id % 41 = 0 THEN 'seed' WHEN page_id % 2 = 0
            THEN 'frontier:explore' ELSE 'frontier:geo-dense' END AS source,
       CAST(page_id % 3 + 1 AS INT) AS depth,
       CASE WHEN page_id % 11 = 0 THEN NULL ELSE page_id END AS parent_url_id,
       3 * page_id + 2 AS ord
FROM {pages}
"""

# Pages that link to each other by absolute address; some get many topical links, a
# description, a recent year, or words of structured data.
LINKED_PAGES = """
SELECT p.page_id, p.url, concat(
         p.html,
         CASE WHEN p.page_id % 7 = 0 THEN
           '<meta name="description" content="Street maps of 2025 "><p>Since 2025 here</p>'
         ELSE '' END,
         CASE WHEN p.page_id % 9 = 0 THEN '<p>latitude 48</p>' ELSE '' END,
         '<a href="', a.url, '">first neighbour</a><a class="x" href="', b.url,
         '#part">second <b>city</b>  neighbour</a>',
         CASE WHEN p.page_id % 5 = 0 THEN concat(
           '<a href="https://city.example.org/map/1/', k, '">robot map</a>',
           '<a href="https://city.example.org/map/2/', k, '">lidar</a>',
           '<a href="https://www.example.com/login?next=', k, '">login</a>',
           '<a href="http://example.com/a/b/c/d/e/f/', k, '">deep</a>',
           '<a href="//cdn.example.net/', k, ';v=1">cdn</a>',
           '<a href="../up/./', k, '">up</a><a href="?q=', k, '">query</a>',
           '<a href="mailto:x@example.org">mail</a><a href="#top">top</a>',
           '<a href="https://city.example.org/vps/', k, '">vps mesh</a>',
           '<a href="https://city.example.org/xr/', k, '"> street  <i>view</i></a>',
           '<a href="HTTPS://City.Example.org/xr/', k, '">same again</a>',
           '<a href="https://a.example.org/1">one</a><a href="https://b.example.org/2">two</a>')
         ELSE '' END) AS html
FROM (SELECT page_id, url, html, CAST(page_id AS STRING) AS k,
             (7 * page_id + 1) % (SELECT count(*) FROM {pages}) AS left_id,
             (3 * page_id + 2) % (SELECT count(*) FROM {pages}) AS right_id
      FROM {pages}) AS p
JOIN (SELECT page_id, url FROM {pages}) AS a ON a.page_id = p.left_id
JOIN (SELECT page_id, regexp_replace(url, '#.*$', '') AS url FROM {pages}) AS b
  ON b.page_id = p.right_id
"""

FETCH_LOG = """
SELECT event_id AS id,
       concat('https://example.org/', event_type, '/', CAST(event_id AS STRING)) AS url,
       concat('https://example.org/', event_type, '/', CAST(event_id AS STRING)) AS final_url,
       CASE WHEN event_type = 'error' THEN 'error'
            WHEN event_type = 'signup' THEN 'http_error' ELSE 'ok' END AS status,
       CASE WHEN event_type = 'error' THEN 0 WHEN event_type = 'signup' THEN 404
            ELSE 200 END AS code,
       value AS ms,
       1000 + event_id % 500 AS bytes,
       CASE WHEN event_type IN ('error', 'signup') THEN ''
            ELSE concat('html/', CAST(event_id AS STRING), '.html') END AS html_path,
       CASE WHEN event_type = 'error' THEN concat('broken	pipe ', props) ELSE '' END AS error,
       concat('run-', CAST(user_id % 2 AS STRING)) AS run,
       CAST(ts AS TIMESTAMP) AS ts
FROM {events}
"""

OUTCOMES = """
SELECT concat('worker-', CAST(user_id % 8 AS STRING)) AS worker,
       CAST(ts AS TIMESTAMP) AS ts,
       event_id AS outcome_id,
       event_type = 'error' AS failed,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS latency_ms,
       event_id % 5 AS frontier
FROM {events}
"""

# Answers as a model would give them: bare JSON, fenced JSON, broken JSON, a JSON list.
RESPONSES = """
SELECT conv_id, turn,
       CASE turn % 4
         WHEN 0 THEN body
         WHEN 1 THEN concat('Here it is:', chr(10), '```json', chr(10), body, chr(10), '```', chr(10))
         WHEN 2 THEN concat(body, '}}, and so on')
         ELSE concat('[', body, ']')
       END AS response
FROM (
  SELECT conv_id, turn,
         concat('{{"title": "', role, ' ', CAST(conv_id AS STRING), '", "main_content": "',
                replace(replace(replace(replace(text, chr(92), ' '), '"', ' '), chr(10), ' '), chr(9), ' '),
                '", "links": [',
                CASE WHEN conv_id % 3 = 0 THEN '' ELSE
                  concat('{{"href": " /turn/', CAST(turn AS STRING), ' ", "text": "next"}}, 7, {{"text": "no address"}}')
                END,
                '], "author": ', CASE WHEN conv_id % 2 = 0 THEN 'null' ELSE '" A. Writer "' END,
                ', "vps_relevance": ', CAST(conv_id % 4 AS STRING), '.5, "recency_signal": "0.25"}}') AS body
  FROM {conversations}
) AS made
"""

TABLES = ("pages", "events", "conversations", "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run one of the SELECTs above on the given tables."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    if text is LINKED_PAGES:
        used["pages"] = spread(used["pages"], "page_id")
    return spark.sql(text, **used)


def as_sql(text: str) -> str:
    """The same SELECT with plain table names."""
    return text.format(**{t: t for t in TABLES})
