"""The registered queries stated a second time, in SQL for the checking database.

Written from the definitions, with unnested rows and window functions where the
library works on arrays, so that the two can disagree.
"""

from __future__ import annotations

from ..functions import html as H
from ..functions.text import WHITESPACE
from ..params import (
    ENTITY_TERMS,
    GEO_TERMS,
    NOISE_TERMS,
    RECONSTRUCTION_TERMS,
    STRUCTURED_TERMS,
    VPS_TERMS,
)
from . import fixtures as X

WS = r"[\t\n\x0b\f\r \x1c-\x1f\x{85}\p{Z}]"
LINK = f"(?is)<a{WS}+[^>]*href=[\"'']([^\"'']+)[\"''][^>]*>(.*?)</a>"
DESCRIPTION = f"(?i)<meta{WS}+name=[\"'']description[\"''][^>]*content=[\"'']([^\"'']+)[\"'']"
TITLE = "(?i)<title[^>]*>([^<]+)</title>"
WORD = r"[\p{L}\p{N}_]"
YEAR = rf"(^|[^\p{{L}}\p{{N}}_])(202[4-9]|203\p{{Nd}})($|[^\p{{L}}\p{{N}}_])"
PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
AT = "TIMESTAMP '2024-02-01 00:00:00'"
ORACLES: dict[str, str] = {}


def with_(*parts: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in parts) + "\n"


def strip(x: str) -> str:
    return f"trim({x}, '{WHITESPACE}')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def no_code(x: str) -> str:
    out = x
    for tag in ("script", "style"):
        out = f"regexp_replace({out}, '(?i)<{tag}[^>]*>[\\s\\S]*?</{tag}>', ' ', 'g')"
    return out


def text_of(x: str) -> str:
    return squeeze(f"regexp_replace({no_code(x)}, '<[^>]+>', ' ', 'g')")


def clamp(x: str) -> str:
    return f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, {x}))"


def count_terms(x: str, terms) -> str:
    return "(" + " + ".join(f"contains({x}, '{t}')::INT" for t in terms) + ")"


def any_term(x: str, terms) -> str:
    return "(" + " OR ".join(f"contains({x}, '{t}')" for t in terms) + ")"


def hits(x: str, terms) -> str:
    return f"({count_terms(x, terms)} / {max(1.0, len(terms) * 0.35)!r}::DOUBLE)"


def words(x: str) -> str:
    flat = squeeze(x)
    return (
        f"CASE WHEN {flat} = '' THEN 0 ELSE length({flat}) - length(replace({flat}, ' ', '')) + 1 END"
    )


def part(x: str, group: int) -> str:
    return f"regexp_extract({x}, '{PARTS}', {group})"


def no_params(path: str) -> str:
    return f"regexp_replace({path}, ';[^/]*$', '')"


def joined(scheme: str, netloc: str, path: str, query: str) -> str:
    return (
        f"CASE WHEN {scheme} IN ('http', 'https') THEN concat({scheme}, '://', lower({netloc}), "
        f"CASE WHEN {path} = '' OR {path}[1] <> '/' THEN '/' ELSE '' END, {path}, "
        f"CASE WHEN {query} = '' THEN '' ELSE concat('?', {query}) END) ELSE '' END"
    )


def canonical(x: str) -> str:
    return joined(f"lower({part(x, 1)})", part(x, 2), no_params(part(x, 3)), part(x, 4))


CANONICAL = f"SELECT page_id, {canonical(strip('url'))} AS canonical_url FROM pages"
LINKED = X.as_sql(X.LINKED_PAGES)
QUEUE = X.as_sql(X.QUEUE)
FOUND = X.as_sql(X.DISCOVERIES)
LOG = X.as_sql(X.FETCH_LOG)
OUT = X.as_sql(X.OUTCOMES)

# --- URLs and links ---------------------------------------------------------

ORACLES["canonical_urls"] = CANONICAL
ORACLES["canonical_dedup"] = (
    f"SELECT canonical_url, min(page_id) AS page_id FROM ({CANONICAL}) GROUP BY canonical_url"
)


def anchors(source: str) -> str:
    """page_id, url, i (1-based), href, text of every link element."""
    return f"""
    SELECT page_id, url, i, {strip('h')} AS href, left({squeeze("regexp_replace(t, '<[^>]+>', ' ', 'g')")}, 220) AS text
    FROM (SELECT page_id, url, generate_subscripts(hs, 1) AS i, unnest(hs) AS h, unnest(ts) AS t
          FROM (SELECT page_id, url, regexp_extract_all(html, '{LINK}', 1) AS hs,
                       regexp_extract_all(html, '{LINK}', 2) AS ts FROM {source}))"""


# The made links use every reference kind; dot segments occur as '../up/./k' only.
RESOLVED = f"""
SELECT page_id, url, i, text, {joined('scheme', 'netloc', 'path', 'query')} AS href
FROM (
  SELECT page_id, url, i, text,
    CASE WHEN rs <> '' THEN rs ELSE bs END AS scheme,
    CASE WHEN rs <> '' AND rs <> bs OR rn <> '' THEN rn ELSE bn END AS netloc,
    CASE WHEN rs <> '' AND rs <> bs OR rn <> '' THEN rp
         WHEN rp = '' AND par = '' THEN bp
         WHEN rp[1] = '/' THEN rp
         WHEN starts_with(rp, '../') THEN
           concat(regexp_replace(regexp_replace(bp, '[^/]*$', ''), '[^/]+/$', ''),
                  replace(substr(rp, 4), './', ''))
         ELSE concat(regexp_replace(bp, '[^/]*$', ''), rp) END AS path,
    CASE WHEN rs = '' AND rn = '' AND rp = '' AND par = '' AND rq = '' THEN bq ELSE rq END AS query
  FROM (
    SELECT page_id, url, i, text,
      lower({part('href', 1)}) AS rs, {part('href', 2)} AS rn,
      {no_params(part('href', 3))} AS rp, regexp_extract({part('href', 3)}, ';([^/]*)$', 1) AS par,
      {part('href', 4)} AS rq,
      lower({part('url', 1)}) AS bs, {part('url', 2)} AS bn,
      {no_params(part('url', 3))} AS bp, {part('url', 4)} AS bq
    FROM anchors))"""


def first_of_each(source: str, limit: int) -> str:
    return f"""
    SELECT * FROM (
      SELECT page_id, url, href, text, row_number() OVER (PARTITION BY page_id ORDER BY i) AS n
      FROM (SELECT *, row_number() OVER (PARTITION BY page_id, href ORDER BY i) AS copy
            FROM {source} WHERE href <> '')
      WHERE copy = 1)
    WHERE n <= {limit}"""


LINK_PARTS = (
    ("linked", LINKED),
    ("anchors", anchors("linked")),
    ("resolved", RESOLVED),
    ("links", first_of_each("resolved", 80)),
)
ORACLES["resolved_links"] = (
    with_(*LINK_PARTS) + "SELECT page_id, n - 1 AS pos, href, text FROM links"
)


def affinity(parent: str, child: str) -> str:
    def last_two(h: str) -> str:
        return f"regexp_extract({h}, '([^.]*\\.)?[^.]*$', 0)"

    return (
        f"CASE WHEN {parent} = '' OR {child} = '' THEN 0.0::DOUBLE WHEN {parent} = {child} THEN 1.0 "
        f"WHEN {last_two(parent)} = {last_two(child)} THEN 0.78 ELSE 0.45 END"
    )


HOSTS = f"lower({part('url', 2)}) AS ph, {part('href', 2)} AS ch"
ORACLES["host_pairs"] = with_(*LINK_PARTS) + f"""
SELECT affinity, count(*) AS links FROM (
  SELECT {affinity('ph', 'ch')} AS affinity FROM (SELECT {HOSTS} FROM links)) GROUP BY affinity"""

# --- page text and payload ----------------------------------------------------

ORACLES["page_text"] = f"""
SELECT page_id, length(text) AS chars, {words('text')} AS words, md5(text) AS text_md5
FROM (SELECT page_id, {text_of('html')} AS text FROM pages)"""
ORACLES["document_words"] = (
    f"SELECT doc_id, length(text) AS chars, {words('text')} AS words FROM documents"
)
_BLOCKS = f"regexp_replace({no_code('html')}, '(?s)<!--.*?-->', ' ', 'g')"
_BODY = _BLOCKS
for _name in ("nav", "header", "footer", "aside"):
    _BODY = f"regexp_replace({_BODY}, '(?is)<{_name}(?:\\s[^>]*)?>.*?</{_name}\\s*>', ' ', 'g')"
ORACLES["main_text"] = f"""
SELECT page_id, length(text) AS chars, {words('text')} AS words, md5(text) AS text_md5
FROM (SELECT page_id, {squeeze(f"regexp_replace({_BODY}, '<[^>]+>', ' ', 'g')")} AS text FROM pages)
WHERE text <> ''"""


def payload(source: str) -> str:
    """page_id, url, title, description, text, blob, hits (terms found, in order)."""
    found = ", ".join(f"CASE WHEN contains(blob, '{t}') THEN '{t}' END" for t in ENTITY_TERMS)
    return f"""
    SELECT *, list_filter([{found}], lambda x: x IS NOT NULL) AS hits
    FROM (
      SELECT *, lower(concat(url, chr(10), coalesce(title, ''), chr(10), coalesce(description, ''),
                             chr(10), left(text, 4000))) AS blob
      FROM (
        SELECT page_id, url, html,
               nullif(left({strip(f"regexp_extract(html, '{TITLE}', 1)")}, 500), '') AS title,
               nullif(left({strip(f"regexp_extract(html, '{DESCRIPTION}', 1)")}, 500), '') AS description,
               {text_of('html')} AS text
        FROM {source}))"""


def relevance(terms) -> str:
    listed = ", ".join(f"'{t}'" for t in terms)
    return f"least(1.0::DOUBLE, 0.08::DOUBLE * len(list_filter(hits, lambda x: x IN ({listed}))))"


def payload_row(source: str) -> str:
    return with_(("src", source), ("made", payload("src")), ("anchors", anchors("src"))) + f"""
    SELECT page_id, title, description, md5(left(text, 10000)) AS content_md5,
           least(50, (SELECT count(*) FROM anchors a WHERE a.page_id = made.page_id AND a.href <> '')) AS links,
           array_to_string(hits[1:15], ',') AS geo_entities,
           round({relevance(VPS_TERMS)}, 6) AS vps_relevance,
           round({relevance(RECONSTRUCTION_TERMS)}, 6) AS reconstruction_relevance,
           CASE WHEN regexp_matches(blob, '{YEAR}') THEN 0.8::DOUBLE ELSE 0.3::DOUBLE END AS recency_signal,
           CASE WHEN text <> '' THEN 0.67::DOUBLE ELSE 0.45::DOUBLE END AS confidence
    FROM made"""


ORACLES["page_payload"] = payload_row("SELECT * FROM pages")
ORACLES["linked_payload"] = payload_row(LINKED)


# Every non-word character is doubled, so that a boundary consumed by one place name is
# still there for the next.
_PLACE = rf"(?:^|[^\p{{L}}\p{{N}}_])([A-Z][a-z]+(?:{WS}+[A-Z][a-z]+){{0,2}})(?:$|[^\p{{L}}\p{{N}}_])"
ORACLES["location_hints"] = f"""
SELECT page_id, to_json(list_transform(
         regexp_extract_all(regexp_replace(left(left(text, 10000), 2500), '([^\\p{{L}}\\p{{N}}_])', '\\1\\1', 'g'),
                            '{_PLACE}', 1)[1:10],
         lambda x: replace(x, '  ', ' ')))::VARCHAR AS location_hints
FROM (SELECT page_id, {text_of('html')} AS text FROM pages)"""


def _attribute(name: str) -> str:
    pattern = (
        f"(?i)(?:^|[^\\p{{L}}\\p{{N}}_]){name}{WS}*={WS}*[\"'']([^\"'']*)[\"'']"
    )
    return (
        f"CASE WHEN regexp_matches(rest, '{pattern}') THEN concat(' {name}=\"', "
        f"left(regexp_extract(rest, '{pattern}', 1), 80), '\"') ELSE '' END"
    )


_OPEN = f"<({WORD}+)([^>]*)>"
_BARE = "html"
for _tag in ("script", "style"):
    _BARE = f"regexp_replace({_BARE}, '(?i)<{_tag}[^>]*>[\\s\\S]*?</{_tag}>', '', 'g')"
_SUMMARY = f"""
SELECT page_id, url, CASE WHEN length(s) > 50000 THEN concat(left(s, 50000), chr(10), '... [truncated]') ELSE s END AS s
FROM (
  SELECT page_id, any_value(url) AS url, string_agg(concat(gap, tag), '' ORDER BY i) AS s
  FROM (
    SELECT page_id, url, i, gap,
           CASE WHEN name IS NULL THEN '' ELSE concat('<', lower(name),
             {", ".join(_attribute(n) for n in H.SUMMARY_ATTRIBUTES)}, '>') END AS tag
    FROM (
      SELECT page_id, url, unnest(gaps) AS gap, unnest(names) AS name, unnest(rests) AS rest,
             generate_subscripts(gaps, 1) AS i
      FROM (
        SELECT page_id, url, regexp_split_to_array(bare, '{_OPEN}') AS gaps,
               regexp_extract_all(bare, '{_OPEN}', 1) AS names,
               regexp_extract_all(bare, '{_OPEN}', 2) AS rests
        FROM (SELECT page_id, url, {_BARE} AS bare FROM pages))))
  GROUP BY page_id)"""
ORACLES["dom_summary"] = with_(("made", _SUMMARY)) + (
    "SELECT page_id, length(s) AS chars, md5(s) AS md5 FROM made"
)
ORACLES["model_request_table"] = with_(("made", _SUMMARY)) + """
SELECT page_id, length(r) AS chars, md5(r) AS md5
FROM (SELECT page_id, concat('Address: ', url, chr(10), 'Simplified page, between the two lines:', chr(10),
             '-----', chr(10), s, chr(10), '-----', chr(10)) AS r FROM made)"""


def raw(source: str) -> str:
    return f"""
    SELECT page_id, url, n, {strip('left(href, 2048)')} AS href, text
    FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY i) AS n
          FROM {source} WHERE href <> '')
    WHERE n <= 50"""


ORACLES["raw_links"] = (
    with_(("src", LINKED), ("anchors", anchors("src")), ("raw", raw("anchors")))
    + "SELECT page_id, n - 1 AS pos, href, text FROM raw"
)
ORACLES["link_counts"] = with_(("anchors", anchors("pages"))) + """
SELECT page_id, least(50, coalesce(n, 0)) AS links FROM pages
LEFT JOIN (SELECT page_id, count(*) AS n FROM anchors WHERE href <> '' GROUP BY page_id) USING (page_id)"""

_BODY_JSON = "json_valid(body)"
ORACLES["model_payloads"] = with_(("answers", X.as_sql(X.RESPONSES))) + """
SELECT conv_id, turn,
       CASE WHEN turn % 4 = 3 THEN 'failed' ELSE 'ok' END AS outcome,
       turn % 4 = 2 AS parse_error,
       CASE WHEN turn % 4 = 3 THEN NULL WHEN turn % 4 <> 2 AND conv_id % 3 <> 0
            AND main <> '' THEN 0.95::DOUBLE ELSE 0.62::DOUBLE END AS confidence,
       CASE WHEN turn % 4 = 3 THEN 'dom analysis failed: ''list'' object has no attribute ''get''' END AS error,
       CASE WHEN good THEN concat(role, ' ', conv_id) END AS title,
       CASE WHEN good THEN length(left(main, 12000)) WHEN turn % 4 = 2 THEN 0 END AS content_chars,
       CASE WHEN good AND conv_id % 3 <> 0 THEN concat('/turn/', turn) WHEN turn % 4 <> 3 THEN '' END AS hrefs,
       CASE WHEN good AND conv_id % 2 <> 0 THEN 'A. Writer' END AS author,
       CASE WHEN good THEN least(1.0, (conv_id % 4) + 0.5)::DOUBLE WHEN turn % 4 = 2 THEN 0.0::DOUBLE END AS vps_relevance,
       CASE WHEN good THEN 0.25::DOUBLE WHEN turn % 4 = 2 THEN 0.0::DOUBLE END AS recency_signal
FROM (SELECT conv_id, turn, role, turn % 4 IN (0, 1) AS good,
             replace(replace(replace(replace(text, chr(92), ' '), '"', ' '), chr(10), ' '), chr(9), ' ') AS main
      FROM conversations)"""

# --- signals and scores ---------------------------------------------------------


def signals(source: str) -> tuple[tuple[str, str], ...]:
    blob = (
        "concat(url, chr(10), coalesce(title, ''), chr(10), coalesce(description, ''), chr(10), "
        "left(text, 5000))"
    )
    content = "lower(left(text, 10000))"
    return (
        ("src", source),
        ("made", payload("src")),
        ("anchors", anchors("src")),
        ("raw", raw("anchors")),
        (
            "strong",
            "SELECT page_id, count(*) AS links, count(*) FILTER "
            f"({any_term('lower(concat(href, chr(32), text))', GEO_TERMS)}) AS strong FROM raw GROUP BY page_id",
        ),
        (
            "signals",
            f"""
            SELECT made.page_id, url, title, text,
                   {clamp(f"{hits(f'lower({blob})', GEO_TERMS)} * 3.4::DOUBLE")} AS geo_term_density,
                   CASE WHEN regexp_matches({blob}, '{YEAR}') THEN 0.8::DOUBLE ELSE 0.0::DOUBLE END AS freshness_signal,
                   CASE WHEN contains({content}, 'application/ld+json') THEN 0.7::DOUBLE
                        WHEN {any_term(content, STRUCTURED_TERMS)} THEN 0.6::DOUBLE
                        ELSE 0.0::DOUBLE END AS structured_data_signal,
                   {clamp("coalesce(strong, 0)::DOUBLE / greatest(1, least(coalesce(links, 0), 15))")} AS link_quality_signal
            FROM made LEFT JOIN strong USING (page_id)""",
        ),
        (
            "scored",
            f"""SELECT *, {clamp("geo_term_density * 0.42::DOUBLE + freshness_signal * 0.18::DOUBLE + structured_data_signal * 0.22::DOUBLE + link_quality_signal * 0.18::DOUBLE")} AS page_score
            FROM signals""",
        ),
    )


SIGNAL_ROW = """
SELECT page_id, round(geo_term_density, 6) AS geo_term_density, freshness_signal,
       structured_data_signal, round(link_quality_signal, 6) AS link_quality_signal,
       round(page_score, 6) AS page_score FROM scored"""
PLAIN_SIGNALS = signals("SELECT * FROM pages")
LINKED_SIGNALS = signals(LINKED)
ORACLES["geo_signals"] = with_(*PLAIN_SIGNALS) + SIGNAL_ROW
ORACLES["stream_pages"] = ORACLES["geo_signals"]
ORACLES["linked_signals"] = with_(*LINKED_SIGNALS) + SIGNAL_ROW
ORACLES["top_pages"] = with_(*PLAIN_SIGNALS) + """
SELECT page_id, url, round(page_score, 6) AS page_score, title FROM scored
ORDER BY round(page_score, 6) DESC, page_id LIMIT 20"""


def link_score(source: str) -> str:
    """All columns of the source plus link_score and reason."""
    blob = "lower(concat(href, ' ', text))"
    path = part("href", 3)
    slashes = f"(length({path}) - length(replace({path}, '/', '')))"
    return f"""
    SELECT *, {clamp("geo * 0.62::DOUBLE + host * 0.28::DOUBLE + (1.0::DOUBLE - noise) * 0.10::DOUBLE - penalty")} AS link_score,
           CASE WHEN geo > 0.7 THEN 'geo-dense' WHEN host > 0.9 THEN 'host-affinity'
                WHEN noise > 0.3 THEN 'likely-noise' ELSE 'explore' END AS reason
    FROM (
      SELECT *, {clamp(f"{hits(blob, GEO_TERMS)} * 3.7::DOUBLE")} AS geo,
             {clamp(f"{hits(blob, NOISE_TERMS)} * 2.6::DOUBLE")} AS noise,
             {affinity('ph', 'ch')} AS host,
             CASE WHEN {slashes} > 5 THEN least(0.28::DOUBLE, ({slashes} - 5) * 0.05::DOUBLE) ELSE 0.0::DOUBLE END AS penalty
      FROM (SELECT *, {HOSTS} FROM {source}))"""


ORACLES["link_scores"] = with_(*LINK_PARTS, ("judged", link_score("links"))) + """
SELECT page_id, href, round(link_score, 6) AS link_score, reason FROM judged"""

# Own links first (canonical, unresolved), HTML links after them when fewer than 8.
FRONTIER_PARTS = (
    *LINKED_SIGNALS,
    (
        "own",
        f"SELECT * FROM (SELECT page_id, url, n AS i, text, {canonical('href')} AS href FROM raw) WHERE href <> ''",
    ),
    ("resolved", RESOLVED),
    ("from_html", first_of_each("resolved", 16)),
    (
        "pool",
        """SELECT page_id, url, i, href, text FROM own UNION ALL
           SELECT page_id, url, 1000 + n AS i, href, text FROM from_html
           WHERE (SELECT count(*) FROM own WHERE own.page_id = from_html.page_id) < 8""",
    ),
    ("unique_links", first_of_each("pool", 1_000_000)),
    ("judged", link_score("unique_links")),
    (
        "blended",
        f"""SELECT page_id, href, n, reason,
            {clamp("link_score * 0.72::DOUBLE + page_score * 0.28::DOUBLE")} AS geo_score
            FROM judged JOIN (SELECT page_id, page_score FROM scored) USING (page_id)""",
    ),
    (
        "ranked",
        "SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY geo_score DESC, n) AS place FROM blended",
    ),
)


def candidates(depth: str) -> str:
    return f"""SELECT page_id, href AS child, place - 1 AS ord, geo_score, reason, {depth} AS depth,
    ceil(geo_score * 100.0::DOUBLE)::BIGINT + greatest(0, 20 - 6 * ({depth})) AS priority
    FROM ranked WHERE place <= 16 AND {depth} < 2"""


FRONTIER = (*FRONTIER_PARTS, ("candidates", candidates("page_id % 3")))
ORACLES["frontier_topn"] = with_(*FRONTIER) + """
SELECT page_id, child, ord, round(geo_score, 6) AS geo_score, reason, priority, depth FROM candidates"""
ORACLES["reason_counts"] = with_(*FRONTIER) + """
SELECT reason, count(*) AS candidates, max(priority) AS top_priority
FROM candidates WHERE geo_score >= 0.28::DOUBLE GROUP BY reason"""

# --- queue --------------------------------------------------------------------------

Q_ROW = """id, url, status, priority::BIGINT AS priority, round(geo_score::DOUBLE, 6) AS geo_score,
 source, depth::BIGINT AS depth, parent_url_id, retries::BIGINT AS retries, claimed_by, error,
 strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at,
 strftime(processed_at, '%Y-%m-%d %H:%M:%S') AS processed_at"""
RANK = "priority + round_even(geo_score::DOUBLE * 100, 0)::INT"
CLAIMABLE = "status = 'pending' AND retries < max_retries"


def claims(n: int) -> str:
    return f"""SELECT id, row_number() OVER (ORDER BY {RANK} DESC, retries, id) AS claim_rank
    FROM queue WHERE {CLAIMABLE} ORDER BY claim_rank LIMIT {n}"""


def on_queue(body: str, *more: tuple[str, str]) -> str:
    return with_(("queue", QUEUE), *more) + body


def changed(source: str, **columns: str) -> str:
    """All queue columns from the source, some replaced."""
    replaced = ", ".join(f"{text} AS {name}" for name, text in columns.items())
    return f"SELECT {Q_ROW} FROM (SELECT * REPLACE ({replaced}) FROM {source})"


ORACLES["queue_rank"] = on_queue(f"SELECT id, ({RANK})::BIGINT AS rank_score FROM queue")
ORACLES["queue_depth"] = on_queue(
    "SELECT count(*) AS queue_depth FROM queue WHERE status IN ('pending', 'in_progress')"
)
ORACLES["claim_workers"] = on_queue(
    "SELECT id, claim_rank, (claim_rank - 1) // 10 AS worker FROM claims", ("claims", claims(40))
)
ORACLES["claim_batch"] = on_queue(
    changed(
        "(SELECT queue.*, claim_rank IS NOT NULL AS hit FROM queue LEFT JOIN claims USING (id))",
        status="CASE WHEN hit THEN 'in_progress' ELSE status END",
        claimed_by="CASE WHEN hit THEN 'worker-0' ELSE claimed_by END",
        updated_at=f"CASE WHEN hit THEN {AT} ELSE updated_at END",
    ),
    ("claims", claims(10)),
)
SEEDS = f"""SELECT pos, {strip('url')} AS url FROM (
  SELECT page_id * 2 AS pos, url FROM pages
  UNION ALL SELECT page_id * 2 + 1 AS pos, concat('  ', url, chr(9)) AS url FROM pages
  UNION ALL SELECT -1 - page_id AS pos, concat(' ', chr(9)) AS url FROM pages)
  WHERE {strip('url')} <> ''"""
SEED_FIRST = """SELECT url, min(pos) AS pos FROM seeds WHERE url NOT IN (SELECT url FROM queue) GROUP BY url"""
ORACLES["seed_report"] = on_queue(
    "SELECT seeds.pos, seeds.url, firsts.pos IS NOT NULL AS inserted FROM seeds "
    "LEFT JOIN firsts ON seeds.url = firsts.url AND seeds.pos = firsts.pos",
    ("seeds", SEEDS),
    ("firsts", SEED_FIRST),
)
ORACLES["seed_enqueue"] = on_queue(
    f"""SELECT {Q_ROW} FROM queue UNION ALL
    SELECT 1000000000 + pos, url, 'pending', 0, 0.0, 'seed', 0, NULL, 0, NULL, NULL,
           '2024-02-01 00:00:00', NULL FROM firsts""",
    ("seeds", SEEDS),
    ("firsts", SEED_FIRST),
)
ORACLES["mark_done"] = on_queue(
    changed(
        "(SELECT *, status = 'pending' AND geo_score >= 0.25 AS hit FROM queue)",
        status="CASE WHEN hit THEN 'done' ELSE status END",
        processed_at=f"CASE WHEN hit THEN {AT} ELSE processed_at END",
        updated_at=f"CASE WHEN hit THEN {AT} ELSE updated_at END",
    )
)
ORACLES["mark_failed"] = on_queue(
    changed(
        "(SELECT *, status = 'pending' AND geo_score < 0.25 AS hit FROM queue)",
        status="CASE WHEN hit AND retries + 1 >= max_retries THEN 'failed' WHEN hit THEN 'pending' ELSE status END",
        retries="CASE WHEN hit THEN retries + 1 ELSE retries END",
        error="CASE WHEN hit THEN left(concat('no answer from ', url), 4096) ELSE error END",
        updated_at=f"CASE WHEN hit THEN {AT} ELSE updated_at END",
    )
)
FOLDED = """
SELECT url, max(priority) AS fp, max(geo_score) AS fg, min(depth) AS fd,
       first(parent_url_id ORDER BY ord) FILTER (parent_url_id IS NOT NULL) AS fparent,
       bool_or(source = 'seed') AS fseed, last(source ORDER BY ord) AS fsource, min(ord) AS ford
FROM found GROUP BY url"""
ORACLES["upsert_discovered"] = on_queue(
    """
SELECT coalesce(q.id, 1000000000 + f.ford) AS id, coalesce(q.url, f.url) AS url,
  CASE WHEN q.id IS NULL OR f.url IS NOT NULL AND q.status IN ('done', 'failed') THEN 'pending' ELSE q.status END AS status,
  greatest(q.priority, f.fp)::BIGINT AS priority,
  round(greatest(q.geo_score, f.fg)::DOUBLE, 6) AS geo_score,
  CASE WHEN f.url IS NULL THEN q.source WHEN q.source = 'seed' OR f.fseed THEN 'seed' ELSE f.fsource END AS source,
  least(q.depth, f.fd)::BIGINT AS depth,
  coalesce(q.parent_url_id, f.fparent) AS parent_url_id,
  CASE WHEN q.id IS NULL OR f.url IS NOT NULL AND q.status IN ('done', 'failed') THEN 0 ELSE q.retries END::BIGINT AS retries,
  NULL::VARCHAR AS claimed_by, NULL::VARCHAR AS error,
  CASE WHEN f.url IS NULL THEN '2024-01-01 00:00:00' ELSE '2024-02-01 00:00:00' END AS updated_at,
  NULL::VARCHAR AS processed_at
FROM queue q FULL JOIN folded f ON q.url = f.url""",
    ("found", FOUND),
    ("folded", FOLDED),
)
ORACLES["discovery_report"] = on_queue(
    """SELECT ord, url, url NOT IN (SELECT url FROM queue)
       AND ord = min(ord) OVER (PARTITION BY url) AS inserted FROM found""",
    ("found", FOUND),
)
ORACLES["delete_cascade"] = on_queue(
    changed(
        "(SELECT * FROM queue WHERE status <> 'failed')",
        parent_url_id="CASE WHEN parent_url_id IN (SELECT id FROM queue WHERE status = 'failed') THEN NULL ELSE parent_url_id END",
    )
)
ORACLES["delete_pages"] = (
    "SELECT page_id AS url_id, url FROM pages WHERE page_id % 4 <> 3"
)
ORACLES["queue_violations"] = on_queue(
    """
SELECT 'status' AS rule, id::VARCHAR AS key, 1::BIGINT AS n FROM bad
UNION ALL SELECT 'geo_score', id::VARCHAR, 1 FROM bad
UNION ALL SELECT 'depth', id::VARCHAR, 1 FROM bad WHERE depth - 3 < 0
UNION ALL SELECT 'url_unique', url, 2 FROM bad
UNION ALL SELECT 'id_unique', id::VARCHAR, 2 FROM bad
UNION ALL SELECT 'parent', (-id)::VARCHAR, 1 FROM bad WHERE id <> 0
UNION ALL SELECT 'page_url', (page_id + 5)::VARCHAR, 1 FROM pages WHERE page_id + 5 NOT IN (SELECT id FROM queue)""",
    ("bad", "SELECT * FROM queue WHERE status = 'failed'"),
)
ORACLES["lineage"] = on_queue("""
SELECT c.id, c.url, c.parent_url_id, p.url AS parent_url, p.status AS parent_status
FROM queue c LEFT JOIN queue p ON p.id = c.parent_url_id""")
ORACLES["lineage_roots"] = f"""
WITH RECURSIVE parents AS (
  SELECT id, CASE WHEN id % 35 = 0 THEN id + 2 WHEN id % 35 = 10 THEN -1 ELSE parent_url_id END AS parent FROM ({QUEUE})
),
reached AS (
  SELECT id, id AS root_id, 0::BIGINT AS hops FROM parents WHERE parent IS NULL OR parent NOT IN (SELECT id FROM parents)
  UNION ALL
  SELECT p.id, r.root_id, r.hops + 1 FROM reached r JOIN parents p ON p.parent = r.id
)
SELECT p.id, r.root_id, r.hops, r.id IS NULL AS cyclic FROM parents p LEFT JOIN reached r ON r.id = p.id"""
ORACLES["store_extractions"] = """
SELECT page_id AS url_id, page_id, CASE WHEN page_id % 3 = 0 THEN 'v2' ELSE 'v1' END AS schema_name,
       CASE WHEN page_id % 3 = 0 THEN '2024-02-02 00:00:00' ELSE '2024-02-01 00:00:00' END AS extracted_at
FROM pages"""
ORACLES["url_table"] = "SELECT row_number() OVER (ORDER BY page_id) AS pos, url FROM pages"
ORACLES["extracted_table"] = f"""
SELECT p.page_id AS id, url, chars, words, text_md5
FROM ({ORACLES['main_text']}) t JOIN pages p ON p.page_id = t.page_id"""
ORACLES["store_latest"] = """
SELECT page_id AS url_id, url, 2::BIGINT AS seq, 20 + page_id % 13 AS fetched, length(html) AS chars FROM pages"""
ORACLES["stored_pages"] = """
SELECT page_id AS url_id, url, CASE WHEN page_id % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS seq,
       CASE WHEN page_id % 3 = 0 THEN 20 ELSE 10 END::BIGINT AS fetched, length(html) AS chars FROM pages"""
ORACLES["corpus_view"] = with_(("queue", QUEUE), *PLAIN_SIGNALS) + """
SELECT q.id AS url_id, s.page_id, s.url, q.status, q.source,
       CASE WHEN s.text <> '' THEN 0.67::DOUBLE ELSE 0.45::DOUBLE END AS confidence,
       round(s.page_score, 6) AS page_score
FROM queue q JOIN scored s ON s.page_id = q.id"""
ORACLES["snapshot_roundtrip"] = on_queue(f"SELECT {Q_ROW} FROM queue WHERE {CLAIMABLE}")
ORACLES["fetch_lookup"] = with_(
    ("found", FOUND),
    ("known", ORACLES["canonical_dedup"]),
) + f"""
SELECT ord, url, page_id FROM (SELECT ord, url, {canonical('url')} AS c FROM found)
LEFT JOIN known ON known.canonical_url = c"""

# --- processing -------------------------------------------------------------------

ORACLES["process_outcomes"] = """
SELECT page_id AS id, CASE
  WHEN page_id % 4 = 3 THEN 'fetch failed or timeout'
  WHEN page_id % 16 = 8 THEN 'connection reset'
  WHEN page_id % 16 = 4 THEN 'insert raw_page failed: text holds a character 0'
  WHEN page_id % 16 = 1 THEN 'dom analysis failed: ''list'' object has no attribute ''get'''
  WHEN page_id % 16 = 5 THEN 'insert extraction failed: payload holds a character 0' END AS failure
FROM pages"""
ORACLES["process_stored"] = f"""
SELECT page_id AS url_id, regexp_replace(url, '#.*$', '') AS url, length(html) AS chars, 200 AS status_code,
       'text/html' AS content_type
FROM ({LINKED}) WHERE page_id % 4 <> 3 AND page_id % 16 NOT IN (4, 8)"""
# The batch runs under the queued URL, which has no fragment.
_QUEUED = f"SELECT page_id, regexp_replace(url, '#.*$', '') AS url, html FROM ({LINKED}) WHERE page_id % 4 <> 3"
_QUEUED_SIGNALS = signals(_QUEUED)
ORACLES["process_extractions"] = with_(*_QUEUED_SIGNALS) + """
SELECT page_id AS url_id, 'spatial-default-v2' AS schema_name,
       CASE WHEN text <> '' THEN 0.67::DOUBLE ELSE 0.45::DOUBLE END AS confidence,
       round(page_score::FLOAT::DOUBLE, 5) AS geo_score, title FROM scored"""
ORACLES["process_answers"] = with_(*_QUEUED_SIGNALS) + """
SELECT page_id AS url_id,
       CASE WHEN page_id % 16 = 9 THEN 0.95::DOUBLE WHEN page_id % 16 = 13 THEN 0.62::DOUBLE
            WHEN text <> '' THEN 0.67::DOUBLE ELSE 0.45::DOUBLE END AS confidence,
       CASE WHEN page_id % 16 IN (9, 13) THEN concat('Answer ', page_id) ELSE title END AS title
FROM scored WHERE page_id % 16 NOT IN (1, 4, 5, 8)"""
ORACLES["saved_pages"] = """
SELECT page_id AS id, length(html) + 1 AS chars, md5(concat(html, chr(10))) AS html_md5
FROM pages WHERE page_id % 7 <> 0"""
ORACLES["process_discoveries"] = with_(
    *_QUEUED_SIGNALS,
    *FRONTIER_PARTS[len(LINKED_SIGNALS):],
    ("candidates", candidates("page_id % 3")),
) + """
SELECT child AS url, priority, round(geo_score::FLOAT::DOUBLE, 5) AS geo_score,
       concat('frontier:', reason) AS source, depth + 1 AS depth, page_id AS parent_url_id
FROM candidates WHERE geo_score >= 0.28::DOUBLE"""

# --- replay -----------------------------------------------------------------------
# Rounds of claim, lookup, settle and merge, written out one after the other.

STRIDE, FIRST_ID = 32, 1 << 40
_WHOLE = f"SELECT page_id, regexp_replace(url, '#.*$', '') AS url, html FROM ({LINKED})"


def replay_round(n: int, batch: str) -> tuple[tuple[str, str], ...]:
    start = FIRST_ID * (n + 1)
    q, ended = f"queue_{n}", "(q.status IN ('done', 'failed') AND (q.settled IS NULL OR f.last_ord > q.settled))"
    opened = f"(f.url IS NOT NULL AND {ended})"
    return (
        (
            f"due_{n}",
            f"""SELECT d.*, l.page_id FROM (
                  SELECT id, url, depth, row_number() OVER (ORDER BY {RANK} DESC, retries, id) AS place
                  FROM {q} WHERE {CLAIMABLE} ORDER BY place LIMIT {batch}) d
                LEFT JOIN lookup l ON l.url = d.url""",
        ),
        (
            f"settled_{n}",
            f"""SELECT q.* REPLACE (
                  CASE WHEN d.id IS NULL THEN q.status WHEN d.page_id IS NOT NULL THEN 'done'
                       WHEN q.retries + 1 >= q.max_retries THEN 'failed' ELSE 'pending' END AS status,
                  q.retries + (d.id IS NOT NULL AND d.page_id IS NULL)::INT AS retries),
                  (d.place + 1) * {STRIDE} - 1 AS settled
                FROM {q} q LEFT JOIN due_{n} d ON d.id = q.id""",
        ),
        (
            f"folded_{n}",
            f"""SELECT child AS url, max(ceil(geo_score * 100.0::DOUBLE)::BIGINT + greatest(0, 20 - 6 * depth)) AS fp,
                  max(geo_score::FLOAT) AS fg, min(depth + 1) AS fd, first(id ORDER BY arrival) AS fparent,
                  last(concat('frontier:', reason) ORDER BY arrival) AS fsource,
                  min(arrival) AS ford, max(arrival) AS last_ord
                FROM (SELECT e.*, d.id, d.depth, d.place * {STRIDE} + e.ord AS arrival
                      FROM due_{n} d JOIN edges e ON e.page_id = d.page_id WHERE d.depth < 2)
                GROUP BY child""",
        ),
        (
            f"queue_{n + 1}",
            f"""SELECT coalesce(q.id, {start} + f.ford) AS id, coalesce(q.url, f.url) AS url,
                  CASE WHEN q.id IS NULL OR {opened} THEN 'pending' ELSE q.status END AS status,
                  greatest(q.priority, f.fp) AS priority, greatest(q.geo_score, f.fg) AS geo_score,
                  CASE WHEN f.url IS NULL OR q.source = 'seed' THEN q.source ELSE f.fsource END AS source,
                  least(q.depth, f.fd) AS depth, coalesce(q.parent_url_id, f.fparent) AS parent_url_id,
                  CASE WHEN q.id IS NULL OR {opened} THEN 0 ELSE q.retries END AS retries,
                  coalesce(q.max_retries, 3) AS max_retries
                FROM settled_{n} q FULL JOIN folded_{n} f ON q.url = f.url""",
        ),
    )


def replayed(rounds: int, batch: str) -> str:
    parts = (
        *signals(_WHOLE),
        *FRONTIER_PARTS[len(LINKED_SIGNALS):],
        ("candidates", candidates("0")),
        ("edges", "SELECT page_id, child, ord, geo_score, reason FROM candidates WHERE geo_score >= 0.28::DOUBLE"),
        ("lookup", f"SELECT {canonical(strip('url'))} AS url, min(page_id) AS page_id FROM ({LINKED}) GROUP BY 1"),
        (
            "queue_0",
            f"""SELECT id, url, status, priority, geo_score, source, depth, parent_url_id, retries, max_retries
                FROM ({QUEUE})""",
        ),
        *(part for n in range(rounds) for part in replay_round(n, batch)),
    )
    return with_(*parts) + f"""
SELECT url, status, priority::BIGINT AS priority, round(geo_score::DOUBLE, 6) AS geo_score, source,
       depth::BIGINT AS depth, retries::BIGINT AS retries FROM queue_{rounds}"""


ORACLES["replay_rounds"] = replayed(3, "(SELECT greatest(1, count(*) // 4) FROM pages)")

# --- fetch runs ---------------------------------------------------------------------


def floor_p95(source: str, keys: str, value: str) -> str:
    return f"""SELECT {keys}, count(*) AS n,
      list_sort(list({value}))[1 + floor(0.95::DOUBLE * (count(*) - 1))::BIGINT] AS p95
      FROM {source} WHERE {value} IS NOT NULL GROUP BY {keys}"""


def on_log(body: str, *more: tuple[str, str]) -> str:
    return with_(("log", LOG), *more) + body


EXTRACTED = "SELECT concat('run-', doc_id % 2) AS run, length(text) AS chars FROM documents WHERE length(text) > 0"
TOTALS = """SELECT run, count(*) FILTER (status = 'ok') AS fetched, count(*) AS total_urls,
  avg(ms) AS avg_ms, sum(bytes)::BIGINT AS total_bytes,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000.0::DOUBLE AS wall_ms FROM log GROUP BY run"""
CHARS = "SELECT run, count(*) AS extracted_docs, sum(chars)::BIGINT AS total_chars FROM extracted GROUP BY run"
RUN_PARTS = (
    ("totals", TOTALS),
    ("p", floor_p95("log", "run", "ms")),
    ("extracted", EXTRACTED),
    ("chars_by_run", CHARS),
)
ORACLES["p95_by_run"] = on_log(floor_p95("log", "run, status", "ms"))
ORACLES["p95_merged"] = on_log(
    "SELECT run, status, count(*) AS n, true AS within FROM log WHERE ms IS NOT NULL GROUP BY run, status"
)
ORACLES["run_summary"] = on_log(
    """SELECT run, fetched, total_urls, round(avg_ms, 6) AS avg_ms, p95 AS p95_ms, total_bytes,
    extracted_docs, total_chars FROM totals JOIN p USING (run) JOIN chars_by_run USING (run)""",
    *RUN_PARTS,
)
_PPS = "(total_urls * 1000.0::DOUBLE / wall_ms)"
ORACLES["rates"] = on_log(
    f"""SELECT run, round(wall_ms, 6) AS wall_ms, round({_PPS}, 6) AS pages_per_sec,
    round({_PPS} * 60, 6) AS pages_per_min, round({_PPS} * 86400, 6) AS pages_per_day,
    round(total_bytes / (fetched / {_PPS}) / 1048576.0::DOUBLE, 9) AS mb_per_sec FROM totals""",
    ("totals", TOTALS),
)
ORACLES["run_equal"] = with_(("extracted", EXTRACTED), ("c", CHARS)) + (
    "SELECT count(*) AS runs, min(total_chars) = max(total_chars) AS equal_totals FROM c"
)
ORACLES["extraction_stats"] = """
SELECT lang, count(*) AS extracted_docs, round(avg(length(text)), 6) AS avg_chars,
       sum(length(text))::BIGINT AS total_chars FROM documents GROUP BY lang"""
ORACLES["parse_lines"] = on_log("""
SELECT k, CASE WHEN good THEN CASE WHEN k % 2 = 0 THEN 'cpp' ELSE 'rust' END END AS name,
       CASE WHEN good THEN ok END AS fetched, CASE WHEN good THEN n END AS total,
       CASE WHEN good THEN k + 0.5::DOUBLE END AS avg_ms,
       CASE WHEN good THEN 265.4::DOUBLE END AS p95_ms,
       CASE WHEN good THEN 6.25::DOUBLE END AS pages_per_sec,
       CASE WHEN good THEN b END AS total_bytes, NOT good AS rejected
FROM (SELECT id % 50 AS k, count(*) FILTER (status = 'ok') AS ok, count(*) AS n,
             sum(bytes)::BIGINT AS b, id % 50 % 10 <> 3 AS good FROM log GROUP BY id % 50)""")
ORACLES["fetch_log_roundtrip"] = on_log("""
SELECT run, id, url, status, code::BIGINT AS code, round(ms, 2) AS ms, bytes, html_path,
       replace(error, chr(9), ' ') AS error FROM log""")
ORACLES["summary_table"] = on_log(
    f"""SELECT run AS name, fetched, total_urls AS total, round(avg_ms, 6) AS avg_ms, p95 AS p95_ms,
    round({_PPS}, 6) AS pages_per_sec, round({_PPS} * 60, 6) AS pages_per_min, round({_PPS} * 86400, 6) AS pages_per_day,
    round(total_bytes / (fetched / {_PPS}) / 1048576.0::DOUBLE, 9) AS mb_per_sec, total_bytes, extracted_docs, total_chars
    FROM totals JOIN p USING (run) JOIN chars_by_run USING (run)""",
    *RUN_PARTS,
)
ORACLES["fetch_status"] = on_log(
    "SELECT status AS made, status, count(*) AS n FROM log GROUP BY status"
)
ORACLES["html_guess"] = """
SELECT page_id, page_id % 3 = 0 OR contains(html, '<html') OR contains(html, '<!DOCTYPE html') AS whole_body,
       page_id % 3 = 0
       OR contains(left(html, greatest(0, 256 - 2 * (page_id % 200))::INT), '<html')
       OR contains(left(html, greatest(0, 256 - 2 * (page_id % 200))::INT), '<!DOCTYPE html') AS first_bytes,
       CASE page_id % 3 WHEN 0 THEN 'text/html' WHEN 1 THEN 'image/png' END AS media_type
FROM pages"""

# --- workers and experiments ----------------------------------------------------


def two_places(total: str, n: str) -> str:
    """Half-up mean of whole cents at two decimals, in whole numbers."""
    return f"(CASE WHEN {n} > 0 THEN (2 * ({total}) + {n}) // (2 * {n}) ELSE 0 END / 100.0::DOUBLE)"


OUT_PARTS = (
    ("outcomes", OUT),
    (
        "counted",
        """SELECT worker, ts, outcome_id, failed, round(latency_ms * 100)::BIGINT AS cents,
        count(*) FILTER (NOT failed) OVER w AS processed_count,
        count(latency_ms) FILTER (NOT failed) OVER w AS timed_count,
        count(*) FILTER (failed) OVER w AS failed_count,
        coalesce(sum(frontier) FILTER (NOT failed) OVER w, 0)::BIGINT AS frontier_enqueued,
        coalesce(sum(round(latency_ms * 100)::BIGINT) FILTER (NOT failed) OVER w, 0)::BIGINT AS total,
        row_number() OVER (PARTITION BY worker ORDER BY ts DESC, outcome_id DESC) = 1 AS last
        FROM outcomes WINDOW w AS (PARTITION BY worker ORDER BY ts, outcome_id)""",
    ),
    (
        "shots",
        """SELECT *, false AS final FROM counted WHERE processed_count > 0 AND processed_count % 15 = 0
        UNION ALL SELECT *, true AS final FROM counted WHERE last""",
    ),
    (
        "flush",
        f"""SELECT s.worker, s.outcome_id, s.final, s.ts, s.processed_count, s.failed_count,
        s.frontier_enqueued, {two_places('s.total', 's.timed_count')} AS avg_latency_ms,
        coalesce(list_sort(list(v.cents) FILTER (v.cents IS NOT NULL))[1 + floor(0.95::DOUBLE * (count(v.cents) - 1))::BIGINT], 0) / 100.0::DOUBLE AS p95_latency_ms
        FROM shots s LEFT JOIN counted v ON v.worker = s.worker AND NOT v.failed
          AND v.processed_count <= s.processed_count
        GROUP BY ALL""",
    ),
)
ORACLES["metrics_flush"] = with_(*OUT_PARTS) + "SELECT * EXCLUDE (ts) FROM flush"
ORACLES["stream_flush"] = ORACLES["metrics_flush"]
ORACLES["latest_metrics"] = with_(*OUT_PARTS) + "SELECT * EXCLUDE (ts, final) FROM flush WHERE final"
ORACLES["worker_metrics"] = with_(*OUT_PARTS) + (
    "SELECT * EXCLUDE (ts, final, outcome_id) FROM flush WHERE final"
)
ORACLES["metrics_append"] = with_(*OUT_PARTS, ("queue", QUEUE)) + """
SELECT worker, 2::BIGINT AS rows, processed_count,
       (SELECT count(*) FROM queue WHERE status IN ('pending', 'in_progress')) AS queue_depth
FROM flush WHERE final"""
TRIALS = """SELECT event_type AS policy, ts::DATE AS trial, count(*)::DOUBLE AS processed,
  avg(value) AS latency, sum(user_id % 7)::DOUBLE AS gain FROM events GROUP BY 1, 2"""
MEANS = "SELECT policy, avg(processed) AS processed, avg(latency) AS latency, avg(gain) AS gain FROM trials GROUP BY policy"
ORACLES["trial_means"] = with_(("trials", TRIALS), ("means", MEANS)) + """
SELECT policy, round(processed, 6) AS processed, round(latency, 6) AS latency, round(gain, 6) AS gain FROM means"""
ORACLES["lift"] = with_(
    ("trials", TRIALS),
    ("means", MEANS),
    ("long", "UNPIVOT means ON processed, latency, gain INTO NAME metric VALUE value"),
) + """
SELECT l.policy, l.metric, round(l.value, 6) AS value, round(b.value, 6) AS baseline,
  round(CASE WHEN abs(b.value) < 1e-9 THEN 0
        WHEN l.metric = 'latency' THEN (b.value - l.value) / b.value * 100.0::DOUBLE
        ELSE (l.value - b.value) / b.value * 100.0::DOUBLE END, 6) AS lift_pct
FROM long l JOIN long b ON b.metric = l.metric AND b.policy = 'view' WHERE l.policy <> 'view'"""

# --- streams -----------------------------------------------------------------------

# A page has the id and depth of its queue row; pages arrive in the order of their keys.
ORACLES["stream_queue"] = with_(
    ("queue", QUEUE),
    *FRONTIER_PARTS,
    (
        "known",
        f"""SELECT c, min(id) AS id, first(depth ORDER BY id) AS depth
        FROM (SELECT id, depth, {canonical(strip('url'))} AS c FROM queue) GROUP BY c""",
    ),
    (
        "placed",
        f"""SELECT r.*, k.id, coalesce(k.depth, 0) AS depth FROM ranked r
        JOIN (SELECT page_id, {canonical(strip('url'))} AS c FROM pages) p USING (page_id)
        LEFT JOIN known k ON k.c = p.c""",
    ),
    (
        "found",
        """SELECT href AS url, ceil(geo_score * 100.0::DOUBLE)::BIGINT + greatest(0, 20 - 6 * depth) AS priority,
        geo_score::FLOAT AS geo_score, concat('frontier:', reason) AS source, depth + 1 AS depth,
        id AS parent_url_id, page_id * 1048576 + place AS ord
        FROM placed WHERE place <= 16 AND depth < 2 AND geo_score >= 0.28::DOUBLE""",
    ),
    ("folded", FOLDED),
) + """
SELECT coalesce(q.url, f.url) AS url,
  CASE WHEN q.id IS NULL OR f.url IS NOT NULL AND q.status IN ('done', 'failed') THEN 'pending' ELSE q.status END AS status,
  greatest(q.priority, f.fp)::BIGINT AS priority,
  round(greatest(q.geo_score, f.fg)::DOUBLE, 6) AS geo_score,
  CASE WHEN f.url IS NULL THEN q.source WHEN q.source = 'seed' OR f.fseed THEN 'seed' ELSE f.fsource END AS source,
  least(q.depth, f.fd)::BIGINT AS depth, coalesce(q.parent_url_id, f.fparent) AS parent_url_id
FROM queue q FULL JOIN folded f ON q.url = f.url"""
# A window is written once the watermark (newest event minus ten minutes) has passed it.
ORACLES["stream_metrics"] = with_(("outcomes", OUT)) + """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, worker,
  count(*) FILTER (NOT failed) AS processed_count, count(*) FILTER (failed) AS failed_count,
  coalesce(sum(frontier) FILTER (NOT failed), 0)::BIGINT AS frontier_enqueued,
  round(avg(latency_ms) FILTER (NOT failed), 6) AS avg_latency_ms,
  round(quantile_disc(latency_ms, 0.95) FILTER (NOT failed), 6) AS p95_approx_ms
FROM outcomes
GROUP BY date_trunc('hour', ts), worker"""
