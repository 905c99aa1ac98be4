"""Reading HTML with regular expressions only, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WORD, WS, blank_to_null, has_any, head, squeeze, strip

# ---------------------------------------------------------------------------
# Patterns and limits that decide what is found
# ---------------------------------------------------------------------------
LINK = rf"""(?isu)<a{WS}+[^>]*href=["']([^"']+)["'][^>]*>(.*?)</a>"""
TITLE = r"(?iu)<title[^>]*>([^<]+)</title>"
DESCRIPTION = (
    rf"""(?iu)<meta{WS}+name=["']description["'][^>]*content=["']([^"']+)["']"""
)
SCRIPT = r"(?iu)<script[^>]*>[\s\S]*?</script>"
STYLE = r"(?iu)<style[^>]*>[\s\S]*?</style>"
TAG = r"<[^>]+>"
OPEN_TAG = rf"<({WORD}+)([^>]*)>"
SUMMARY_ATTRIBUTES = ("id", "class", "role", "data-testid", "itemprop", "itemtype")
TRUNCATION_MARK = "\n... [truncated]"
HREF_CHARS, ANCHOR_CHARS, FIELD_CHARS, ATTRIBUTE_CHARS = 2048, 220, 500, 80
RAW_LINK_LIMIT = 50

# Boilerplate blocks left out of the main text, one kind after the other.
BOILERPLATE = ("nav", "header", "footer", "aside")
COMMENT = r"(?s)<!--.*?-->"

# A pattern that looks for the end of a block from every beginning takes quadratic time on a
# page of unclosed ones. If one beginning finds no end, no later one does: the rest of the page
# is then taken as a whole and put back.
LINK_END = "(?isu)^.*</a>"


# A tag that never ends would be looked at to the end of the page from each of its beginnings. Text
# after the last ``>`` holds no whole tag, so patterns run on what is before. Between two ``>`` all
# beginnings of a tag see the same end, so where the first one does not fit none does: the
# patterns below then take the whole stretch, and each is read once.
LINK_OR_TAG = LINK.replace("[^>]*href", "(?:[^>]*href") + "|[^>]*>)"
LINK_FROM_START = LINK.replace("<a", r"\A<a", 1)
TITLE_OR_TAG = r"(?iu)<title[^>]*>(?:([^<]+)</title>)?"
DESCRIPTION_OR_TAG = DESCRIPTION.replace("[^>]*content", "(?:[^>]*content") + "|[^>]*)"


def _tail(html: Column) -> Column:
    """What comes after the last ``>``."""
    return F.substring_index(html, ">", -1)


def _closed(html: Column) -> Column:
    """The page up to its last ``>``."""
    return F.substring(html, F.lit(1), F.length(html) - F.length(_tail(html)))


def _first(html: Column, pattern: str) -> Column:
    """What the pattern's group holds where it first fits, else an empty text."""
    found = F.filter(F.regexp_extract_all(_closed(html), F.lit(pattern), F.lit(1)), lambda x: x != "")
    return F.coalesce(F.get(found, 0), F.lit(""))


def _replace_blocks(html: Column, pattern: str, begin: str, filler: str) -> Column:
    """All blocks replaced. Before an unclosed one ``filler`` is added: nothing, or a blank
    that goes with the blanks its tag leaves."""
    return F.regexp_replace(html, rf"{pattern}|({begin}[\s\S]*\z)", filler + "$1")


def boilerplate_block(name: str) -> str:
    return rf"(?is)<{name}(?:\s[^>]*)?>.*?</{name}\s*>"


def without_code(closed: Column, filler: str) -> Column:
    """HTML that ends with ``>``, with script and style blocks replaced by ``filler``."""
    bare = _replace_blocks(closed, SCRIPT, "<script[^>]*>", filler)
    return _replace_blocks(bare, STYLE, "<style[^>]*>", filler)


def page_text(html: Column) -> Column:
    """Visible text: code blocks and tags removed, whitespace collapsed."""
    bare = F.regexp_replace(without_code(_closed(html), " "), TAG, " ")
    return squeeze(F.concat(bare, _tail(html)))


def main_text(html: Column) -> Column:
    """Visible text without navigation, header, footer, aside and comment blocks."""
    body = _replace_blocks(without_code(_closed(html), " "), COMMENT, "<!--", " ")
    for name in BOILERPLATE:
        begin = rf"<{name}(?:\s[^>]*)?>"
        body = _replace_blocks(body, boilerplate_block(name), begin, " ")
    return squeeze(F.concat(F.regexp_replace(body, TAG, " "), _tail(html)))


def title(html: Column) -> Column:
    """First non-blank title element, NULL when there is none."""
    return blank_to_null(head(strip(_first(html, TITLE_OR_TAG)), FIELD_CHARS))


def description(html: Column) -> Column:
    """Meta description whose ``name`` comes before ``content``, else NULL."""
    return blank_to_null(head(strip(_first(html, DESCRIPTION_OR_TAG)), FIELD_CHARS))


def anchors(html: Column) -> Column:
    """Every link of the page in order: ``array<struct<href, text>>``.

    The page is scanned once for whole elements, up to the last end of one; address and
    text are then read from the short matches.
    """
    found = F.regexp_extract_all(F.regexp_extract(html, LINK_END, 0), F.lit(LINK_OR_TAG), F.lit(0))
    return F.transform(
        F.filter(found, lambda a: a.rlike(LINK_FROM_START)),
        lambda a: F.struct(
            strip(F.regexp_extract(a, LINK, 1)).alias("href"),
            head(
                squeeze(_untagged(F.regexp_extract(a, LINK, 2))),
                ANCHOR_CHARS,
            ).alias("text"),
        ),
    )


def _untagged(text: Column) -> Column:
    return F.concat(F.regexp_replace(_closed(text), TAG, " "), _tail(text))


def raw_links(found: Column) -> Column:
    """The first 50 links with an address, unresolved and not deduplicated."""
    return F.slice(
        F.transform(
            F.filter(found, lambda a: a["href"] != ""),
            lambda a: F.struct(head(a["href"], HREF_CHARS).alias("href"), a["text"].alias("text")),
        ),
        1,
        RAW_LINK_LIMIT,
    )


def _short_tag(tag: Column) -> Column:
    rest = F.regexp_extract(tag, OPEN_TAG, 2)

    def attribute(name: str) -> Column:
        pattern = rf"""(?iu)(?<!{WORD}){name}{WS}*={WS}*["']([^"']*)["']"""
        value = head(F.regexp_extract(rest, pattern, 1), ATTRIBUTE_CHARS)
        return F.when(rest.rlike(pattern), F.concat(F.lit(f' {name}="'), value, F.lit('"')))

    return F.concat(
        F.lit("<"),
        F.lower(F.regexp_extract(tag, OPEN_TAG, 1)),
        F.concat_ws("", *[attribute(name) for name in SUMMARY_ATTRIBUTES]),
        F.lit(">"),
    )


def dom_summary(html: Column, max_chars: int = 50000) -> Column:
    """HTML without code blocks, each opening tag reduced to its key attributes."""
    bare = without_code(_closed(html), "")
    tags = F.transform(F.regexp_extract_all(bare, F.lit(OPEN_TAG), F.lit(0)), _short_tag)
    joined = F.array_join(
        F.zip_with(
            F.split(bare, OPEN_TAG, -1),
            F.array_append(tags, F.lit("")),
            lambda between, tag: F.concat(between, tag),
        ),
        "",
    )
    joined = F.concat(joined, _tail(html))
    return F.when(
        F.length(joined) > max_chars, F.concat(head(joined, max_chars), F.lit(TRUNCATION_MARK))
    ).otherwise(joined)


def looks_like_html(content_type: Column, body: Column, head_bytes: int | None = None) -> Column:
    """HTML by content type, or by a marker in the body (or its first bytes)."""
    marks = ("<html", "<!DOCTYPE html")
    if head_bytes is None:
        found = has_any(body, marks)
    else:
        start = F.substring(F.encode(body, "UTF-8"), 1, head_bytes)
        found = F.contains(start, F.lit(marks[0].encode())) | F.contains(
            start, F.lit(marks[1].encode())
        )
    return F.coalesce(F.contains(content_type, F.lit("html")), F.lit(False)) | found


def fetch_status(transport_error: Column, code: Column) -> Column:
    """``error`` on transport failure, ``http_error`` from code 400, else ``ok``."""
    return (
        F.when(F.coalesce(transport_error, F.lit("")) != "", F.lit("error"))
        .when(code >= 400, F.lit("http_error"))
        .otherwise(F.lit("ok"))
    )


def media_type(content_type: Column) -> Column:
    """Content type without its parameters."""
    return strip(F.substring_index(content_type, ";", 1))
