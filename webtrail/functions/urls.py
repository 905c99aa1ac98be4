"""URL splitting, canonicalising and resolving with native expressions.

``parse_url`` is strict (it raises or returns NULL on links that browsers and
crawlers accept), so URLs are cut here with one lenient pattern. The work is
written as stages (struct in, struct out) that serve a table column through
``through`` and the links array of a page through ``each``. Stages hand on the
fields named in ``keep``, so a link can carry its text along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS, Stage, carry, each, strip, through

# Characters cut from the left of a URL, and removed anywhere in it.
_CONTROL_OR_SPACE = "".join(chr(c) for c in range(0x21))
_REMOVED = "\t\r\n"
# Scheme, authority, path, query; whatever follows is the fragment.
PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
SCHEME, NETLOC, PATH, QUERY = 1, 2, 3, 4
_PARAMS = r";([^/]*)\z"
# Characters whose compatibility form contains one of / ? # @ : .
_CONFUSABLE = (
    "[\u2047\u2048\u2049\u2100\u2101\u2105\u2106\u2a74\ufe13\ufe16"
    "\ufe55\ufe56\ufe5f\ufe6b\uff03\uff0f\uff1a\uff1f\uff20]"
)
_HEX = "[0-9A-Fa-f]{1,4}"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IP6_FULL = rf"^{_HEX}(?::{_HEX}){{7}}\z"


def _ip6_ok(host: Column) -> Column:
    """Bracketed host is an IPv6 address (or a ``v...`` future form)."""
    bare = F.regexp_replace(host, r"%[^%]+\z", "")
    flat = F.regexp_replace(bare, rf"(?<=:){_OCTET}(?:\.{_OCTET}){{3}}\z", "0:0")
    # One gap of two colons among at most seven groups; counted, as a pattern would recurse.
    groups = F.filter(F.split(flat, ":"), lambda g: g != "")
    gaps = F.length(flat) - F.length(F.replace(flat, F.lit("::"), F.lit(":")))
    short = (
        F.contains(flat, F.lit("::"))
        & ~F.contains(flat, F.lit(":::"))
        & (gaps == 1)
        & ~flat.rlike(r"^:[^:]|[^:]:\z")
        & (F.size(groups) <= 7)
        & F.forall(groups, lambda g: g.rlike(rf"^{_HEX}\z"))
    )
    return F.when(
        F.startswith(host, F.lit("v")), host.rlike(r"^v[a-fA-F0-9]+\..+\z")
    ).otherwise(flat.rlike(_IP6_FULL) | short)


def _authority_ok(netloc: Column) -> Column:
    opened, closed = F.contains(netloc, F.lit("[")), F.contains(netloc, F.lit("]"))
    inner = F.substring_index(F.substr(netloc, F.instr(netloc, F.lit("[")) + 1), "]", 1)
    return (
        F.when(opened != closed, F.lit(False))
        .when(opened & ~_ip6_ok(inner), F.lit(False))
        .when(F.length(netloc) == F.octet_length(netloc), F.lit(True))
        .otherwise(~netloc.rlike(_CONFUSABLE))
    )


def _split_stages(keep: Sequence[str] = ()) -> list[Stage]:
    """``struct<href, ...>`` to ``struct<scheme, netloc, path, params, query, ok, ...>``."""

    def clean(a: Column) -> Column:
        text = F.translate(F.ltrim(strip(a["href"]), F.lit(_CONTROL_OR_SPACE)), _REMOVED, "")
        return F.struct(text.alias("text_"), *carry(a, keep))

    def cut(a: Column) -> Column:
        def part(group: int) -> Column:
            return F.regexp_extract(a["text_"], PARTS, group)

        return F.struct(
            F.lower(part(SCHEME)).alias("scheme"),
            part(NETLOC).alias("netloc"),
            part(PATH).alias("path"),
            part(QUERY).alias("query"),
            *carry(a, keep),
        )

    def finish(a: Column) -> Column:
        has_params = F.contains(a["path"], F.lit(";"))
        return F.struct(
            *carry(a, ["scheme", "netloc"]),
            F.when(has_params, F.regexp_replace(a["path"], _PARAMS, ""))
            .otherwise(a["path"])
            .alias("path"),
            F.when(has_params, F.regexp_extract(a["path"], _PARAMS, 1))
            .otherwise(F.lit(""))
            .alias("params"),
            a["query"].alias("query"),
            _authority_ok(a["netloc"]).alias("ok"),
            *carry(a, keep),
        )

    return [clean, cut, finish]


def _join_stage(keep: Sequence[str] = ()) -> Stage:
    """Canonical text of the parts as ``href``, ``''`` when it is no usable web URL."""

    def join(p: Column) -> Column:
        rooted = F.startswith(p["path"], F.lit("/"))
        slashes = F.when(
            (p["netloc"] != "") | rooted | (p["path"] == ""), F.lit("://")
        ).otherwise(F.lit(":"))
        lead = F.when(rooted | ((p["netloc"] == "") & (p["path"] != "")), F.lit("")).otherwise(
            F.lit("/")
        )
        mark = F.when(p["query"] == "", F.lit("")).otherwise(F.lit("?"))
        return F.struct(
            F.when(
                p["scheme"].isin("http", "https") & p["ok"],
                F.concat(
                    p["scheme"], slashes, F.lower(p["netloc"]), lead, p["path"], mark, p["query"]
                ),
            )
            .otherwise(F.lit(""))
            .alias("href"),
            *carry(p, keep),
        )

    return join


def _target_stages(base: Column, keep: Sequence[str] = ()) -> list[Stage]:
    """Split reference to the parts of the URL it means when read on page ``base``."""

    def choose(p: Column) -> Column:
        """Which parts come from the reference and which from the base."""
        foreign = (p["scheme"] != "") & (p["scheme"] != base["scheme"])
        own_host = foreign | (p["netloc"] != "")
        same_page = (p["path"] == "") & (p["params"] == "")
        # A rooted path without dot segments is final; others need their segments.
        plain = F.startswith(p["path"], F.lit("/")) & ~F.contains(p["path"], F.lit("/."))
        return F.struct(
            F.when(foreign, p["scheme"]).otherwise(base["scheme"]).alias("scheme"),
            F.when(own_host, p["netloc"]).otherwise(base["netloc"]).alias("netloc"),
            F.when(~own_host & same_page, base["path"]).otherwise(p["path"]).alias("path"),
            F.when(~own_host & same_page & (p["query"] == ""), base["query"])
            .otherwise(p["query"])
            .alias("query"),
            (base["ok"] & p["ok"]).alias("ok"),
            (~own_host & ~same_page & ~plain).alias("merge"),
            *carry(p, keep),
        )

    def segments(p: Column) -> Column:
        """Folder of the base plus the reference path, as a list of segments."""
        folder = F.regexp_replace(base["path"], r"[^/]+\z", "")
        start = F.when(
            (base["path"] == "") | (folder != ""), F.concat(folder, F.lit("/"))
        ).otherwise(F.lit(""))
        # Empty segments inside a relative result would only double its slashes.
        below = F.regexp_replace(F.concat(start, p["path"]), "/{2,}", "/")
        rooted = F.startswith(p["path"], F.lit("/"))
        return F.struct(
            *carry(p, ["scheme", "netloc", "path", "query", "ok", *keep]),
            F.when(p["merge"], F.split(F.when(rooted, p["path"]).otherwise(below), "/")).alias(
                "segments"
            ),
        )

    def fold(p: Column) -> Column:
        def push(done: Column, seg: Column) -> Column:
            return (
                F.when(
                    seg == "..",
                    F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))),
                )
                .when(seg == ".", done)
                .otherwise(F.array_append(done, seg))
            )

        start = F.array().cast("array<string>")
        ends = F.when(
            F.element_at(p["segments"], -1).isin(".", ".."), F.array(F.lit(""))
        ).otherwise(start)
        merged = F.array_join(F.concat(F.aggregate(p["segments"], start, push), ends), "/")
        return F.struct(
            *carry(p, ["scheme", "netloc", "query", "ok", *keep]),
            F.when(p["segments"].isNull(), p["path"]).otherwise(merged).alias("path"),
        )

    return [choose, segments, fold]


def _as_link(url: Column) -> Column:
    return F.struct(url.alias("href"))


def split_url(url: Column) -> Column:
    """``struct<scheme, netloc, path, params, query, ok>``; the fragment is dropped.

    The scheme is lowercased, user info and port stay in ``netloc``, and
    ``params`` is the ``;...`` tail of the last path segment. ``ok`` is false for
    a host that no parser accepts, such as an unclosed bracket.
    """
    return through(_as_link(url), *_split_stages())


def canonical_links(links: Column, keep: Sequence[str] = ("text",)) -> Column:
    """Canonical address of every link; unusable ones get ``''``."""
    return each(links, *_split_stages(keep), _join_stage(keep))


def resolved_links(links: Column, base: Column, keep: Sequence[str] = ("text",)) -> Column:
    """Every link resolved against ``base`` (a ``split_url`` struct), canonical form."""
    return each(links, *_split_stages(keep), *_target_stages(base, keep), _join_stage(keep))


def settled_links(links: Column, keep: Sequence[str] = ("text",)) -> Column:
    """A second canonical pass over canonical links.

    Only trailing whitespace, which can surface when a fragment is cut, makes it
    differ from the first, so links without it pass through as they are.
    """
    return F.when(
        F.exists(links, lambda a: a["href"].rlike(WS + r"\z")), canonical_links(links, keep)
    ).otherwise(links)


def canonicalize_url(url: Column) -> Column:
    """Keep http(s) only, lowercase the host, drop fragment and ``;params``."""
    return through(_as_link(url), *_split_stages(), _join_stage())["href"]


def resolve_url(base: Column, href: Column) -> Column:
    """Resolve ``href`` against ``base`` (a ``split_url`` struct), canonical form."""
    return through(_as_link(href), *_split_stages(), *_target_stages(base), _join_stage())["href"]


def host_of(url: Column) -> Column:
    return F.lower(split_url(url)["netloc"])


def host_affinity(parent_host: Column, host: Column) -> Column:
    """1 for the same host, 0.78 for the same last two labels, 0.45 otherwise,
    0 when either host is empty."""
    return (
        F.when((parent_host == "") | (host == ""), F.lit(0.0))
        .when(parent_host == host, F.lit(1.0))
        .when(
            F.substring_index(parent_host, ".", -2) == F.substring_index(host, ".", -2),
            F.lit(0.78),
        )
        .otherwise(F.lit(0.45))
    )
