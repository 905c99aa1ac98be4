"""Plain statements of the definitions, one page or row at a time.

Independent of the library: standard library only, no Spark.
"""

from __future__ import annotations

import math
import re
from urllib.parse import urljoin, urlsplit

from webtrail.params import (
    ENTITY_TERMS,
    GEO_TERMS,
    NOISE_TERMS,
    RECONSTRUCTION_TERMS,
    VPS_TERMS,
)

ANCHOR = re.compile(r"""<a\s+[^>]*href=["']([^"']+)["'][^>]*>(.*?)</a>""", re.I | re.S)
YEAR = re.compile(r"\b(202[4-9]|203\d)\b")


def unit(x):
    return min(1.0, max(0.0, x))


def cut(url):
    """scheme, host part, path without its last ;params, query"""
    bits = urlsplit(url)
    head, slash, last = bits.path.rpartition("/")
    return bits.scheme, bits.netloc, head + slash + last.split(";", 1)[0], bits.query


def canonical(url):
    try:
        scheme, host, path, query = cut(url.strip())
    except ValueError:
        return ""
    if scheme not in ("http", "https"):
        return ""
    path = path or "/"
    if host:
        body = "//" + host.lower() + ("" if path.startswith("/") else "/") + path
    else:
        body = "//" + path if path.startswith("/") else path
    return f"{scheme}:{body}" + (f"?{query}" if query else "")


def resolve(base, href):
    try:
        return canonical(urljoin(base, href.strip()))
    except ValueError:
        return ""


def flat(text):
    return " ".join(text.split())


def anchors(html):
    for m in ANCHOR.finditer(html):
        yield m[1].strip(), flat(re.sub("<[^>]+>", " ", m[2]))[:220]


def visible(html):
    for name in ("script", "style"):
        html = re.sub(rf"<{name}[^>]*>[\s\S]*?</{name}>", " ", html, flags=re.I)
    return flat(re.sub("<[^>]+>", " ", html))


def payload(html, url):
    found = re.search("<title[^>]*>([^<]+)</title>", html, re.I)
    title = (found[1].strip()[:500] if found else "") or None
    found = re.search(
        r"""<meta\s+name=["']description["'][^>]*content=["']([^"']+)["']""", html, re.I
    )
    about = (found[1].strip()[:500] if found else "") or None
    text = visible(html)
    blob = f"{url}\n{title or ''}\n{about or ''}\n{text[:4000]}".lower()
    hits = [t for t in ENTITY_TERMS if t in blob]
    kept = [(h[:2048].strip(), t.strip()) for h, t in anchors(html) if h][:50]
    return {
        "title": title,
        "description": about,
        "main_content": text[:10000],
        "links": kept,
        "geo_entities": hits[:15],
        "location_hints": re.findall(
            r"\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,2})\b", text[:2500]
        )[:10],
        "vps_relevance": unit(0.08 * len(set(hits) & set(VPS_TERMS))),
        "reconstruction_relevance": unit(0.08 * len(set(hits) & set(RECONSTRUCTION_TERMS))),
        "recency_signal": 0.8 if YEAR.search(blob) else 0.3,
        "confidence": 0.67 if text else 0.45,
    }


def share(text, terms):
    return sum(t in text for t in terms) / max(1, len(terms) * 0.35)


def page_score(url, p):
    blob = f"{url}\n{p['title'] or ''}\n{p['description'] or ''}\n{p['main_content'][:5000]}"
    low = p["main_content"].lower()
    density = unit(share(blob.lower(), GEO_TERMS) * 3.4)
    fresh = 0.8 if YEAR.search(blob) else 0.65 if p.get("article_date") else 0.0
    made = 0.7 if "application/ld+json" in low else 0.0
    if any(w in low for w in ("schema.org", "geo", "latitude", "longitude")):
        made = max(made, 0.6)
    strong = sum(any(t in f"{h} {x}".lower() for t in GEO_TERMS) for h, x in p["links"])
    quality = unit(strong / max(1, min(15, len(p["links"]))))
    return unit(density * 0.42 + fresh * 0.18 + made * 0.22 + quality * 0.18)


def affinity(parent, child):
    a, b = (urlsplit(u).netloc.lower() for u in (parent, child))
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    return 0.78 if a.split(".")[-2:] == b.split(".")[-2:] else 0.45


def link_score(parent, href, text):
    low = f"{href} {text}".lower()
    geo, noise = unit(share(low, GEO_TERMS) * 3.7), unit(share(low, NOISE_TERMS) * 2.6)
    slashes = urlsplit(href).path.count("/")
    penalty = min(0.28, (slashes - 5) * 0.05) if slashes > 5 else 0.0
    host = affinity(parent, href)
    score = unit(geo * 0.62 + host * 0.28 + (1.0 - noise) * 0.10 - penalty)
    for reason, applies in (
        ("geo-dense", geo > 0.7), ("host-affinity", host > 0.9), ("likely-noise", noise > 0.3)
    ):
        if applies:
            return score, reason
    return score, "explore"


def html_links(html, base, limit):
    seen = {}
    for href, text in anchors(html):
        url = resolve(base, href)
        if url:
            seen.setdefault(url, text)
    return list(seen.items())[:limit]


def frontier(url, p, html, score, depth, max_depth=2, limit=16):
    if depth >= max_depth:
        return []
    own = [(canonical(h), t[:220]) for h, t in p["links"]]
    pool = [x for x in own if x[0]]
    if len(pool) < limit // 2:
        pool += html_links(html, url, limit)
    unique = {}
    for href, text in pool:
        again = canonical(href)
        if again:
            unique.setdefault(again, text)
    made = []
    for href, text in unique.items():
        link, reason = link_score(url, href, text)
        blend = unit(link * 0.72 + score * 0.28)
        made.append((href, blend, math.ceil(blend * 100.0) + max(0, 20 - depth * 6), reason))
    return sorted(made, key=lambda m: -m[1])[:limit]


def dom_summary(html, limit=50000):
    """A walk from one angle bracket to the next."""
    for name in ("script", "style"):
        kept, low, at = "", html.lower(), 0
        while (start := low.find("<" + name, at)) >= 0:
            inside = low.find(">", start)
            stop = low.find(f"</{name}>", inside) if inside >= 0 else -1
            if stop < 0:
                break
            kept, at = kept + html[at:start], stop + len(name) + 3
        html = kept + html[at:]
    out, at = "", 0
    while (start := html.find("<", at)) >= 0:
        stop, end = html.find(">", start), start + 1
        while end < len(html) and (html[end].isalnum() or html[end] == "_"):
            end += 1
        if stop < 0 or end == start + 1:
            out, at = out + html[at : start + 1], start + 1
            continue
        rest = html[end:stop]
        made = [f' {n}="{v[:80]}"' for n in SHOWN if (v := attribute(rest, n)) is not None]
        out, at = out + html[at:start] + "<" + html[start + 1 : end].lower() + "".join(made) + ">", stop + 1
    out += html[at:]
    return out if len(out) <= limit else out[:limit] + "\n... [truncated]"


SHOWN = ("id", "class", "role", "data-testid", "itemprop", "itemtype")


def attribute(rest, name):
    """Value of the first quoted attribute called ``name`` in any case, or None."""
    low, at = rest.lower(), -1
    while (at := low.find(name, at + 1)) >= 0:
        if at and (rest[at - 1].isalnum() or rest[at - 1] == "_"):
            continue
        tail = rest[at + len(name) :].lstrip()
        value = tail[1:].lstrip()
        if tail[:1] == "=" and value[:1] in ("'", '"'):
            ends = [i for q in "'\"" if (i := value.find(q, 1)) >= 0]
            if ends:
                return value[1 : min(ends)]
    return None


def floor_quantile(values, q=0.95):
    return sorted(values)[int(q * (len(values) - 1))] if values else 0.0
