"""Text helpers as native column expressions.

Whitespace here means Unicode whitespace: Java's ``\\s`` alone misses the
no-break space and its relatives, so the class is spelled out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode whitespace characters, as a set and as a regex class.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS = r"[\s\p{Z}\x1c-\x1f\x85]"

# A word character, and a year from 2024 to 2039 standing alone.
WORD = r"[\p{L}\p{N}_]"
# The look back comes after the first literal, so it runs only where a year may start.
RECENT_YEAR = rf"20(?<!{WORD}20)(?:2[4-9]|3\p{{Nd}})(?!{WORD})"

# Fixed value: what a float literal may look like as text, once the underscores between its
# digits are gone. Possessive classes only: a repeated group would recurse once per digit.
_BETWEEN_DIGITS = r"(?<=[0-9])_(?=[0-9])"
_FLOAT = (
    r"(?i)^[+-]?(?:(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:e[+-]?[0-9]++)?"
    r"|inf(?:inity)?|nan)\z"
)


Stage = Callable[[Column], Column]


def let(value: Column, body: Stage) -> Column:
    """Evaluate ``value`` once and hand it to ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def through(value: Column, *stages: Stage) -> Column:
    """Run one value through the stages, each evaluated once."""
    return F.get(each(F.array(value), *stages), F.lit(0))


def each(items: Column, *stages: Stage) -> Column:
    """Run every array element through the stages.

    Stages follow each other as separate transforms instead of nesting: Spark
    compares expressions when it plans a task, and deeply nested lambdas make
    that step slower than the work itself.
    """
    for stage in stages:
        items = F.transform(items, stage)
    return items


def carry(row: Column, names: Sequence[str]) -> list[Column]:
    """Fields handed on unchanged from one stage to the next."""
    return [row[n].alias(n) for n in names]


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def squeeze(text: Column) -> Column:
    """Collapse every whitespace run to one space and trim the ends."""
    return F.trim(F.regexp_replace(text, WS + "+", " "))


def head(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def clamp(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def unit_float(text: Column, default: float = 0.0) -> Column:
    """Parse text as a float and clamp it to [0, 1]; anything else is ``default``."""
    digits = F.regexp_replace(strip(text), _BETWEEN_DIGITS, "")
    parsed = F.when(digits.rlike(_FLOAT), digits.try_cast("double"))
    return F.when(parsed.isNull(), F.lit(default)).otherwise(clamp(parsed))


def has_any(text: Column, terms: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in terms])


def term_count(text: Column, terms: Sequence[str]) -> Column:
    """How many of the terms occur as substrings; each term counts once."""
    return reduce(
        lambda a, b: a + b, [F.contains(text, F.lit(t)).cast("int") for t in terms]
    )


# The next two run over the list of terms. They are short to plan, but meant for the
# variable of a lambda: the expression behind a plain column may be moved into the inner
# lambda by the optimizer, and would then be computed again for every term.


def element_has_any(element: Column, terms: Sequence[str]) -> Column:
    return F.exists(F.lit(list(terms)), lambda term: F.contains(element, term))


def element_term_count(element: Column, terms: Sequence[str]) -> Column:
    return F.size(F.filter(F.lit(list(terms)), lambda term: F.contains(element, term)))


def keyword_hits(count: Column, terms: Sequence[str]) -> Column:
    """A term count relative to 35 % of the list (at least 1)."""
    return count / F.lit(max(1.0, len(terms) * 0.35))


def recent_year(text: Column) -> Column:
    """A cheap substring test keeps the pattern away from most texts."""
    return has_any(text, ("202", "203")) & text.rlike(RECENT_YEAR)


def char_count(text: Column) -> Column:
    return F.length(text).cast("bigint")


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words: every word with the space after it
    shrinks to one character, and those are counted."""
    return F.length(
        F.regexp_replace(strip(text), rf"[^{WS[1:]}+{WS}*", "w")
    ).cast("bigint")
