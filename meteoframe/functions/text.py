"""Line and token helpers for landed text feeds (Column -> Column).

All of these are built-in expressions, so they stay inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Whitespace as Python's str.split()/str.strip() see it, derived by rule
# (every code point below U+3001 that str.isspace() accepts).  Stripping uses
# trim() with this set.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
_RARE = WHITESPACE.replace(" ", "")
_CONTROL = [ch for ch in _RARE if ch < "\x80"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Trim whitespace at both ends (all Unicode whitespace, not only ' ')."""
    return F.trim(_c(c), F.lit(WHITESPACE))


def tokens(c) -> Column:
    """Whitespace tokenise: runs collapse, ends ignored, blank -> empty array.

    Other blanks become spaces only in lines that hold any; then the split is at
    single spaces and empty pieces go, so that no pattern runs per line.
    """
    v = _c(c)
    plain = F.octet_length(v) == F.length(v)
    for ch in _CONTROL:
        plain = plain & ~v.contains(ch)
    return F.array_remove(F.split(F.when(plain, v).otherwise(F.translate(v, _RARE, " " * len(_RARE))), " "), "")


def bind(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` plus ``value``, computed once per row: later expressions and
    filters read the result.  (A plain new column is written out again by the
    optimizer in every place that uses it.)"""
    return df.select("*", F.explode(F.array(value)).alias(name))


def token(parts, i: int) -> Column:
    """i-th token (0-based) or null when the line is shorter."""
    return F.get(_c(parts), F.lit(i))


def padded_token(parts, i: int) -> Column:
    """i-th token, '' when missing (short rows are padded, extra tokens cut)."""
    return F.coalesce(token(parts, i), F.lit(""))


def before(c, marker: str) -> Column:
    """Text before the first marker: '25(12)' -> '25'."""
    return F.substring_index(_c(c), marker, 1)


def newline_to_space(c) -> Column:
    """Each newline / carriage return becomes one space; null stays null."""
    return F.translate(_c(c), "\n\r", "  ")


def is_blank(c) -> Column:
    return strip(c) == ""


def is_comment_or_blank(c, prefixes=("#",)) -> Column:
    """Lines dropped by every text feed: comment prefixes and blank lines."""
    cond = is_blank(c)
    for p in prefixes:
        cond = cond | _c(c).startswith(p)
    return cond


def starts_with_digit(c) -> Column:
    return _c(c).rlike(r"^[0-9]")


def first_tokens(c, n: int = 2, sep: str = " ") -> Column:
    """First n sep-separated tokens joined back: 'a b c' -> 'a b'; null -> null."""
    return F.array_join(F.slice(F.split(_c(c), sep), 1, n), sep)


def location_name(level1, level2) -> Column:
    """'level1 level2' trimmed, or level1 alone when level2 is empty."""
    l1, l2 = _c(level1), _c(level2)
    return F.when(F.coalesce(l2, F.lit("")) == "", l1).otherwise(
        strip(F.concat(l1, F.lit(" "), l2)))
