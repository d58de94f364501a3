"""Cleaning of titles, names and keys with native string expressions.

Java regex flags: ``i`` case-insensitive, ``u`` Unicode case, ``U`` Unicode
classes, ``d`` only ``\\n`` ends a line.  ``U`` leaves the four ASCII separators
out of ``\\s``; they are listed beside it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The title clean-up patterns, applied in this order.
FEATURING_TAIL = r"\s+\(??feat\..*?$"
BRACKETED_PART = r"\s*\[.*?]|\(.*?\)$"
DOUBLED_QUOTE = r'""'
EDGE_QUOTES = "'\"“”‘’"
SPACE_RUN = r"\s+"
NAME_SEPARATOR = ","

#: What any of the patterns needs in order to change a text: a dot, an opening bracket,
#: a double blank, or a character that is no printable ASCII one.
CLEAN_UP_NEEDED = r"[^ -~]|[.(\[]|  "

# The white space characters of Unicode.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

_SPACE = r"[\s\x1c-\x1f]"


def _java(pattern: str, flags: str = "(?Ud)") -> str:
    return flags + pattern.replace(r"\s", _SPACE)


def strip_space(c: Column) -> Column:
    """Trim every kind of white space at both ends, not only blanks."""
    return F.trim(c, F.lit(WHITE_SPACE))


def tidy(c: Column) -> Column:
    """Title or name without featured artists, bracketed remarks and edge
    quotes, blanks collapsed.  Null becomes the empty string, so that the
    empty-key filter drops it."""
    s = F.coalesce(c.cast("string"), F.lit(""))
    # most names hold nothing the patterns look for, and patterns cost most of a job's time
    bare = F.trim(F.trim(F.replace(s, F.lit(DOUBLED_QUOTE), F.lit('"')), F.lit(EDGE_QUOTES)))
    return F.when(F.rlike(s, F.lit(CLEAN_UP_NEEDED)), _cleaned_up(s)).otherwise(bare)


def _cleaned_up(s: Column) -> Column:
    s = F.regexp_replace(s, _java(FEATURING_TAIL, "(?iuUd)"), "")
    s = F.regexp_replace(s, _java(BRACKETED_PART), "")
    s = F.replace(s, F.lit(DOUBLED_QUOTE), F.lit('"'))
    # Quotes count as edge quotes also before one final line break.
    s = F.trim(F.regexp_replace(s, r"\n\z", ""), F.lit(EDGE_QUOTES))
    return F.trim(F.regexp_replace(s, _java(SPACE_RUN), " "))


def primary_artist(c: Column) -> Column:
    """The part before the first comma."""
    return strip_space(F.substring_index(c, NAME_SEPARATOR, 1))


def clean_key(c: Column) -> Column:
    """Join key: lower case, trimmed.  Null stays null and matches nothing."""
    return strip_space(F.lower(c.cast("string")))


def join_names(names: Column, sep: str = ", ", limit: int | None = None) -> Column:
    """One string from an array of names, optionally cut to ``limit`` characters."""
    joined = F.array_join(names, sep)
    return joined if limit is None else F.left(joined, F.lit(limit))
