"""String predicates and normalisers (all built-in, JVM-side expressions)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# `trim` only strips spaces; the validation rules strip every character
# Python's str.strip() treats as whitespace.
# FIXED VALUES: the whitespace set of str.isspace().
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003"
              "\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.btrim(col_of(c), F.lit(WHITESPACE))


def is_blank(c: str | Column) -> Column:
    """NULL, empty or whitespace-only."""
    c = col_of(c)
    return c.isNull() | (strip_ws(c) == F.lit(""))


def null_if_token(c: str | Column, tokens: Iterable[str]) -> Column:
    """NULL when the whole value equals one of the NA tokens."""
    c = col_of(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def is_valid_zip(c: str | Column) -> Column:
    """A missing zip is fine; otherwise exactly five ASCII digits after stripping."""
    c = col_of(c)
    return c.isNull() | strip_ws(c).rlike(r"^[0-9]{5}$")


def upper_trim(c: str | Column) -> Column:
    return F.upper(F.trim(col_of(c)))


def fits_length(c: str | Column, n: int) -> Column:
    c = col_of(c)
    return c.isNull() | (F.length(c) <= F.lit(n))
