"""Timestamp parsing and resolution-time columns.

Request times are wall-clock local times, so they are parsed to
``timestamp_ntz``: results never depend on the session time zone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketflow.functions.text import col_of


def parse_ts(c: str | Column, formats: Sequence[str] = ()) -> Column:
    """Lenient parse of text to ``timestamp_ntz``; anything unparseable is NULL.

    Accepts the ISO forms ``yyyy-MM-dd[ HH:mm[:ss[.SSS]]]`` with ``T`` or space,
    then each of the declared ``formats`` (Spark date patterns) in turn.
    Timestamp inputs pass through (as NTZ).
    """
    iso = col_of(c).try_cast("timestamp_ntz")
    if not formats:
        return iso
    text = col_of(c).cast("string")
    return F.coalesce(iso, *[F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats])


def epoch_seconds(c: str | Column) -> Column:
    """Whole seconds since the epoch, floored (NTZ read as wall clock)."""
    return F.unix_timestamp(col_of(c))


def resolution_seconds(created: str | Column, closed: str | Column) -> Column:
    """Whole-second difference, each side floored first; NULL while open."""
    closed = col_of(closed)
    return F.when(closed.isNotNull(), epoch_seconds(closed) - epoch_seconds(created))


def resolution_hours(created: str | Column, closed: str | Column) -> Column:
    """Hours between creation and closing, rounded HALF_UP to 2 dp."""
    return F.round(resolution_seconds(created, closed) / F.lit(3600), 2)


def resolution_days(created: str | Column, closed: str | Column) -> Column:
    """Calendar-date difference (not hours / 24); NULL while open."""
    closed = col_of(closed)
    return F.when(closed.isNotNull(), F.datediff(closed, col_of(created)))


def hours_to_cents(c: str | Column) -> Column:
    """Resolution hours (2 dp) as an exact integer count of hundredths."""
    return F.round(col_of(c) * F.lit(100)).cast("long")


def int_div(a: Column, b: Column) -> Column:
    """Floor division of non-negative integers, exact: an integer division of
    decimals, so neither a floating-point step nor an overflow of the scaled
    numerator (38 digits) can change it."""
    return F.call_function("div", a.cast("decimal(38,0)"), b.cast("decimal(38,0)"))


def half_up_avg_cents(sum_cents: Column, n: Column) -> Column:
    """Exact HALF_UP average of non-negative integer cents, as hours (2 dp).

    ``((2*s + n) div (2*n)) / 100`` in integer arithmetic, so the value does
    not depend on the order in which partial sums were combined.
    NULL when ``n`` is 0 (no closed request in the group).
    """
    s = sum_cents.cast("decimal(38,0)")
    n = n.cast("decimal(38,0)")
    return F.when(n > 0, int_div(s * 2 + n, n * 2) / F.lit(100.0))
