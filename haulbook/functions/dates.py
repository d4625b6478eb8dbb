"""Date arithmetic that counts calendar boundaries, and duration text.

A difference is the number of minute, hour, day or month boundaries crossed
between two stamps: 00:00:59 to 00:01:01 is one minute. Everything works on the
stamp's own fields, so zone-less and zoned stamps behave alike. The longer ones
take column names or SQL text and are parsed as one expression.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

EPOCH = dt.date(1970, 1, 1)


def as_col(c) -> Column:
    """A column from a column, a column name, or a date/datetime/ISO-date value."""
    if isinstance(c, Column):
        return c
    if isinstance(c, (dt.date, dt.datetime)):
        return F.lit(c)
    return F.col(c)


def as_date(c) -> Column:
    """A date column from a column, a date value, or ISO date text."""
    if isinstance(c, str):
        c = dt.date.fromisoformat(c)
    if isinstance(c, dt.datetime):
        c = c.date()
    return F.to_date(as_col(c))


def day_index(ts: str) -> Column:
    """Days since 1970-01-01. Here and below ``ts``, ``a`` and ``b`` are column names or SQL text."""
    return F.expr(_days(ts))


def _days(ts: str) -> str:
    return f"datediff(to_date({ts}), date'1970-01-01')"


def _hours(ts: str) -> str:
    return f"(cast({_days(ts)} as bigint) * 24 + hour({ts}))"


def _minutes(ts: str) -> str:
    return f"({_hours(ts)} * 60 + minute({ts}))"


def _seconds(ts: str) -> str:
    return f"({_minutes(ts)} * 60 + second({ts}))"


def month_index(ts: str) -> str:
    """SQL text: months since year 0."""
    return f"(year({ts}) * 12 + month({ts}) - 1)"


def days_between(a: str, b: str) -> Column:
    return F.expr(f"datediff(to_date({b}), to_date({a}))")


def hours_between(a: str, b: str) -> Column:
    return F.expr(f"{_hours(b)} - {_hours(a)}")


def minutes_between(a: str, b: str) -> Column:
    return F.expr(f"{_minutes(b)} - {_minutes(a)}")


def months_between_boundaries(a: str, b: str) -> Column:
    return F.expr(f"{month_index(b)} - {month_index(a)}")


def time_span(a: str, b: str) -> Column:
    """``D HH:MM:SS`` from a to b; a leading minus when b is earlier; NULL if either is NULL."""
    secs = f"({_seconds(b)} - {_seconds(a)})"
    size = f"abs({secs})"
    two = lambda unit, base: f"lpad(cast({size} div {unit} % {base} as string), 2, '0')"
    return F.expr(f"concat(if({secs} < 0, '-', ''), cast({size} div 86400 as string), ' ', "
                  f"{two(3600, 24)}, ':', {two(60, 60)}, ':', {two(1, 60)})")


def local_time(ts, zone, keep: bool = False) -> Column:
    """A zone-less UTC stamp shown in the given zone; NULL zone gives NULL, or with ``keep`` the stamp as it is."""
    shown = F.convert_timezone(F.lit("UTC"), as_col(zone), as_col(ts))
    return F.coalesce(shown, as_col(ts)) if keep else shown


def us_date(ts) -> Column:
    """``mm/dd/yyyy``."""
    return F.date_format(as_col(ts), "MM/dd/yyyy")


def month_name(ts) -> Column:
    return F.date_format(as_col(ts), "MMMM")


def yyyymm(ts) -> Column:
    ts = as_col(ts)
    return F.year(ts) * 100 + F.month(ts)


def yyyymm_to_date(c) -> Column:
    """First day of an integer ``YYYYMM`` month."""
    c = as_col(c)
    return F.make_date((c / 100).cast("int"), c % 100, F.lit(1))


def same_day_of_month(a, b, same_date: bool = False) -> Column:
    """Day-of-month equality, which also holds across months; ``same_date`` asks for the same date."""
    if same_date:
        return F.to_date(as_col(a)) == F.to_date(as_col(b))
    return F.dayofmonth(as_col(a)) == F.dayofmonth(as_col(b))
