"""Report windows.

``today`` is always an argument: a date, ISO text or a date column. Every
function returns a pair of columns (start, end), so a window can be worked out
for one date or for each row of a frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .dates import as_col, as_date, yyyymm, yyyymm_to_date

OPEN_END = 299912  # month that stands for "no end" in a validity range

# Window kinds and the word used in their titles.
KINDS = {"Y": "Year", "Q": "Quarter", "M": "Month", "W": "Week", "I": "ISO Week", "D": "Day", "B": "Bi-Month"}


def previous_week(today) -> tuple[Column, Column]:
    """Sunday to Saturday of the week before."""
    d = as_date(today)
    return F.date_add(d, -F.dayofweek(d) - 6), F.date_add(d, -F.dayofweek(d))


def previous_month(today) -> tuple[Column, Column]:
    d = F.add_months(as_date(today), -1)
    return F.to_date(F.trunc(d, "MM")), F.last_day(d)


def yesterday(today) -> tuple[Column, Column]:
    d = F.date_sub(as_date(today), 1)
    return d, d


def trailing_months(today, k: int = 3) -> tuple[Column, Column]:
    """First day of the month k months back to the last day of last month."""
    d = as_date(today)
    return F.to_date(F.trunc(F.add_months(d, -k), "MM")), F.last_day(F.add_months(d, -1))


def months_to_now(now, k: int = 2) -> tuple[Column, Column]:
    now = as_col(now)
    return F.to_date(F.trunc(F.add_months(F.to_date(now), -k), "MM")), now


def fixed_start_to_day_end(start, end) -> tuple[Column, Column]:
    """Start of the first day and the start of the day after the last one: use ``>= start`` and ``< end``."""
    return as_date(start), F.date_add(as_date(end), 1)


def month_span(year, month, span: int = 1) -> tuple[Column, Column]:
    """``span`` months ending with the given month; month 0 is December of the year before."""
    y = F.lit(year) if isinstance(year, int) else as_col(year)
    m = F.lit(month) if isinstance(month, int) else as_col(month)
    last = F.add_months(F.make_date(y, F.lit(1), F.lit(1)), m - 1)
    return F.add_months(last, -(span - 1)), F.last_day(last)


def last_n_months(today, n: int = 3) -> Column:
    """Array of (start, end), one per month, latest first."""
    first = F.to_date(F.trunc(as_date(today), "MM"))
    return F.array(*[
        F.struct(F.add_months(first, -k).alias("start"), F.last_day(F.add_months(first, -k)).alias("end"))
        for k in range(1, n + 1)
    ])


def period_start(kind: str, day) -> Column:
    """First day of the period of the given kind that holds ``day``."""
    d = as_date(day)
    if kind == "W":
        return F.date_add(d, 1 - F.dayofweek(d))
    if kind == "D":
        return d
    if kind == "B":
        month = F.month(d)
        return F.make_date(F.year(d), month - (month - 1) % 2, F.lit(1))
    return F.to_date(F.trunc(d, {"Y": "YEAR", "Q": "QUARTER", "M": "MM", "I": "WEEK"}[kind]))


def shift_periods(kind: str, start: Column, n: int) -> Column:
    months = {"Y": 12, "Q": 3, "M": 1, "B": 2}
    if kind in months:
        return F.add_months(start, months[kind] * n)
    return F.date_add(start, (1 if kind == "D" else 7) * n)


def period_starts(kind: str, first, last) -> Column:
    """Array with the first days of all periods from the one that holds ``first`` to the one that holds ``last``."""
    step = {"Y": "1 year", "Q": "3 month", "M": "1 month", "B": "2 month", "D": "1 day"}.get(kind, "7 day")
    return F.sequence(period_start(kind, first), period_start(kind, last), F.expr(f"interval {step}"))


def report_window(kind: str, offset: int, today, summary: bool = False) -> Column:
    """Array of (start, end, title, label): one window, or 13 going back in time with ``summary``.

    Offset 0 is the last complete period, negative is older, +1 the current one.
    """
    first = period_start(kind, today)

    def one(shift: int) -> Column:
        start = shift_periods(kind, first, shift)
        end = F.date_sub(shift_periods(kind, first, shift + 1), 1)
        when = title_for_month(start) if kind == "M" else F.concat(
            F.lit(f"{KINDS[kind]} of "), F.date_format(start, "M/d/yyyy"))
        return F.struct(start.alias("start"), end.alias("end"), when.alias("title"),
                        F.date_format(end, "yyyy-MM-dd").alias("label"))

    return F.array(*[one(offset - 1 - k) for k in range(13 if summary else 1)])


def force_month(month) -> tuple[Column, Column]:
    """The window of one given ``YYYYMM`` month."""
    d = yyyymm_to_date(F.lit(month) if isinstance(month, int) else month)
    return d, F.last_day(d)


def month_spine(start, end) -> Column:
    """Array with the first day of every month from start to end."""
    return F.sequence(F.to_date(F.trunc(as_date(start), "MM")), F.to_date(F.trunc(as_date(end), "MM")),
                      F.expr("INTERVAL 1 MONTH"))


def spine_frame(spark: SparkSession, start, end) -> DataFrame:
    """One row per month with its ``YYYYMM`` number."""
    return (spark.range(1).select(F.explode(month_spine(start, end)).alias("month"))
            .select("month", yyyymm("month").alias("yyyymm")))


def valid_in_month(month, begin="begin_yyyymm", end="end_yyyymm") -> Column:
    """A validity range covers the month; an open end counts as far future."""
    month = F.lit(month) if isinstance(month, int) else as_col(month)
    return (as_col(begin) <= month) & (month <= F.coalesce(as_col(end), F.lit(OPEN_END)))


def title_for_month(start) -> Column:
    return F.concat(F.lit("Month of "), F.date_format(as_date(start), "M/yyyy"))


def shift_window(start, end, hours: int = 6) -> tuple[Column, Column]:
    """Widen a window before a zone conversion."""
    return (F.timestamp_add("HOUR", F.lit(-hours), as_col(start)),
            F.timestamp_add("HOUR", F.lit(hours), as_col(end)))


def in_window(ts, start, end, upper: str = "midnight") -> Column:
    """Stamp inside the window.

    ``midnight`` ends at 00:00 of the last day, as a plain BETWEEN on dates does;
    ``whole_day`` takes the last day entirely. Bounds stay on the bare column so
    that they reach the file scan.
    """
    ts = as_col(ts)
    if upper == "midnight":
        return (ts >= as_date(start).cast("timestamp_ntz")) & (ts <= as_date(end).cast("timestamp_ntz"))
    if upper != "whole_day":
        raise ValueError("upper is 'midnight' or 'whole_day'")
    return (ts >= as_date(start).cast("timestamp_ntz")) & (ts < F.date_add(as_date(end), 1).cast("timestamp_ntz"))
