"""Row filters used by the searches and reports."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from haulbook.functions.dates import as_col
from haulbook.functions.text import prefix_like
from haulbook.functions.windows import shift_window

# Order statuses searched when none are named.
DEFAULT_STATUSES = ["R", "S", "T", "U", "Q", "D", "P", "QU"]
AUTO_COMPLETED = 2
# Fixed value: first day of a search for open orders without dates.
OPEN_SINCE = "2009-09-01"


def optional_filter(df: DataFrame, col: str, value) -> DataFrame:
    """``col = value``, or every row with a value when none is asked for."""
    return df.filter(F.col(col).isNotNull() if value is None else F.col(col) == F.lit(value))


def list_filter(df: DataFrame, col: str, csv: str | None, keep_null: bool = True) -> DataFrame:
    """Rows whose column is in a comma list. None keeps all; NULL columns pass only then."""
    if csv is None:
        return df if keep_null else df.filter(F.col(col).isNotNull())
    wanted = [x.strip() for x in csv.split(",") if x.strip()]
    return df.filter(F.col(col).isin([F.lit(x).cast(df.schema[col].dataType) for x in wanted]))


def in_list(df: DataFrame, col: str, values) -> DataFrame:
    return df.filter(F.trim(F.col(col)).isin(list(values)))


def not_in_list(df: DataFrame, col: str, values) -> DataFrame:
    return df.filter(~F.trim(F.col(col)).isin(list(values)))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def exclude_user(df: DataFrame, user_id: int, col: str = "ordered_by") -> DataFrame:
    return df.filter(F.col(col) != user_id)


def search_orders(orders: DataFrame, order_id=None, route=None, patient_id=None, last_name=None,
                  **others) -> DataFrame:
    """Search by the strongest criterion given: order, then route, then patient, then last-name prefix.

    A hit drops every weaker criterion. ``others`` (date_mode, start, end, statuses,
    priority, clients, drivers) is dropped by an order or patient search; a route search
    keeps only the dates, on the scheduled time. A search for scheduled, open or priority
    orders without a date mode goes by the scheduled time. Orders without a driver are
    found only without a list of drivers. ``today`` is the day that a search looks at which gives neither a date mode nor a
    date: any of the three stamps between its first instant and itself. A search for ``!`` without dates means from
    ``OPEN_SINCE`` to today. Without ``today`` such searches are over all days.
    """
    if order_id:
        return status_mode_filter(orders.filter(F.col("order_id") == order_id))
    if patient_id and not route:
        return status_mode_filter(orders.filter(F.col("patient_id") == patient_id))
    dates = {k: others.get(k) for k in ("start", "end")}
    if route:
        df = orders.filter(F.col("route_number") == route)
        return status_mode_filter(date_mode_filter(df, 0, **dates))
    df = orders if last_name is None else orders.filter(prefix_like("last_name", last_name))
    mode, codes = others.get("date_mode"), (others.get("statuses") or "").split(",")
    if mode is None and (others.get("priority") or "S" in codes or "!" in codes):
        mode = 0
    today = others.get("today")
    if today is not None and (mode is None or "!" in codes):
        start = dates["start"] if dates["start"] is not None else OPEN_SINCE if "!" in codes else today
        dates = {"start": start, "end": dates["end"] if dates["end"] is not None else today if "!" in codes else start}
    df = date_mode_filter(df, mode, **dates)
    df = list_filter(df, "driver_id", others.get("drivers"))
    df = list_filter(df, "client_id", others.get("clients"))
    return status_mode_filter(df, others.get("statuses"), others.get("priority", False))


def date_mode_filter(df: DataFrame, mode: int | None, start=None, end=None, hours: int = 6) -> DataFrame:
    """0 scheduled (window widened by ``hours``), 1 ordered, 2 completed, 3 completed automatically, None any of them.

    Bounds are columns, dates or ISO text; one that is missing is the other.
    """
    if start is None and end is None:
        return df
    start, end = (F.lit(b).cast("timestamp_ntz") for b in (end if start is None else start, start if end is None else end))
    wide = shift_window(start, end, hours)
    tests = {
        0: F.col("scheduled").between(*wide),
        1: F.col("stamp").between(start, end),
        2: F.col("completed").between(start, end),
    }
    if mode == 3:
        return df.filter(tests[2] & (F.col("completion_action") == AUTO_COMPLETED))
    return df.filter(reduce(or_, tests.values()) if mode is None else tests[mode])


def status_mode_filter(df: DataFrame, statuses: str | None = None, priority: bool = False) -> DataFrame:
    """Status search. ``S`` asks for scheduled, ``R`` for unscheduled, ``!`` for completed but not reconciled.

    Scheduled orders carry status R, so S looks among those with a scheduled time.
    ``priority`` asks for priority orders and implies S.
    """
    codes = [x for x in (statuses or "").split(",") if x]
    unscheduled, scheduled, open_only = "R" in codes, "S" in codes or priority, "!" in codes
    codes = [x for x in codes if x not in ("S", "!")] + (["R"] if scheduled else [])
    out = df.filter(F.trim("status").isin(codes if codes else DEFAULT_STATUSES))
    if scheduled:
        wanted = F.col("scheduled").isNotNull()
        if priority:
            wanted = wanted & F.coalesce("priority", F.lit(False))
        out = out.filter(F.col("scheduled").isNull() | wanted if unscheduled else wanted)
    elif unscheduled:
        out = out.filter(F.col("scheduled").isNull())
    if open_only:
        out = out.filter(F.col("reconciled").isNull() & F.col("completed").isNotNull())
    return out


def status_group(status) -> Column:
    """Work state of an order status."""
    s = F.trim(as_col(status))
    return (F.when(s.isin("Q", "T", "U"), "ENRT").when(s.isin("D", "E", "P"), "DONE")
            .when(s == "R", "RECV").when(s == "QU", "QUEUED"))
