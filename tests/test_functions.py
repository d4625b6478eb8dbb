import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import at
from haulbook.functions import dates as d, numbers as n, text as x, windows as w


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


@pytest.mark.parametrize("a, b, minutes, hours, days, months", [
    ("2017-01-01 00:00:59", "2017-01-01 00:01:01", 1, 0, 0, 0),
    ("2017-01-01 00:00:00", "2017-01-01 00:00:59", 0, 0, 0, 0),
    ("2016-12-31 23:59:59", "2017-01-01 00:00:00", 1, 1, 1, 1),
    ("2017-03-01 10:00:00", "2017-02-27 09:30:00", -2910, -49, -2, -1),
])
def test_differences_count_boundaries(frame, a, b, minutes, hours, days, months):
    df = frame("a timestamp_ntz, b timestamp_ntz", [(at(a), at(b))])
    got = df.select(d.minutes_between("a", "b"), d.hours_between("a", "b"), d.days_between("a", "b"),
                    d.months_between_boundaries("a", "b")).first()
    assert tuple(got) == (minutes, hours, days, months)


def test_time_span(frame):
    df = frame("a timestamp_ntz, b timestamp_ntz", [(at("2017-01-01 00:00:00"), at("2017-01-02 03:04:05")),
                                                    (at("2017-01-02 00:00:01"), at("2017-01-02 00:00:00")), (at("2017-01-01"), None)])
    assert [r[0] for r in df.select(d.time_span("a", "b")).collect()] == ["1 03:04:05", "-0 00:00:01", None]


def test_local_time_and_missing_zone(frame):
    df = frame("t timestamp_ntz, z string", [(at("2017-07-01 12:00:00"), "America/New_York"), (at("2017-07-01 12:00:00"), None)])
    assert [r[0] for r in df.select(d.local_time("t", "z")).collect()] == [at("2017-07-01 08:00:00"), None]


@pytest.mark.parametrize("today, start, end", [
    ("2017-04-02", "2017-03-26", "2017-04-01"),  # Sunday
    ("2017-03-29", "2017-03-19", "2017-03-25"),  # Wednesday
    ("2017-04-01", "2017-03-19", "2017-03-25"),  # Saturday
])
def test_previous_week(spark, today, start, end):
    assert one(spark, *w.previous_week(today)) == (dt.date.fromisoformat(start), dt.date.fromisoformat(end))


def test_months(spark):
    day = dt.date
    assert one(spark, *w.previous_month("2017-01-15")) == (day(2016, 12, 1), day(2016, 12, 31))
    assert one(spark, *w.month_span(2017, 0, 1)) == (day(2016, 12, 1), day(2016, 12, 31))
    assert one(spark, *w.month_span(2017, 1, 3)) == (day(2016, 11, 1), day(2017, 1, 31))
    assert one(spark, *w.trailing_months("2017-05-31", 3)) == (day(2017, 2, 1), day(2017, 4, 30))
    assert one(spark, *w.force_month(201602)) == (day(2016, 2, 1), day(2016, 2, 29))
    assert [tuple(r) for r in one(spark, w.last_n_months("2017-02-28", 2))[0]] == [
        (day(2017, 1, 1), day(2017, 1, 31)), (day(2016, 12, 1), day(2016, 12, 31))]
    assert [r.yyyymm for r in w.spine_frame(spark, "2016-11-20", "2017-02-01").collect()] == [201611, 201612, 201701, 201702]
    assert one(spark, w.title_for_month("2017-03-01")) == ("Month of 3/2017",)


@pytest.mark.parametrize("kind, offset, start, end", [
    ("M", 0, "2017-02-01", "2017-02-28"), ("M", 1, "2017-03-01", "2017-03-31"), ("M", -1, "2017-01-01", "2017-01-31"),
    ("W", 0, "2017-03-05", "2017-03-11"), ("I", 0, "2017-03-06", "2017-03-12"), ("Y", 0, "2016-01-01", "2016-12-31"),
    ("Q", 0, "2016-10-01", "2016-12-31"), ("B", 0, "2017-01-01", "2017-02-28"), ("D", 0, "2017-03-14", "2017-03-14"),
])
def test_report_window(spark, kind, offset, start, end):
    win = one(spark, w.report_window(kind, offset, "2017-03-15"))[0]
    assert [(str(r.start), str(r.end), r.label) for r in win] == [(start, end, end)]
    assert len(one(spark, w.report_window(kind, offset, "2017-03-15", summary=True))[0]) == 13


def test_window_edges(frame):
    df = frame("t timestamp_ntz", [(at(f"2017-04-{s}"),) for s in ("01 00:00:00", "07 00:00:00", "07 09:00:00", "08 00:00:00")])
    count = lambda upper: df.filter(w.in_window("t", "2017-04-01", "2017-04-07", upper)).count()
    assert (count("midnight"), count("whole_day")) == (2, 3)
    with pytest.raises(ValueError):
        w.in_window("t", "2017-04-01", "2017-04-07", "noon")


def test_text(frame, spark):
    assert one(spark, x.clean_markup(F.lit("Driver&#39;s &#34;thank you&#34; was worth &#36;5"))) == ("Driver's \"thank you\" was worth $5",)
    assert one(spark, x.strip_breaks(F.lit("a<br />b<br>c\r\nd"))) == ("abcd",)
    df = frame("last string, first string, mid string, code string", [("Doe", "Jo", None, " #G"), ("Roe", "Al", "B", ""), ("Poe", "Ed", "C", "DX")])
    assert [tuple(r) for r in df.select(x.person_name("last", "first", "mid"), x.driver_label("first", "last"), x.code_in_string("code")).collect()] == [
        (None, "Jo D.", True), ("Roe, Al B", "Al R.", False), ("Poe, Ed C", "Ed P.", False)]
    assert one(spark, x.same_code(F.lit("NOd "), "Nod"), x.is_numeric(F.lit("12")), x.is_numeric(F.lit("1x"))) == (True, True, False)


def test_numbers(frame):
    df = frame("a int, b int", [(1, 8), (3, 0), (5, 5), (2, 3)])
    assert [r[0] for r in df.select(n.pct_of("a", "b", "decimal(5,2)")).collect()] == [Decimal(v) for v in ("12.50", "0.00", "100.00", "66.67")]
    assert df.select(n.pct_of("a", "b", as_text=True)).first()[0] == "12.50%"
    assert [r[0] for r in df.select(n.share_of("a", "b", empty="null")).collect()][1] is None
    assert [r[0] for r in df.select(n.yes_no(F.col("a") / F.nullif("b", F.lit(0)) > 0.5, "N", "Y")).collect()] == ["Y", "Y", "N", "N"]
