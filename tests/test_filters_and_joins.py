import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import at, tuples
from haulbook.operators import filters as f, lookups as k
from haulbook.operators.intervals import prefix_ranks, range_join, running_at
from haulbook.operators.scan import scan_before, time_levels

ORDERS = "order_id int, patient_id int, route_number int, last_name string, client_id int, status string, scheduled timestamp_ntz, stamp timestamp_ntz, completed timestamp_ntz, reconciled timestamp_ntz, completion_action int, priority boolean, driver_id int"
T = at("2017-01-10")
ROWS = [
    (1, 10, 5, "Smith", 1, "R", None, T, None, None, None, False, 7),
    (2, 10, 5, "Smithson", 2, "R", T, T, None, None, None, True, None),
    (3, 11, 6, "Jones", 1, "D", T, T, T, None, 2, None, 8),
    (4, 12, 6, "Smith", 1, "D", T, T, T, T, 1, False, 9),
    (5, 12, 7, "Smith", 1, "Z", T, T, T, T, 1, False, 9),
]


def ids(df):
    return sorted(r.order_id for r in df.collect())


def test_status_modes(frame):
    o = frame(ORDERS, ROWS)
    assert ids(f.status_mode_filter(o)) == [1, 2, 3, 4]
    assert ids(f.status_mode_filter(o, "R")) == [1]
    assert ids(f.status_mode_filter(o, "S")) == [2]
    assert ids(f.status_mode_filter(o, "R,S")) == [1, 2]
    assert ids(f.status_mode_filter(o, "D,!")) == [3]
    assert ids(f.status_mode_filter(o, priority=True)) == [2]


def test_date_modes(frame):
    o = frame(ORDERS, ROWS)
    lo, hi = F.lit("2017-01-10 05:00:00"), F.lit("2017-01-11")
    assert ids(f.date_mode_filter(o, 0, lo, hi)) == [2, 3, 4, 5]  # widened by six hours
    assert ids(f.date_mode_filter(o, 0, lo, hi, hours=0)) == []
    assert ids(f.date_mode_filter(o, 1, F.lit("2017-01-10"), hi)) == [1, 2, 3, 4, 5]
    assert ids(f.date_mode_filter(o, 3, F.lit("2017-01-10"), hi)) == [3]
    assert ids(f.date_mode_filter(o, None, lo, hi)) == [2, 3, 4, 5]
    assert ids(f.date_mode_filter(o, 2)) == [1, 2, 3, 4, 5]


def test_search_precedence(frame):
    o = frame(ORDERS, ROWS)
    assert ids(f.search_orders(o, order_id=3, route=5, patient_id=10, last_name="S", statuses="R")) == [3]
    assert ids(f.search_orders(o, route=5, patient_id=11)) == [1, 2]
    assert ids(f.search_orders(o, patient_id=12, last_name="Jo")) == [4]
    assert ids(f.search_orders(o, last_name="smith", clients="1")) == [1, 4]


def test_list_filter_keeps_null_only_without_a_list(frame):
    o = frame(ORDERS, ROWS)
    assert ids(f.list_filter(o, "driver_id", None)) == [1, 2, 3, 4, 5]
    assert ids(f.list_filter(o, "driver_id", "7, 9")) == [1, 4, 5]


def test_lookups(frame):
    look = frame("group string, code string, name string", [("ORC", "A ", "Ask"), ("XX", "A", "Other"), ("ORC", "O", "Order")])
    df = frame("id int, reason string", [(1, "A"), (2, None), (3, "Q")])
    assert tuples(k.join_code(df, look, "ORC", "reason", "n"), "id", "n") == [(1, "Ask"), (2, None), (3, None)]
    assert tuples(k.join_code(df, look, "ORC", "reason", "n", default="O"), "id", "n") == [(1, "Ask"), (2, "Order"), (3, None)]
    assert tuples(k.join_code(df, look, "ORC", "reason", "n", how="inner"), "id") == [(1,)]


def test_region_fill_flags_and_fallback(frame):
    states = frame("region_id int, state string", [(-1, "DE"), (-2, "NJ")])
    df = frame("region_id int, region_name string", [(5, "North"), (None, "NJ Region"), (None, "ZZ Region")])
    assert tuples(k.region_fill(df, states), "region_name", "region_id") == [("NJ Region", -2), ("North", 5), ("ZZ Region", None)]
    hit = k.flag_matches(df, frame("region_name string", [("North",), ("Ghost",)]), ["region_name"], "hit")
    assert tuples(hit, "region_name", "hit") == [("NJ Region", 0), ("North", 1), ("ZZ Region", 0)]
    places = frame("user_id int, company_id int, location_id int, type string", [(1, 100, 1, "H"), (1, 2, 9, "D"), (2, 2, 9, "D"), (2, 2, 8, "D"), (3, 7, 1, "S")])
    who = frame("u int, a int, b int", [(1, 100, 2), (2, 100, 2), (3, 100, 2)])
    assert tuples(k.fallback_lookup(who, places, "u", "a", "b"), "u", "user_company", "user_level") == [(1, 100, "H"), (2, 2, "D"), (3, None, None)]


def test_anti_join_ignores_null_keys(frame):
    left, right = frame("id int", [(1,), (2,)]), frame("id int", [(None,), (2,)])
    assert tuples(k.anti_join(left, right, "id"), "id") == [(1,)]


@pytest.mark.parametrize("block", [1, 3, 65_536])
def test_scan_agrees_with_a_loop(frame, block):
    """Null keys and stamps, ties in time, hours with one and with many rows."""
    rnd = random.Random(block)
    stamps = [None, *[dt.datetime(2017, 3, d, h, m) for d in (1, 2) for h in (0, 5) for m in (0, 30)]]
    rows = [(i, rnd.choice([None, 1, 2]), rnd.choice(stamps), rnd.choice([None, None, i]), rnd.randint(0, 3)) for i in range(200)]
    df = frame("id int, k int, ts timestamp_ntz, v int, w int", rows)
    got = {r.id: (r.before, r.found, r.found_before) for r in scan_before(df, ["k"], ["ts", "id"], time_levels("ts", "id", block), F.col("v"), F.col("w")).collect()}
    want = {}
    for k in (None, 1, 2):
        before, last, at_last = 0, None, None
        for i, _, _, v, w in sorted((r for r in rows if r[1] == k), key=lambda r: (r[2] is not None, r[2] or stamps[1], r[0])):
            want[i] = (before, last, at_last)
            if v is not None:
                last, at_last = v, before
            before += w
    assert got == want


def test_scan_starts_no_job(spark, frame):
    df = frame("id int, k int, ts timestamp_ntz", [(1, 1, None)])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("scan", "scan")
    scan_before(df, ["k"], ["ts", "id"], time_levels("ts", "id"), F.col("id"))
    assert tracker.getJobIdsForGroup("scan") == []


def test_range_join(frame):
    rnd = random.Random(2)
    ranges = [(i, a, a + rnd.randint(-2, 70)) for i, a in enumerate(rnd.randint(0, 120) for _ in range(60))] + [(99, 0, 119_999), (98, None, 5), (97, 7, None)]
    points = list(range(0, 140, 3)) + [119_999]
    got = range_join(frame("id int, a int, b int", ranges), "a", "b", frame("p int", [(p,) for p in points]), "p")
    want = sorted((i, p) for i, a, b in ranges if None not in (a, b) for p in points if a <= p <= b)
    assert sorted((r.id, r.p) for r in got.collect()) == want


def test_prefix_sums_over_two_orders(frame):
    """Counts of points at or before a question in both orders, through the tree and one sweep."""
    rnd = random.Random(4)
    points = [(rnd.choice("ab"), rnd.randint(-9, 9), rnd.choice([None, *range(-9, 9)]), 1) for _ in range(150)]
    asks = [(rnd.choice("abc"), rnd.randint(-12, 12), rnd.randint(-9, 9)) for _ in range(60)]
    p, q = frame("k string, x int, y int, n long", points), frame("k string, x int, y int", asks).distinct()
    inside, read = prefix_ranks(p, q, ["k"], "x")
    assert max(len(r.nodes) for r in inside.collect()) <= 6
    spread = p.join(inside, ["k", "x"]).withColumn("node", F.explode("nodes"))
    reads = q.join(read, ["k", "x"]).withColumn("node", F.explode("nodes"))
    parts = running_at(spread, reads, ["k", "node"], "y", ["n"])
    got = {(r.k, r.x, r.y): r.n for r in reads.join(parts, ["k", "node", "y"]).groupBy("k", "x", "y").agg(F.sum("n").alias("n")).collect()}
    assert got == {(k, x, y): sum(a == k and b <= x and (c is None or c <= y) for a, b, c, _ in points) for k, x, y in set(asks)}
