import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import at, tuples
from haulbook.operators.aggregates import elapsed_buckets
from haulbook.plans import redelivery as rd

ORDERS = "order_id int, patient_id int, driver_id int, route_number int, completed timestamp_ntz, reason string"
DETAILS = "order_id int, reference_order_id int, product_id int"
DME, O2, DISP, SERVICE = 1, 2, 3, 4  # products


def model(frame):
    return dict(
        patients=frame("patient_id int, client_id int, site_id int, type string", [(p, 10, 20, "P") for p in range(1, 30)] + [(99, 10, 20, "M")]),
        budgets=frame("client_id int, site_id int, sub_unit int, begin_yyyymm int, end_yyyymm int", [(10, 20, None, 201601, None), (10, 20, 5, 201001, 201012)]),
        equipment_lines=frame("product_id int, equipment_id int, item_id int, oxygen boolean, disposable boolean",
                              [(DME, 1, 9, False, False), (O2, 2, 50, True, False), (DISP, 3, 60, False, True), (SERVICE, 4, 227, False, True),
                               (25400, 5, 70, False, True), (7, 7, 195, False, False)]))


def run(frame, orders, details, **opts):
    m = model(frame)
    return rd.redelivery(frame(ORDERS, [(*o, "A") for o in orders]), frame(DETAILS, details), m["patients"], m["budgets"], m["equipment_lines"],
                         sub_items=frame("sub_item int", [(195,)]), **opts)


def notes(df, start="2017-03-01"):
    rows = df.filter(F.col("window_start") == F.lit(start).cast("date")).select("order_id", "note").collect()
    return {r.order_id: r.note for r in rows}


def test_every_note(frame):
    T = lambda d, h=0, m=0: dt.datetime(2017, 3, d, h, m)
    orders = [
        (1, 1, 1, 1, T(1)), (2, 1, 1, 1, T(6)), (3, 1, 1, 1, T(11, 0, 1)),           # kept at 5 days, dropped a minute later
        (4, 2, 1, 1, T(1)), (5, 2, 1, 1, T(1)),                                        # same instant
        (6, 3, 1, 1, T(1, 8)), (7, 3, 1, 1, T(1, 15)),                                 # same route and day
        (8, 4, 1, 1, T(2)), (9, 4, 1, 1, T(2, 1)), (10, 4, 2, 1, T(2, 2)), (11, 4, 1, 1, T(3)),
        (12, 5, 1, 1, T(4)), (13, 99, 1, 1, T(4)),
    ]
    details = [(o, None, DME) for o in (1, 2, 3, 4, 5, 6, 7, 13)] + [
        (None, 8, DME), (10, None, O2), (11, None, SERVICE), (11, None, DME)]
    got = notes(run(frame, orders, details))
    assert got == {1: "NoPreOrd", 2: "[Re-Del]", 3: "GT>Days", 4: "NoPreOrd", 5: "SameStop", 6: "NoPreOrd", 7: "SameRoute",
                   8: "PickupOnly", 9: "NoDetails", 10: "StandingO2", 11: "Service", 12: "NoDetails"}


def test_twice_posted_and_no_valid_predecessor_with_lowest_id_ties(frame):
    T = lambda d, h=0: dt.datetime(2017, 3, d, h)
    # three orders at one instant on different routes: 22 and 23 both point at 21, and so does 24
    orders = [(20, 1, 1, 1, T(1)), (21, 1, 1, 1, T(2)), (22, 1, 1, 2, T(2)), (23, 1, 1, 3, T(2)), (24, 1, 1, 1, T(3)),
              (30, 2, 1, 1, T(2)), (31, 2, 1, 1, T(2)), (32, 2, 1, 1, T(3))]
    details = [(o, None, DME) for o in (20, 21, 22, 23, 24, 32)] + [(30, None, SERVICE), (31, None, SERVICE)]
    df = run(frame, orders, details, ties="lowest_id")
    assert notes(df) == {20: "NoPreOrd", 21: "[Re-Del]", 22: "[Re-Del]", 23: "2xPost", 24: "2xPost", 30: "Service", 31: "Service", 32: "NoValidPre"}
    strict = run(frame, orders, details)
    assert notes(strict) == {20: "NoPreOrd", 21: "[Re-Del]", 22: "[Re-Del]", 23: "[Re-Del]", 24: "[Re-Del]", 30: "Service", 31: "Service", 32: "NoPreOrd"}
    pre = {r.order_id: r.pre_order_id for r in strict.collect()}
    assert (pre[21], pre[22], pre[23], pre[24]) == (20, 21, 22, 23)


def test_skipped_predecessors_are_listed(frame):
    T = lambda d: dt.datetime(2017, 3, d)
    orders = [(1, 1, 1, 1, T(1)), (2, 1, 1, 1, T(2)), (3, 1, 1, 1, T(3)), (4, 1, 1, 1, T(4))]
    details = [(1, None, DME), (2, None, SERVICE), (3, None, SERVICE), (4, None, DME)]
    df = run(frame, orders, details)
    assert tuples(df.filter("order_id = 4"), "pre_order_id", "skipped", "note") == [(1, 2, "[Re-Del]")]
    for opts in ({}, {"width": 255}, {"width": 255, "block": 90}):
        assert tuples(rd.skipped_orders(df, **opts), "order_id", "skipped", "skipped_ids", "skipped_notes") == [
            (3, 1, "2", "Service"), (4, 2, "3, 2", "Service, Service")]
    assert tuples(rd.skipped_runs(df), "run_after", "place", "order_id", "note") == [(1, 1, 2, "Service"), (1, 2, 3, "Service")]


def test_long_skip_lists_are_whole_and_can_be_cut(frame):
    orders = [(i, 1, 1, 1, dt.datetime(2017, 3, 1) + dt.timedelta(hours=i)) for i in range(1, 301)]
    df = run(frame, orders, [(i, None, SERVICE) for i in range(1, 301)])
    whole = {r.order_id: r.skipped_ids for r in rd.skipped_orders(df).collect()}
    cut = {r.order_id: r.skipped_ids for r in rd.skipped_orders(df, width=255, block=100).collect()}
    assert len(whole) == len(cut) == 299
    for i in range(2, 301):
        want = ", ".join(str(j) for j in range(i - 1, 0, -1))
        assert whole[i] == want and cut[i] == want[:255]
    assert tuples(rd.skipped_runs(df), "run_after", "place", "order_id") == sorted([(None, i, i) for i in range(1, 301)], key=str)


def test_lookback_reaches_the_month_before(frame):
    orders = [(1, 1, 1, 1, at("2017-02-26 10:00:00")), (2, 1, 1, 1, at("2017-03-01 10:00:00")), (3, 2, 1, 1, at("2017-02-20 10:00:00"))]
    df = run(frame, orders, [(o, None, DME) for o in (1, 2, 3)])
    assert notes(df) == {1: "NoPreOrd", 2: "[Re-Del]"}
    assert tuples(df.filter("not in_period"), "order_id", "window_start") == [(1, dt.date(2017, 3, 1))]
    only = run(frame, orders, [(o, None, DME) for o in (1, 2, 3)], first="2017-03-01", last="2017-03-01")
    assert tuples(only, "order_id") == [(1,), (2,)]


@pytest.mark.parametrize("kind, days, want", [
    ("D", 3, ["2017-02-27", "2017-02-28", "2017-03-01", "2017-03-02"]), ("W", 8, ["2017-02-26", "2017-03-05"]), ("I", 14, ["2017-02-27", "2017-03-06", "2017-03-13"]),
    ("M", 40, ["2017-02-01", "2017-03-01", "2017-04-01"]), ("B", 3, ["2017-01-01", "2017-03-01"]), ("Q", 400, ["2017-01-01", "2017-04-01", "2017-07-01", "2017-10-01", "2018-01-01", "2018-04-01"]),
    ("Y", 400, ["2017-01-01", "2018-01-01"]), ("M", 0, ["2017-02-01"])])
def test_an_order_lies_in_every_period_its_lookback_reaches(frame, kind, days, want):
    got = rd.order_windows(frame("id int, completed timestamp_ntz", [(1, at("2017-02-27 23:30:00"))]), "completed", kind, days)
    assert [str(r.window_start) for r in got.orderBy("window_start").collect()] == want


def test_daily_windows_look_back_over_five_days(frame):
    orders = [(1, 1, 1, 1, at("2017-03-01 10:00:00")), (2, 1, 2, 1, at("2017-03-04 10:00:00")), (3, 1, 3, 1, at("2017-03-09 10:01:00"))]
    df = run(frame, orders, [(o, None, DME) for o in (1, 2, 3)], kind="D", days=5)
    assert notes(df, "2017-03-04") == {1: "NoPreOrd", 2: "[Re-Del]"} and notes(df, "2017-03-09") == {2: "NoPreOrd", 3: "GT>Days"}
    assert df.count() == 18 and df.filter("in_period").count() == 3


def test_predecessors_are_found_before_orders_are_dealt_to_windows(frame):
    df = run(frame, [(1, 1, 1, 1, at("2017-03-01 10:00:00"))], [(1, None, DME)], kind="D", days=5)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan and "Window [" in plan
    assert plan.index("Generate explode") < plan.index("Window [")


@pytest.mark.parametrize("kind, days, first, last", [("D", 5, None, None), ("D", 0, None, None), ("W", 9, None, None), ("M", 5, None, None),
                                                     ("M", 70, "2017-02-01", "2017-04-01"), ("D", 40, "2017-02-20", "2017-03-10")])
def test_predecessors_within_each_window_agree_with_brute_force(frame, kind, days, first, last):
    """Budgets with gaps, patients listed under several pairs or twice under one, and long runs of invalid orders."""
    rng, m = random.Random(6), model(frame)
    patients = frame("patient_id int, client_id int, site_id int, type string",
                     [(1, 10, 20, "P"), (2, 10, 21, "P"), (3, 10, 20, "P"), (3, 10, 21, "P"), (4, 10, 22, "P"), (4, 10, 99, "P")])
    budgets = frame("client_id int, site_id int, sub_unit int, begin_yyyymm int, end_yyyymm int",
                    [(10, 20, None, 201601, None), (10, 21, 0, 201701, 201702), (10, 21, 0, 201704, 201704), (10, 22, 0, 201703, 201703)])
    orders = [(i, rng.randint(1, 4), 1, i, dt.datetime(2017, 1, 20) + dt.timedelta(hours=rng.randint(0, 2000)), "A") for i in range(1, 161)]
    orders = frame(ORDERS, orders)
    details = frame(DETAILS, [(i, None, SERVICE if rng.random() < 0.6 else DME) for i in range(1, 161)])
    opts = dict(kind=kind, days=days, first=first, last=last)
    got = rd.redelivery(orders, details, patients, budgets, m["equipment_lines"], block=2, **opts).collect()
    bad = {r.order_id for r in details.collect() if r.product_id == SERVICE}
    raw = rd.raw_orders(orders, patients, budgets, **opts).select("window_start", "patient_id", "site_id", "completed", "order_id").collect()
    want = []
    for w, p in {(r.window_start, r.patient_id) for r in raw}:
        pre, skipped = None, 0
        for r in sorted((r for r in raw if (r.window_start, r.patient_id) == (w, p)), key=lambda r: (r.completed, r.order_id)):
            want.append((str(w), r.order_id, pre, skipped))
            pre, skipped = (pre, skipped + 1) if r.order_id in bad else (r.order_id, 0)
    assert want and sorted(((str(r.window_start), r.order_id, r.pre_order_id, r.skipped) for r in got), key=str) == sorted(want, key=str)


def simulate(orders, bad, days=5):
    """Predecessor by chasing pointers; ties point at the lowest other id, cycles end without result."""
    by_id = {o[0]: o for o in orders}
    first = {}
    for o in orders:
        others = [p for p in orders if p[1] == o[1] and p[0] != o[0] and p[4] <= o[4]]
        first[o[0]] = min(others, key=lambda p: (-p[4].timestamp(), p[0]))[0] if others else None
    out = {}
    for o in orders:
        seen, p = {o[0]}, first[o[0]]
        while p is not None and p in bad and p not in seen:
            seen.add(p)
            p = first[p]
        out[o[0]] = "none" if p is not None and p in seen else p
    return out


@pytest.mark.parametrize("seed, block", [(1, 10 ** 6), (2, 10 ** 6), (3, 1), (4, 2)])
def test_predecessors_against_brute_force(frame, seed, block):
    rnd = random.Random(seed)
    orders = [(i, rnd.randint(1, 5), rnd.randint(1, 2), rnd.randint(1, 2), dt.datetime(2017, 3, rnd.randint(1, 6), rnd.choice([0, 0, 8]))) for i in range(1, 81)]
    bad = {o[0] for o in orders if rnd.random() < 0.5}
    details = [(o[0], None, SERVICE if o[0] in bad else DME) for o in orders]
    low = {r.order_id: (r.pre_order_id, r.note) for r in run(frame, orders, details, ties="lowest_id").collect()}
    for oid, want in simulate(orders, bad).items():
        pre, note = low[oid]
        assert pre == (None if want == "none" else want)
        if oid not in bad:
            assert (note == "NoValidPre") == (want == "none")
    strict = {r.order_id: (r.pre_order_id, r.skipped) for r in run(frame, orders, details, block=block).collect()}
    for o in orders:
        before = sorted((p for p in orders if p[1] == o[1] and (p[4], p[0]) < (o[4], o[0])), key=lambda p: (p[4], p[0]))
        good = [p for p in before if p[0] not in bad]
        n = len([p for p in before if not good or (p[4], p[0]) > (good[-1][4], good[-1][0])])
        assert strict[o[0]] == (good[-1][0] if good else None, n)


def test_every_order_has_one_note(frame):
    rnd = random.Random(9)
    orders = [(i, rnd.randint(1, 3), 1, 1, dt.datetime(2017, 3, rnd.randint(1, 9))) for i in range(1, 40)]
    df = run(frame, orders, [(o[0], None, DME) for o in orders])
    assert df.count() == df.select("window_start", "order_id").distinct().count() == 39
    assert df.filter("note is null").count() == 0


def test_elapsed_bands(frame):
    df = frame("m int, w int", [(0, 1), (1440, 1), (1441, 1), (10080, 1), (10081, 1), (5, 0)])
    r = df.agg(*elapsed_buckets("m", "w")).first().asDict()
    assert [r[f"n_{k * 24}h"] for k in range(1, 8)] == [2, 1, 0, 0, 0, 0, 1]


# ---- paired items

LINES = "order_id int, item_id int, check_out timestamp_ntz, check_in timestamp_ntz, other_status timestamp_ntz"
PAIR = "main_item int, sub_item int"


def pairs_of(frame, orders, lines, chosen, pairs=((9, 195),)):
    labelled = frame("order_id int, redelivery int, paired_count int", [(c, 1, 1) for c in chosen])
    return rd.paired_items(labelled, frame(ORDERS, [(*o, "A") for o in orders]), frame(LINES, lines), frame(PAIR, list(pairs)))


@pytest.mark.parametrize("lines, missed", [
    ([(2, 9, "2017-03-05 08:00:00", None)], 0),                       # main item on the same stop
    ([(1, 9, "2017-03-01 08:00:00", None)], 1),                       # earlier and still out
    ([(1, 9, "2017-03-01 08:00:00", "2017-03-02 08:00:00")], 0),      # earlier and returned
    ([], 0),                                                          # never
])
def test_pair_cases(frame, lines, missed):
    orders = [(1, 1, 1, 1, at("2017-03-01 09:00:00")), (2, 1, 1, 1, at("2017-03-05 09:00:00"))]
    rows = [(o, i, at(c), b and at(b), None) for o, i, c, b in lines] + [(2, 195, at("2017-03-05 08:00:00"), None, None)]
    assert tuples(pairs_of(frame, orders, rows, [2]), "order_id", "missed") == [(2, missed)]


@pytest.mark.parametrize("year, seed", [(2017, 5), (1965, 6), (1969, 7)])
def test_pairs_against_brute_force(frame, year, seed):
    rnd = random.Random(seed)
    day = lambda lo, hi: dt.datetime(year, 12, 20) + dt.timedelta(days=rnd.randint(lo, hi), hours=rnd.choice([0, 9]))
    orders = [(i, rnd.randint(1, 3), rnd.choice([1, 2, None]), 1, day(1, 20)) for i in range(1, 60)]
    pairs = [(9, 195), (10, 195), (50, 250)]
    lines = []
    for i in range(400):
        out = day(1, 20)
        back = out + dt.timedelta(days=rnd.randint(-2, 6)) if rnd.random() < 0.5 else None
        kind = rnd.random() < 0.5
        lines.append((rnd.randint(1, 59), rnd.choice([9, 10, 50, 195, 250]), out if rnd.random() < 0.95 else None, back if kind else None, None if kind else back))
    chosen = list(range(1, 60, 2))
    by_id = {o[0]: o for o in orders}
    far = dt.datetime(2999, 12, 31, 12)
    want = {}
    for o, item, out, _, _ in [l for l in lines if l[0] in chosen and l[1] in (195, 250)]:
        if out is None:
            want[(o, item, None)] = (0, 0)
            continue
        me, t = by_id[o], dt.datetime.combine(out.date(), dt.time())
        stop = prior = 0
        for mo, mi, mout, mb1, mb2 in lines:
            if (mi, item) not in pairs or by_id[mo][1] != me[1] or mout is None:
                continue
            other, back = by_id[mo], mb1 or mb2 or far
            same = other[4].date() == me[4].date() and None not in (me[2], other[2]) and other[2:4] == me[2:4]
            if same:
                stop += mout.date() <= me[4].date() and back >= t
            elif other[4].date() <= me[4].date():
                prior += mout <= t and back >= t
        want[(o, item, (out.date() - dt.date(1970, 1, 1)).days)] = (stop, prior)
    got = {(r.order_id, r.sub_item, r.out_day): (r.stop_count, r.prior_count) for r in pairs_of(frame, orders, lines, chosen, pairs).collect()}
    assert got == want and any(k[2] is None for k in want) and max(v[1] for v in want.values()) > 3


def test_summary_drops_unknown_states_and_fits_percentages(frame):
    m = model(frame)
    labelled = run(frame, [(1, 1, 1, 1, at("2017-03-01")), (2, 1, 1, 1, at("2017-03-02"))], [(1, None, DME), (2, None, DME)])
    loc = lambda state: frame("location_id int, name string, company_id int, region_id int, state string", [(10, "Hosp", 100, None, state), (20, "Site", 2, None, None)])
    comp = frame("id int, name string", [(2, "Own"), (100, "Hospice")])
    regions, states = frame("id int, name string", [(1, "North")]), frame("region_id int, state string", [(-1, "DE")])
    args = (comp, regions, states)
    out = rd.redelivery_summary(labelled, None, m["patients"], loc("DE"), *args)
    assert tuples(out, "month", "provider", "client", "region", "orders", "redeliveries", "n_24h", "pct_redelivery") == [
        ("March", "Own, Site", "Hosp", "DE Region", 2, 1, 1, out.first().pct_redelivery)]
    assert float(out.first().pct_redelivery) == 50
    assert rd.redelivery_summary(labelled, None, m["patients"], loc("ZZ"), *args).count() == 0
