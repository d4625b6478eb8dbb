import random

from pyspark.sql import functions as F

from conftest import at, tuples
from haulbook.functions.text import same_code
from haulbook.operators import history as h
from haulbook.plans import workflow as wf

LOG = "history_id int, order_id int, action string, at timestamp_ntz, user_id int"


def test_milestones_follow_ids_not_times(frame):
    log = frame(LOG, [
        (1, 7, "NOd", at("2017-01-01 08:00:00"), 1), (2, 7, "LVB", at("2017-01-01 08:20:00"), 2), (3, 7, "Rec", at("2017-01-01 08:10:00"), 1),
        (4, 7, "LVB", at("2017-01-01 08:15:00"), 3), (5, 7, "Sch", at("2017-01-01 08:30:00"), 4), (6, 7, "Sch", at("2017-01-01 08:25:00"), 5),
        (7, 7, "LVB", at("2017-01-01 09:00:00"), 6), (8, 8, "NOd", at("2017-01-02 08:00:00"), 1),
    ])
    assert tuples(h.milestone_ids(log), "order_id", "new_id", "received_id", "scheduled_id", "scheduled_by") == [(7, 1, 3, 6, 5), (8, 8, 8, None, None)]
    for parts in (1, 7):
        assert tuples(h.view_milestones(log.repartition(parts)), "order_id", "views_before", "first_view_id", "last_view_id", "first_view") == [
            (7, 2, 4, 4, at("2017-01-01 08:15:00")), (8, None, None, None, None)]


def test_first_per_key_ignores_case_and_breaks_ties_by_id(frame):
    same = at("2017-01-01 09:00:00")
    log = frame(LOG, [(1, 7, "NOd", at("2017-01-01 08:00:00"), 1), (3, 7, "Cmp", same, 3), (2, 7, "cmp", same, 2), (4, 7, "EnR", None, 9)])
    got = h.first_per_key(log, {"viewed": ~same_code("action", "Nod"), "done": same_code("action", "CMP"), "sent": same_code("action", "EnR")})
    assert tuples(got, "viewed_by", "done_by", "sent_by") == [(2, 2, None)]


def test_views_brute_force(frame):
    rnd = random.Random(3)
    rows = [(i, rnd.randint(1, 6), rnd.choice(["NOd", "Rec", "Sch", "LVB", "LVB", "EnR"]), at(f"2017-01-{rnd.randint(1, 28):02d}"), i % 5) for i in range(200)]
    want = []
    for o in range(1, 7):
        mine = [r for r in rows if r[1] == o]
        rec = max((r[0] for r in mine if r[2] in ("NOd", "Rec")), default=None)
        sch = max((r[0] for r in mine if r[2] == "Sch"), default=None)
        views = [r[0] for r in mine if r[2] == "LVB"]
        want.append((o, sum(v <= sch for v in views) or None, min((v for v in views if v >= rec), default=None)))
    for parts in (1, 7):
        assert tuples(h.view_milestones(frame(LOG, rows).repartition(parts)), "order_id", "views_before", "first_view_id") == want


def model(frame):
    return dict(
        patients=frame("patient_id int, client_id int, site_id int, address_id int, last_name string, first_name string, type string", [(1, 10, 20, 1, "Doe", "Jo", "P")]),
        locations=frame("location_id int, name string, company_id int, region_id int, state string, type string", [(10, "Hosp", 100, 1, "DE", "C"), (20, "Site", 2, None, None, "S")]),
        companies=frame("id int, name string, abbr string", [(100, "Hospice", "HO"), (2, "Own", "OW")]),
        users=frame("user_id int, user string, full string", [(1, "u1", "Ann"), (2, "u2", "Bob")]))


ORDERS = "order_id int, patient_id int, status string, type string, reason string, priority boolean, ordered_by int, stamp timestamp_ntz, received timestamp_ntz, scheduled timestamp_ntz"


def test_never_viewed_counts_as_met_unless_unknown(frame):
    m = model(frame)
    orders = frame(ORDERS, [(1, 1, "D", "D", "A", False, 1, at("2017-01-02 08:00:00"), at("2017-01-02 08:00:00"), at("2017-01-02 08:31:00")),
                            (2, 1, "R", "D", "A", True, 1, at("2017-01-02 08:00:00"), None, at("2017-01-02 08:05:00")),
                            (3, 1, "R", "D", "A", True, 1, at("2017-01-02 08:00:00"), None, None)])
    log = frame(LOG, [(1, 1, "NOd", at("2017-01-02 08:00:00"), 1), (2, 1, "Sch", at("2017-01-02 08:31:00"), 2), (3, 2, "NOd", at("2017-01-02 08:00:00"), 1),
                      (4, 2, "LVB", at("2017-01-02 08:16:00"), 2), (5, 2, "Sch", at("2017-01-02 08:20:00"), 2), (6, 3, "NOd", at("2017-01-02 08:00:00"), 1)])
    look = frame("group string, code string, name string", [("ORC", "A", "Ask")])
    run = lambda **o: wf.order_workflow(orders, log, m["patients"], m["locations"], m["companies"], m["users"], look, "2017-01-02", "2017-01-02", **o)
    cols = ("order_id", "received_metric_met", "scheduling_metric_met", "scheduling_variance", "viewed_by_name", "status_group")
    assert tuples(run(), *cols) == [(1, "Y", "N", 31, None, "DONE"), (2, "Y", "Y", None, "Bob", "RECV")]
    assert tuples(run(unknown=True), *cols[:3]) == [(1, None, "N"), (2, None, None)]
    v1 = run(clock="stamp")
    assert tuples(v1, "order_id", "received_metric_met", "view_variance", "time_to_schedule") == [(1, "Y", None, "0 00:31:00"), (2, "N", 16, "0 00:05:00")]


def test_dispatch_bands(frame):
    df = frame("m int", [(14,), (15,), (29,), (30,), (None,)])
    assert [r[0] for r in df.select(wf.dispatch_band(F.col("m"))).collect()] == ["<15", "NA", "NA", ">30", "NA"]


def test_assignment_shows_on_the_same_day_of_month(frame):
    m = model(frame)
    orders = frame(ORDERS, [(1, 1, "D", "D", "A", False, 1, at("2017-01-02 08:00:00"), None, at("2017-02-02 08:00:00")),
                            (2, 1, "D", "D", "A", False, 1, at("2017-01-02 08:00:00"), None, at("2017-01-03 08:00:00"))])
    log = frame(LOG, [(1, 1, "EnR", at("2017-02-02 09:00:00"), 2), (2, 2, "EnR", at("2017-01-03 09:00:00"), 2)])
    run = lambda **o: wf.workflow_activity(orders, log, m["patients"], m["locations"], m["users"], "2017-01-01", "2017-01-03", **o)
    assert tuples(run(), "order_id", "assigned_by") == [(1, "u2"), (2, None)]
    assert tuples(run(same_date=True), "order_id", "assigned_by") == [(1, None), (2, None)]
    assert tuples(run(truncate_to_date=True), "order_id", "created_to_viewed") == [(1, "31 00:00:00"), (2, "1 00:00:00")]
