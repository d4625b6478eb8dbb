"""Rules that the given tables do not reach: each test fails on a plan without the rule."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import at, tuples
from haulbook.operators import aggregates as ag, filters as f, lookups as k, ranking as rk
from haulbook.plans import billing as b, quality as q, service as sc, workflow as wf
from haulbook.plans.redelivery import order_contents
from haulbook.sources import tables

BUDGETS = "budget_id int, client_id int, site_id int, sub_unit int, begin_yyyymm int, end_yyyymm int, contract_id int, network_type string"


def test_own_company_is_a_parameter(frame):
    """Owner and type follow the company that asks."""
    activity = frame("yyyymm int, client_id int, sub_unit int, site_id int", [(201701, 1, None, 5), (201701, 2, None, 6)])
    budgets = frame(BUDGETS, [(100, 1, 5, None, 201601, None, 7, "N"), (101, 2, 6, None, 201601, None, 9, "N")])
    args = (activity, budgets, frame("contract_id int, owner_company int", [(7, 4)]), frame("location_id int, company_id int", [(5, 3), (6, 4)]),
            frame("yyyymm int", [(201701,)]))
    shown = lambda own: tuples(b.contract_pairs(*args, own_company=own), "client_id", "owner", "contract_type")
    assert shown(2) == [(1, 4, "SWC"), (2, 2, "NET")]
    assert shown(4) == [(1, 4, "NET"), (2, 4, "B&M")]


def test_budget_months_with_gaps_and_odd_ranges(frame):
    budgets = frame(BUDGETS, [(1, 1, 1, None, 201611, 201702, 7, "N"), (2, 1, 2, None, 201612, None, 7, "N"), (3, 1, 3, 4, 201705, 201701, 7, "N"),
                              (4, 1, 4, 0, None, 201712, 7, "N"), (5, 1, 5, 0, 190001, 999912, 7, "N")])
    months = frame("yyyymm int", [(201612,), (201702,), (201702,), (201812,), (None,)])
    got = tuples(b.budget_months(budgets, months), "budget_id", "yyyymm", "sub_unit")
    assert got == sorted([(1, 201612, 0), (1, 201702, 0)] + [(i, m, 0) for i in (2, 5) for m in (201612, 201702, 201812)], key=str)
    assert b.budget_months(budgets, frame("yyyymm int", [])).count() == 0


def test_wide_amounts_keep_their_share(frame):
    big = Decimal("60000000000000000.0000")
    df = frame("g int, v decimal(28,4)", [(1, big), (1, big * 3)])
    assert [str(r.share) for r in rk.share_of_group(df, ["g"], "v").orderBy("v").collect()] == ["0.250", "0.750"]


def test_two_budgets_of_a_pair_are_one_reconcile_row(frame):
    orders = frame("order_id int, patient_id int, type string, reason string, stamp timestamp_ntz, ordered_by int", [(1, 1, "D", "A", at("2017-01-02"), 9)])
    log = frame("history_id int, order_id int, action string, at timestamp_ntz, user_id int", [(1, 1, "Rcd", at("2017-01-03"), 5)])
    out = wf.reconcile_log(orders, log, frame("patient_id int, client_id int, site_id int", [(1, 10, 20)]),
                           frame("client_id int, site_id int", [(10, 20), (10, 20)]),
                           frame("location_id int, name string, company_id int", [(10, "C", 100), (20, "S", 2)]),
                           frame("id int, name string", [(100, "H")]), frame("user_id int, user string, full string", [(5, "u", "U")]),
                           frame("group string, code string, name string", [("ORC", "A", "Any")]), "2017-01-01", "2017-01-31")
    assert out.count() == 1


def test_optional_filters_and_null(frame):
    df = frame("id int, c int", [(1, 5), (2, None)])
    assert tuples(f.optional_filter(df, "c", None), "id") == [(1,)] and tuples(f.optional_filter(df, "c", 5), "id") == [(1,)]


@pytest.mark.parametrize("opts, want", [
    ({}, [1, 2, 3, 4]), ({"today": "2017-03-05"}, [1, 2]), ({"today": "2017-03-05", "start": "2017-03-06"}, [1, 3]),
    ({"today": "2017-03-05", "date_mode": 1}, [1, 2, 3, 4]), ({"today": "2017-03-07", "statuses": "!", "start": "2017-03-05"}, [1]),
    ({"today": "2017-03-07", "statuses": "!"}, [1, 4]), ({"today": "2017-03-05", "order_id": 4}, [4])])
def test_search_defaults(frame, opts, want):
    """Without dates and mode a search is about today; for open orders it goes back to the first day."""
    T = lambda d: at(f"2017-03-{d:02d}")
    df = frame("order_id int, patient_id int, route_number int, last_name string, client_id int, status string, scheduled timestamp_ntz, stamp timestamp_ntz, "
               "completed timestamp_ntz, reconciled timestamp_ntz, completion_action int, priority boolean, driver_id int",
               [(1, 1, 1, "A", 1, "D", T(5), T(1), T(6), None, None, False, 1), (2, 1, 1, "A", 1, "D", T(1), T(5), T(9), T(9), None, False, 1),
                (3, 1, 1, "A", 1, "D", T(9), T(9), T(6), T(6), None, False, 1), (4, 1, 1, "A", 1, "D", at("2016-03-05"), T(1), T(2), None, None, False, 1)])
    assert [r.order_id for r in f.search_orders(df, **opts).orderBy("order_id").collect()] == want


def test_tables_show_the_columns_of_their_files(frame, spark, tmp_path):
    path = str(tmp_path)
    frame("a int", [(1,)]).write.parquet(f"{path}/region.parquet")
    assert tables.load_tables(spark, path, ["region"])["region"].columns == ["a"]
    frame("a int, b int", [(1, 2)]).write.mode("overwrite").parquet(f"{path}/region.parquet")
    assert tables.load_tables(spark, path, ["region"])["region"].columns == ["a", "b"]


def test_rows_without_a_group_are_kept_and_spread(frame):
    df = frame("id int, g int, h int", [(1, 7, 1), (2, 7, 1), (3, None, 1), (4, 7, None), (5, None, None), (6, 8, 1)])
    out = ag.keep_first_of_group(df, ["g", "h"], "id", "keep")
    assert tuples(out, "id", "keep") == [(1, 1), (2, 0), (3, 1), (4, 1), (5, 1), (6, 1)]
    assert "_spread" in out._jdf.queryExecution().optimizedPlan().toString()
    many = frame("id int, g int", [(i, None) for i in range(500)] + [(900, 1)])
    joined = k.spread_left_join(many, frame("g int, v int", [(1, 5)]), ["g"], "id")
    assert tuples(joined.filter("g = 1"), "id", "v") == [(900, 5)] and joined.filter("v is null").count() == 500


def test_pickups_are_counted_without_a_product(frame):
    keys = frame("order_id int, client_id int, site_id int", [(1, 10, 20), (2, 10, 20), (3, 10, 20)])
    details = frame("order_id int, reference_order_id int, product_id int", [(1, None, 5), (1, 2, 5), (None, 2, 5), (None, 3, None), (1, None, None), (1, None, 99)])
    kinds = frame("product_id int, equipment_id int, item_id int, oxygen boolean, disposable boolean", [(5, 50, 500, False, False)])
    out = order_contents(keys, details, kinds, None, None)
    assert tuples(out.filter("order_id < 9"), "order_id", "dme_count", "pickup_count") == [(1, 2, 0), (2, 0, 2), (3, 0, 1)]


def test_names_are_looked_up_after_the_log_is_summed(frame):
    log = frame("history_id int, order_id int, action string, at timestamp_ntz, user_id int",
                [(1, 1, "NOd", at("2017-01-02"), 5), (2, 1, "LVB", at("2017-01-02 01:00:00"), 6), (3, 1, "Sch", at("2017-01-02 02:00:00"), 77)])
    out = wf.workflow_activity(frame("order_id int, patient_id int, type string, stamp timestamp_ntz, scheduled timestamp_ntz", [(1, 1, "D", at("2017-01-02"), None)]), log,
                               frame("patient_id int, client_id int, last_name string, first_name string", [(1, 10, "L", "F")]),
                               frame("location_id int, name string, type string", [(10, "C", "C")]), frame("user_id int, user string", [(5, "five"), (6, "six")]),
                               "2017-01-01", "2017-01-31")
    assert tuples(out, "viewed_by", "scheduled_by", "completed_by") == [("six", None, None)]


def test_status_names_and_unlisted_statuses(frame):
    orders = frame("order_id int, status string", [(1, "D "), (2, "X")])
    named = wf._named_status(orders, frame("status string, status_name string", [("D", "Done")]))
    assert tuples(named, "order_id", "status_name") == [(1, "Done")] and wf._named_status(orders, None).count() == 2


def test_notes_of_any_length_leave_one_row(frame):
    parts = ag.concat_notes(frame("k int, id int, note string", [(1, i, "abcdef") for i in range(9)] + [(2, 1, "x")]), "k", "note", "id", block=2, max_chars=8)
    assert parts.filter("k = 1").count() > 2
    assert tuples(ag.first_part(parts, "k"), "k", "note_parts") == [(1, parts.filter("k = 1").count()), (2, 1)]


def test_accuracy_counts_both_sides_of_a_line(frame):
    lines = [("G", None, "x", 5, 1, 2), ("G", None, None, 5, None, 1), ("D", "s", None, 5, 2, None)]
    out = q.driver_accuracy(
        frame("order_id int, patient_id int, driver_id int, completed timestamp_ntz", [(1, 1, 3, at("2017-01-02")), (2, 1, 3, at("2017-01-03"))]),
        frame("status string, serial_number string, o2_lot string, product_id int, order_id int, reference_order_id int", lines),
        frame("patient_id int, client_id int, site_id int", [(1, 10, 20)]), frame("location_id int, company_id int, name string", [(20, 2, "S")]),
        frame("product_id int, client_id int, site_id int, serial_count int, o2_count int", [(5, 10, 20, 1, 1)]),
        frame("order_id int, " + ", ".join(f"{n} int" for n in q.CHECKS), []), frame("user_id int, first string, last string", [(3, "A", "B")]),
        frame("user_id int, role int", [(3, 17)]), "2017-01-01", "2017-01-31")
    assert tuples(out, "order_id", "serial_delivery", "oxygen_delivery", "serial_pickup", "oxygen_pickup") == [(1, 1, 0, 1, 1), (2, 0, 1, 1, 0)]


def test_dashboard_columns_without_a_source_are_null(frame):
    df = frame("a int, phone1 string", [(1, "x")])
    assert tuples(df.select(*sc.columns_or_null(df, sc.PATIENT_COLUMNS)), "phone1", "phone2", "infectious") == [("x", None, None)]


def test_site_without_a_zone_shows_its_stamps(frame):
    level = frame("order_id int, site_id int, zone string, zone_abbr string, stamp timestamp_ntz", [(1, 1, None, None, at("2017-01-02 03:00:00")), (2, 2, "America/New_York", "ET", at("2017-01-02 03:00:00"))])
    shown = level.select("order_id", sc.local_time("stamp", "zone", keep=True).alias("here"))
    assert tuples(shown, "order_id", "here") == [(1, at("2017-01-02 03:00:00")), (2, at("2017-01-01 22:00:00"))]
    assert dt.datetime(2017, 1, 2) < shown.filter("order_id = 1").first().here
