import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import at, tuples
from haulbook.operators import aggregates as ag, ranking as rk, reshape as rs
from haulbook.plans import billing as b, channel as ch, client_orders as co, quality as q, service as sc, survey as sv


# ---- survey

def rolled(frame, **over):
    leaf = {"client_company": 1, "month": "March", "region_id": 7, "region_name": "Northeast 1", "client_id": 1, "site_id": 2,
            "site_name": "S", "client_name": "C"}
    counts = {c: 0 for c in sv.COUNTS} | {"xQ1": 4, "nQ1y": 1, "xQ4": 2, "nQ4m": 1, "nQ4f": 1}
    shares = {n: Decimal("0.900000") for n in sv.share_columns()}
    names = [*leaf, *counts, *shares]
    kinds = ["int", "string", "int", "string", "int", "int", "string", "string"] + ["bigint"] * len(counts) + ["decimal(9,6)"] * len(shares)
    rows = [tuple((leaf | counts | shares | o).values()) for o in over.get("rows", [{}, {"region_id": 8, "region_name": "South", "client_id": 3}])]
    df = frame(", ".join(f"{n} {k}" for n, k in zip(names, kinds)), rows)
    return rs.hierarchy_rollup(df, sv.COUNTS, ["client_company", "month"], ["region_id", "region_name"], sv.share_columns())


def test_rollup_keeps_leaf_shares_and_recomputes_above(frame):
    out = rolled(frame)
    assert tuples(out, "level", "region_name", "xQ1", "nQ1y", "pQ1") == [
        (10, "All", 8, 2, Decimal("0.250000")), (20, "Northeast 1", 4, 1, Decimal("0.250000")), (20, "South", 4, 1, Decimal("0.250000")),
        (40, "Northeast 1", 4, 1, Decimal("0.900000")), (40, "South", 4, 1, Decimal("0.900000"))]
    leaf, whole = out.filter("level = 40"), out.filter("level = 10")
    assert [leaf.agg(F.sum(c)).first()[0] for c in ("xQ1", "nQ4m")] == [whole.first()[c] for c in ("xQ1", "nQ4m")]


def test_subregions_get_a_parent(frame):
    out = rs.subregion_rollup(rolled(frame), sv.COUNTS, ["client_company", "month"], sv.share_columns(), ["Northeast"])
    assert tuples(out, "level", "region_id", "region_name", "xQ1") == [
        (10, 0, "All", 8), (20, -700000, "Northeast", 4), (20, 8, "South", 4), (30, 7, "Northeast 1", 4), (40, 7, "Northeast 1", 4), (40, 8, "South", 4)]


def test_question_rows(frame):
    rows = rs.questions_to_rows(rolled(frame).filter("level = 10"), ["level"])
    got = {r.question: (r.meet, r.fail, r.exceed) for r in rows.collect()}
    half, zero = Decimal("0.500000"), Decimal("0.000000")
    assert got["Equipment"] == (Decimal("0.250000"), Decimal("0.750000"), None)
    assert got["Instruction"] == (zero, Decimal("1.000000"), None)  # no answers: fail is 1
    assert got["Delivery Person"] == (half, half, zero) and len(got) == 6
    empty = {r.question: r.fail for r in rs.questions_to_rows(rolled(frame).filter("level = 10"), ["level"], null_when_empty=True).collect()}
    assert empty["Instruction"] is None and empty["Equipment"] == Decimal("0.750000")


def test_survey_counts(frame):
    results = frame("k int, result_id int, status string", [(1, 1, "C"), (1, 2, "U"), (1, 3, "Z"), (2, 4, "O")])
    answers = frame("k int, result_id int, question string, answer string", [(1, 1, "Q1", "y"), (1, 1, "Q4", "x"), (1, 1, "Q4", "?")])
    out = sv.survey_counts(results, answers, ["k"])
    assert tuples(out, "k", "total", "done", "usable", "no_contact", "opted_out", "xQ1", "nQ1y", "xQ4", "nQ4x", "pQ4x", "pQ2") == [
        (1, 2, 1, 1, 1, 0, 1, 1, 1, 1, Decimal("1.000000"), Decimal("0.000000")), (2, 1, 0, 0, 0, 1, 0, 0, 0, 0, Decimal("0.000000"), Decimal("0.000000"))]


# ---- quality

def test_inventory_percentages(frame):
    daily = frame("site_id int, count_due int, inventory_ref int, at timestamp_ntz", [
        (1, -1, 5, at("2017-03-01")), (1, -2, 6, at("2017-03-02")), (2, -1, None, at("2017-03-01")), (2, 3, 0, at("2017-03-01")), (3, 1, 1, at("2017-03-31 09:00:00"))])
    sites = frame("location_id int, name string, type string", [(1, "A", "S"), (2, "B", "C")])
    out = q.inventory_past_due(daily, sites, "2017-03-01", "2017-03-31")
    assert tuples(out, "site_id", "site_name", "past_due", "tracked", "items", "pct_past_due", "pct_tracked") == [
        (1, "A", 2, 2, 2, Decimal("100.00"), Decimal("100.00")), (2, None, 1, 0, 2, Decimal("0.00"), Decimal("0.00"))]
    assert q.inventory_past_due(daily, sites, "2017-03-01", "2017-03-31", upper="whole_day").count() == 3


def test_driver_accuracy(frame):
    orders = frame("order_id int, patient_id int, driver_id int, completed timestamp_ntz", [(i, 1, 5, at("2017-03-02")) for i in (1, 2, 3)] + [(4, 1, 6, at("2017-03-02"))])
    details = frame("order_id int, reference_order_id int, status string, serial_number string, o2_lot string, product_id int", [
        (1, None, "D", None, "x", 1), (1, None, "D", None, "x", 1), (1, 2, "D", "s", None, 1), (3, None, "?", None, None, 1), (4, None, "D", None, None, 1)])
    kit = frame("product_id int, client_id int, site_id int, serial_count int, o2_count int", [(1, 10, 20, 1, 1)])
    stats = frame("order_id int, " + ", ".join(f"{c} int" for c in q.CHECKS), [(2, 0, 0, 0, 0, 0, 0, 0), (3, 0, 0, 0, 0, 0, 0, 1)])
    out = q.driver_accuracy(orders, details, frame("patient_id int, client_id int, site_id int", [(1, 10, 20)]),
                            frame("location_id int, name string, company_id int", [(20, "Site", 2)]), kit, stats,
                            frame("user_id int, first string, last string", [(5, "Al", "Bo"), (6, "Cy", "Do")]),
                            frame("user_id int, role int", [(5, 17), (5, 17), (6, 3)]), "2017-03-01", "2017-03-31")
    assert tuples(out, "order_id", "serial_delivery", "oxygen_pickup", "missing_order_stat", "totally_accurate", "driver_name") == [
        (1, 2, 0, True, None, "Al Bo"), (2, 0, 1, False, 0, "Al Bo"), (3, 0, 0, False, 1, "Al Bo")]
    strict = q.accuracy_flags(out.drop("missing_order_stat", "totally_accurate").withColumn("has_stats", F.when(F.col("order_id") > 1, True)), True)
    assert tuples(strict, "order_id", "totally_accurate") == [(1, None), (2, 1), (3, 1)]


# ---- billing

def test_combined_types_need_every_member(frame):
    one = frame("contract_type string, id int", [("B&M", 1), (None, 2)])
    assert rs.combine_types(one).count() == 2
    two = frame("contract_type string, id int", [("B&M", 1), ("SWC", 2)])
    assert tuples(rs.combine_types(two), "contract_type", "id") == [("B&M", 1), ("B-S", 1), ("B-S", 2), ("SWC", 2)]
    assert rs.combine_types(two.unionByName(frame("contract_type string, id int", [("NET", 3)]))).count() == 3 + 2 + 2 + 2 + 3


def test_padding_and_top_with_ties(frame):
    df = frame("g string, item int, name string, total int", [("a", 1, "x", 5), ("a", 2, "y", 5), ("a", 3, "z", 9)])
    assert tuples(rk.top_n_per_group(df, ["g"], 2, "total", ["item"]), "item", "rank") == [(1, 2), (3, 1)]
    padded = rs.pad_to_n(df, ["g"], 5, "name", {"item": F.lit(0), "total": F.lit(0)})
    assert tuples(padded.filter("item = 0"), "name", "total") == [("Space Holder 1", 0), ("Space Holder 2", 0)]


def test_contract_pairs(frame):
    months = frame("yyyymm int", [(201701,), (201702,)])
    activity = frame("yyyymm int, client_id int, sub_unit int, site_id int", [(201701, 1, None, 5), (201701, 1, 9, 5), (201701, 2, None, 6), (201701, 1, 0, -1)])
    budgets = frame("budget_id int, client_id int, site_id int, sub_unit int, begin_yyyymm int, end_yyyymm int, contract_id int, network_type string",
                    [(100, 1, 5, None, 201601, None, 7, "N"), (101, 3, 6, None, 201702, 201712, 8, "X")])
    contracts = frame("contract_id int, owner_company int", [(7, 2), (8, 4)])
    locations = frame("location_id int, company_id int", [(5, 2), (6, 3)])
    out = b.contract_pairs(activity, budgets, contracts, locations, months)
    assert tuples(out, "yyyymm", "client_id", "sub_unit", "activity", "budget_id", "owner", "contract_type") == [
        (201701, 1, 0, 1, 100, 2, "B&M"), (201701, 1, 9, -1, 100, 2, "B&M"), (201701, 2, 0, 1, None, 2, "NET"),
        (201702, 1, 0, 0, 100, 2, "B&M"), (201702, 3, 0, 0, 101, 4, "SWC")]


def test_top_items_outputs(frame):
    items = frame("yyyymm int, client_id int, site_id int, item_id int, total decimal(19,4), contract_type string, region_id int, region_name string", [
        (201701, 1, 1, i, Decimal(t), "B&M", r, f"R{r}") for r, i, t in [(1, 1, 60), (1, 2, 40), (2, 1, 10), (2, 3, 90)]])
    names = frame("item_id int, name string", [(1, " Bed "), (2, "Chair"), (3, "Tank")])
    run = lambda scope: b.top_items(items, names, dt.date(2017, 1, 1), n=2, n_months=2, scope=scope)
    assert tuples(run("national"), "item", "m1_total", "m1_share", "m2_share") == [
        ("Bed   (1)", Decimal("70.0000"), Decimal("0.350"), Decimal("0.000")), ("Tank   (3)", Decimal("90.0000"), Decimal("0.900"), Decimal("0.000"))]
    assert tuples(run("by_region"), "region_name", "item_name", "m1_share") == [
        ("R1", "Bed", Decimal("0.600")), ("R1", "Tank", Decimal("0.000")), ("R2", "Bed", Decimal("0.100")), ("R2", "Tank", Decimal("0.900"))]
    assert tuples(run("regional"), "region_name", "item_name") == [("R1", "Bed"), ("R1", "Chair"), ("R2", "Bed"), ("R2", "Tank")]
    with pytest.raises(ValueError):
        run("galaxy")


def test_net_totals_drop_zero_sums(frame):
    df = frame("k int, total decimal(19,4)", [(1, Decimal(5)), (1, Decimal(-5)), (2, Decimal(0)), (3, Decimal(4)), (3, Decimal(0))])
    assert tuples(ag.net_nonzero_totals(df, ["k"], "total"), "k", "total", "records") == [(3, Decimal("4.0000"), 1)]


# ---- notes, item lists, service

def test_notes_in_parts_lose_nothing(frame):
    df = frame("k int, id int, note string", [(1, i, f"n{i}") for i in range(40)] + [(2, 7, "only"), (2, 8, None)])
    whole = {r.k: r.notes for r in ag.concat_notes(df, "k", "note", "id").collect()}
    assert whole == {1: ", ".join(f"n{i}" for i in range(40)), 2: "only"}
    parts = ag.concat_notes(df, "k", "note", "id", block=4, max_chars=30).orderBy("k", "part").collect()
    assert len([r for r in parts if r.k == 1]) > 2
    assert ", ".join(r.notes for r in parts if r.k == 1) == whole[1]


def test_item_list(frame):
    df = frame("order_id int, equipment_name string, status_name string", [(1, "Bed", "Delivered"), (1, "Bed", "Delivered"), (1, "Air", "Lost")])
    assert tuples(ag.item_list(df), "order_id", "item_list") == [(1, "{1x} Air[Lost], {2x} Bed[Delivered]")]


def test_idle_sites_and_company_total(frame):
    orders = frame("site_id int, service_call int, beds int, lal int", [(1, 1, 1, 0), (1, 1, 0, 0), (1, 0, 1, 1)])
    sites = frame("site_id int, site_name string", [(1, "A"), (2, "B")])
    out = ag.site_summary(orders, sites, ["beds", "lal"])
    assert tuples(out, "site_id", "orders", "service_calls", "beds", "lal", "other", "pct_beds", "pct_service_calls") == [
        (1, 3, 2, 1, 0, 1, "50.00%", "66.67%"), (2, None, None, None, None, None, None, None)]
    assert tuples(ag.company_summary(out, ["beds", "lal"]), "site_name", "orders", "service_calls", "pct_other") == [("All", 3, 2, "50.00%")]


def test_lateness(frame):
    df = frame("schedule_end timestamp_ntz, completed timestamp_ntz, priority boolean", [
        (at("2017-01-01 10:00:00"), at("2017-01-01 10:31:00"), True), (at("2017-01-01 10:00:00"), at("2017-01-01 10:30:59"), True),
        (at("2017-01-01 10:00:00"), at("2017-01-01 12:00:00"), None), (at("2017-01-01 10:00:00"), None, True)])
    assert [tuple(r) for r in sc.lateness(df).select("variance", "missed").collect()] == [(31, 1), (30, 0), (120, 0), (None, 0)]


def test_pickup_summary(frame):
    orders = frame("order_id int, patient_id int, status string, dme_id int, scheduled timestamp_ntz, schedule_end timestamp_ntz, completed timestamp_ntz", [
        (1, 1, "P", 1, at("2017-03-01"), at("2017-03-01"), at("2017-03-03 00:59:00")), (2, 1, "P", 1, at("2017-03-01"), at("2017-03-01"), at("2017-03-03 01:00:00")),
        (3, 1, "D", 1, at("2017-03-01"), at("2017-03-01"), at("2017-03-01")), (4, 2, "D", 1, at("2017-03-01"), at("2017-03-01"), at("2017-03-01"))])
    patients = frame("patient_id int, client_id int, site_id int, last_name string, first_name string", [(1, 10, 20, "Doe", "Jo"), (2, 11, 20, "Roe", "Al")])
    locations = frame("location_id int, company_id int", [(10, 7), (11, 8)])
    sel = co.client_orders(orders, patients, locations, "2017-03-01", "2017-03-31", client_company=7)
    assert tuple(co.pickup_summary(sel).first()) == (3, 2, 1)
    assert tuples(co.orders_by_patient(sel), "patient", "order_count") == [("Doe, Jo", 1)]
    assert co.client_orders(orders, patients, locations, "2017-03-01", "2017-03-31", dme_ids=[1], status="P", over_hours=48).count() == 1


def test_order_channel(frame):
    orders = frame("order_id int, patient_id int, status string, reason string, ordered_by int, stamp timestamp_ntz", [
        (i, 1, "D", "A", u, at("2017-03-01")) for i, u in ((1, 1), (2, 2), (3, 3), (4, 4))] + [(5, 1, "D", "X", 1, at("2017-03-01")), (6, 1, "Q", "A", 1, at("2017-03-01"))])
    locations = frame("location_id int, name string, company_id int, region_id int, state string, billing_mode string", [(10, "Hosp", 100, None, "NJ", "C"), (20, "Site", 2, None, None, "S")])
    users = frame("user_id int, type string, first string, full string", [(1, "D", "Al", "Al A"), (2, "C", "House", "H"), (3, "C", "Bo", "Bo B"), (4, "S", "Cy", "Cy C")])
    out = ch.order_channel(orders, frame("patient_id int, client_id int, site_id int", [(1, 10, 20)]), locations,
                           frame("id int, name string", [(100, "Hospice"), (2, "Own")]), frame("id int, name string", [(1, "North")]),
                           frame("region_id int, state string", [(-2, "NJ")]), users,
                           frame("user_id int, company_id int, location_id int, type string", [(1, 2, 20, "D"), (4, 100, 10, "H")]), "2017-03-01", "2017-03-31", house_name="house")
    assert tuples(out, "order_id", "phone", "system", "phone_network", "phone_own", "region_id", "region") == [
        (1, 1, 0, 0, 1, -2, "NJ Region"), (2, 1, 0, 1, 0, -2, "NJ Region"), (3, 0, 1, 0, 0, -2, "NJ Region"), (4, 1, 0, 1, 0, -2, "NJ Region")]


def test_lines_of_service_calls_are_found_once(spark, frame, tmp_path):
    stamp = dt.datetime(1997, 3, 1)
    frame("detail_id long, order_id long, product_id long", [(1, 1, 7), (2, 1, 8), (2, 1, 8), (3, 2, 7), (4, 2, 8)]).write.parquet(f"{tmp_path}/details")
    out = sc.service_call_orders(
        frame("order_id long, patient_id int, address_id int, reason string, stamp timestamp_ntz, completed timestamp_ntz", [(o, 5, 6, "A", stamp, stamp) for o in (1, 2)]),
        spark.read.parquet(f"{tmp_path}/details"), frame("detail_id long", [(2,), (3,)]), frame("order_id long, note string, note_id int", [(1, "b", 2), (1, "a", 1)]),
        frame("patient_id int, client_id int, site_id int, last_name string, first_name string", [(5, 10, 20, "L", "F")]),
        frame("location_id int, company_id int, name string", [(10, 3, "C"), (20, 2, "S")]), frame("product_id long, name string", [(7, "p7"), (8, "p8")]),
        frame("address_id int, street string, city string, state string, zip string", [(6, "s", "c", "st", "z")]), frame("code string, name string", [("A", "reason")]),
        "1997-01-01", "1997-12-31")
    assert tuples(out, "order_id", "detail_id", "product_name", "notes") == [(1, 2, "p8", "a, b"), (1, 2, "p8", "a, b"), (2, 3, "p7", None)]
    assert not [f for f in out.inputFiles() if f"{tmp_path}/details" in f]
