"""Service calls and service level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from haulbook.functions.dates import as_col, local_time, minutes_between, us_date
from haulbook.functions.numbers import yes_no
from haulbook.functions.text import driver_label, person_name, strip_breaks, strip_quotes
from haulbook.functions.windows import in_window
from haulbook.operators.aggregates import (
    CATEGORY_GROUPS, company_summary, concat_notes, first_part, flag_counts_per_key, latest_per_key, site_summary,
)
from haulbook.operators.filters import optional_filter, search_orders, status_group
from haulbook.operators.lookups import dedupe_lookup, join_code
from haulbook.operators.ranking import dynamic_sort, padded_id
from haulbook.sources.daytable import replace_days
from haulbook.sources.sinks import staged

# Labels and limits of the service-level report.
TYPE_NAMES = {"P": "PICKUP", "D": "DELIVERY", "E": "EXCHANGE"}
TYPE_CODES = {"P": "PU", "D": "DEL", "E": "EXCH"}
PLACE_NAMES = {
    "ACH": "ACH (Adult Care Home)",
    "AL": "AL (Assisted Living)",
    "LTC": "LTC (Long Term Care)",
    "RES": "Residence",
}
MISSED_AFTER = 30
SPECIALTY_ITEMS = [243, 244]
OWN_COMPANY = 2


# Columns of the dashboard that not every installation fills, by the table they come from; a table without one shows NULL.
PATIENT_COLUMNS = {"phone1": "string", "phone2": "string", "contact": "string", "infectious": "string"}
ADDRESS_COLUMNS = {"street2": "string", "state": "string", "zip": "string", "latitude": "double", "longitude": "double", "room": "string",
                   "bed": "string", "place_name": "string"}
USER_COLUMNS = {"user": "string", "phone_cell": "string", "phone_office": "string"}
ORDER_COLUMNS = {"completion_action": "int", "route_id": "bigint", "service_call": "boolean"}


def columns_or_null(df: DataFrame, wanted: dict[str, str]) -> list[Column]:
    return [F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in wanted.items()]


def label_of(c, labels: dict[str, str]) -> Column:
    pairs = [x for k, v in labels.items() for x in (F.lit(k), F.lit(v))]
    return F.element_at(F.create_map(*pairs), F.trim(as_col(c)))


def service_call_details(orders: DataFrame, item_lines: DataFrame, patients: DataFrame, locations: DataFrame,
                         companies: DataFrame, users: DataFrame, user_locations: DataFrame, levels: DataFrame,
                         lookup: DataFrame, notepads: DataFrame, addresses: DataFrame, start, end, *,
                         company: int = OWN_COMPANY, upper: str = "midnight",
                         groups: dict[str, list] = CATEGORY_GROUPS, service: Column | None = None) -> DataFrame:
    """Completed deliveries and pickups with Y/N flags by item category, names and cleaned notes.

    ``item_lines`` has order_id, category, item_name; ``levels`` code and name.
    """
    done = orders.filter(in_window("completed", start, end, upper))
    lines = item_lines.join(done.select("order_id"), "order_id", "left_semi")
    counts = flag_counts_per_key(lines, groups=groups, service=service)
    base = done.filter(F.trim("type").isin("D", "P") & F.trim("status").isin("D", "P")).select(
        "order_id", "patient_id", "completed", "driver_id", "ordered_by", "reason")
    site = (locations.filter(F.col("company_id") == company)
            .select(F.col("location_id").alias("site_id"), F.col("name").alias("_site"), F.col("company_id").alias("_d")))
    client = locations.select(F.col("location_id").alias("client_id"), F.col("name").alias("_client"), F.col("company_id").alias("_h"))
    firm = lambda k: companies.select(F.col("id").alias(k), F.col("abbr").alias(f"{k}_abbr"))
    driver = users.select(F.col("user_id").alias("driver_id"), person_name("last", "first").alias("driver"))
    orderer = users.select(F.col("user_id").alias("ordered_by"), person_name("last", "first", "middle").alias("ordered_by_name"))
    level = dedupe_lookup(levels, "code", "name").select(F.col("code").alias("_level"), F.col("name").alias("user_level"))
    home = (user_locations.filter(F.col("priority") == 1).groupBy(F.col("user_id").alias("ordered_by"))
            .agg(F.min("type").alias("_level")).join(level, "_level", "left").drop("_level"))
    out = (base.join(counts, "order_id")
           .join(patients.select("patient_id", "client_id", "site_id", "address_id"), "patient_id")
           .join(site, "site_id").join(client, "client_id").join(firm("_d"), "_d").join(firm("_h"), "_h")
           .join(addresses.select("address_id", "place"), "address_id")
           .join(driver, "driver_id", "left").join(orderer, "ordered_by", "left").join(home, "ordered_by", "left")
           .join(notepads.select("order_id", "note"), "order_id", "left"))
    out = join_code(out, lookup, "ORC", "reason", "reason_name")
    flags = {n: (F.col(n) > 0) for n in groups}
    other = sum((F.col(n) for n in groups), F.lit(0)) == 0
    return out.select(
        "site_id", F.concat("_d_abbr", F.lit(": "), "_site").alias("site"),
        F.concat("_h_abbr", F.lit(": "), "_client").alias("client"), "completed", "order_id",
        F.coalesce("driver", F.lit("")).alias("driver"), "ordered_by_name",
        F.coalesce("user_level", F.lit("Unknown")).alias("user_level"), "reason_name",
        F.coalesce("place", F.lit("Unknown")).alias("place"),
        yes_no(F.col("service_calls") > 0).alias("service_call"),
        *[yes_no(c).alias(n) for n, c in flags.items()], yes_no(other).alias("other"),
        strip_breaks("note").alias("notes"))


def summary_flags(details: DataFrame, groups: list[str] = list(CATEGORY_GROUPS)) -> DataFrame:
    """0/1 flags for the site summary from a details frame."""
    flag = lambda n: F.when(F.col(n) == "Y", 1).otherwise(0).alias(n)
    return details.select("site_id", flag("service_call"), *[flag(g) for g in groups])


def service_call_orders(orders: DataFrame, details: DataFrame, service_details: DataFrame, notes: DataFrame,
                        patients: DataFrame, locations: DataFrame, products: DataFrame, addresses: DataFrame,
                        reasons: DataFrame, start, end, *, company: int | None = OWN_COMPANY,
                        client_id: int | None = None, upper: str = "midnight", max_chars: int = 500_000_000) -> DataFrame:
    """Orders placed in the window that have service-call lines, one row per such line, with joined notes and product.

    ``notes`` is the first part of the joined notes and ``note_parts`` their number: a row stays one row however long
    they are. ``concat_notes`` gives the further parts.
    """
    lines = staged(details.join(service_details.select("detail_id"), "detail_id", "left_semi").select("order_id", "product_id", "detail_id"))
    placed = (orders.filter(in_window("stamp", start, end, upper)).join(lines, "order_id", "left_semi")
              .select("order_id", "patient_id", "address_id", "reason",
                      F.to_date("stamp").alias("ordered_on"), F.to_date("completed").alias("delivered_on")))
    joined = first_part(concat_notes(notes.join(placed.select("order_id"), "order_id", "left_semi"), "order_id", "note", "note_id",
                                     max_chars=max_chars), "order_id")
    site = locations.select(F.col("location_id").alias("site_id"), F.col("company_id").alias("_firm"))
    site = optional_filter(site, "_firm", company)
    client = optional_filter(locations.select(F.col("location_id").alias("client_id"), F.col("name").alias("client_name")),
                             "client_id", client_id)
    return (placed.join(lines, "order_id")
            .join(patients.select("patient_id", "client_id", "site_id", "last_name", "first_name"), "patient_id")
            .join(site, "site_id").join(client, "client_id").join(addresses, "address_id")
            .join(reasons.select(F.col("code").alias("reason"), F.col("name").alias("reason_name")), "reason")
            .join(products.select("product_id", F.col("name").alias("product_name")), "product_id")
            .join(joined, "order_id", "left")
            .select("client_name", "client_id", "order_id", person_name("last_name", "first_name").alias("patient"),
                    "street", "city", "state", "zip", "reason_name", "ordered_on", "delivered_on",
                    "notes", "note_parts", "product_name", "detail_id"))


def lateness(df: DataFrame, due: str = "schedule_end", done: str = "completed") -> DataFrame:
    """``variance``: minutes late; ``missed``: 1 for priority orders more than 30 minutes late."""
    late = minutes_between(due, done)
    return (df.withColumn("variance", late)
            .withColumn("missed", F.when((late > MISSED_AFTER) & F.coalesce("priority", F.lit(False)), 1).otherwise(0)))


def service_level(orders: DataFrame, patients: DataFrame, locations: DataFrame, regions_by_site: DataFrame,
                  zones: DataFrame, users: DataFrame, addresses: DataFrame, *, company: int = OWN_COMPANY,
                  site_id: int | None = None, **search) -> DataFrame:
    """Orders found by the search, of patients of the provider's sites, with lateness, labels and local times.

    ``search`` takes order_id, route, patient_id, last_name, date_mode, start, end,
    statuses, clients, drivers, priority. ``zones`` has site_id, zone and zone_abbr.
    """
    site = (locations.filter((F.col("company_id") == company) & (F.trim("type") == "S"))
            .select(F.col("location_id").alias("site_id"), F.col("name").alias("site_name")))
    site = optional_filter(site, "site_id", site_id)
    client = (locations.filter(F.trim("type") == "C")
              .select(F.col("location_id").alias("client_id"), F.col("name").alias("client_name")))
    full = F.concat("last_name", F.lit(", "), "first_name", F.lit(" "), F.coalesce("middle", F.lit("")))
    people = patients.select("patient_id", "client_id", "site_id", "last_name", full.alias("patient"),
                             "disabled", "torpid", "dup", *columns_or_null(patients, PATIENT_COLUMNS))
    found = search_orders(orders.drop("client_id", "site_id").join(people, "patient_id"), **search)
    region = regions_by_site.groupBy(F.col("site").alias("site_name")).agg(F.min("region").alias("region"))
    driver = users.select(F.col("user_id").alias("driver_id"), driver_label("first", "last").alias("driver"),
                          *[c.alias(f"driver_{n}") for c, n in zip(columns_or_null(users, USER_COLUMNS), ("user", "phone", "office_phone"))])
    place = addresses.select("address_id", strip_quotes("street").alias("street"), "city",
                             label_of("place", PLACE_NAMES).alias("place"), *columns_or_null(addresses, ADDRESS_COLUMNS))
    missing = [c for c in ORDER_COLUMNS if c not in found.columns]
    found = found.withColumns({c: F.lit(None).cast(ORDER_COLUMNS[c]) for c in missing}) if missing else found
    out = (found.join(site, "site_id").join(client, "client_id").join(region, "site_name", "left")
           .join(driver, "driver_id", "left").join(place, "address_id", "left").join(zones, "site_id", "left"))
    return (lateness(out).withColumn("status_group", status_group("status"))
            .withColumn("type_name", label_of("type", TYPE_NAMES)))


def replace_history(level: DataFrame, path: str, start, end) -> DataFrame:
    """Keep the rows of a ``service_level`` result in a history by scheduled day: those of the window replace its days.

    Orders of the result that are not scheduled in the window are left out, as the daily run is asked for one window.
    """
    return replace_days(level.filter(in_window("scheduled", start, end, "whole_day")), path, "scheduled", start, end)


DETAIL_SORTS = ["order_id", "type", "status", "stamp", "scheduled", "completed", "patient", "city", "client_name",
                "submitter", "driver", "route", "add_on_stop"]


def service_level_detail(level: DataFrame, notepads: DataFrame, route_stops: DataFrame, item_lines: DataFrame,
                         lookup: DataFrame, users: DataFrame, *, date_mode: int | None = 0, start=None, end=None,
                         sort: str | None = None, answers: DataFrame | None = None) -> DataFrame:
    """The wide dashboard rows of a ``service_level`` result, with local times, note and patient flags, in the asked order.

    The exact window is applied to local times, after the coarse search. A site without
    a zone shows its stamps unshifted. ``answers`` (order_id, answer_id) adds the number of an order's survey answer, its
    lowest where it has several.
    """
    shown = level
    if start is not None and date_mode in (0, None):
        low, high = F.lit(start).cast("timestamp_ntz"), F.lit(start if end is None else end).cast("timestamp_ntz")
        inside = local_time("scheduled", "zone", keep=True).between(low, high)
        if date_mode is None:
            for c in ("stamp", "completed"):
                inside = inside | F.col(c).between(low, high)
        shown = shown.filter(inside)
    stops = latest_per_key(route_stops, "order_id", "sequence_number")
    specialty = (item_lines.filter(F.col("item_id").isin(SPECIALTY_ITEMS)).groupBy("order_id")
                 .agg(F.count("*").alias("specialty_count")))
    viewer = users.groupBy(F.col("user").alias("last_viewed_by")).agg(
        F.min("last").alias("viewer_last"), F.min_by("first", "last").alias("viewer_first"))
    submitter = users.select(F.col("user_id").alias("ordered_by"), F.col("full").alias("submitter"))
    pad = notepads.select("order_id", "note_count", "last_update")
    out = (shown.join(stops, "order_id", "left").join(specialty, "order_id", "left").join(pad, "order_id", "left")
           .join(viewer, "last_viewed_by", "left").join(submitter, "ordered_by", "left"))
    if answers is None:
        out = out.withColumn("answer_id", F.lit(None).cast("long"))
    else:
        out = out.join(answers.groupBy("order_id").agg(F.min("answer_id").cast("long").alias("answer_id")), "order_id", "left")
    out = join_code(out, lookup, "ORC", "reason", "reason_name", default="O")
    infectious = F.when(F.col("infectious").isin("?", "0"), "").otherwise(F.ltrim("infectious"))
    seen = F.timestamp_add("SECOND", F.lit(1), F.coalesce("last_viewed", F.lit("1900-01-01").cast("timestamp_ntz")))
    here = lambda c: local_time(c, "zone", keep=True)
    flag = lambda cond: F.when(cond, 1).otherwise(0)
    out = out.select(
        "client_name", "order_id", "status", "status_group", label_of("type", TYPE_CODES).alias("type"),
        here("stamp").alias("stamp"), us_date(here("scheduled")).alias("scheduled_on"),
        here("completed").alias("completed"), here("disabled").alias("disabled"), "patient", "street", "street2", "city", "state", "zip",
        "phone1", "phone2", "contact", "place", "submitter", "patient_id", "driver", "driver_id", "driver_user", "driver_phone",
        "driver_office_phone", "answer_id", infectious.alias("infectious"), "latitude", "longitude", "room", "bed", "place_name",
        "completion_action", "route_id", "service_call", "note_count", "client_id", "site_id", "route_number",
        F.when(F.col("add_on_stop") == F.lit(False), "No").otherwise("Yes").alias("add_on_stop"), "last_viewed_by",
        here("last_viewed").alias("last_viewed"), F.coalesce("dup", F.lit(0)).alias("duplicate"),
        F.coalesce(F.trim("reason"), F.lit("O")).alias("reason"), "reason_name",
        flag(F.col("torpid").isNotNull()).alias("is_torpid"), flag(F.col("disabled").isNotNull()).alias("is_disabled"),
        flag(F.col("last_update") > seen).alias("new_note"), "site_name", "priority", "missed", "variance",
        here("scheduled").alias("schedule_start"), here("schedule_end").alias("schedule_end"), "zone_abbr",
        "sequence_number", F.coalesce("specialty_count", F.lit(0)).alias("specialty_count"),
        "viewer_last", "viewer_first")
    columns = {k: F.col(k) for k in DETAIL_SORTS if k in out.columns} | {
        "order_id": padded_id("order_id"), "scheduled": F.col("schedule_start"),
        "route": F.coalesce("sequence_number", "route_number").cast("string")}
    return dynamic_sort(out, sort, columns, "order_id")
