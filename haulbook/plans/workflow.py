"""Order workflow, dispatch time, workflow activity and the reconcile log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from haulbook.functions.dates import minutes_between, same_day_of_month, time_span
from haulbook.functions.numbers import yes_no
from haulbook.functions.text import person_name, same_code
from haulbook.functions.windows import in_window
from haulbook.operators.filters import exclude_user, status_group
from haulbook.operators.history import (
    COMPLETED, ENROUTE, NEW, RECONCILED, SCHEDULED, VIEWED, first_columns, first_per_key, milestone_columns,
    min_created, view_milestones,
)
from haulbook.operators.lookups import join_code, star_join
from haulbook.sources.sinks import staged

# Minutes allowed to the first view and to scheduling.
VIEW_LIMIT, SCHEDULE_LIMIT = 15, 30
OWN_COMPANY = 2


def _met(minutes: Column, limit: int, unknown: bool) -> Column:
    late = yes_no(minutes > limit, "N", "Y")
    return F.when(minutes.isNull(), F.lit(None).cast("string")).otherwise(late) if unknown else late


def _user(users: DataFrame, key: str, value: str, out: str) -> DataFrame:
    return users.select(F.col("user_id").alias(key), F.col(value).alias(out))


def _site_label() -> Column:
    return F.concat(F.col("site_name"), F.lit(" [ "), F.col("site_id").cast("string"), F.lit(" ]"))


def _client_label() -> Column:
    return F.concat(F.col("client_company_abbr"), F.lit(": "), F.col("client_name"))


def _orders_of(orders, patients, locations, companies, company) -> DataFrame:
    star = star_join(orders, patients.drop("address_id", "type"), locations, companies)
    return star.filter(F.col("site_company") == company)


def _named_status(orders: DataFrame, statuses: DataFrame | None) -> DataFrame:
    """Orders of a listed status with its name."""
    if statuses is None:
        return orders
    return orders.join(statuses.select(F.trim("status").alias("_code"), "status_name"), F.trim("status") == F.col("_code")).drop("_code")


def _status_name(statuses: DataFrame | None) -> list[Column]:
    return [] if statuses is None else [F.col("status_name")]


def order_workflow(orders: DataFrame, history: DataFrame, patients: DataFrame, locations: DataFrame,
                   companies: DataFrame, users: DataFrame, lookup: DataFrame, start, end, *,
                   company: int = OWN_COMPANY, clock: str = "received", upper: str = "whole_day",
                   unknown: bool = False, statuses: DataFrame | None = None) -> DataFrame:
    """Orders placed in the window with their view and scheduling times and whether both were in time.

    ``clock="received"`` counts from the received stamp. ``clock="stamp"`` counts views
    from the order stamp and scheduling from the received stamp or else the order
    stamp, and adds who completed it and the view variance. Never-viewed orders count
    as met unless ``unknown``. Orders never scheduled drop out. ``statuses`` (status, status_name) adds the name of
    the status and keeps orders of listed statuses only.
    """
    base = _orders_of(orders.filter(in_window("stamp", start, end, upper)), patients, locations, companies, company)
    base = staged(_named_status(base, statuses))
    log = history.join(base.select("order_id"), "order_id", "left_semi")
    people = first_columns({"viewed": same_code("action", VIEWED), "completed_log": same_code("action", COMPLETED)})
    marks = view_milestones(log, people).select(
        "order_id", "scheduled_by", "first_view", "views_before", "last_view", "viewed_by", "completed_log_by")
    received = "coalesce(received, stamp)"
    view_from, sched_from, span_from = {
        "received": ("received", "received", "received"),
        "stamp": ("stamp", received, received),
    }[clock]
    view_minutes = minutes_between(view_from, "first_view")
    sched_minutes = minutes_between(sched_from, "scheduled")
    out = (base.join(marks, "order_id")
           .join(_user(users, "scheduled_by", "full", "scheduled_by_name"), "scheduled_by")
           .join(_user(users, "ordered_by", "full", "ordered_by_name"), "ordered_by")
           .join(_user(users, "viewed_by", "full", "viewed_by_name"), "viewed_by", "left"))
    cols = [
        F.to_date("stamp").alias("placed"), F.col("order_id"), F.col("status"), *_status_name(statuses),
        status_group("status").alias("status_group"),
        F.when(F.col("priority"), "Yes").otherwise("No").alias("priority"),
        _site_label().alias("site"), _client_label().alias("client"), F.col("ordered_by_name"),
        F.col("received"), F.col("first_view"), F.col("viewed_by_name"),
        time_span(span_from, "first_view").alias("time_to_view"),
        _met(view_minutes, VIEW_LIMIT, unknown).alias("received_metric_met"),
        F.col("scheduled"), F.col("scheduled_by_name"),
        time_span(span_from, "scheduled").alias("time_to_schedule"),
        _met(sched_minutes, SCHEDULE_LIMIT, unknown).alias("scheduling_metric_met"),
        sched_minutes.alias("scheduling_variance"), F.col("views_before"), F.col("last_view"),
    ]
    if clock == "stamp":
        out = out.join(_user(users, "completed_log_by", "full", "completed_by_name"), "completed_log_by", "left")
        return out.select(*cols, F.col("completed_by_name"), view_minutes.alias("view_variance"))
    out = join_code(out, lookup, "ORC", "reason", "reason_name", how="inner")
    return out.select(*cols, F.col("reason_name"))


def time_to_dispatch(orders: DataFrame, history: DataFrame, patients: DataFrame, locations: DataFrame,
                     companies: DataFrame, users: DataFrame, day, *, annotations: DataFrame | None = None,
                     inventory_orders: DataFrame | None = None, company: int = OWN_COMPANY,
                     statuses: DataFrame | None = None) -> DataFrame:
    """Minutes from scheduling to dispatch.

    With annotations: orders scheduled and due on the day whose first sync fell on
    it; band ``<15``, ``>30`` (30 and above) or ``NA``. Without: orders due up to the
    next midnight that were sent out, with the text span from scheduling to
    departure and who completed them. ``statuses`` as for ``order_workflow``.
    """
    synced_mode = annotations is not None
    due = in_window("schedule_end", day, day, "whole_day")
    if synced_mode:
        due = due & in_window("scheduled", day, day, "whole_day")
    base = staged(_named_status(_orders_of(orders.filter(due), patients, locations, companies, company), statuses))
    log = history.join(base.select("order_id"), "order_id", "left_semi")
    done = first_columns({"done": same_code("action", COMPLETED)})
    marks = log.groupBy("order_id").agg(*milestone_columns(), *done).select("order_id", "scheduled_by", "enroute_by", "done_by")
    out = (base.join(marks, "order_id")
           .join(users.select(F.col("user_id").alias("scheduled_by")), "scheduled_by", "left_semi")
           .join(users.select(F.col("user_id").alias("ordered_by")), "ordered_by", "left_semi")
           .join(_user(users, "enroute_by", "full", "dispatched_by"), "enroute_by", "left"))
    cols = [
        F.to_date("schedule_end").alias("due"), F.col("order_id"), F.col("status"), *_status_name(statuses),
        F.when(F.col("priority"), "Yes").otherwise("No").alias("priority"),
        _client_label().alias("client"), _site_label().alias("site"),
        F.coalesce("enroute_count", F.lit(0)).alias("times_enroute"), F.col("dispatched_by"),
    ]
    if not synced_mode:
        out = (out.filter(F.col("enroute_count") != 0)
               .join(_user(users, "done_by", "user", "completed_by"), "done_by", "left"))
        return out.select(*cols, F.col("enroute"), time_span("scheduled", "enroute").alias("time_to_dispatch"),
                          F.col("completed"), F.col("completed_by"))
    synced = min_created(annotations, inventory_orders).filter(in_window("synced", day, day, "whole_day"))
    minutes = minutes_between("scheduled", "synced")
    return out.join(synced, "order_id").select(
        *cols, minutes.alias("minutes_to_dispatch"), F.col("scheduled"), F.col("synced"),
        dispatch_band(minutes).alias("variance"), F.col("add_on_stop"))


def dispatch_band(minutes: Column) -> Column:
    return F.when(minutes < 15, "<15").when(minutes >= 30, ">30").otherwise("NA")


def activity_by_order(history: DataFrame, level: str = "reconcile") -> DataFrame:
    """Per order the first view (first action that is not new), scheduling and en-route, with users;
    level ``reconcile`` adds completion and reconciliation."""
    acts = {"viewed": ~same_code("action", NEW), "scheduled": same_code("action", SCHEDULED),
            "assigned": same_code("action", ENROUTE)}
    if level == "reconcile":
        acts |= {"completed": same_code("action", COMPLETED), "reconciled": same_code("action", RECONCILED)}
    return first_per_key(history, acts)


def workflow_activity(orders: DataFrame, history: DataFrame, patients: DataFrame, locations: DataFrame,
                      users: DataFrame, start, end, *, level: str = "reconcile", upper: str = "midnight",
                      same_date: bool = False, truncate_to_date: bool = False) -> DataFrame:
    """When and by whom each order of the window was viewed, scheduled, assigned (and completed, reconciled).

    Assignment shows only if order and due date share the day of month.
    ``truncate_to_date`` drops the time of day before the spans are worked out.
    """
    base = orders.filter(in_window("stamp", start, end, upper)).select(
        "order_id", "patient_id", "type", "stamp", F.col("scheduled").alias("due"))
    acts = activity_by_order(history.join(base.select("order_id"), "order_id", "left_semi"), level)
    # Names are looked up for the few acting users of an order, not for every row of the log.
    for c in [c for c in acts.columns if c.endswith("_by")]:
        acts = acts.withColumnRenamed(c, "_who").join(_user(users, "_who", "user", c), "_who", "left").drop("_who")
    clients = (locations.filter(F.trim("type") == "C")
               .select(F.col("location_id").alias("client_id"), F.col("name").alias("company_name")))
    out = (base.join(patients.select("patient_id", "client_id", "last_name", "first_name"), "patient_id")
           .join(clients, "client_id", "left").join(acts, "order_id", "left"))
    same_day = same_day_of_month("stamp", "due", same_date)
    for c in ("assigned_at", "assigned_by"):
        out = out.withColumn(c, F.when(same_day, F.col(c)))
    steps = ["viewed", "scheduled", "assigned"] + (["completed", "reconciled"] if level == "reconcile" else [])
    stamps = ["stamp"] + [f"{s}_at" for s in steps]
    if truncate_to_date:
        for c in stamps:
            out = out.withColumn(c, F.to_date(c).cast("timestamp_ntz"))
    spans = [time_span("stamp", "viewed_at").alias("created_to_viewed"),
             time_span("scheduled_at", "assigned_at").alias("scheduled_to_assigned"),
             time_span("viewed_at", "scheduled_at").alias("viewed_to_scheduled")]
    if level == "reconcile":
        spans.append(time_span("completed_at", "reconciled_at").alias("complete_to_reconciled"))
    return out.select("company_name", "order_id", F.col("type").alias("order_type"),
                      person_name("last_name", "first_name").alias("patient"), "stamp",
                      *[f"{s}_{x}" for s in steps for x in ("at", "by")], *spans)


def reconcile_log(orders: DataFrame, history: DataFrame, patients: DataFrame, budgets: DataFrame,
                  locations: DataFrame, companies: DataFrame, users: DataFrame, lookup: DataFrame, start, end, *,
                  providers: list[int] | None = None, skip_user: int | None = None,
                  upper: str = "midnight") -> DataFrame:
    """Reconcile actions on orders placed in the window, with reason and warehouse, for the given providers.

    An order counts if its client and site share a budget, once however many they share.
    """
    base = orders.filter(in_window("stamp", start, end, upper))
    if skip_user is not None:
        base = exclude_user(base, skip_user)
    base = base.select("order_id", "patient_id", "type", "reason")
    site = locations.select(F.col("location_id").alias("site_id"), F.col("name").alias("warehouse"),
                            F.col("company_id").alias("provider"))
    if providers is not None:
        site = site.filter(F.col("provider").isin(providers))
    client = (locations.select(F.col("location_id").alias("client_id"), F.col("name").alias("client_name"),
                               F.col("company_id").alias("_company"))
              .join(companies.select(F.col("id").alias("_company"), F.col("name").alias("company_name")), "_company"))
    done = history.filter(same_code("action", RECONCILED)).select("order_id", "user_id", F.col("at").alias("reconciled_at"))
    # Patients of budgeted pairs and sites of the wanted providers are settled before the log is read.
    people = (patients.select("patient_id", "client_id", "site_id")
              .join(budgets.select("client_id", "site_id").distinct(), ["client_id", "site_id"]).join(site, "site_id"))
    out = (done.join(base.join(people, "patient_id"), "order_id").join(client, "client_id")
           .join(users.select("user_id", "user", "full"), "user_id"))
    out = join_code(out, lookup, "ORC", "reason", "reason_name")
    kind = F.when(F.trim("type") == "D", "Delivery").when(F.trim("type") == "P", "Pick Up").otherwise("Unknown")
    return out.select(F.lit("Reconciled").alias("entry"), "company_name", "client_name", "user",
                      F.col("full").alias("user_full"), "order_id", "reconciled_at", kind.alias("order_type"),
                      F.coalesce("reason_name", F.lit("")).alias("reason"), "warehouse")
