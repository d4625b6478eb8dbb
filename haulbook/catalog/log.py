"""Action-log operators and the order workflow reports over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulbook.functions.text import same_code
from haulbook.operators import history as h
from haulbook.plans import workflow as wf

from .registry import day, query, span, stamp
from .roles import Roles, with_roles

H = with_roles("r_history")

MARKS = """marks as (select order_id, max(case when action = 'NOd' then history_id end) new_id,
  max(case when action in ('NOd', 'Rec') then history_id end) received_id,
  max(case when action = 'Sch' then history_id end) scheduled_id,
  arg_max(user_id, case when action = 'Sch' then history_id end) scheduled_by,
  max(case when action = 'EnR' then history_id end) enroute_id,
  arg_max(user_id, case when action = 'EnR' then history_id end) enroute_by from r_history group by 1)"""

VIEWS = """views as (select order_id, nullif(count(case when history_id <= scheduled_id then 1 end), 0) views_before,
  min(case when history_id >= received_id then history_id end) first_view_id,
  arg_min("at", case when history_id >= received_id then history_id end) first_view,
  max(case when history_id <= scheduled_id then history_id end) last_view_id,
  arg_max("at", case when history_id <= scheduled_id then history_id end) last_view
  from r_history join marks using (order_id) where action = 'LVB' group by 1)"""

VIEW_SQL = f"{H}, {MARKS}, {VIEWS} select {{}} from marks left join views using (order_id)"


def _h(spark, path):
    return Roles(spark, path).history()


@query("milestone_ids", f"{H}, {MARKS} select * from marks")
def _(spark, path):
    return h.milestone_ids(_h(spark, path))


@query("views_before", VIEW_SQL.format("order_id, scheduled_id, views_before"))
def _(spark, path):
    return h.views_before(_h(spark, path))


@query("first_view_after", VIEW_SQL.format(f"order_id, received_id, first_view_id, {stamp('first_view')} as first_view"))
def _(spark, path):
    return h.first_view_after(_h(spark, path))


@query("last_view_before", VIEW_SQL.format(f"order_id, scheduled_id, last_view_id, {stamp('last_view')} as last_view"))
def _(spark, path):
    return h.last_view_before(_h(spark, path))


@query("views_before_salted", VIEW_SQL.format("order_id, scheduled_id, views_before"))
def _(spark, path):
    """The same over a log that comes in many small parts."""
    return h.views_before(_h(spark, path).repartition(64, F.xxhash64("history_id")))


@query("first_per_key", f"""{H} select order_id, {stamp("min(case when action <> 'NOd' then at end)")} as viewed_at,
arg_min(user_id, case when action <> 'NOd' then history_id end) as viewed_by,
{stamp("min(case when action = 'Cmp' then at end)")} as completed_at,
arg_min(user_id, case when action = 'Cmp' then history_id end) as completed_by from r_history group by 1""".replace(" at end", ' "at" end'))
def _(spark, path):
    return h.first_per_key(_h(spark, path), {"viewed": ~same_code("action", "Nod"), "completed": same_code("action", "CMP")})


@query("min_created", f"""select o_custkey as order_id, {stamp('min(l_shipdate)')} as synced from lineitem join orders on o_orderkey = l_orderkey
where l_linenumber = 4 and l_returnflag = 'A' group by 1""")
def _(spark, path):
    t = Roles(spark, path).t
    notes = t["lineitem"].select(F.col("l_orderkey").alias("item_id"), F.when(F.col("l_returnflag") == "A", 8).otherwise(1).alias("item_type"),
                                 F.col("l_linenumber").alias("annotation_type"), F.col("l_shipdate").alias("created"))
    links = t["orders"].select(F.col("o_orderkey").alias("inventory_order_id"), F.col("o_custkey").alias("order_id"))
    return h.min_created(notes, links)


PEOPLE = """people as (select order_id, arg_min(user_id, case when action = 'LVB' then history_id end) viewed_by,
  arg_min(user_id, case when action = 'Cmp' then history_id end) done_by from r_history group by 1)"""

STAR = """star as (select o.*, s.name site_name, p.site_id, p.client_id, c.name client_name, h.abbr, p.last_name, p.first_name
  from r_logged o join r_patients p using (patient_id) join r_locations s on s.location_id = p.site_id
  join r_locations c on c.location_id = p.client_id join r_companies h on h.id = c.company_id where s.company_id = 2)"""

WORKFLOW = with_roles("r_statuses", "r_logged", "r_patients", "r_locations", "r_companies", "r_users", "r_history") + f", {MARKS}, {VIEWS}, {PEOPLE}, {STAR}"


def _workflow_sql(clock):
    start = "received" if clock == "received" else "stamp"
    sched = "received" if clock == "received" else "coalesce(received, stamp)"
    extra = ("left(o_name, 200) as reason_name" if clock == "received" else
             f"ud.\"full\" as completed_by_name, date_diff('minute', {start}, first_view) as view_variance")
    reason = ("join (select distinct left(o_orderpriority, 1) code, o_orderpriority o_name from orders) r on r.code = star.reason"
              if clock == "received" else "left join r_users ud on ud.user_id = people.done_by")
    return f"""{WORKFLOW}
select {day('stamp')} as placed, order_id, status, status_name,
 case status when 'D' then 'DONE' when 'R' then 'RECV' end as status_group, case when priority then 'Yes' else 'No' end as priority,
 site_name || ' [ ' || site_id || ' ]' as site, abbr || ': ' || client_name as client, uo."full" as ordered_by_name,
 {stamp('received')} as received, {stamp('first_view')} as first_view, uv."full" as viewed_by_name,
 {span(sched, 'first_view')} as time_to_view,
 case when date_diff('minute', {start}, first_view) > 15 then 'N' else 'Y' end as received_metric_met,
 {stamp('scheduled')} as scheduled, us."full" as scheduled_by_name, {span(sched, 'scheduled')} as time_to_schedule,
 case when date_diff('minute', {sched}, scheduled) > 30 then 'N' else 'Y' end as scheduling_metric_met,
 date_diff('minute', {sched}, scheduled) as scheduling_variance, views_before, {stamp('last_view')} as last_view, {extra}
from star join r_statuses using (status) join marks using (order_id) left join views using (order_id) left join people using (order_id)
join r_users us on us.user_id = scheduled_by join r_users uo on uo.user_id = ordered_by left join r_users uv on uv.user_id = viewed_by
{reason} where stamp >= '2024-01-01' and stamp < '2024-02-01'"""


def _workflow(spark, path, clock):
    r = Roles(spark, path)
    return wf.order_workflow(r.logged_orders(), r.history(), r.patients(), r.locations(), r.companies(), r.users(), r.lookup(),
                             "2024-01-01", "2024-01-31", clock=clock, statuses=r.statuses())


@query("order_workflow", _workflow_sql("received"))
def _(spark, path):
    return _workflow(spark, path, "received")


@query("order_workflow_v1", _workflow_sql("stamp"))
def _(spark, path):
    return _workflow(spark, path, "stamp")


DISPATCH_COLS = f"""{day('schedule_end')} as due, order_id, status, status_name, case when priority then 'Yes' else 'No' end as priority,
 abbr || ': ' || client_name as client, site_name || ' [ ' || site_id || ' ]' as site, enroute_count as times_enroute, ue."full" as dispatched_by"""


@query("time_to_dispatch", f"""{WORKFLOW}, sync as (select user_id order_id, min(ts) synced from events where event_type = 'error' group by 1)
select {DISPATCH_COLS}, date_diff('minute', scheduled, synced) as minutes_to_dispatch, {stamp('scheduled')} as scheduled, {stamp('synced')} as synced,
 case when date_diff('minute', scheduled, synced) < 15 then '<15' when date_diff('minute', scheduled, synced) >= 30 then '>30' else 'NA' end as variance,
 cast(add_on_stop as int) as add_on_stop
from star join r_statuses using (status) join marks using (order_id) join sync using (order_id) join r_users us on us.user_id = scheduled_by
left join r_users ue on ue.user_id = enroute_by where scheduled::date = '2024-01-01' and synced::date = '2024-01-01'""")
def _(spark, path):
    r = Roles(spark, path)
    e = r.t["events"]
    notes = e.filter(F.col("event_type") == "error").select(F.col("event_id").alias("item_id"), F.lit(8).alias("item_type"),
                                                            F.lit(4).alias("annotation_type"), F.col("ts").alias("created"))
    links = e.select(F.col("event_id").alias("inventory_order_id"), F.col("user_id").alias("order_id"))
    out = wf.time_to_dispatch(r.logged_orders(), r.history(), r.patients(), r.locations(), r.companies(), r.users(), "2024-01-01",
                              annotations=notes, inventory_orders=links, statuses=r.statuses())
    return out.withColumn("add_on_stop", F.col("add_on_stop").cast("int"))


@query("time_to_dispatch_v1", f"""{WORKFLOW}
select {DISPATCH_COLS}, {stamp('enroute')} as enroute, {span('scheduled', 'enroute')} as time_to_dispatch, {stamp('completed')} as completed,
 ud."user" as completed_by
from star join r_statuses using (status) join marks using (order_id) left join people using (order_id) join r_users us on us.user_id = scheduled_by
left join r_users ue on ue.user_id = enroute_by left join r_users ud on ud.user_id = done_by where schedule_end::date = '2024-01-01'""")
def _(spark, path):
    r = Roles(spark, path)
    return wf.time_to_dispatch(r.logged_orders(), r.history(), r.patients(), r.locations(), r.companies(), r.users(), "2024-01-01", statuses=r.statuses())


def _activity_sql(level, cut):
    steps = {"viewed": "<> 'NOd'", "scheduled": "= 'Sch'", "assigned": "= 'EnR'"}
    if level == "reconcile":
        steps |= {"completed": "= 'Cmp'", "reconciled": "= 'Rcd'"}
    trunc = (lambda c: f"date_trunc('day', {c})") if cut else (lambda c: c)
    acts = ", ".join(f"min(case when action {c} then \"at\" end) {n}_t, arg_min(user_id, case when action {c} then history_id end) {n}_u"
                     for n, c in steps.items())
    names = " ".join(f'left join r_users u_{n} on u_{n}.user_id = {n}_u' for n in steps)
    gate = "case when day(o.stamp) = day(o.scheduled) then {} end"
    val = lambda n: gate.format(f"{n}_t") if n == "assigned" else f"{n}_t"
    by = lambda n: gate.format(f'u_{n}."user"') if n == "assigned" else f'u_{n}."user"'
    cols = ", ".join(f"{stamp(trunc(val(n)))} as {n}_at, {by(n)} as {n}_by" for n in steps)
    pairs = {"created_to_viewed": ("o.stamp", val("viewed")), "scheduled_to_assigned": (val("scheduled"), val("assigned")),
             "viewed_to_scheduled": (val("viewed"), val("scheduled"))}
    if level == "reconcile":
        pairs["complete_to_reconciled"] = (val("completed"), val("reconciled"))
    spans = ", ".join(f"{span(trunc(a), trunc(b))} as {n}" for n, (a, b) in pairs.items())
    return f"""{with_roles('r_logged', 'r_patients', 'r_locations', 'r_users', 'r_history')}, acts as (select order_id, {acts} from r_history group by 1)
select c.name as company_name, o.order_id, o.type as order_type, p.last_name || ', ' || p.first_name as patient, {stamp(trunc('o.stamp'))} as stamp, {cols}, {spans}
from r_logged o join r_patients p using (patient_id) left join r_locations c on c.location_id = p.client_id and c.type = 'C'
left join acts using (order_id) {names} where o.stamp >= '2024-01-01' and o.stamp <= '2024-01-03'"""


def _activity(spark, path, **opts):
    r = Roles(spark, path)
    return wf.workflow_activity(r.logged_orders(), r.history(), r.patients(), r.locations(), r.users(), "2024-01-01", "2024-01-03", **opts)


@query("workflow_activity", _activity_sql("workflow", False))
def _(spark, path):
    return _activity(spark, path, level="workflow")


@query("reconcile_speed", _activity_sql("reconcile", False))
def _(spark, path):
    return _activity(spark, path)


@query("reconcile_speed_by_date", _activity_sql("reconcile", True))
def _(spark, path):
    return _activity(spark, path, truncate_to_date=True)


@query("reconcile_log", f"""{with_roles('r_logged', 'r_patients', 'r_locations', 'r_companies', 'r_users', 'r_history', 'r_budgets')}
select 'Reconciled' as entry, f.name as company_name, c.name as client_name, u."user", u."full" as user_full, o.order_id,
 {stamp('h."at"')} as reconciled_at, case o.type when 'D' then 'Delivery' when 'P' then 'Pick Up' else 'Unknown' end as order_type,
 coalesce(r.name, '') as reason, s.name as warehouse
from r_history h join r_logged o on o.order_id = h.order_id join r_patients p using (patient_id) join r_budgets b using (client_id, site_id)
join r_locations c on c.location_id = p.client_id join r_companies f on f.id = c.company_id join r_locations s on s.location_id = p.site_id
join r_users u on u.user_id = h.user_id
left join (select distinct left(o_orderpriority, 1) code, o_orderpriority as name from orders) r on r.code = o.reason
where action = 'Rcd' and o.ordered_by <> 3 and s.company_id in (2, 3) and o.stamp >= '2024-01-01' and o.stamp <= '2024-01-03'""")
def _(spark, path):
    r = Roles(spark, path)
    return wf.reconcile_log(r.logged_orders(), r.history(), r.patients(), r.budgets(), r.locations(), r.companies(), r.users(),
                            r.lookup(), "2024-01-01", "2024-01-03", providers=[2, 3], skip_user=3)
