"""Client orders, redelivery, accuracy, inventory, service calls and service level over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulbook.operators.aggregates import concat_notes
from haulbook.plans import client_orders as co, quality as q, redelivery as rd, service as sc
from haulbook.plans.schemas import store_report
from haulbook.sources.sinks import shared_dir, staged

from .registry import ORACLES, QUERIES, day, pct, query, stamp
from .roles import Roles, with_roles

# ---- client orders: completed = last shipment, due and scheduled = order date

CLIENT_ROLES = with_roles("r_shipped", "r_patients", "r_locations")
CLIENT_FROM = "from r_shipped o join r_patients p using (patient_id) join r_locations c on c.location_id = p.client_id"
CLIENT_WHERE = "completed >= '1996-01-01' and completed <= '1998-12-31'"


def _client(spark, path, **opts):
    r = Roles(spark, path)
    return co.client_orders(r.shipped_orders(), r.patients(), r.locations(), "1996-01-01", "1998-12-31", **opts)


CLIENT_COLS = ["order_id", "status", "patient", "client_id", "site_id", "completed"]


def _client_sql(where):
    return f"""{CLIENT_ROLES} select order_id, status, last_name || ', ' || first_name as patient, p.client_id, p.site_id, {stamp('completed')} as completed
{CLIENT_FROM} where {CLIENT_WHERE} and {where}"""


@query("client_orders", _client_sql("c.company_id = 101"))
def _(spark, path):
    return _client(spark, path, client_company=101).select(*CLIENT_COLS)


@query("client_deliveries", _client_sql("c.company_id = 101 and status = 'D'"))
def _(spark, path):
    return _client(spark, path, client_company=101, status="D").select(*CLIENT_COLS)


@query("client_pickups_within", _client_sql("c.company_id = 101 and status = 'P' and date_diff('hour', scheduled, completed) <= 48"))
def _(spark, path):
    return _client(spark, path, client_company=101, status="P", within_hours=48).select(*CLIENT_COLS)


@query("client_pickups_over", _client_sql("dme_id in (2, 4) and status = 'P' and date_diff('hour', schedule_end, completed) > 48"))
def _(spark, path):
    return _client(spark, path, dme_ids=[2, 4], status="P", over_hours=48).select(*CLIENT_COLS)


@query("pickup_summary", f"""{CLIENT_ROLES} select count(*) as total_orders, count(case when status = 'P' then 1 end) as total_pickups,
count(case when status = 'P' and date_diff('hour', scheduled, completed) <= 48 then 1 end) as pickups_within {CLIENT_FROM} where {CLIENT_WHERE} and c.company_id = 101""")
def _(spark, path):
    return co.pickup_summary(_client(spark, path, client_company=101))


@query("orders_by_patient", f"""{CLIENT_ROLES} select last_name || ', ' || first_name as patient, count(*) as order_count {CLIENT_FROM}
where {CLIENT_WHERE} and c.company_id = 101 and status = 'D' group by 1""")
def _(spark, path):
    return co.orders_by_patient(_client(spark, path, client_company=101))


# ---- redelivery over every month

BASE = with_roles("r_orders", "r_details", "r_equipment", "r_client_equip", "r_pairs", "r_patients", "r_budgets", "r_locations", "r_companies") + """,
win as (select distinct order_id, unnest([date_trunc('month', completed), date_trunc('month', completed + interval 5 day)])::date as window_start from r_orders),
raw as (select w.window_start, o.order_id, o.patient_id, o.driver_id, o.route_number, o.completed, p.client_id, p.site_id
  from win w join r_orders o using (order_id) join r_patients p using (patient_id) where p.type <> 'M' and exists (select 1 from r_budgets b
  where b.client_id = p.client_id and b.site_id = p.site_id and begin_yyyymm <= year(window_start) * 100 + month(window_start)
  and year(window_start) * 100 + month(window_start) <= end_yyyymm)),
line as (select d.order_id, e.item_id own_item, e.item_id, e.oxygen, coalesce(c.disposable, e.disposable) disposable
  from r_details d join r_orders o using (order_id) join r_patients p using (patient_id) join r_equipment e using (product_id)
  left join r_client_equip c on c.client_id = p.client_id and c.site_id = p.site_id and c.equipment_id = e.equipment_id),
cnt as (select order_id, count(case when not oxygen and not disposable then 1 end) dme,
  count(case when oxygen then 1 end) + count(case when disposable and item_id in (147, 794) then 1 end) o2,
  count(case when disposable and item_id not in (147, 794, 227, 796, 797, 89, 308, 764, 295, 296) then 1 end) disp,
  count(case when disposable and item_id = 227 then 1 end) service, count(case when own_item in (select sub_item from r_pairs) then 1 end) paired
  from line group by 1),
pick as (select reference_order_id order_id, count(*) pickup from r_details where reference_order_id is not null group by 1),
full_count as (select r.*, coalesce(dme, 0) dme, coalesce(o2, 0) o2, coalesce(disp, 0) disp, coalesce(service, 0) service, coalesce(paired, 0) paired,
  coalesce(pickup, 0) pickup from raw r left join cnt using (order_id) left join pick using (order_id)),
excl as (select *, case when dme + o2 + disp + service = 0 and pickup > 0 then 'PickupOnly' when dme + o2 + disp + service + pickup = 0 then 'NoDetails'
  when o2 > 0 and dme = 0 then 'StandingO2' when service > 0 then 'Service' end x from full_count)"""

FINISH = """named as (select window_start, order_id, patient_id, client_id, site_id, driver_id, route_number, completed, paired, pre.order_id pre_order_id,
  date_diff('minute', coalesce(pre.completed, completed), completed) as minutes, skipped,
  case when x is not null then x when no_valid then 'NoValidPre' when pre is null then 'NoPreOrd'
    when date_diff('minute', pre.completed, completed) > 7200 then 'GT>Days'
    when date_diff('minute', pre.completed, completed) = 0 and driver_id = pre.driver_id and route_number = pre.route_number then 'SameStop'
    when date_diff('minute', pre.completed, completed) < 1440 and driver_id = pre.driver_id and route_number = pre.route_number
      and pre.completed::date = completed::date then 'SameRoute' end n0 from linked),
lab as (select *, coalesce(n0, case when pre_order_id is not null and order_id > min(case when n0 is null then order_id end) over (partition by window_start, pre_order_id)
  then '2xPost' else '[Re-Del]' end) note from named)"""

STRICT = BASE + """,
linked as (select *, false no_valid, last_value(case when x is null then {'order_id': order_id, 'driver_id': driver_id, 'route_number': route_number, 'completed': completed} end ignore nulls) over w pre,
  bad - coalesce(last_value(case when x is null then bad end ignore nulls) over w, 0) skipped
  from (select *, coalesce(sum(case when x is null then 0 else 1 end) over w, 0)::bigint bad from excl
    window w as (partition by window_start, patient_id order by completed, order_id rows between unbounded preceding and 1 preceding))
  window w as (partition by window_start, patient_id order by completed, order_id rows between unbounded preceding and 1 preceding)),
""" + FINISH

LOWEST = BASE.replace("with ", "with recursive ", 1) + """,
other as (select a.window_start, a.order_id, arg_min(b.order_id, (date_diff('second', b.completed, a.completed), b.order_id)) p0
  from excl a join excl b on a.window_start = b.window_start and a.patient_id = b.patient_id and a.order_id <> b.order_id and b.completed <= a.completed group by 1, 2),
point as (select e.window_start, e.order_id, e.x, o.p0 from excl e left join other o using (window_start, order_id)),
walk as (select window_start, order_id, p0 at_id from point union
  select w.window_start, w.order_id, p.p0 from walk w join point p on p.window_start = w.window_start and p.order_id = w.at_id
  where p.x is not null and w.at_id <> w.order_id),
done as (select w.window_start, w.order_id, max(case when p.x is null and w.at_id <> w.order_id then w.at_id end) pre_id,
  count(case when w.at_id is null then 1 end) ran_out from walk w left join point p on p.window_start = w.window_start and p.order_id = w.at_id group by 1, 2),
linked as (select e.*, d.pre_id is null and d.ran_out = 0 no_valid, cast(null as bigint) skipped,
  case when b.order_id is not null then {'order_id': b.order_id, 'driver_id': b.driver_id, 'route_number': b.route_number, 'completed': b.completed} end pre
  from excl e join done d using (window_start, order_id) left join excl b on b.window_start = e.window_start and b.order_id = d.pre_id),
""" + FINISH

LABEL_COLS = ["window_start", "order_id", "patient_id", "note", "redelivery", "pre_order_id", "minutes", "in_period", "paired_count", "skipped"]
LABEL_SQL = f"""select {day('window_start')} as window_start, order_id, patient_id, note, case when note = '[Re-Del]' then 1 else 0 end as redelivery,
 pre_order_id, minutes, case when date_trunc('month', completed) = window_start then 1 else 0 end as in_period, paired as paired_count, skipped from lab"""


def _labelled(spark, path, **opts):
    r = Roles(spark, path)
    return rd.redelivery(r.orders(), r.details(), r.patients(), r.budgets(), r.equipment(), client_equip=r.client_equip(),
                         sub_items=r.pairs(), **opts)


def _label_rows(df):
    return df.withColumn("in_period", F.col("in_period").cast("int")).select(*LABEL_COLS)


@query("redelivery", f"{STRICT} {LABEL_SQL}")
def _(spark, path):
    return _label_rows(_labelled(spark, path))


@query("redelivery_split", f"{STRICT} {LABEL_SQL}")
def _(spark, path):
    """The same with two ids to a block."""
    return _label_rows(_labelled(spark, path, block=2))


@query("redelivery_lowest_id", f"{LOWEST} {LABEL_SQL}")
def _(spark, path):
    return _label_rows(_labelled(spark, path, ties="lowest_id"))


def _skipped_sql(text):
    return f"""{STRICT} select {day('a.window_start')} as window_start, a.patient_id, a.order_id, a.skipped,
{text("string_agg(b.order_id, ', ' order by b.completed desc, b.order_id desc)")} as skipped_ids,
{text("string_agg(b.note, ', ' order by b.completed desc, b.order_id desc)")} as skipped_notes
from lab a join lab b on a.window_start = b.window_start and a.patient_id = b.patient_id and (b.completed, b.order_id) < (a.completed, a.order_id)
left join lab p on p.window_start = a.window_start and p.order_id = a.pre_order_id
where a.skipped > 0 and (p.order_id is null or (b.completed, b.order_id) > (p.completed, p.order_id)) group by 1, 2, 3, 4"""


@query("skipped_orders", _skipped_sql(lambda text: text))
def _(spark, path):
    return rd.skipped_orders(staged(_labelled(spark, path)))


@query("skipped_orders_short", _skipped_sql(lambda text: f"left({text}, 255)"))
def _(spark, path):
    """The same cut for a report column."""
    return rd.skipped_orders(staged(_labelled(spark, path)), width=255)


@query("skipped_runs", f"""{STRICT} select {day('window_start')} as window_start, patient_id, run_after, order_id, note,
row_number() over (partition by window_start, patient_id, run_after order by completed, order_id) as place
from (select lab.*, pre_order_id as run_after, x from lab join (select window_start, order_id, x from excl) e using (window_start, order_id)) where x is not null""")
def _(spark, path):
    return rd.skipped_runs(_labelled(spark, path))


DAILY = (STRICT.replace("unnest([date_trunc('month', completed), date_trunc('month', completed + interval 5 day)])::date as window_start",
                        "unnest(generate_series(completed::date, completed::date + 5, interval 1 day))::date as window_start"))


@query("redelivery_daily", f"{DAILY} {LABEL_SQL.replace(chr(39) + 'month' + chr(39), chr(39) + 'day' + chr(39))}")
def _(spark, path):
    """Day by day, with a look-back over five earlier days: an order lies in six windows."""
    return _label_rows(_labelled(spark, path, kind="D", days=5))


PAIRED = STRICT + """,
chosen as (select distinct order_id from lab where note = '[Re-Del]' and paired > 0),
placed as (select order_id, patient_id, completed::date stop_day, driver_id, route_number from r_orders),
il as (select d.order_id, e.item_id, d.check_out, coalesce(d.check_in, d.other_status, timestamp '2999-12-31 12:00:00') back from r_details d join r_equipment e using (product_id) where d.order_id is not null),
subs as (select order_id, patient_id, stop_day, driver_id, route_number, item_id sub_item, check_out::date sday, count(*) lines
  from il join chosen using (order_id) join placed using (order_id) where item_id in (select sub_item from r_pairs) group by all),
mains as (select il.order_id, p.sub_item, check_out, back, patient_id, stop_day, driver_id, route_number from il join r_pairs p on p.main_item = il.item_id join placed using (order_id)),
hits as (select s.*, count(case when m.stop_day = s.stop_day and m.driver_id = s.driver_id and m.route_number = s.route_number and m.check_out::date <= s.stop_day and m.back >= s.sday then 1 end) stop_count,
  count(case when m.stop_day <= s.stop_day and not (m.stop_day = s.stop_day and m.driver_id = s.driver_id and m.route_number = s.route_number) and m.check_out <= s.sday and m.back >= s.sday then 1 end) prior_count
  from subs s left join mains m on m.patient_id = s.patient_id and m.sub_item = s.sub_item group by all),
sums as (select patient_id, stop_day, driver_id, route_number, sub_item, stop_count, prior_count, sum(lines) n from hits group by all),
flags as (select patient_id, stop_day, driver_id, route_number, sub_item, max(case when n <= stop_count then 1 else 0 end) valid_on_stop,
  max(case when n <= stop_count + prior_count then 1 else 0 end) found from sums group by all),
marked as (select h.*, valid_on_stop, found, case when found = 1 and valid_on_stop = 0 then 1 else 0 end missed
  from hits h join flags using (patient_id, stop_day, driver_id, route_number, sub_item))"""


def _pairs_marked(r, labelled):
    return rd.paired_items(labelled, r.orders(), r.item_lines(), r.pairs())


@query("paired_items", f"""{PAIRED} select order_id, patient_id, date_diff('day', date '1970-01-01', stop_day) as stop_day, driver_id, route_number, sub_item,
date_diff('day', date '1970-01-01', sday) as out_day, lines, stop_count, prior_count, valid_on_stop, found, missed from marked""")
def _(spark, path):
    return _pairs_marked(Roles(spark, path), staged(_labelled(spark, path)))


def _summary_sql(bands, percents):
    n = lambda k: f"sum(case when {f'minutes > {(k - 1) * 1440} and ' if k > 1 else ''}minutes <= {k * 1440} and note = '[Re-Del]' then 1 else 0 end)::bigint"
    cols = [f"{n(k)} as n_{k * 24}h" for k in range(1, bands + 1)]
    if percents:
        cols += [f"{pct(n(k), 'count(*)', 4)} as pct_{k * 24}h" for k in range(1, bands + 1)]
    red, mis = "count(case when note = '[Re-Del]' then 1 end)", "sum(coalesce(missed, 0))::bigint"
    return f"""{PAIRED}, st as (select * from r_locations where type = 'C' and state <> 'ZZ')
select {day('window_start')} as window_start, monthname(window_start) as month, rtrim(d.name || ', ' || s.name) as provider, rtrim(c.name) as client,
 rtrim(coalesce(r_name, c.state || ' Region')) as region, count(*) as orders, {red} as redeliveries, {mis} as missed_pairs,
 {pct(mis, 'count(*)', 4)} as pct_missed_pairs, {pct(red, 'count(*)', 4)} as pct_redelivery, {', '.join(cols)}
from lab left join (select order_id, max(missed) missed from marked group by 1) m using (order_id)
join r_locations s on s.location_id = lab.site_id join r_companies d on d.id = s.company_id join st c on c.location_id = lab.client_id
left join region on r_regionkey = c.region_id where date_trunc('month', completed) = window_start group by 1, 2, 3, 4, 5"""


def _summary(spark, path, **opts):
    r = Roles(spark, path)
    labelled = staged(_labelled(spark, path))
    return rd.redelivery_summary(labelled, _pairs_marked(r, labelled), r.patients(), r.locations(), r.companies(), r.regions(), r.states(), **opts)


@query("redelivery_summary", _summary_sql(7, True))
def _(spark, path):
    return _summary(spark, path)


@query("redelivery_summary_short", _summary_sql(5, False))
def _(spark, path):
    return _summary(spark, path, bands=5, percents=False)


@query("redelivered_order_items", f"""{STRICT}, hit as (select * from lab where note = '[Re-Del]'),
want as (select order_id from hit union select pre_order_id from hit where pre_order_id is not null),
per as (select d.order_id, p_name, status, count(*) n from r_details d join part on p_partkey = product_id group by 1, 2, 3)
select want.order_id, string_agg('{{' || n || 'x}} ' || p_name || '[' || status || ']', ', ' order by p_name || chr(1) || status) as item_list
from want left join per using (order_id) group by 1""")
def _(spark, path):
    lines = Roles(spark, path).item_lines().withColumnRenamed("status", "status_name")
    return rd.redelivered_order_items(staged(_labelled(spark, path)), lines)


# ---- driver accuracy and inventory

KIT = "instr('DSHOPMY#GS', status) > 0 and category % 2 = 0"


@query("driver_accuracy", f"""{with_roles('r_orders', 'r_details', 'r_equipment', 'r_patients', 'r_locations', 'r_users')},
base as (select o.order_id, {day('completed')} completed_on, driver_id, p.client_id, p.site_id, s.name site_name, o.reason, o.status from r_orders o
  join r_patients p using (patient_id) join r_locations s on s.location_id = p.site_id
  where s.company_id = 2 and driver_id in (1, 2, 3, 5) and completed >= '1997-01-01' and completed <= '1997-12-31'),
l as (select coalesce(order_id, reference_order_id) order_id, order_id is null back, case when {KIT} and not has_serial then 1 else 0 end ser,
  case when {KIT} and not has_lot then 1 else 0 end oxy from r_details join r_equipment using (product_id)),
e as (select order_id, sum(case when not back then ser else 0 end)::bigint serial_delivery, sum(case when not back then oxy else 0 end)::bigint oxygen_delivery,
  sum(case when back then ser else 0 end)::bigint serial_pickup, sum(case when back then oxy else 0 end)::bigint oxygen_pickup from l group by 1),
s as (select order_id, case when status = 'D' then 1 else 0 end ir from r_orders where reason <> '5')
select b.order_id, completed_on, b.site_id, site_name, b.driver_id, u.first_name || ' ' || u.last_name as driver_name, serial_delivery, oxygen_delivery, serial_pickup, oxygen_pickup,
 s.ir as ir_correct, case when s.order_id is null then 1 else 0 end as missing_order_stat,
 case when s.order_id is null then null when serial_delivery + oxygen_delivery + serial_pickup + s.ir = 0 then 0 else 1 end as totally_accurate
from base b join e using (order_id) left join s using (order_id) join r_users u on u.user_id = b.driver_id""")
def _(spark, path):
    r = Roles(spark, path)
    stats = r.orders().filter("reason <> '5'").selectExpr("order_id", "if(status = 'D', 1, 0) as ir_correct",
                                                          *[f"0 as {n}" for n in q.CHECKS if n != "ir_correct"])
    drivers = r.orders().filter("driver_id in (1, 2, 3, 5)").selectExpr("driver_id as user_id", "17 as role").distinct()
    out = q.driver_accuracy(r.orders(), r.details(), r.patients(), r.locations(), _kit_list(r), stats, r.users(), drivers, "1997-01-01", "1997-12-31")
    return out.selectExpr("order_id", "completed_on", "site_id", "site_name", "driver_id", "driver_name", "serial_delivery", "oxygen_delivery",
                          "serial_pickup", "oxygen_pickup", "ir_correct", "cast(missing_order_stat as int) as missing_order_stat", "totally_accurate")


def _kit_list(r):
    """Kits of the products ever ordered by a client and site: even sizes need a serial number and a lot."""
    pairs = (r.t["lineitem"].selectExpr("l_orderkey as order_id", "l_partkey as product_id").join(r.orders().select("order_id", "patient_id"), "order_id")
             .join(r.patients().select("patient_id", "client_id", "site_id"), "patient_id").select("product_id", "client_id", "site_id").distinct())
    size = r.equipment().selectExpr("product_id", "1 - category % 2 as serial_count", "1 - category % 2 as o2_count")
    return pairs.join(size, "product_id")


@query("inventory_past_due", f"""select s_suppkey as site_id, s_name as site_name, past_due, tracked, items, {pct('past_due', 'tracked', 2)} as pct_past_due,
{pct('tracked', 'items', 2)} as pct_tracked from (select l_suppkey, count(case when l_shipdate < o_orderdate then 1 end) past_due, count(case when l_linestatus = 'O' then 1 end) tracked,
count(*) items from lineitem join orders on l_orderkey = o_orderkey where l_shipdate >= '1996-01-01' and l_shipdate <= '1999-12-31' group by 1) join supplier on s_suppkey = l_suppkey""")
def _(spark, path):
    t = Roles(spark, path).t
    daily = t["lineitem"].join(t["orders"], F.expr("l_orderkey = o_orderkey")).selectExpr(
        "l_suppkey as site_id", "datediff(l_shipdate, o_orderdate) as count_due", "if(l_linestatus = 'O', 1, null) as inventory_ref", "l_shipdate as at")
    sites = t["supplier"].selectExpr("s_suppkey as location_id", "s_name as name", "'S' as type")
    return q.inventory_past_due(daily, sites, "1996-01-01", "1999-12-31")


# ---- service calls

GROUPS = {"beds": [1, 2, 3], "concentrators": [4, 5], "lal": [6], "wheelchairs": [7, 8, 9, 10]}
CALLS = with_roles("r_orders", "r_details", "r_equipment", "r_patients", "r_locations", "r_companies", "r_users", "r_user_locations") + f""",
c as (select order_id, count(case when item_name = 'PROMO' then 1 end) sc, {', '.join(f"count(case when category in ({', '.join(map(str, v))}) then 1 end) {n}" for n, v in GROUPS.items())}
  from r_details join r_equipment using (product_id) where order_id is not null group by 1),
home as (select user_id, min(type) as type from r_user_locations group by 1),
calls as (select p.site_id, d.abbr || ': ' || s.name as site, h.abbr || ': ' || k.name as client, completed, order_id,
  coalesce(ud.last_name || ', ' || ud.first_name, '') as driver, uo.last_name || ', ' || uo.first_name || ' X' as ordered_by_name,
  coalesce(case home.type when 'D' then 'Provider' when 'H' then 'Hospice' end, 'Unknown') as user_level, rn.name as reason_name,
  case when o.patient_id % 3 = 0 then 'RES' else 'Unknown' end as place, case when sc > 0 then 'Y' else 'N' end as service_call,
  {', '.join(f"case when {n} > 0 then 'Y' else 'N' end as {n}" for n in GROUPS)}, case when beds + concentrators + lal + wheelchairs = 0 then 'Y' else 'N' end as other,
  coalesce(replace(cv.text, '<br>', ''), '') as notes
  from r_orders o join c using (order_id) join r_patients p using (patient_id) join r_locations s on s.location_id = p.site_id join r_companies d on d.id = s.company_id
  join r_locations k on k.location_id = p.client_id join r_companies h on h.id = k.company_id left join r_users ud on ud.user_id = o.driver_id
  left join r_users uo on uo.user_id = o.ordered_by left join home on home.user_id = o.ordered_by
  left join (select distinct left(o_orderpriority, 1) code, o_orderpriority as name from orders) rn on rn.code = o.reason
  left join (select conv_id, string_agg(text, ', ' order by turn) as text from conversations group by 1) cv on cv.conv_id = o.order_id
  where s.company_id = 2 and completed >= '1997-01-01' and completed <= '1997-12-31' and o.type in ('D', 'P') and o.status in ('D', 'P'))"""


def _calls(spark, path):
    r = Roles(spark, path)
    levels = config_levels(r)
    pads = concat_notes(r.t["conversations"], "conv_id", "text", "turn").selectExpr("conv_id as order_id", "notes as note")
    places = r.t["customer"].selectExpr("c_custkey as address_id", "if(c_custkey % 3 = 0, 'RES', null) as place")
    return sc.service_call_details(r.orders(), r.item_lines(), r.patients(), r.locations(), r.companies(), r.users(), r.user_locations(), levels,
                                   r.lookup(), pads, places, "1997-01-01", "1997-12-31", groups=GROUPS, service=F.col("item_name") == "PROMO")


def config_levels(r):
    """User levels, each listed twice as in the source they stand for."""
    rows = r.user_locations().select("type").distinct()
    return rows.unionByName(rows).selectExpr("type as code", "case type when 'D' then 'Provider' when 'H' then 'Hospice' end as name")


@query("service_calls_by_site", f"""{CALLS} select site_id, site, client, {stamp('completed')} as completed, order_id, driver, ordered_by_name, user_level, reason_name, place,
service_call, beds, concentrators, lal, wheelchairs, other, notes from calls""")
def _(spark, path):
    return _calls(spark, path)


def _call_summary_sql(total):
    n = lambda c: f"count(case when service_call = 'Y' and {c} = 'Y' then 1 end) {c}"
    names = [*GROUPS, "other"]
    src = ("(select 0 site_id, 'All' site_name, sum(orders)::bigint orders, sum(service_calls)::bigint service_calls, " + ", ".join(f"sum({c})::bigint {c}" for c in names) + " from per)") if total else "per"
    text = lambda a, b: f"printf('%.2f', {pct(a, b)}) || '%'"
    return f"""{CALLS}, t as (select site_id, count(*) orders, count(case when service_call = 'Y' then 1 end) service_calls, {', '.join(n(c) for c in names)} from calls group by 1),
per as (select l.location_id site_id, l.name site_name, t.* exclude (site_id) from r_locations l left join t on t.site_id = l.location_id where l.type = 'S' and l.company_id = 2)
select *, {', '.join(f"{text(c, 'service_calls')} as pct_{c}" for c in names)}, {text('service_calls', 'orders')} as pct_service_calls from {src}"""


def _call_sites(spark, path):
    sites = Roles(spark, path).locations().filter("type = 'S' and company_id = 2").selectExpr("location_id as site_id", "name as site_name")
    return sc.site_summary(sc.summary_flags(_calls(spark, path), list(GROUPS)), sites, list(GROUPS))


@query("service_call_sites", _call_summary_sql(False))
def _(spark, path):
    return _call_sites(spark, path)


@query("service_call_company", _call_summary_sql(True))
def _(spark, path):
    return sc.company_summary(staged(_call_sites(spark, path)), list(GROUPS))


@query("service_call_orders", f"""{with_roles('r_orders', 'r_patients', 'r_locations')},
d as (select l_orderkey order_id, l_partkey product_id, l_orderkey * 10 + l_linenumber detail_id, count(*) n from lineitem
  where l_orderkey * 10 + l_linenumber in (select l_orderkey * 10 + l_linenumber from lineitem where l_quantity > 45) group by 1, 2, 3),
n as (select conv_id order_id, string_agg(text, ', ' order by turn) notes from conversations group by 1)
select k.name as client_name, p.client_id, order_id, p.last_name || ', ' || p.first_name as patient, 'street ' || o.address_id as street, k.state as city, rn.name as reason_name,
{day('stamp')} as ordered_on, {day('completed')} as delivered_on, notes, case when notes is not null then 1 end as note_parts, p_name as product_name, detail_id
from r_orders o join d using (order_id) join r_patients p using (patient_id) join r_locations s on s.location_id = p.site_id join r_locations k on k.location_id = p.client_id
join (select distinct left(o_orderpriority, 1) code, o_orderpriority as name from orders) rn on rn.code = o.reason join part on p_partkey = d.product_id
left join n using (order_id) where s.company_id = 2 and stamp >= '1997-01-01' and stamp <= '1999-12-31'""")
def _(spark, path):
    r = Roles(spark, path)
    # Dealt by detail once, which serves the distinct and the join with the calls.
    details = (r.t["lineitem"].selectExpr("l_orderkey as order_id", "l_partkey as product_id", "l_orderkey * 10 + l_linenumber as detail_id")
               .repartition("detail_id").distinct())
    calls = r.t["lineitem"].filter("l_quantity > 45").selectExpr("l_orderkey * 10 + l_linenumber as detail_id")
    notes = r.t["conversations"].selectExpr("conv_id as order_id", "text as note", "turn as note_id")
    state = r.locations().filter("type = 'C'").selectExpr("location_id as client_id", "state as city")
    addresses = r.patients().join(state, "client_id").selectExpr("address_id", "concat('street ', address_id) as street", "city", "city as state", "city as zip")
    products = r.equipment().selectExpr("product_id", "equipment_name as name")
    reasons = r.lookup().filter("group = 'ORC'").select("code", "name")
    return sc.service_call_orders(r.orders(), details, calls, notes, r.patients(), r.locations(), products, addresses, reasons,
                                  "1997-01-01", "1999-12-31").drop("state", "zip")


# ---- service level

LEVEL = with_roles("r_shipped", "r_patients", "r_locations", "r_users") + f""",
lvl as (select o.*, p.client_id, p.site_id, p.last_name || ', ' || p.first_name || ' ' || coalesce(p.middle, '') as patient, p.disabled, p.torpid, p.dup, s.name site_name, k.name client_name, u.last_name ul, u.first_name uf,
  date_diff('minute', schedule_end, completed) variance, case when date_diff('minute', schedule_end, completed) > 30 and priority then 1 else 0 end missed,
  case p.site_id when 1065 then 'America/New_York' when 1066 then 'America/Denver' end as zone, case p.site_id when 1065 then 'ET' when 1066 then 'MT' end zone_abbr
  from r_shipped o join r_patients p using (patient_id) join r_locations s on s.location_id = p.site_id and s.type = 'S' and s.company_id = 2
  join r_locations k on k.location_id = p.client_id and k.type = 'C' left join r_users u on u.user_id = o.driver_id)"""


# Role mapping: further address columns from the patient's number, in words that both engines read.
ADDRESS = {"street2": "case when patient_id % 2 = 0 then concat('Unit ', patient_id % 100) end", "state": "concat('S', patient_id % 50)",
           "zip": "concat('', 10000 + patient_id)", "latitude": "cast(patient_id as double) / 10", "longitude": "cast(patient_id as double) / 20",
           "room": "concat('R', patient_id % 9)", "bed": "concat('B', patient_id % 3)", "place_name": "concat('Home ', patient_id % 7)"}


def _level(spark, path, **search):
    r = Roles(spark, path)
    zones = r.locations().filter("type = 'S'").selectExpr(
        "location_id as site_id", "case location_id when 1065 then 'America/New_York' when 1066 then 'America/Denver' end as zone",
        "case location_id when 1065 then 'ET' when 1066 then 'MT' end as zone_abbr")
    regions = r.locations().filter("type = 'S'").selectExpr("name as site", "concat('Area ', left(name, 1)) as region")
    addresses = r.patients().selectExpr("address_id", "concat('O', chr(39), last_name) as street", "first_name as city", "if(patient_id % 2 = 0, 'RES', 'AL') as place",
                                        *[f"{x} as {n}" for n, x in ADDRESS.items()])
    return sc.service_level(r.shipped_orders(), r.patients(), r.locations(), regions, zones, r.users(), addresses, **search)


@query("service_level", f"""{LEVEL} select order_id, client_name, site_name, patient, 'Area ' || left(site_name, 1) as region,
case status when 'D' then 'DONE' when 'P' then 'DONE' when 'R' then 'RECV' end as status_group, case type when 'P' then 'PICKUP' when 'D' then 'DELIVERY' end as type_name,
case when patient_id % 2 = 0 then 'Residence' else 'AL (Assisted Living)' end as place, 'O' || left(patient, 8) as street, missed, variance,
uf || ' ' || left(ul, 1) || '.' as driver from lvl
where status in ('R','S','T','U','Q','D','P','QU') and scheduled between timestamp '1997-01-01' - interval 6 hour and timestamp '1997-12-31' + interval 6 hour""")
def _(spark, path):
    out = _level(spark, path, date_mode=0, start=F.lit("1997-01-01"), end=F.lit("1997-12-31"))
    return out.select("order_id", "client_name", "site_name", "patient", "region", "status_group", "type_name", "place", "street", "missed", "variance", "driver")


@query("service_level_history", f"""{LEVEL} select order_id, site_name, status, {stamp('scheduled')} as scheduled, missed, variance from lvl
where status in ('R','S','T','U','Q','D','P','QU') and scheduled >= '1997-01-01' and scheduled < '1997-07-01'
and (status = 'D' or not (scheduled >= '1997-02-01' and scheduled < '1997-03-01'))""")
def _(spark, path):
    """Half a year of history whose February is replaced by a later run that finds delivered orders only."""
    folder = shared_dir(spark)
    cols = ["order_id", "site_name", "status", "scheduled", "missed", "variance"]
    level = _level(spark, path, date_mode=0, start=F.lit("1997-01-01"), end=F.lit("1997-06-30")).select(*cols)
    sc.replace_history(level, folder, "1997-01-01", "1997-06-30")
    again = _level(spark, path, date_mode=0, start=F.lit("1997-02-01"), end=F.lit("1997-02-28"), statuses="D").select(*cols)
    return sc.replace_history(again, folder, "1997-02-01", "1997-02-28")


@query("service_level_urgent", f"""{LEVEL} select site_name, count(*) as orders, sum(missed)::bigint as missed from lvl
where status = 'R' and scheduled is not null and priority and stamp >= '1996-01-01' and stamp <= '1998-12-31' group by 1""")
def _(spark, path):
    out = _level(spark, path, date_mode=1, start=F.lit("1996-01-01"), end=F.lit("1998-12-31"), priority=True)
    return out.groupBy("site_name").agg(F.count("*").alias("orders"), F.sum("missed").alias("missed"))


@query("service_level_detail", f"""{LEVEL}, spec as (select l_orderkey, count(*) n from lineitem join part on p_partkey = l_partkey where l_returnflag <> 'R' and p_brand in ('Brand#24', 'Brand#25') group by 1),
stop as (select l_orderkey, max(l_linenumber) sq from lineitem group by 1),
pad as (select conv_id, count(*) n, timestamp '1996-01-01' + to_days(cast(conv_id as int)) lu from conversations group by 1)
select order_id, client_name, {stamp("coalesce(timezone(zone, timezone('UTC', stamp)), stamp)")} as stamp, strftime(coalesce(timezone(zone, timezone('UTC', scheduled)), scheduled), '%m/%d/%Y') as scheduled_on,
{stamp("coalesce(timezone(zone, timezone('UTC', completed)), completed)")} as completed, case lvl.type when 'P' then 'PU' else 'DEL' end as type, pad.n as note_count, sq as sequence_number, coalesce(spec.n, 0) as specialty_count,
case when lu > coalesce(last_viewed, timestamp '1900-01-01') + interval 1 second then 1 else 0 end as new_note, reason, rn.name as reason_name, zone_abbr, missed, variance, su."full" as submitter,
case when add_on_stop = false then 'No' else 'Yes' end as add_on_stop, last_viewed_by, vu.last_name as viewer_last,
{', '.join(f"{x} as {n}" for n, x in ADDRESS.items())}, '555-' || patient_id as phone1, case when patient_id % 3 <> 0 then '556-' || patient_id end as phone2,
'C' || patient_id as contact, case patient_id % 4 when 2 then 'X' when 3 then null else '' end as infectious, lvl.driver_id, du."user" as driver_user,
'm' || du.user_id as driver_phone, 'o' || du.user_id as driver_office_phone, case when order_id % 3 = 0 then order_id * 2 end as answer_id, completion_action, route_id,
cast(service_call as int) as service_call, case when torpid is not null then 1 else 0 end as is_torpid, case when disabled is not null then 1 else 0 end as is_disabled, dup as duplicate
from lvl left join r_users du on du.user_id = lvl.driver_id left join spec on spec.l_orderkey = order_id left join stop on stop.l_orderkey = order_id left join pad on conv_id = order_id
left join (select distinct left(o_orderpriority, 1) code, o_orderpriority as name from orders) rn on rn.code = reason left join r_users su on su.user_id = ordered_by
left join r_users vu on vu."user" = last_viewed_by
where status in ('R','S','T','U','Q','D','P','QU') and coalesce(timezone(zone, timezone('UTC', scheduled)), scheduled) between timestamp '1997-01-01' and timestamp '1997-12-31'""")
def _(spark, path):
    r = Roles(spark, path)
    level = _level(spark, path, date_mode=0, start="1997-01-01", end="1997-12-31")
    pads = r.t["conversations"].groupBy("conv_id").agg(F.count("*").alias("note_count")).selectExpr(
        "conv_id as order_id", "note_count", "timestampadd(DAY, conv_id, timestamp_ntz'1996-01-01 00:00:00') as last_update")
    stops = r.t["lineitem"].selectExpr("l_orderkey as order_id", "l_linenumber as sequence_number")
    brand = r.t["part"].selectExpr("p_partkey as product_id", "case p_brand when 'Brand#24' then 243 when 'Brand#25' then 244 else 0 end as item_id")
    special = r.details().filter("order_id is not null").select("order_id", "product_id").join(brand, "product_id")
    out = sc.service_level_detail(level, pads, stops, special, r.lookup(), r.users(), date_mode=0, start="1997-01-01", end="1997-12-31", sort="client_name",
                                  answers=r.orders().filter("order_id % 3 = 0").selectExpr("order_id", "order_id * 2 as answer_id"))
    return out.withColumn("service_call", F.col("service_call").cast("int")).select(*ADDRESS, "phone1", "phone2", "contact", "infectious", "driver_id", "driver_user",
                      "driver_phone", "driver_office_phone", "answer_id", "completion_action", "route_id", "service_call", "is_torpid", "is_disabled", "duplicate",
                      "order_id", "client_name", "stamp", "scheduled_on", "completed", "type", "note_count", "sequence_number", "specialty_count", "new_note", "reason",
                      "reason_name", "zone_abbr", "missed", "variance", "submitter", "add_on_stop", "last_viewed_by", "viewer_last")


# ---- reports stored under their declared schemas

@query("stored_reports", f"""select 'orders_by_patient' as report, patient as name, order_count as value from ({ORACLES['orders_by_patient']})
union all select 'inventory_past_due', site_name, past_due from ({ORACLES['inventory_past_due']})
union all select 'pickup_summary', 'all', total_pickups from ({ORACLES['pickup_summary']})""")
def _(spark, path):
    shown = {"orders_by_patient": ("patient", "order_count"), "inventory_past_due": ("site_name", "past_due"), "pickup_summary": ("'all'", "total_pickups")}
    parts = []
    for name, (label, value) in shown.items():
        stored = spark.read.parquet(store_report(QUERIES[name](spark, path), name, shared_dir(spark)))
        parts.append(stored.selectExpr(f"'{name}' as report", f"{label} as name", f"{value} as value"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
