"""Sources, sinks, report windows and filters over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from haulbook.functions import windows as w
from haulbook.functions.dates import same_day_of_month, yyyymm
from haulbook.functions.numbers import not_null_and_positive
from haulbook.functions.text import code_in_string, prefix_like
from haulbook.operators import filters as f
from haulbook.sources import sinks, tables
from haulbook.sources.daytable import replace_days

from .registry import day, query, stamp
from .roles import Roles, with_roles


# ---- sources and sinks

@query("load_tables", " union all ".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in tables.TABLES))
def _(spark, path):
    loaded = tables.load_tables(spark, path)
    return reduce(lambda a, b: a.union(b), [d.groupBy().agg(F.count("*").alias("row_count"))
                                            .select(F.lit(n).alias("table_name"), "row_count") for n, d in loaded.items()])


@query("config_table", f"""{with_roles('r_states')}
select r.state, count(*) as customers from customer join r_states r on -r.region_id - 1 = c_nationkey group by 1""")
def _(spark, path):
    r = Roles(spark, path)
    return (r.t["customer"].join(r.states(), -F.col("region_id") - 1 == F.col("c_nationkey"))
            .groupBy("state").agg(F.count("*").alias("customers")))


@query("describe_pairs", """select p.main_item, p.sub_item, '[ ' || trim(s.p_name) || ' ] paired with [ ' || trim(m.p_name) || ' ]' as description
from (select distinct l_partkey as main_item, l_partkey + l_linenumber as sub_item from lineitem) p
left join part m on m.p_partkey = main_item left join part s on s.p_partkey = sub_item""")
def _(spark, path):
    t = Roles(spark, path).t
    pairs = t["lineitem"].select(F.col("l_partkey").alias("main_item"),
                                 (F.col("l_partkey") + F.col("l_linenumber")).alias("sub_item")).distinct()
    return tables.describe_pairs(pairs, t["part"].select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name")))


def _nation_orders(spark, path):
    t = Roles(spark, path).t
    return (t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
            .groupBy("c_nationkey").agg(F.count("*").alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(19,2)")).alias("amount"))
            .join(t["nation"], F.col("n_nationkey") == F.col("c_nationkey"))
            .select(F.concat(F.lit(" "), "n_name", F.lit(" ")).alias("nation"), "n_regionkey", "orders", "amount"))


NATION_ORDERS = """select n_name nation, n_regionkey, count(*) orders, sum(cast(o_totalprice as decimal(19,2))) amount
from orders join customer on o_custkey = c_custkey join nation on n_nationkey = c_nationkey group by 1, 2"""


@query("write_report", f"select ' ' || nation || ' ' as nation, orders, cast(amount as double) as amount from ({NATION_ORDERS})")
def _(spark, path):
    schema = sinks.T.StructType.fromDDL("nation string, orders int, amount decimal(19,4)")
    out = sinks.write_report(_nation_orders(spark, path), sinks.shared_dir(spark), schema)
    return spark.read.parquet(out)


@query("export_delimited", f"select nation, cast(orders as varchar) as orders from ({NATION_ORDERS})")
def _(spark, path):
    out = sinks.export_delimited(_nation_orders(spark, path).select("nation", "orders"), sinks.shared_dir(spark))
    return spark.read.option("sep", "\t").option("header", True).csv(out)


@query("export_by_key", f"select nation, cast(orders as varchar) as orders, n_regionkey from ({NATION_ORDERS})")
def _(spark, path):
    out = sinks.export_by_key(_nation_orders(spark, path).drop("amount"), sinks.shared_dir(spark), "n_regionkey")
    return spark.read.option("sep", "\t").option("header", True).csv(out)


@query("replace_window", f"""select order_key, priority, {stamp('placed')} as placed from (
select o_orderkey as order_key, o_orderpriority as priority, o_orderdate as placed from orders
where not (o_orderdate >= '1997-03-01' and o_orderdate <= '1997-03-31')
union all select o_orderkey, 'again ' || o_orderpriority, o_orderdate from orders
where o_orderdate >= '1997-03-01' and o_orderdate <= '1997-03-31')""")
def _(spark, path):
    cols = [F.col("o_orderkey").alias("order_key"), F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("placed")]
    stored = spark.read.parquet(sinks.write_report(Roles(spark, path).t["orders"].select(*cols), sinks.shared_dir(spark)))
    fresh = (stored.filter(w.in_window("placed", "1997-03-01", "1997-03-31"))
             .withColumn("priority", F.concat(F.lit("again "), "priority")))
    once = sinks.replace_window(stored, fresh, "placed", "1997-03-01", "1997-03-31")
    return sinks.replace_window(once, fresh, "placed", "1997-03-01", "1997-03-31")


DAYS = f"""select o_orderkey as order_key, o_orderpriority as priority, o_orderdate as placed from orders"""


@query("replace_partitions", f"""select order_key, priority, {stamp('placed')} as placed from (
select * from ({DAYS}) where not (placed >= '1997-03-01' and placed < '1997-04-01')
union all select order_key, 'again ' || priority, placed from ({DAYS})
where placed >= '1997-03-01' and placed < '1997-04-01' and day(placed) % 3 <> 0)""")
def _(spark, path):
    """A month replaced in place; every third of its days gets no row and is gone."""
    orders = Roles(spark, path).t["orders"].select(F.col("o_orderkey").alias("order_key"), F.col("o_orderpriority").alias("priority"),
                                                   F.col("o_orderdate").alias("placed"))
    folder = sinks.shared_dir(spark)
    replace_days(orders, folder, "placed")
    month = (orders.filter(w.in_window("placed", "1997-03-01", "1997-03-31", "whole_day") & (F.dayofmonth("placed") % 3 != 0))
             .withColumn("priority", F.concat(F.lit("again "), "priority")))
    return replace_days(month, folder, "placed", "1997-03-01", "1997-03-31")


@query("freshness_check", f"""select {stamp('max(o_orderdate)')} as newest,
case when timestamp '2001-08-01' > max(o_orderdate) then 'WARNING UPDATE DATABASE' else 'DB OKAY' end as info from orders""")
def _(spark, path):
    return tables.freshness_check(Roles(spark, path).orders(), "2001-08-01")


# ---- report windows, worked out for every order date

def _days(spark, path):
    return Roles(spark, path).t["orders"].select(F.to_date("o_orderdate").alias("d")).distinct()


DAYS = "(select distinct cast(o_orderdate as date) d from orders)"


def _window_query(name, start, end, fn):
    @query(name, f"select {day('d')} as d, {day(start)} as win_start, {day(end)} as win_end from {DAYS}")
    def _(spark, path):
        s, e = fn(F.col("d"))
        return _days(spark, path).select("d", s.alias("win_start"), e.alias("win_end"))


_window_query("previous_week", "d - cast(dayofweek(d) as int) - 7", "d - cast(dayofweek(d) as int) - 1", w.previous_week)
_window_query("previous_month", "date_trunc('month', d) - interval 1 month", "date_trunc('month', d) - interval 1 day", w.previous_month)
_window_query("yesterday", "d - 1", "d - 1", w.yesterday)
_window_query("trailing_months", "date_trunc('month', d) - interval 3 month", "date_trunc('month', d) - interval 1 day", w.trailing_months)
_window_query("months_to_now", "date_trunc('month', d) - interval 2 month", "d", w.months_to_now)
_window_query("fixed_start_to_day_end", "date '1995-01-01'", "d + 1", lambda d: w.fixed_start_to_day_end("1995-01-01", d))
_window_query("month_span", "make_date(cast(year(d) as int), cast(month(d) as int), 1) - interval 3 month",
              "make_date(cast(year(d) as int), cast(month(d) as int), 1) - interval 1 day",
              lambda d: w.month_span(F.year(d), F.month(d) - 1, 3))
_window_query("force_month", "date_trunc('month', d)", "last_day(d)", lambda d: w.force_month(yyyymm(d)))


@query("last_n_months", f"""select {day('d')} as d, k, {day("date_trunc('month', d) - to_months(k)")} as win_start,
{day("last_day(date_trunc('month', d) - to_months(k))")} as win_end from {DAYS} cross join (select cast(unnest(range(1, 4)) as int) k)""")
def _(spark, path):
    return (_days(spark, path).select("d", F.posexplode(w.last_n_months(F.col("d"), 3)).alias("pos", "win"))
            .select("d", (F.col("pos") + 1).alias("k"), F.col("win.start").alias("win_start"), F.col("win.end").alias("win_end")))


PERIODS = {  # kind: start of the current period, step for n periods
    "Y": ("date_trunc('year', d)", "to_months(12 * ({n}))"),
    "Q": ("date_trunc('quarter', d)", "to_months(3 * ({n}))"),
    "M": ("date_trunc('month', d)", "to_months({n})"),
    "W": ("(d - cast(dayofweek(d) as int))", "to_days(7 * ({n}))"),
    "I": ("date_trunc('week', d)", "to_days(7 * ({n}))"),
    "D": ("d", "to_days({n})"),
    "B": ("make_date(cast(year(d) as int), cast(month(d) - (month(d) - 1) % 2 as int), 1)", "to_months(2 * ({n}))"),
}


def _period_sql(kind, first_shift, count):
    start, step = PERIODS[kind]
    at = f"cast({start} + {step.format(n='s')} as date)"
    end = f"cast({start} + {step.format(n='s + 1')} as date) - 1"
    title = (f"'Month of ' || month({at}) || '/' || year({at})" if kind == "M" else
             f"'{w.KINDS[kind]} of ' || month({at}) || '/' || day({at}) || '/' || year({at})")
    return (f"select '{kind}' as kind, {day('d')} as d, s, {day(at)} as win_start, {day(end)} as win_end, {title} as title, "
            f"{day(end)} as label from {DAYS} cross join (select cast({first_shift} - unnest(range({count})) as int) as s)")


def _periods(spark, path, kinds, offset, summary):
    days = _days(spark, path)
    parts = [days.select(F.lit(k).alias("kind"), "d", F.posexplode(w.report_window(k, offset, F.col("d"), summary)).alias("pos", "win"))
             .select("kind", "d", (F.lit(offset - 1) - F.col("pos")).alias("s"), F.col("win.start").alias("win_start"),
                     F.col("win.end").alias("win_end"), F.col("win.title").alias("title"), F.col("win.label").alias("label"))
             for k in kinds]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("report_window", " union all ".join(_period_sql(k, -1, 1) for k in PERIODS))
def _(spark, path):
    return _periods(spark, path, PERIODS, 0, False)


@query("report_window_summary", " union all ".join(_period_sql(k, -1, 13) for k in ("M", "W")))
def _(spark, path):
    return _periods(spark, path, ["M", "W"], 0, True)


@query("report_window_current", " union all ".join(_period_sql(k, 0, 1) for k in PERIODS))
def _(spark, path):
    return _periods(spark, path, PERIODS, 1, False)


@query("month_spine", f"""select c_nationkey as nation, {day('m')} as month from (select c_nationkey,
unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate), interval 1 month)) as m
from orders join customer on c_custkey = o_custkey group by 1)""")
def _(spark, path):
    t = Roles(spark, path).t
    span = (t["orders"].groupBy("o_custkey").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
            .join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey")
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    return span.select(F.col("c_nationkey").alias("nation"),
                       F.explode(w.month_spine(F.col("lo"), F.col("hi"))).alias("month"))


@query("valid_in_month", f"""{with_roles('r_budgets', 'r_orders', 'r_patients')}
select year(stamp) * 100 + month(stamp) as yyyymm, count(*) as orders from r_orders join r_patients using (patient_id)
join r_budgets b using (client_id, site_id)
where begin_yyyymm <= year(stamp) * 100 + month(stamp) and year(stamp) * 100 + month(stamp) <= coalesce(end_yyyymm, 299912) group by 1""")
def _(spark, path):
    r = Roles(spark, path)
    return (r.orders().join(r.patients().select("patient_id", "client_id", "site_id"), "patient_id")
            .join(r.budgets(), ["client_id", "site_id"]).filter(w.valid_in_month(yyyymm("stamp")))
            .groupBy(yyyymm("stamp").alias("yyyymm")).agg(F.count("*").alias("orders")))


@query("title_for_month", f"select distinct {day('d')} as d, 'Month of ' || month(d) || '/' || year(d) as title from {DAYS}")
def _(spark, path):
    return _days(spark, path).select("d", w.title_for_month(F.col("d")).alias("title"))


@query("shift_window", f"""select event_id, {stamp('ts - interval 6 hour')} as lo, {stamp('ts + interval 6 hour')} as hi,
{stamp('ts')} as same from events""")
def _(spark, path):
    lo, hi = w.shift_window("ts", "ts", 6)
    return Roles(spark, path).t["events"].select("event_id", lo.alias("lo"), hi.alias("hi"), w.shift_window("ts", "ts", 0)[0].alias("same"))


@query("window_edges", """select sum(case when ts >= '2024-01-07' and ts <= '2024-01-13' then 1 else 0 end)::bigint as midnight,
sum(case when ts >= '2024-01-07' and ts < '2024-01-14' then 1 else 0 end)::bigint as whole_day from events""")
def _(spark, path):
    inside = lambda upper: F.count(F.when(w.in_window("ts", "2024-01-07", "2024-01-13", upper), 1)).alias(upper)
    return Roles(spark, path).t["events"].agg(inside("midnight"), inside("whole_day"))


# ---- filters

def _o(spark, path):
    return Roles(spark, path).orders()


@query("optional_filter", f"""{with_roles('r_orders')} select 'one' as asked, order_id from r_orders where reason = '2'
union all select 'all', order_id from r_orders""")
def _(spark, path):
    o = _o(spark, path)
    one = f.optional_filter(o, "reason", "2").select(F.lit("one").alias("asked"), "order_id")
    return one.unionByName(f.optional_filter(o, "reason", None).select(F.lit("all").alias("asked"), "order_id"))


@query("list_filter", f"{with_roles('r_orders')} select order_id, driver_id from r_orders where driver_id in (1, 4, 9)")
def _(spark, path):
    return f.list_filter(_o(spark, path), "driver_id", "1,4,9").select("order_id", "driver_id")


@query("search_orders", f"""{with_roles('r_shipped', 'r_patients')},
j as (select s.*, p.client_id, p.last_name from r_shipped s join r_patients p using (patient_id)),
st as (select * from j where status in ('R','S','T','U','Q','D','P','QU'))
select 'order' as asked, order_id from st where order_id = 77
union all select 'route', order_id from st where route_number = 2 and scheduled between timestamp '1997-01-01' - interval 6 hour and timestamp '1997-06-30' + interval 6 hour
union all select 'patient', order_id from st where patient_id = 5
union all select 'name', order_id from st where lower(last_name) like 'cust%' and client_id in (3, 4)
  and completed between '1998-01-01' and '1998-12-31'
union all select 'today', order_id from st where scheduled between timestamp '1997-03-05' - interval 6 hour and timestamp '1997-03-05' + interval 6 hour
  or stamp = '1997-03-05' or completed = '1997-03-05'
union all select 'open', order_id from st where scheduled between timestamp '1997-01-01' - interval 6 hour and timestamp '1997-02-01' + interval 6 hour
  and reconciled is null and completed is not null""")
def _(spark, path):
    r = Roles(spark, path)
    j = r.shipped_orders().join(r.patients().select("patient_id", "client_id", "last_name"), "patient_id")
    found = {
        "order": f.search_orders(j, order_id=77, route=2, patient_id=5, last_name="x", date_mode=1, start=F.lit("1997-01-01"), end=F.lit("1997-01-02")),
        "route": f.search_orders(j, route=2, patient_id=5, start=F.lit("1997-01-01"), end=F.lit("1997-06-30")),
        "patient": f.search_orders(j, patient_id=5, last_name="x", statuses="Q"),
        "name": f.search_orders(j, last_name="Cust", clients="3,4", date_mode=2, start=F.lit("1998-01-01"), end=F.lit("1998-12-31")),
        "today": f.search_orders(j, today="1997-03-05"),
        "open": f.search_orders(j, statuses="!", start="1997-01-01", today="1997-02-01"),
    }
    return reduce(lambda a, b: a.unionByName(b), [d.select(F.lit(k).alias("asked"), "order_id") for k, d in found.items()])


DATE_TESTS = {
    0: "scheduled between timestamp '1997-02-01' - interval 6 hour and timestamp '1997-03-31' + interval 6 hour",
    1: "stamp between '1997-02-01' and '1997-03-31'",
    2: "completed between '1997-02-01' and '1997-03-31'",
    3: "completed between '1997-02-01' and '1997-03-31' and completion_action = 2",
}
DATE_TESTS_ALL = {**DATE_TESTS, None: " or ".join(DATE_TESTS[k] for k in (0, 1, 2))}


@query("date_mode_filter", with_roles("r_shipped") + " " + " union all ".join(
    f"select {-1 if k is None else k} as mode, count(*) as n, min(order_id) as lo, max(order_id) as hi from r_shipped where {v}"
    for k, v in DATE_TESTS_ALL.items()))
def _(spark, path):
    s = Roles(spark, path).shipped_orders()
    one = lambda k: f.date_mode_filter(s, k, "1997-02-01", "1997-03-31").agg(
        F.lit(-1 if k is None else k).alias("mode"), F.count("*").alias("n"), F.min("order_id").alias("lo"), F.max("order_id").alias("hi"))
    return reduce(lambda a, b: a.unionByName(b), [one(k) for k in DATE_TESTS_ALL])


STATUS_TESTS = {
    None: "status in ('R','S','T','U','Q','D','P','QU')",
    "R": "status = 'R' and scheduled is null",
    "S": "status = 'R' and scheduled is not null",
    "R,S,D": "status in ('R', 'D')",
    "D,P,!": "status in ('D', 'P') and reconciled is null and completed is not null",
    "priority": "status = 'R' and scheduled is not null and priority",
}


@query("status_mode_filter", with_roles("r_shipped") + " " + " union all ".join(
    f"select '{k}' as asked, count(*) as n, min(order_id) as lo, max(order_id) as hi from r_shipped where {v}"
    for k, v in STATUS_TESTS.items()))
def _(spark, path):
    s = Roles(spark, path).shipped_orders()
    one = lambda k: f.status_mode_filter(s, None if k == "priority" else k, k == "priority").agg(
        F.lit(str(k)).alias("asked"), F.count("*").alias("n"), F.min("order_id").alias("lo"), F.max("order_id").alias("hi"))
    return reduce(lambda a, b: a.unionByName(b), [one(k) for k in STATUS_TESTS])


@query("in_list", f"{with_roles('r_orders')} select order_id, status from r_orders where status in ('D', 'P')")
def _(spark, path):
    return f.in_list(_o(spark, path), "status", ["D", "P"]).select("order_id", "status")


@query("not_in_list", f"{with_roles('r_orders')} select order_id, reason from r_orders where reason not in ('1', '5')")
def _(spark, path):
    return f.not_in_list(_o(spark, path), "reason", ["1", "5"]).select("order_id", "reason")


@query("prefix_like", "select c_custkey as id, c_name as name from customer where lower(c_name) like 'customer#00000001%'")
def _(spark, path):
    return Roles(spark, path).t["customer"].filter(prefix_like("c_name", "CUSTOMER#00000001")).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


@query("code_in_string", """select l_linestatus || l_returnflag as code, l_linestatus, count(*) as n,
case when instr('DSHOPMY#GS', l_linestatus) > 0 then 1 else 0 end as hit,
case when instr('DSHOPMY#GS', l_linestatus || l_returnflag) > 0 then 1 else 0 end as hit_pair from lineitem group by 1, 2""")
def _(spark, path):
    both = F.concat("l_linestatus", "l_returnflag")
    return Roles(spark, path).t["lineitem"].groupBy(both.alias("code"), "l_linestatus").agg(F.count("*").alias("n")).select(
        "code", "l_linestatus", "n", code_in_string("l_linestatus").cast("int").alias("hit"),
        code_in_string("code").cast("int").alias("hit_pair"))


@query("not_null_and_positive", "select c_custkey as id, case when coalesce(c_acctbal, 0) > 0 then 1 else 0 end as flag from customer")
def _(spark, path):
    return Roles(spark, path).t["customer"].select(F.col("c_custkey").alias("id"), not_null_and_positive("c_acctbal").alias("flag"))


@query("same_day_of_month", """select l_orderkey as id, count(*) as n, sum(case when day(o_orderdate) = day(l_shipdate) then 1 else 0 end)::bigint as same_day,
sum(case when o_orderdate::date = l_shipdate::date then 1 else 0 end)::bigint as same_date from lineitem join orders on l_orderkey = o_orderkey group by 1""")
def _(spark, path):
    t = Roles(spark, path).t
    j = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    hit = lambda flag: F.count(F.when(same_day_of_month("o_orderdate", "l_shipdate", flag), 1))
    return j.groupBy(F.col("l_orderkey").alias("id")).agg(F.count("*").alias("n"), hit(False).alias("same_day"), hit(True).alias("same_date"))


@query("exclude_user", f"{with_roles('r_orders')} select order_id, ordered_by from r_orders where ordered_by <> 12")
def _(spark, path):
    return f.exclude_user(_o(spark, path), 12).select("order_id", "ordered_by")


@query("distinct_rows", "select distinct l_orderkey as order_id, l_linenumber as line from lineitem")
def _(spark, path):
    return Roles(spark, path).t["lineitem"].select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line")).transform(f.distinct_rows)
