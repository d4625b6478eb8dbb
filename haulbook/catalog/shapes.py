"""Aggregates, windows, reshaping and set operations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulbook.functions.dates import minutes_between, yyyymm, yyyymm_to_date
from haulbook.operators import aggregates as a, ranking as rk, reshape as rs
from haulbook.plans.quality import accuracy_flags, kit_errors
from haulbook.plans.workflow import dispatch_band

from .registry import money_ratio, pct, query, ratio
from .roles import Roles, with_roles

MONEY = "decimal(19,4)"


def _seg_sales(spark, path):
    """Billed total per segment, region and brand number, one row each."""
    r = Roles(spark, path)
    nation = r.t["nation"].select(F.col("n_nationkey").alias("client_id"), F.col("n_regionkey").alias("region_id"))
    return (r.billed().groupBy("client_id", "site_id", "equipment_id", "yyyymm").agg(F.sum("total").alias("total"))
            .join(r.brands(), "equipment_id").join(nation, "client_id")
            .groupBy("site_id", "region_id", "item_id", "yyyymm").agg(F.sum("total").cast("decimal(28,4)").alias("total")))


SALES = f"""{with_roles('r_billed')}, sales as (select site_id, n_regionkey region_id, item_id, yyyymm, sum(total) total
from r_billed join nation on n_nationkey = client_id group by all)"""


# ---- aggregates

@query("count_orders_by", "select c_name as name, count(*) as order_count from orders join customer on o_custkey = c_custkey group by 1")
def _(spark, path):
    t = Roles(spark, path).t
    per = a.count_orders_by(t["orders"], "o_custkey")
    return (per.join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_name").alias("name"))
            .agg(F.sum("order_count").alias("order_count")))


@query("conditional_counts", """select count(*) as orders, count(case when o_orderstatus = 'P' then 1 end) as pickups,
count(case when o_orderstatus = 'P' and o_totalprice < 100000 then 1 end) as small_pickups from orders""")
def _(spark, path):
    p = F.col("o_orderstatus") == "P"
    return a.conditional_counts(Roles(spark, path).t["orders"],
                                {"orders": F.lit(True), "pickups": p, "small_pickups": p & (F.col("o_totalprice") < 100000)})


GROUPS = {"beds": [1, 2, 3], "concentrators": [4, 5], "lal": [6], "wheelchairs": [7, 8, 9, 10]}


@query("flag_counts_per_key", f"""select l_orderkey as order_id, count(case when p_type = 'PROMO' then 1 end) as service_calls,
{', '.join(f"count(case when p_size in ({', '.join(map(str, v))}) then 1 end) as {n}" for n, v in GROUPS.items())}
from lineitem join part on p_partkey = l_partkey where l_returnflag <> 'R' group by 1""")
def _(spark, path):
    return a.flag_counts_per_key(Roles(spark, path).item_lines(), groups=GROUPS, service=F.col("item_name") == "PROMO")


@query("elapsed_buckets", "select o_custkey as patient_id, " + ", ".join(
    f"count(case when m <= {(k + 1) * 1440} {'and m > ' + str(k * 1440) if k else ''} then 1 end) as n_{(k + 1) * 24}h, "
    + pct(f"count(case when m <= {(k + 1) * 1440} {'and m > ' + str(k * 1440) if k else ''} then 1 end)", "count(*)", 4) + f" as pct_{(k + 1) * 24}h"
    for k in range(7)) + " from (select o_custkey, abs(date_diff('minute', o_orderdate, l_shipdate)) % 12000 as m from lineitem join orders on l_orderkey = o_orderkey) group by 1")
def _(spark, path):
    t = Roles(spark, path).t
    j = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    m = j.select(F.col("o_custkey").alias("patient_id"), (F.abs(minutes_between("o_orderdate", "l_shipdate")) % 12000).alias("m"))
    return m.groupBy("patient_id").agg(*a.elapsed_buckets("m"))


@query("mean_over_months", f"""select o_custkey as id, count(*) as months, {ratio('sum(n)::bigint', 'count(*)', 6)} as mean from
(select o_custkey, year(o_orderdate) * 100 + month(o_orderdate) as m, sum(cast(left(o_orderpriority, 1) as int)) as n from orders group by 1, 2) group by 1""")
def _(spark, path):
    o = Roles(spark, path).orders().withColumn("m", yyyymm("stamp"))
    return a.mean_over_months(o, ["patient_id"], "m", "route_number").withColumnRenamed("patient_id", "id")


@query("net_nonzero_totals", """select l_suppkey as site, l_partkey as item, cast(sum(v) as double) as total, count(*) as records from
(select l_suppkey, l_partkey, case l_returnflag when 'A' then 1 when 'R' then -1 else 0 end as v from lineitem) where v <> 0 group by 1, 2 having sum(v) <> 0""")
def _(spark, path):
    v = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "R", -1).otherwise(0).cast(MONEY)
    l = Roles(spark, path).t["lineitem"].select(F.col("l_suppkey").alias("site"), F.col("l_partkey").alias("item"), v.alias("v"))
    return a.net_nonzero_totals(l, ["site", "item"], "v")


KIT = "case when instr('DSHOPMY#GS', l_linestatus) > 0 and l_linenumber % 2 = 0 and {c} = 0 then 1 else 0 end"


def _kit_lines(spark, path, back):
    flag = F.col("l_returnflag") == "R"
    l = Roles(spark, path).t["lineitem"].filter(flag if back else ~flag)
    n = F.when(F.col("l_linenumber") % 2 == 0, 1).otherwise(0)
    return kit_errors(l.select(F.col("l_orderkey").alias("order_id"), F.col("l_linestatus").alias("status"), n.alias("serial_count"), n.alias("o2_count"),
                               F.when(F.col("l_discount") > 0, "s").alias("serial_number"), F.when(F.col("l_tax") > 0, "o").alias("o2_lot")))


@query("error_lines_per_order", f"""select l_orderkey as order_id,
sum(case when l_returnflag <> 'R' then {KIT.format(c='l_discount')} else 0 end)::bigint as serial_delivery, sum(case when l_returnflag <> 'R' then {KIT.format(c='l_tax')} else 0 end)::bigint as oxygen_delivery,
sum(case when l_returnflag = 'R' then {KIT.format(c='l_discount')} else 0 end)::bigint as serial_pickup, sum(case when l_returnflag = 'R' then {KIT.format(c='l_tax')} else 0 end)::bigint as oxygen_pickup
from lineitem group by 1""")
def _(spark, path):
    return a.error_lines_per_order(_kit_lines(spark, path, False), _kit_lines(spark, path, True), ["order_id"])


NOTES = "select conv_id, 0 as part, string_agg(text, ', ' order by turn) as notes, count(*) as note_count from conversations group by 1"


@query("concat_notes", NOTES)
def _(spark, path):
    return a.concat_notes(Roles(spark, path).t["conversations"], "conv_id", "text", "turn")


@query("concat_notes_blocks", NOTES)
def _(spark, path):
    """The same through blocks of two turns each."""
    return a.concat_notes(Roles(spark, path).t["conversations"], "conv_id", "text", "turn", block=2)


@query("item_list", """select l_orderkey as order_id, string_agg('{' || n || 'x} ' || p_name || '[' || l_linestatus || ']', ', ' order by p_name || chr(1) || l_linestatus) as item_list
from (select l_orderkey, p_name, l_linestatus, count(*) as n from lineitem join part on p_partkey = l_partkey where l_returnflag <> 'R' group by 1, 2, 3) group by 1""")
def _(spark, path):
    return a.item_list(Roles(spark, path).item_lines().withColumnRenamed("status", "status_name"))


@query("keep_first_of_group", """select o_orderkey as order_id, case when row_number() over (partition by o_custkey, o_orderdate order by o_orderkey) = 1 then 1 else 0 end as keep from orders""")
def _(spark, path):
    return a.keep_first_of_group(Roles(spark, path).orders(), ["patient_id", "stamp"], "order_id", "keep").select("order_id", "keep")


@query("latest_per_key", "select l_orderkey as order_id, max(l_linenumber) as sequence_number from lineitem group by 1")
def _(spark, path):
    l = Roles(spark, path).t["lineitem"].select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("sequence_number"))
    return a.latest_per_key(l, "order_id", "sequence_number")


SITE_GROUPS = ["small", "promo"]

def _site_sql(total):
    sums = "sum(orders)::bigint as orders, sum(service_calls)::bigint as service_calls, sum(small)::bigint as small, sum(promo)::bigint as promo, sum(other)::bigint as other"
    src = f"(select 0 as site_id, 'All' as site_name, {sums} from per_site)" if total else "per_site"
    text = lambda n, d: f"printf('%.2f', {pct(n, d)}) || '%'"
    return f"""with per_site as (select s_suppkey as site_id, s_name as site_name, orders, service_calls, small, promo, other from supplier left join (
select l_suppkey, count(*) as orders, count(case when sc then 1 end) as service_calls, count(case when sc and sm then 1 end) as small,
count(case when sc and pr then 1 end) as promo, count(case when sc and not sm and not pr then 1 end) as other from
(select l_suppkey, l_linenumber > 5 as sc, l_quantity < 10 as sm, l_discount = 0.1 as pr from lineitem) group by 1) on l_suppkey = s_suppkey)
select site_id, site_name, orders, service_calls, small, promo, other, {text('small', 'service_calls')} as pct_small, {text('promo', 'service_calls')} as pct_promo,
{text('other', 'service_calls')} as pct_other, {text('service_calls', 'orders')} as pct_service_calls from {src}"""


def _sites(spark, path):
    t = Roles(spark, path).t
    flag = lambda c, n: F.when(c, 1).otherwise(0).alias(n)
    lines = t["lineitem"].select(
        F.col("l_suppkey").alias("site_id"), flag(F.col("l_linenumber") > 5, "service_call"), flag(F.col("l_quantity") < 10, "small"),
        flag(F.col("l_discount") == 0.1, "promo"))
    return a.site_summary(lines, t["supplier"].select(F.col("s_suppkey").alias("site_id"), F.col("s_name").alias("site_name")), SITE_GROUPS)


@query("site_summary", _site_sql(False))
def _(spark, path):
    return _sites(spark, path)


@query("company_summary", _site_sql(True))
def _(spark, path):
    return a.company_summary(_sites(spark, path), SITE_GROUPS)


@query("dispatch_bands", """select event_id, case when m < 15 then '<15' when m >= 30 then '>30' else 'NA' end as band from
(select event_id, case when event_type <> 'error' then date_diff('minute', date_trunc('hour', ts), ts) end as m from events)""")
def _(spark, path):
    e = Roles(spark, path).t["events"]
    m = F.when(F.col("event_type") != "error", minutes_between("date_trunc('hour', ts)", "ts"))
    return e.select("event_id", dispatch_band(m).alias("band"))


@query("accuracy_flags", """select o_orderkey as order_id, case when has is null then 1 else 0 end as missing_order_stat,
case when has is null then null when ir + se = 0 then 0 else 1 end as totally_accurate from
(select o_orderkey, case when o_orderstatus <> 'P' then true end as has, case when o_orderstatus = 'F' then 1 else 0 end as ir,
case when o_orderpriority = '5-LOW' then 1 else 0 end as se from orders)""")
def _(spark, path):
    o = Roles(spark, path).t["orders"]
    zero = ["oxygen_delivery", "serial_pickup", "wo_match", "instruct", "dme", "signature", "notes", "replied"]
    flags = o.select(F.col("o_orderkey").alias("order_id"), F.when(F.col("o_orderstatus") != "P", True).alias("has_stats"),
                     F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("ir_correct"),
                     F.when(F.col("o_orderpriority") == "5-LOW", 1).otherwise(0).alias("serial_delivery"), *[F.lit(0).alias(n) for n in zero])
    out = accuracy_flags(flags)
    return out.select("order_id", F.col("missing_order_stat").cast("int").alias("missing_order_stat"), "totally_accurate")


# ---- windows

@query("sequence_rows", f"""{SALES} select site_id, item_id, cast(total as double) as total, row_number() over (partition by site_id order by total desc, item_id) as seqno
from (select site_id, item_id, sum(total) total from sales group by 1, 2)""")
def _(spark, path):
    s = _seg_sales(spark, path).groupBy("site_id", "item_id").agg(F.sum("total").alias("total"))
    return rk.sequence_rows(s, ["site_id"], [F.col("total").desc(), "item_id"])


VALID = """with o as (select o_orderkey, o_custkey, o_orderdate, o_orderstatus <> 'F' as ok from orders),
n as (select *, last_value(case when ok then o_orderkey end ignore nulls) over w as prev_id,
  sum(case when ok then 0 else 1 end) over w as bad from o window w as (partition by o_custkey order by o_orderdate, o_orderkey rows between unbounded preceding and 1 preceding))
select n.o_orderkey as order_id, n.prev_id, cast(coalesce(n.bad, 0) - coalesce(p.bad, 0) as bigint) as skipped from n left join n p on p.o_orderkey = n.prev_id"""


def _valid(spark, path, **opts):
    o = Roles(spark, path).orders()
    out = rk.previous_valid_order(o, ["patient_id"], "completed", "order_id", F.col("status") != "D", ["order_id"], **opts)
    return out.select("order_id", F.col("prev.order_id").alias("prev_id"), "skipped")


@query("previous_valid_order", VALID)
def _(spark, path):
    return _valid(spark, path)


@query("previous_valid_order_split", VALID)
def _(spark, path):
    """The same with two ids to a block."""
    return _valid(spark, path, block=2)


TOTALS = "totals as (select site_id, region_id, item_id, sum(total) total from sales group by 1, 2, 3)"


def _totals(spark, path):
    return _seg_sales(spark, path).groupBy("site_id", "region_id", "item_id").agg(F.sum("total").alias("total"))


@query("top_n_per_group", f"""{SALES}, {TOTALS} select * from (select site_id, region_id, item_id, cast(total as double) as total,
row_number() over (partition by site_id, region_id order by total desc, item_id) as rank from totals) where rank <= 5""")
def _(spark, path):
    return rk.top_n_per_group(_totals(spark, path), ["site_id", "region_id"], 5, "total", ["item_id"])


@query("share_of_group", f"""{SALES}, {TOTALS} select site_id, region_id, item_id, cast(total as double) as total, cast(g as double) as group_total,
{money_ratio('total', 'g')} as share from (select *, sum(total) over (partition by site_id, region_id) as g from totals)""")
def _(spark, path):
    return rk.share_of_group(_totals(spark, path), ["site_id", "region_id"], "total")


# ---- sorts, limits, padding, reshaping

@query("sort_report", "select n_regionkey, n_name, count(*) as n from customer join nation on n_nationkey = c_nationkey group by 1, 2 order by n_regionkey, n desc, n_name")
def _(spark, path):
    t = Roles(spark, path).t
    n = t["customer"].groupBy("c_nationkey").agg(F.count("*").alias("n"))
    named = t["nation"].join(n, F.col("n_nationkey") == F.col("c_nationkey")).select("n_regionkey", "n_name", "n")
    return rk.sort_report(named, "n_regionkey", F.col("n").desc(), "n_name")


@query("dynamic_sort", "select o_orderkey as order_id, o_orderstatus as status from orders order by o_orderstatus, lpad(cast(o_orderkey as varchar), 25, '0')")
def _(spark, path):
    o = Roles(spark, path).t["orders"].select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"))
    return rk.dynamic_sort(o, "status", {"order_id": rk.padded_id("order_id"), "status": F.col("status")}, "order_id")


@query("limit_n", "select l_orderkey as order_id, count(*) as n from lineitem group by 1 order by n desc, order_id limit 5")
def _(spark, path):
    n = Roles(spark, path).t["lineitem"].groupBy(F.col("l_orderkey").alias("order_id")).agg(F.count("*").alias("n"))
    return rk.limit_n(n, 5, F.col("n").desc(), "order_id")


TYPES = "select s_nationkey as region_id, s_suppkey as item_id, s_name as item_name, count(*)::bigint as total from supplier join lineitem on l_suppkey = s_suppkey group by 1, 2, 3"


@query("pad_to_n", f"""with t as ({TYPES}) select region_id, item_id, item_name, total from t
union all select region_id, 0, 'Space Holder ' || k, 0 from (select region_id, 5 - count(*) as gap from t group by 1) cross join (select unnest(range(1, 6)) k) where k <= gap""")
def _(spark, path):
    t = Roles(spark, path).t
    n = t["lineitem"].groupBy("l_suppkey").agg(F.count("*").alias("total"))
    rows = t["supplier"].join(n, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_nationkey").alias("region_id"), F.col("s_suppkey").alias("item_id"), F.col("s_name").alias("item_name"), "total")
    return rs.pad_to_n(rows, ["region_id"], 5, "item_name", {"item_id": F.lit(0).cast("long"), "total": F.lit(0).cast("long")})


MONTHS = [199801, 199802, 199803, 199804, 199805, 199806]


def _month_cols(k, m):
    t = f"coalesce(sum(case when yyyymm = {m} then total end), 0)"
    g = f"coalesce(sum(case when yyyymm = {m} then g end), 0)"
    return f"'{m // 100}-{m % 100:02d}' as m{k}_label, cast({t} as double) as m{k}_total, cast({g} as double) as m{k}_group, {money_ratio(t, g)} as m{k}_share"


@query("months_to_columns", f"""{SALES}, i as (select site_id, item_id, yyyymm, sum(total) total from sales group by all)
select site_id, item_id, {', '.join(_month_cols(k, m) for k, m in enumerate(MONTHS, 1))},
cast(coalesce(sum(case when yyyymm between 199801 and 199806 then total end), 0) as double) as months_total
from (select *, sum(total) over (partition by site_id, yyyymm) as g from i) group by 1, 2""")
def _(spark, path):
    return _months(spark, path)


def _months(spark, path):
    i = _seg_sales(spark, path).groupBy("site_id", "item_id", "yyyymm").agg(F.sum("total").alias("total"))
    g = i.groupBy("site_id", "yyyymm").agg(F.sum("total").alias("group_total"))
    both = i.join(g, ["site_id", "yyyymm"]).withColumn("month", yyyymm_to_date("yyyymm"))
    return rs.total_across_months(rs.months_to_columns(both, ["site_id", "item_id"], "month", "1998-01-01", 6), 6)


@query("total_across_months", f"""{SALES} select site_id, item_id, cast(coalesce(sum(case when yyyymm between 199801 and 199806 then total end), 0) as double) as months_total
from sales group by 1, 2""")
def _(spark, path):
    return _months(spark, path).select("site_id", "item_id", "months_total")


@query("densify", f"""{SALES}, r as (select site_id, region_id, item_id, sum(total) total from sales where yyyymm = 199701 group by all),
top as (select site_id, item_id from (select site_id, item_id, row_number() over (partition by site_id order by sum(total) desc, item_id) rn from sales group by 1, 2) where rn <= 5)
select site_id, item_id, region_id, cast(coalesce(total, 0) as double) as total from top join (select distinct site_id, region_id from sales) using (site_id)
left join r using (site_id, region_id, item_id)""")
def _(spark, path):
    s = _seg_sales(spark, path)
    jan = s.filter(F.col("yyyymm") == 199701).groupBy("site_id", "region_id", "item_id").agg(F.sum("total").alias("total"))
    top = rk.top_n_per_group(s.groupBy("site_id", "item_id").agg(F.sum("total").alias("t")), ["site_id"], 5, "t", ["item_id"]).select("site_id", "item_id")
    return rs.densify(jan, top, s.select("site_id", "region_id").distinct(), ["site_id"], ["site_id", "region_id", "item_id"], ["total"])


# ---- set operations

@query("union_all", """select l_orderkey as order_id, 'delivery' as kind, count(*) as n from lineitem where l_returnflag <> 'R' group by 1
union all select l_orderkey, 'pickup', count(*) from lineitem where l_returnflag = 'R' group by 1""")
def _(spark, path):
    l = Roles(spark, path).t["lineitem"]
    side = lambda c, k: l.filter(c).groupBy(F.col("l_orderkey").alias("order_id")).agg(F.lit(k).alias("kind"), F.count("*").alias("n"))
    back = F.col("l_returnflag") == "R"
    return rs.union_all(side(~back, "delivery"), side(back, "pickup"))


@query("union_distinct", """select l_orderkey as order_id from lineitem where l_quantity > 45 union select o_orderkey from orders where o_orderpriority = '1-URGENT'""")
def _(spark, path):
    t = Roles(spark, path).t
    return rs.union_distinct(t["lineitem"].filter("l_quantity > 45").select(F.col("l_orderkey").alias("order_id")),
                             t["orders"].filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("order_id")))


BASE_TYPES = "select c_nationkey as client, c_custkey as id, case when c_mktsegment < 'C' then 'B&M' when c_mktsegment < 'H' and c_nationkey > 3 then 'NET' when c_nationkey % 2 = 0 then 'SWC' end as contract_type from customer"


@query("combine_types", f"""with b as ({BASE_TYPES}), m as (select * from (values {', '.join(f"('{m}', '{c}', {len(ms)})" for c, ms in rs.COMBINED_TYPES.items() for m in ms)}) v(member, combo, need))
select * from b union all select b.client, b.id, m.combo from b join m on m.member = b.contract_type
join (select client, combo from (select distinct client, contract_type from b) d join m on m.member = d.contract_type group by client, combo having count(*) = min(need)) ok
on ok.client = b.client and ok.combo = m.combo""")
def _(spark, path):
    c = Roles(spark, path).t["customer"]
    kind = (F.when(F.col("c_mktsegment") < "C", "B&M").when((F.col("c_mktsegment") < "H") & (F.col("c_nationkey") > 3), "NET")
            .when(F.col("c_nationkey") % 2 == 0, "SWC"))
    base = c.select(F.col("c_nationkey").alias("client"), F.col("c_custkey").alias("id"), kind.alias("contract_type"))
    return rs.combine_types(base, scope=["client"])


@query("append_windows", """select year(o_orderdate) * 100 + month(o_orderdate) as window_month, c_nationkey as client, count(*) as orders
from orders join customer on o_custkey = c_custkey group by 1, 2""")
def _(spark, path):
    """Month and client are columns, so one plan covers what a loop over clients and months would append."""
    t = Roles(spark, path).t
    per = t["orders"].groupBy("o_custkey", yyyymm("o_orderdate").alias("window_month")).agg(F.count("*").alias("n"))
    return (per.join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).groupBy("window_month", F.col("c_nationkey").alias("client"))
            .agg(F.sum("n").alias("orders")))
