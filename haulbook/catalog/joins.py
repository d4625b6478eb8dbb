"""Join forms over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulbook.functions.dates import yyyymm
from haulbook.operators import lookups as k
from haulbook.operators.ranking import previous_order
from haulbook.operators.history import up_to_last
from haulbook.plans.billing import budget_months

from .registry import query, stamp
from .roles import Roles, with_roles


@query("star_join", f"""{with_roles('r_orders', 'r_patients', 'r_locations', 'r_companies')}
select s.name as site_name, c.name as client_name, f.abbr as client_company_abbr, count(*) as orders, sum(order_id)::bigint as ids
from r_orders join r_patients using (patient_id) join r_locations s on s.location_id = site_id
join r_locations c on c.location_id = client_id join r_companies f on f.id = c.company_id group by 1, 2, 3""")
def _(spark, path):
    r = Roles(spark, path)
    star = k.star_join(r.orders(), r.patients().drop("type", "address_id"), r.locations(), r.companies())
    return star.groupBy("site_name", "client_name", "client_company_abbr").agg(F.count("*").alias("orders"), F.sum("order_id").alias("ids"))


@query("left_outer_lookup", f"""{with_roles('r_history', 'r_users')} select h.history_id, u."full" as user_full
from r_history h left join r_users u on u.user_id = h.user_id * 20""")
def _(spark, path):
    r = Roles(spark, path)
    names = r.users().select(F.col("user_id").alias("key"), F.col("full").alias("user_full"))
    return r.history().withColumn("key", F.col("user_id") * 20).join(names, "key", "left").select("history_id", "user_full")


@query("right_outer_update", """select o_orderkey as order_id, case when big.c is null then 0 else 1 end as flag from orders
left join (select o_custkey c, year(o_orderdate) y from orders group by 1, 2 having count(*) > 3) big on big.c = o_custkey and big.y = year(o_orderdate)""")
def _(spark, path):
    o = Roles(spark, path).t["orders"].withColumn("y", F.year("o_orderdate"))
    big = o.groupBy("o_custkey", "y").agg(F.count("*").alias("n")).filter("n > 3")
    return k.flag_matches(o, big, ["o_custkey", "y"], "flag").select(F.col("o_orderkey").alias("order_id"), "flag")


@query("pair_attributes", f"""{with_roles('r_billed', 'r_budgets')} select client_id, site_id, yyyymm, count(*) as lines, min(budget_id) as budget_id
from r_billed join r_budgets using (client_id, site_id) group by 1, 2, 3""")
def _(spark, path):
    r = Roles(spark, path)
    return (r.billed().groupBy("client_id", "site_id", "yyyymm").agg(F.count("*").alias("lines"))
            .join(r.budgets().select("client_id", "site_id", "budget_id"), ["client_id", "site_id"]))


@query("group_scoped_lookup", """select o_orderkey as order_id, o_orderpriority as reason_name from orders""")
def _(spark, path):
    r = Roles(spark, path)
    return k.join_code(r.orders(), r.lookup(), "ORC", "reason", "reason_name", how="inner").select("order_id", "reason_name")


@query("lookup_with_default", """select o_orderkey as order_id, case when o_orderpriority = '5-LOW' then '1-URGENT' else o_orderpriority end as reason_name from orders""")
def _(spark, path):
    r = Roles(spark, path)
    o = r.orders().withColumn("reason", F.when(F.col("reason") != "5", F.col("reason")))
    return k.join_code(o, r.lookup(), "ORC", "reason", "reason_name", default="1").select("order_id", "reason_name")


@query("deduped_lookup", """select event_id, event_type || '/1' as label from events""")
def _(spark, path):
    """Each code stands in several groups of the lookup; the join still gives one row per event."""
    e = Roles(spark, path).t["events"]
    lookup = e.select(F.col("event_type").alias("code"), F.concat("event_type", F.lit("/"), (F.col("event_id") % 3 + 1).cast("string")).alias("label")).distinct()
    return e.join(k.dedupe_lookup(lookup, "code", "label"), F.col("event_type") == F.col("code")).select("event_id", "label")


@query("prefix_join", f"""{with_roles('r_locations')}, t as (select location_id, state || ' Region' as region_name, region_id from r_locations where type = 'C')
select location_id, region_name, coalesce(t.region_id, s.region_id) as region_id, count(c_custkey) as customers from t
left join r_states s on s.state = left(region_name, 2) left join customer on c_nationkey = location_id group by 1, 2, 3""")
def _(spark, path):
    r = Roles(spark, path)
    loc = r.locations().filter(F.col("type") == "C").select("location_id", "region_id", F.concat("state", F.lit(" Region")).alias("region_name"))
    filled = k.region_fill(loc, r.states())
    n = r.t["customer"].groupBy("c_nationkey").agg(F.count("*").alias("customers"))
    return (filled.join(n, F.col("c_nationkey") == F.col("location_id"), "left")
            .select("location_id", "region_name", "region_id", F.coalesce("customers", F.lit(0)).alias("customers")))


@query("semi_join", "select o_orderkey as order_id from orders where o_orderkey in (select l_orderkey from lineitem where l_quantity > 49)")
def _(spark, path):
    t = Roles(spark, path).t
    big = t["lineitem"].filter("l_quantity > 49").select(F.col("l_orderkey").alias("order_id"))
    return k.semi_join(t["orders"].select(F.col("o_orderkey").alias("order_id")), big, "order_id")


@query("anti_join", "select o_orderkey as order_id from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')")
def _(spark, path):
    t = Roles(spark, path).t
    back = t["lineitem"].select(F.when(F.col("l_returnflag") == "R", F.col("l_orderkey")).alias("order_id"))
    return k.anti_join(t["orders"].select(F.col("o_orderkey").alias("order_id")), back, "order_id")


@query("theta_join_on_id", """select user_id as order_id, count(*) as n, min(event_id) as first_id from events
join (select user_id u, max(event_id) m from events where event_type = 'click' group by 1) on u = user_id and event_id <= m group by 1""")
def _(spark, path):
    """History rows up to the order's last scheduling."""
    log = Roles(spark, path).history()
    return up_to_last(log, F.col("action") == "Sch").groupBy("order_id").agg(F.count("*").alias("n"), F.min("history_id").alias("first_id"))


PREV = f"""select o_orderkey as order_id, lag(o_orderkey) over w as prev_id, {stamp('lag(o_orderdate) over w')} as prev_at
from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)"""


def _previous(spark, path, **opts):
    o = Roles(spark, path).orders()
    return previous_order(o, ["patient_id"], "completed", "order_id", ["order_id", "completed"], **opts).select(
        "order_id", F.col("prev.order_id").alias("prev_id"), F.col("prev.completed").alias("prev_at"))


@query("previous_order", PREV)
def _(spark, path):
    return _previous(spark, path)


@query("previous_order_split", PREV)
def _(spark, path):
    """The same with two ids to a block."""
    return _previous(spark, path, block=2)


@query("fallback_lookup", f"""{with_roles('r_orders', 'r_patients', 'r_locations', 'r_user_locations')}
select o.order_id, coalesce(a.company_id, b.company_id) as user_company, case when a.company_id is not null then a.type else b.type end as user_level
from r_orders o join r_patients p using (patient_id) join r_locations c on c.location_id = p.client_id join r_locations s on s.location_id = p.site_id
left join r_user_locations a on a.user_id = o.ordered_by and a.company_id = c.company_id
left join r_user_locations b on b.user_id = o.ordered_by and b.company_id = s.company_id""")
def _(spark, path):
    r = Roles(spark, path)
    firm = lambda key, out: r.locations().select(F.col("location_id").alias(key), F.col("company_id").alias(out))
    o = (r.orders().join(r.patients().select("patient_id", "client_id", "site_id"), "patient_id")
         .join(firm("client_id", "c1"), "client_id").join(firm("site_id", "c2"), "site_id"))
    return k.fallback_lookup(o, r.user_locations(), "ordered_by", "c1", "c2").select("order_id", "user_company", "user_level")


@query("join_on_name", """select s_suppkey as id, n_name as name, r_name as region from supplier join nation on s_nationkey = n_nationkey
left join region on r_regionkey = n_regionkey""")
def _(spark, path):
    t = Roles(spark, path).t
    site = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("id"), F.col("n_name").alias("name"))
    table = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).groupBy(F.col("n_name").alias("name")).agg(F.min("r_name").alias("region"))
    return site.join(table, "name", "left")


@query("deduped_dimension", """select c_custkey as id, c_mktsegment as level_name from customer""")
def _(spark, path):
    t = Roles(spark, path).t
    levels = t["customer"].select(F.ascii("c_mktsegment").alias("code"), F.col("c_mktsegment").alias("level_name")).dropDuplicates()
    return t["customer"].withColumn("code", F.ascii("c_mktsegment")).join(levels, "code").select(F.col("c_custkey").alias("id"), "level_name")


@query("bridge_chain", """select l_orderkey as order_id, count(*) as n, count(distinct p_type) as types, sum(p_size)::bigint as sizes
from lineitem join part on l_partkey = p_partkey where l_returnflag <> 'R' group by 1""")
def _(spark, path):
    r = Roles(spark, path)
    bridge = k.equipment_lines(r.equipment().select("product_id", "equipment_id"),
                               r.equipment().select("equipment_id", F.col("product_id").alias("item_id")),
                               r.equipment().select(F.col("product_id").alias("item_id"), F.col("item_name").alias("name"), "category"))
    lines = r.details().filter(F.col("order_id").isNotNull()).join(bridge, "product_id")
    return lines.groupBy("order_id").agg(F.count("*").alias("n"), F.count_distinct("item_name").alias("types"), F.sum("category").alias("sizes"))


@query("override_lookup", f"""{with_roles('r_details', 'r_equipment', 'r_client_equip', 'r_orders', 'r_patients')}
select client_id, site_id, count(*) as lines, count(case when coalesce(c.disposable, e.disposable) then 1 end) as disposable,
count(case when e.disposable then 1 end) as general from r_details d join r_orders o using (order_id) join r_patients p using (patient_id)
join r_equipment e using (product_id) left join r_client_equip c using (client_id, site_id, equipment_id) group by 1, 2""")
def _(spark, path):
    r = Roles(spark, path)
    eq = r.equipment().select("product_id", "equipment_id", "item_id", "oxygen", "disposable", F.col("disposable").alias("general"))
    who = r.orders().select("order_id", "patient_id").join(r.patients().select("patient_id", "client_id", "site_id"), "patient_id")
    lines = r.details().select("order_id", "product_id").join(who, "order_id").join(eq, "product_id")
    return k.override_flags(lines, r.client_equip()).groupBy("client_id", "site_id").agg(
        F.count("*").alias("lines"), F.count(F.when(F.col("disposable"), 1)).alias("disposable"), F.count(F.when(F.col("general"), 1)).alias("general"))


@query("spine_join", f"""{with_roles('r_budgets')} select yyyymm, count(*) as pairs from r_budgets
join (select distinct year(o_orderdate) * 100 + month(o_orderdate) yyyymm from orders) on begin_yyyymm <= yyyymm and yyyymm <= end_yyyymm group by 1""")
def _(spark, path):
    r = Roles(spark, path)
    months = r.t["orders"].select(yyyymm("o_orderdate").alias("yyyymm")).distinct()
    return budget_months(r.budgets(), months).groupBy("yyyymm").agg(F.count("*").alias("pairs"))
