"""Contract pairs, billed items and top items over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from haulbook.functions.dates import yyyymm
from haulbook.operators.reshape import COMBINED_TYPES, TYPE_LABELS
from haulbook.plans import billing as b, channel as ch, survey as sv

from .registry import money_ratio, query, ratio
from .roles import Roles, with_roles
from .survey import PAIRS as REGION_PAIRS

MEMBERS = ", ".join(f"('{m}', '{c}', {len(ms)})" for c, ms in COMBINED_TYPES.items() for m in ms)
LABEL = "case contract_type " + " ".join(f"when '{k}' then '{v}'" for k, v in TYPE_LABELS.items()) + " else 'Unknown Type' end"


def _activity(r):
    """A pair is active in a month with orders; patients with an odd number lie in sub-unit 1."""
    return (r.orders().select("patient_id", yyyymm("stamp").alias("yyyymm")).distinct()
            .join(r.patients().select("patient_id", "client_id", "site_id"), "patient_id")
            .select("yyyymm", "client_id", (F.col("patient_id") % 2).cast("int").alias("sub_unit"), "site_id"))


def _months(r):
    return r.t["orders"].select(yyyymm("o_orderdate").alias("yyyymm")).distinct()


def _pairs(r):
    return b.contract_pairs(_activity(r), r.budgets().unionByName(r.sub_budgets()), r.contracts(), r.locations(), _months(r))


PAIR_SQL = f"""{with_roles('r_budgets', 'r_contracts', 'r_locations', 'r_orders', 'r_patients', 'r_billed')},
months as (select distinct year(o_orderdate) * 100 + month(o_orderdate) yyyymm from orders),
act as (select distinct year(stamp) * 100 + month(stamp) yyyymm, client_id, cast(patient_id % 2 as int) sub_unit, site_id from r_orders join r_patients using (patient_id)),
both_units as (select client_id, site_id, begin_yyyymm, end_yyyymm, 0 sub_unit, budget_id, contract_id from r_budgets
  union all select client_id, site_id, begin_yyyymm, end_yyyymm, 1, budget_id + 5000000, (client_id + 1) % 25 from r_budgets where client_id % 5 = 0),
bud as (select yyyymm, client_id, sub_unit, site_id, budget_id, contract_id from both_units join months on begin_yyyymm <= yyyymm and yyyymm <= end_yyyymm),
pair as (select *, 1 activity from act union all select yyyymm, client_id, sub_unit, site_id, 0 from bud
  where (yyyymm, client_id, sub_unit, site_id) not in (select (yyyymm, client_id, sub_unit, site_id) from act)),
con as (select p.yyyymm, p.client_id, p.sub_unit, p.site_id, case when o.budget_id is null and m.budget_id is not null then -1 else activity end activity,
  coalesce(o.budget_id, m.budget_id) budget_id, coalesce(o.contract_id, m.contract_id) contract_id from pair p
  left join bud o on (o.yyyymm, o.client_id, o.sub_unit, o.site_id) = (p.yyyymm, p.client_id, p.sub_unit, p.site_id)
  left join bud m on m.sub_unit = 0 and (m.yyyymm, m.client_id, m.site_id) = (p.yyyymm, p.client_id, p.site_id)),
contract as (select c.yyyymm, c.client_id, c.sub_unit, c.site_id, activity, budget_id, c.contract_id, case when budget_id is not null then 'N' end network_type, coalesce(k.owner_company, 2) as owner,
  case when l.company_id = 2 then 'B&M' when coalesce(k.owner_company, 2) = 2 then 'NET' else 'SWC' end contract_type
  from con c left join r_contracts k using (contract_id) left join r_locations l on l.location_id = c.site_id)"""


@query("contract_pairs", f"{PAIR_SQL} select * from contract")
def _(spark, path):
    return _pairs(Roles(spark, path))


def _typed_pairs(r):
    """Type from the contract, region from the budgeted pairs; one row per month, client and site."""
    regions = sv.budgeted_pairs(r.budgets(), r.locations(), r.regions(), r.states()).select("client_id", "site_id", "region_id", "region_name")
    main = _pairs(r).filter(F.col("sub_unit") == 0).select("yyyymm", "client_id", "site_id", "contract_type")
    return main.join(regions, ["client_id", "site_id"])


ITEM_SQL = f"""{PAIR_SQL}, {REGION_PAIRS},
typed as (select c.yyyymm, c.client_id, c.site_id, contract_type, region_id, region_name from contract c join pairs using (client_id, site_id) where sub_unit = 0),
net as (select yyyymm, client_id, site_id, item_id, sum(total) total, count(*) records from r_billed group by 1, 2, 3, 4),
base as (select n.*, contract_type, region_id, region_name from net n left join typed t using (yyyymm, client_id, site_id)),
member as (select * from (values {MEMBERS}) v(m, combo, need)),
ok as (select combo from (select distinct contract_type from base) join member on m = contract_type group by combo having count(*) = min(need)),
items as (select * from base union all select yyyymm, client_id, site_id, item_id, total, records, combo, region_id, region_name
  from base join member on m = contract_type where combo in (select combo from ok))"""


def _typed(r):
    return b.typed_items(r.billed(), r.brands(), _typed_pairs(r))


@query("billable_items", f"{ITEM_SQL} select yyyymm, client_id, site_id, item_id, cast(total as double) as total, records, contract_type, region_id, region_name from items")
def _(spark, path):
    r = Roles(spark, path)
    return b.billable_items(r.billed(), r.brands(), _typed_pairs(r))


START, N_MONTHS = dt.date(1998, 1, 1), 3
MONTHS = [199801, 199802, 199803]

TOP_SQL = f"""{ITEM_SQL}, known as (select * from items where contract_type is not null and region_id is not null),
nat as (select contract_type, item_id, total, g from (select contract_type, item_id, sum(total) total, sum(sum(total)) over (partition by contract_type) g,
  row_number() over (partition by contract_type order by sum(total) desc, item_id) rn from known group by 1, 2) where rn <= 5),
rnat as (select contract_type, region_id, region_name, item_id, total, g from (select contract_type, region_id, region_name, item_id, sum(total) total,
  sum(sum(total)) over (partition by contract_type, region_id, region_name) g,
  row_number() over (partition by contract_type, region_id, region_name order by sum(total) desc, item_id) rn from known group by 1, 2, 3, 4) where rn <= 5),
cell as (select contract_type, region_id, region_name, yyyymm, item_id, sum(total) total, sum(sum(total)) over (partition by contract_type, region_id, region_name, yyyymm) g
  from known group by 1, 2, 3, 4, 5),
brand as (select distinct cast(substr(p_brand, 7) as int) item_id, p_brand as item_name from part)"""


def _month(m):
    t = f"coalesce(sum(case when yyyymm = {m} then total end), 0)"
    g = f"coalesce(sum(case when yyyymm = {m} then g end), 0)"
    return t, money_ratio(t, g)


MONTH_COLS = ", ".join(f"cast({_month(m)[0]} as double) as m{i}_total, {_month(m)[1]} as m{i}_share" for i, m in enumerate(MONTHS, 1))
ALL_MONTHS = "cast(coalesce(sum(case when yyyymm in (199801, 199802, 199803) then total end), 0) as double) as months_total"


def _top(spark, path, **opts):
    r = Roles(spark, path)
    return b.top_items(_typed(r), r.brand_names(), START, n_months=N_MONTHS, **opts)


@query("top_items", f"""{TOP_SQL} select contract_type, {LABEL} as contract, 'National: All Regions' as region_name, item_id, item_name,
item_name || '   (' || item_id || ')' as item, {ALL_MONTHS}, {MONTH_COLS}
from cell join brand using (item_id) where (contract_type, item_id) in (select (contract_type, item_id) from nat) group by contract_type, item_id, item_name""")
def _(spark, path):
    return _top(spark, path)


@query("top_items_by_region", f"""{TOP_SQL}, c as (select contract_type, region_id, region_name, item_id, {MONTH_COLS} from cell group by 1, 2, 3, 4)
select contract_type, {LABEL} as contract, region_id, region_name, item_id, item_name, {', '.join(f'coalesce(m{i}_share, 0) as m{i}_share' for i in (1, 2, 3))}
from nat join brand using (item_id) join (select distinct contract_type, region_id, region_name from known) using (contract_type)
left join c using (contract_type, region_id, region_name, item_id)""")
def _(spark, path):
    return _top(spark, path, scope="by_region")


@query("top_items_regional", f"""{TOP_SQL}, c as (select contract_type, region_id, region_name, item_id, item_name, {ALL_MONTHS}, {MONTH_COLS} from cell join brand using (item_id)
where (contract_type, region_id, region_name, item_id) in (select (contract_type, region_id, region_name, item_id) from rnat) group by 1, 2, 3, 4, 5)
select *, {LABEL} as contract from (select * from c union all select contract_type, region_id, region_name, 0, 'Space Holder ' || k, 0, 0, 0, 0, 0, 0, 0 from
(select contract_type, region_id, region_name, 5 - count(*) gap from c group by 1, 2, 3) cross join (select unnest(range(1, 6)) k) where k <= gap)""")
def _(spark, path):
    return _top(spark, path, scope="regional")


@query("top_lists", f"""{TOP_SQL} select contract_type, item_id, cast(total as double) as total, cast(g as double) as group_total, {money_ratio('total', 'g')} as share,
row_number() over (partition by contract_type order by total desc, item_id) as rank from nat""")
def _(spark, path):
    return b.top_lists(b.monthly_cells(_typed(Roles(spark, path))))


# ---- order channel and census

@query("order_channel", f"""{with_roles('r_orders', 'r_patients', 'r_locations', 'r_companies', 'r_users', 'r_user_locations')}
select distinct f.name as hospice, coalesce(nullif(c.region_id, 0), st.region_id, 0) as region_id, coalesce(re.r_name, c.state || ' Region') as region, c.name as client,
d.name as provider, s.name as site, ph as phone, 1 - ph as system, case when own then 0 else ph end as phone_network, case when own then ph else 0 end as phone_own,
order_id, monthname(stamp) as month, "full" as ordered_by_name from (
select o.*, p.client_id, p.site_id, u."full", case when u.type in ('D', 'S') or lower(u.first_name) = 'house' then 1 else 0 end as ph
from r_orders o join r_patients p using (patient_id) join r_users u on u.user_id = ordered_by
where o.status in ('D', 'P') and o.reason not in ('X', 'S', 'W', 'V') and stamp >= '1997-01-01' and stamp <= '1997-03-31') x
join r_locations c on c.location_id = client_id and c.billing_mode <> 'H' join r_locations s on s.location_id = site_id
join r_companies f on f.id = c.company_id join r_companies d on d.id = s.company_id
left join region re on re.r_regionkey = nullif(c.region_id, 0) left join r_states st on coalesce(c.region_id, 0) = 0 and st.state = left(c.state, 2),
lateral (select coalesce(max(case when a.company_id = c.company_id then a.type end), max(case when a.company_id = s.company_id then a.type end)) = 'D'
  and coalesce(max(case when a.company_id = c.company_id then a.company_id end), max(case when a.company_id = s.company_id then a.company_id end)) = 2 as own0
  from r_user_locations a where a.user_id = x.ordered_by) l0, lateral (select coalesce(own0, false) as own) l1""")
def _(spark, path):
    r = Roles(spark, path)
    return ch.order_channel(r.orders(), r.patients(), r.locations(), r.companies(), r.regions(), r.states(), r.users(), r.user_locations(),
                            "1997-01-01", "1997-03-31", house_name="house")


@query("census_average", f"""select n_regionkey as hospice, n_regionkey as region, c_nationkey as client, cast(1000 + ascii(c_mktsegment) as bigint) as site, 2 as dme,
{ratio('sum(n)::bigint', 'count(*)', 6)} as mean, count(*) as months from (
select n_regionkey, c_nationkey, c_mktsegment, year(o_orderdate) * 100 + month(o_orderdate) as m, count(distinct o_custkey) as n
from orders join customer on o_custkey = c_custkey join nation on n_nationkey = c_nationkey where o_orderdate >= '1997-01-01' and o_orderdate < '1997-04-01' group by all) group by all""")
def _(spark, path):
    r = Roles(spark, path)
    days = (r.orders().select("patient_id", yyyymm("stamp").alias("yyyymm")).distinct()
            .join(r.patients().select("patient_id", F.col("client_id").alias("client"), F.col("site_id").alias("site")), "patient_id")
            .groupBy("client", "site", "yyyymm").agg(F.count("*").alias("patient_count"))
            .join(r.t["nation"].select(F.col("n_nationkey").alias("client"), F.col("n_regionkey").alias("region")), "client")
            .withColumn("hospice", F.col("region")).withColumn("dme", F.lit(2)))
    return ch.census_average(days, "1997-01-01", "1997-03-31")
