"""The given star schema in the roles of the order model, once for Spark and once as SQL.

Every role is derived from the given tables: orders and lineitem are orders and
their lines, customers are patients, nations are clients, market segments are the
provider's sites, parts are products and equipment, events are an action log, and
return flags are survey answers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from haulbook.sources.tables import STATES, config_table, load_tables, state_regions

# Role mapping: event types as log actions; every third signup is a receipt, every fifth view a departure.
ACTIONS = {"signup": "NOd", "click": "Sch", "view": "LVB", "purchase": "Cmp", "error": "Rcd"}
OTHER_ACTIONS = {"signup": (3, "Rec"), "view": (5, "EnR")}
ACTION_CASE = ("case " + " ".join(f"when event_type = '{k}' and event_id % {n} = 0 then '{v}'" for k, (n, v) in OTHER_ACTIONS.items()) + " "
               + " ".join(f"when event_type = '{k}' then '{v}'" for k, v in ACTIONS.items()) + " end")
# Role mapping: the day of a conversation.
NOTE_DAY = "timestampadd(DAY, conv_id, timestamp_ntz'1996-01-01 00:00:00')"
# Role mapping: names of the order statuses that occur.
STATUS_NAMES = {"D": "Delivered", "P": "Picked up", "R": "Received"}
# Role mapping: sub-item brands and the brands they go out with.
ROLE_PAIRS = {1: [6, 7], 2: [8], 3: [9, 10], 4: [11], 5: [12, 13]}


class _Tables(dict):
    """Tables read when first asked for."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self._source = spark, path

    def __missing__(self, name: str) -> DataFrame:
        self[name] = load_tables(*self._source, [name])[name]
        return self[name]


class Roles:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.t = _Tables(spark, path)

    def orders(self) -> DataFrame:
        return self.t["orders"].selectExpr(
            "o_orderkey as order_id", "o_custkey as patient_id",
            "case o_orderstatus when 'F' then 'D' when 'O' then 'R' else 'P' end as status",
            "if(o_orderstatus = 'P', 'P', 'D') as type", "left(o_orderpriority, 1) as reason",
            "o_orderpriority = '1-URGENT' as priority", "cast(o_custkey % 10 as int) as driver_id",
            "cast(left(o_orderpriority, 1) as int) as route_number", "o_custkey as ordered_by", "o_custkey as address_id",
            "cast(2 + o_custkey % 3 as int) as dme_id", "o_orderdate as stamp", "o_orderdate as scheduled",
            "o_orderdate as completed", "o_totalprice as price")

    def shipped_orders(self) -> DataFrame:
        """Orders that are due at the order date and completed with their last shipment."""
        done = self.t["lineitem"].groupBy("l_orderkey").agg(F.expr("max(l_shipdate) as done"), F.expr("min(l_shipdate) as last_viewed"))
        return (self.orders().drop("completed").join(done, F.expr("order_id = l_orderkey"), "left").drop("scheduled")
                .selectExpr("* except (l_orderkey, done)", "done as completed", "stamp as schedule_end",
                            "if(reason <> '5', stamp, null) as scheduled", "if(status = 'D', done, null) as reconciled",
                            "route_number as completion_action", "concat('u', driver_id) as last_viewed_by",
                            "route_number = 3 as add_on_stop", "order_id % 100 as route_id", "order_id % 6 = 0 as service_call"))

    def details(self) -> DataFrame:
        return self.t["lineitem"].selectExpr(
            "if(l_returnflag <> 'R', l_orderkey, null) as order_id", "if(l_returnflag = 'R', l_orderkey, null) as reference_order_id",
            "l_partkey as product_id", "l_linestatus as status", "l_shipdate as check_out",
            "if(l_returnflag = 'A', l_shipdate + make_dt_interval(cast(l_quantity as int)), null) as check_in",
            "if(l_returnflag = 'N' and l_linenumber = 2, l_shipdate + make_dt_interval(20), null) as other_status",
            "if(l_discount > 0, cast(l_discount as string), null) as serial_number", "if(l_tax > 0, cast(l_tax as string), null) as o2_lot")

    def equipment(self) -> DataFrame:
        return self.t["part"].selectExpr(
            "p_partkey as product_id", "p_partkey as equipment_id",
            "case when p_type = 'SMALL' and p_size <= 10 then 227 when p_type = 'SMALL' and p_size <= 20 then 147 "
            "else cast(substr(p_brand, 7) as int) end as item_id",
            "p_type = 'ECONOMY' as oxygen", "p_type = 'SMALL' as disposable", "p_name as equipment_name", "p_size as category",
            "p_type as item_name")

    def client_equip(self) -> DataFrame:
        return self.t["part"].filter("p_size > 30").selectExpr(
            "cast(p_partkey % 25 as int) as client_id", "case p_partkey % 3 when 0 then 1065 when 1 then 1066 else 1072 end as site_id", "p_partkey as equipment_id", "cast(null as int) as item_id",
            "cast(null as boolean) as oxygen", "true as disposable")

    def pairs(self) -> DataFrame:
        return config_table(self.spark, [(m, s) for s, ms in ROLE_PAIRS.items() for m in ms], "main_item int, sub_item int")

    def item_lines(self) -> DataFrame:
        return self.details().filter("order_id is not null").join(self.equipment().drop("equipment_id"), "product_id")

    def patients(self) -> DataFrame:
        return self.t["customer"].selectExpr(
            "c_custkey as patient_id", "c_nationkey as client_id", "1000 + ascii(c_mktsegment) as site_id", "c_custkey as address_id",
            "substr(c_name, 1, 8) as last_name", "substr(c_name, 10, 9) as first_name", "if(c_custkey % 4 = 0, 'Q', null) as middle",
            "if(c_acctbal < -900, 'M', 'P') as type", "if(c_custkey % 11 = 0, timestamp_ntz'1997-06-01 12:00:00', null) as disabled",
            "if(c_custkey % 13 = 0, timestamp_ntz'1997-03-01 00:00:00', null) as torpid", "cast(c_custkey % 2 as int) as dup",
            "concat('555-', c_custkey) as phone1", "if(c_custkey % 3 = 0, null, concat('556-', c_custkey)) as phone2", "concat('C', c_custkey) as contact",
            "case c_custkey % 4 when 0 then '?' when 1 then '0' when 2 then ' X' end as infectious")

    def locations(self) -> DataFrame:
        """Nations as clients, with the states in order and an unknown one for the last; segments as sites."""
        st = state_regions(self.spark).selectExpr("-region_id - 1 as n_nationkey", "state")
        clients = self.t["nation"].join(st, "n_nationkey", "left").selectExpr(
            "n_nationkey as location_id", "n_name as name", "100 + n_regionkey as company_id",
            "if(n_regionkey <> 4, n_regionkey, null) as region_id", "if(n_nationkey < 24, state, 'ZZ') as state", "'C' as type",
            "if(n_nationkey = 7, 'H', 'C') as billing_mode")
        sites = self.t["customer"].select("c_mktsegment").distinct().selectExpr(
            "1000 + ascii(c_mktsegment) as location_id", "c_mktsegment as name", "if(ascii(c_mktsegment) < 71, 2, 3) as company_id",
            "cast(null as int) as region_id", "cast(null as string) as state", "'S' as type", "'S' as billing_mode")
        return clients.unionByName(sites)

    def companies(self) -> DataFrame:
        firms = self.t["region"].selectExpr("100 + r_regionkey as id", "r_name as name", "left(r_name, 2) as abbr")
        return firms.unionByName(config_table(self.spark, [(2, "Own", "OW"), (3, "Network", "NE")], "id int, name string, abbr string"))

    def regions(self) -> DataFrame:
        return self.t["region"].selectExpr("r_regionkey as id", "r_name as name")

    def states(self) -> DataFrame:
        return state_regions(self.spark)

    def budgets(self) -> DataFrame:
        """Client-site pairs with the first and last month of their orders."""
        span = self.t["orders"].groupBy("o_custkey").agg(F.expr("min(o_orderdate) as lo"), F.expr("max(o_orderdate) as hi"))
        return (span.join(self.patients(), F.expr("o_custkey = patient_id")).groupBy("client_id", "site_id")
                .agg(F.expr("min(lo) as lo"), F.expr("max(hi) as hi"))
                .selectExpr("client_id", "site_id", "year(lo) * 100 + month(lo) as begin_yyyymm", "year(hi) * 100 + month(hi) as end_yyyymm",
                            "0 as sub_unit", "client_id * 10000 + site_id as budget_id", "client_id as contract_id", "'N' as network_type"))

    def sub_budgets(self) -> DataFrame:
        """Every fifth client has a budget of its own, under the next client's contract, for sub-unit 1."""
        return self.budgets().filter("client_id % 5 = 0").selectExpr(
            "client_id", "site_id", "begin_yyyymm", "end_yyyymm", "1 as sub_unit", "budget_id + 5000000 as budget_id", "(client_id + 1) % 25 as contract_id", "network_type")

    def contracts(self) -> DataFrame:
        return self.t["nation"].selectExpr("n_nationkey as contract_id", "if(n_regionkey < 2, 2, 3) as owner_company")

    def users(self) -> DataFrame:
        """Customers as users; those of the BUILDING segment are of a phone type."""
        return self.t["customer"].selectExpr(
            "c_custkey as user_id", "concat('u', c_custkey) as user", "concat('m', c_custkey) as phone_cell", "concat('o', c_custkey) as phone_office", "c_name as full", "substr(c_name, 1, 8) as first",
            "substr(c_name, 10, 9) as last", "'X' as middle", "if(c_mktsegment = 'BUILDING', 'D', 'C') as type")

    def user_locations(self) -> DataFrame:
        """Odd users belong to their client company, even ones to company 2, but for the HOUSEHOLD segment."""
        base = self.patients().selectExpr("patient_id as user_id", "client_id", "site_id")
        firm = self.locations().selectExpr("location_id as client_id", "company_id")
        a = base.filter("user_id % 2 = 1").join(firm, "client_id").selectExpr(
            "user_id", "company_id", "client_id as location_id", "'H' as type", "1 as priority")
        b = base.filter("user_id % 2 = 0 and site_id <> 1072").selectExpr(
            "user_id", "2 as company_id", "site_id as location_id", "'D' as type", "1 as priority")
        return a.unionByName(b)

    def history(self) -> DataFrame:
        return self.t["events"].selectExpr("event_id as history_id", "user_id as order_id", f"{ACTION_CASE} as action",
                                           "ts as at", "cast(floor(value) as bigint) as user_id")

    def logged_orders(self) -> DataFrame:
        """One order per logged user: placed at its first action, scheduled with its first click."""
        log = self.t["events"].groupBy(F.col("user_id").alias("order_id")).agg(
            F.expr("min(ts) as stamp"), F.expr("min(if(event_type = 'click', ts, null)) as scheduled"), F.expr("max(ts) as enroute"),
            F.expr("count(*) as enroute_count"))
        return log.selectExpr(
            "*", "if(order_id % 3 <> 0, stamp, null) as received", "scheduled as schedule_end", "enroute as completed",
            "order_id as patient_id", "order_id as ordered_by", "if(order_id % 2 = 0, 'D', 'R') as status",
            "if(order_id % 2 = 0, 'D', 'P') as type", "cast(order_id % 5 + 1 as string) as reason", "order_id % 4 = 0 as priority",
            "order_id % 7 = 0 as add_on_stop")

    def statuses(self) -> DataFrame:
        return config_table(self.spark, list(STATUS_NAMES.items()), "status string, status_name string")

    def lookup(self) -> DataFrame:
        """Order reasons are the order priorities; note types are the chat roles."""
        orc = self.t["orders"].select("o_orderpriority").distinct().selectExpr(
            "'ORC' as group", "left(o_orderpriority, 1) as code", "o_orderpriority as name")
        qaft = self.t["conversations"].select("role").distinct().selectExpr(
            "'QAFT' as group", "role as code", "if(role = 'system', 'Escalation', role) as name")
        return orc.unionByName(qaft)

    def survey_lines(self) -> DataFrame:
        """Each order line is a survey answer; its line number is the question."""
        return (self.t["lineitem"].select("l_orderkey", "l_returnflag", "l_linestatus", "l_linenumber")
                .join(self.t["orders"].select("o_orderkey", "o_custkey", "o_orderdate"), F.expr("l_orderkey = o_orderkey"))
                .join(self.patients().select("patient_id", "client_id", "site_id"), F.expr("o_custkey = patient_id"))
                .withColumn("month", F.expr("date_format(o_orderdate, 'yyyy')")))

    def survey_results(self) -> DataFrame:
        return self.survey_lines().selectExpr(
            "client_id", "site_id", "month", "l_orderkey as result_id",
            "case l_linenumber when 7 then 'U' when 6 then 'O' when 5 then 'E' when 4 then 'A' else 'C' end as status",
            "o_orderdate as finished")

    def survey_answers(self) -> DataFrame:
        return self.survey_lines().selectExpr(
            "client_id", "site_id", "month", "l_orderkey as result_id", "concat('Q', l_linenumber) as question",
            "case when l_linenumber <= 3 then if(l_linestatus = 'O', 'y', 'n') "
            "else case l_returnflag when 'A' then 'm' when 'N' then 'x' else 'f' end end as answer")

    def notes(self) -> DataFrame:
        """Chat turns as survey notes: conversation = survey and order, role = type, day by conversation number."""
        return self.t["conversations"].selectExpr("conv_id as result_id", "role as type", "text as note", f"{NOTE_DAY} as created")

    def note_results(self) -> DataFrame:
        return self.t["conversations"].select("conv_id").distinct().selectExpr(
            "conv_id as result_id", "conv_id as order_id", "if(conv_id % 2 = 0, 'C', 'X') as status", f"{NOTE_DAY} as finished")

    def billed(self) -> DataFrame:
        o = self.t["orders"].selectExpr("o_orderkey", "o_custkey", "year(o_orderdate) * 100 + month(o_orderdate) as yyyymm")
        return (self.t["lineitem"].select("l_orderkey", "l_partkey", "l_extendedprice").join(o, F.expr("l_orderkey = o_orderkey"))
                .join(self.patients().select("patient_id", "client_id", "site_id"), F.expr("o_custkey = patient_id"))
                .selectExpr("yyyymm", "client_id", "site_id", "l_partkey as equipment_id", "cast(l_extendedprice as decimal(19,4)) as total"))

    def brands(self) -> DataFrame:
        return self.t["part"].selectExpr("p_partkey as equipment_id", "cast(substr(p_brand, 7) as int) as item_id")

    def brand_names(self) -> DataFrame:
        return self.t["part"].selectExpr("cast(substr(p_brand, 7) as int) as item_id", "p_brand as name").distinct()


STATE_SQL = ", ".join(f"({i}, '{s}')" for i, s in STATES.items())
PAIR_SQL = ", ".join(f"({m}, {s})" for s, ms in ROLE_PAIRS.items() for m in ms)

ROLE_SQL = {
    "r_orders": """select o_orderkey order_id, o_custkey patient_id,
      case o_orderstatus when 'F' then 'D' when 'O' then 'R' else 'P' end status,
      case o_orderstatus when 'P' then 'P' else 'D' end type, left(o_orderpriority, 1) reason,
      o_orderpriority = '1-URGENT' priority, o_custkey % 10 driver_id, cast(left(o_orderpriority, 1) as int) route_number,
      o_custkey ordered_by, o_custkey address_id, 2 + o_custkey % 3 dme_id,
      o_orderdate stamp, o_orderdate scheduled, o_orderdate completed from orders""",
    "r_shipped": """select o.* exclude (completed, scheduled), o.stamp schedule_end, l.completed, l.last_viewed,
      case when o.reason <> '5' then o.stamp end scheduled, case when o.status = 'D' then l.completed end reconciled,
      o.route_number completion_action, 'u' || o.driver_id last_viewed_by, o.route_number = 3 add_on_stop,
      order_id % 100 route_id, order_id % 6 = 0 service_call
      from r_orders o left join (select l_orderkey, max(l_shipdate) completed, min(l_shipdate) last_viewed
        from lineitem group by 1) l on l_orderkey = order_id""",
    "r_details": """select case when l_returnflag <> 'R' then l_orderkey end order_id,
      case when l_returnflag = 'R' then l_orderkey end reference_order_id, l_partkey product_id, l_linestatus status,
      l_shipdate check_out, case when l_returnflag = 'A' then l_shipdate + to_days(cast(l_quantity as int)) end check_in,
      case when l_returnflag = 'N' and l_linenumber = 2 then l_shipdate + to_days(20) end other_status,
      l_discount > 0 has_serial, l_tax > 0 has_lot from lineitem""",
    "r_equipment": """select p_partkey product_id, p_partkey equipment_id,
      case when p_type = 'SMALL' and p_size <= 10 then 227 when p_type = 'SMALL' and p_size <= 20 then 147
        else cast(substr(p_brand, 7) as int) end item_id,
      p_type = 'ECONOMY' oxygen, p_type = 'SMALL' disposable, p_name equipment_name, p_size category, p_type item_name from part""",
    "r_client_equip": """select cast(p_partkey % 25 as int) client_id, case p_partkey % 3 when 0 then 1065 when 1 then 1066 else 1072 end site_id,
      p_partkey equipment_id, true disposable from part where p_size > 30""",
    "r_pairs": f"select * from (values {PAIR_SQL}) v(main_item, sub_item)",
    "r_patients": """select c_custkey patient_id, c_nationkey client_id, 1000 + ascii(c_mktsegment) site_id, c_custkey address_id,
      substr(c_name, 1, 8) last_name, substr(c_name, 10, 9) first_name, case when c_custkey % 4 = 0 then 'Q' end middle,
      case when c_custkey % 11 = 0 then timestamp '1997-06-01 12:00:00' end disabled, case when c_custkey % 13 = 0 then timestamp '1997-03-01' end torpid,
      cast(c_custkey % 2 as int) dup, case when c_acctbal < -900 then 'M' else 'P' end type from customer""",
    "r_statuses": "select * from (values " + ", ".join(f"('{k}', '{v}')" for k, v in STATUS_NAMES.items()) + ") v(status, status_name)",
    "r_states": f"select * from (values {STATE_SQL}) v(region_id, state)",
    "r_locations": """select n_nationkey location_id, n_name name, 100 + n_regionkey company_id,
      case when n_regionkey <> 4 then n_regionkey end region_id,
      case when n_nationkey < 24 then state else 'ZZ' end state, 'C' type,
      case when n_nationkey = 7 then 'H' else 'C' end billing_mode
      from nation left join r_states on -r_states.region_id - 1 = n_nationkey
      union all select distinct 1000 + ascii(c_mktsegment), c_mktsegment, case when ascii(c_mktsegment) < 71 then 2 else 3 end,
      null, null, 'S', 'S' from customer""",
    "r_companies": """select 100 + r_regionkey id, r_name name, left(r_name, 2) abbr from region
      union all values (2, 'Own', 'OW'), (3, 'Network', 'NE')""",
    "r_budgets": """select c_nationkey client_id, 1000 + ascii(c_mktsegment) site_id,
      min(year(o_orderdate) * 100 + month(o_orderdate)) begin_yyyymm, max(year(o_orderdate) * 100 + month(o_orderdate)) end_yyyymm,
      c_nationkey * 10000 + 1000 + ascii(c_mktsegment) budget_id, c_nationkey contract_id
      from orders join customer on o_custkey = c_custkey group by c_nationkey, c_mktsegment""",
    "r_contracts": "select n_nationkey contract_id, case when n_regionkey < 2 then 2 else 3 end owner_company from nation",
    "r_users": """select c_custkey user_id, 'u' || c_custkey "user", c_name "full", substr(c_name, 1, 8) first_name,
      substr(c_name, 10, 9) last_name, case when c_mktsegment = 'BUILDING' then 'D' else 'C' end type from customer""",
    "r_user_locations": """select patient_id user_id, company_id, client_id location_id, 'H' type
      from r_patients join r_locations on location_id = client_id where patient_id % 2 = 1
      union all select patient_id, 2, site_id, 'D' from r_patients where patient_id % 2 = 0 and site_id <> 1072""",
    "r_history": f"""select event_id history_id, user_id order_id, {ACTION_CASE} as action,
      ts as "at", cast(floor(value) as bigint) user_id from events""",
    "r_logged": """select user_id order_id, min(ts) stamp, min(case when event_type = 'click' then ts end) scheduled,
      max(ts) enroute, count(*) enroute_count, case when user_id % 3 <> 0 then min(ts) end received,
      min(case when event_type = 'click' then ts end) schedule_end, max(ts) completed, user_id patient_id, user_id ordered_by,
      case when user_id % 2 = 0 then 'D' else 'R' end status, case when user_id % 2 = 0 then 'D' else 'P' end type,
      cast(user_id % 5 + 1 as varchar) reason, user_id % 4 = 0 priority, user_id % 7 = 0 add_on_stop
      from events group by user_id""",
    "r_survey": """select c_nationkey client_id, 1000 + ascii(c_mktsegment) site_id, strftime(o_orderdate, '%Y') as month,
      l_linenumber n, l_returnflag flag, l_linestatus st, o_orderdate finished
      from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey""",
    "r_notes": """select conv_id result_id, role as type, text note, timestamp '1996-01-01' + to_days(cast(conv_id as int)) created
      from conversations""",
    "r_note_results": """select distinct conv_id result_id, conv_id order_id, case when conv_id % 2 = 0 then 'C' else 'X' end status,
      timestamp '1996-01-01' + to_days(cast(conv_id as int)) finished from conversations""",
    "r_billed": """select year(o_orderdate) * 100 + month(o_orderdate) yyyymm, c_nationkey client_id,
      1000 + ascii(c_mktsegment) site_id, cast(substr(p_brand, 7) as int) item_id, cast(l_extendedprice as decimal(19, 4)) total
      from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join part on l_partkey = p_partkey""",
}

NEEDS = {"r_shipped": ["r_orders"], "r_locations": ["r_states"], "r_user_locations": ["r_patients", "r_locations"]}


def with_roles(*names: str) -> str:
    """SQL text: ``with`` the named roles and what they need."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in NEEDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "with " + ",\n".join(f"{n} as ({ROLE_SQL[n]})" for n in order)
