"""Scalar helpers over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulbook.functions import dates as d, text as x
from haulbook.functions.numbers import money_share, pct_of, share_of, yes_no
from haulbook.operators.filters import status_group
from haulbook.operators.ranking import previous_order
from haulbook.operators.reshape import type_label

from .registry import day, money_ratio, pct, query, ratio, span, stamp
from .roles import Roles, with_roles


@query("date_differences", """select l_orderkey as id, count(*) as n, sum(date_diff('day', o_orderdate, l_shipdate))::bigint as days,
sum(date_diff('month', o_orderdate, l_shipdate))::bigint as months, sum(date_diff('hour', o_orderdate, l_shipdate))::bigint as hours
from lineitem join orders on l_orderkey = o_orderkey group by 1""")
def _(spark, path):
    t = Roles(spark, path).t
    j = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.count("*").alias("n"), F.sum(d.days_between("o_orderdate", "l_shipdate")).alias("days"),
        F.sum(d.months_between_boundaries("o_orderdate", "l_shipdate")).alias("months"),
        F.sum(d.hours_between("o_orderdate", "l_shipdate")).alias("hours"))


@query("minute_boundaries", f"""select event_id, date_diff('minute', date_trunc('hour', ts), ts) as in_hour,
date_diff('minute', prev, ts) as since_prev, date_diff('hour', prev, ts) as hours_since from (
select event_id, ts, lag(ts) over (partition by user_id order by ts, event_id) as prev from events)""")
def _(spark, path):
    e = previous_order(Roles(spark, path).t["events"], ["user_id"], "ts", "event_id", ["ts"]).withColumn("before", F.col("prev.ts"))
    return e.select(
        "event_id", d.minutes_between("date_trunc('hour', ts)", "ts").alias("in_hour"),
        d.minutes_between("before", "ts").alias("since_prev"), d.hours_between("before", "ts").alias("hours_since"))


@query("time_span", f"""select user_id, {span('min(ts)', 'max(ts)')} as forward, {span('max(ts)', 'min(ts)')} as backward,
{span('min(ts)', "max(case when event_type = 'none' then ts end)")} as missing from events group by 1""")
def _(spark, path):
    e = Roles(spark, path).t["events"].groupBy("user_id").agg(
        F.min("ts").alias("a"), F.max("ts").alias("b"), F.max(F.when(F.col("event_type") == "none", F.col("ts"))).alias("c"))
    return e.select("user_id", d.time_span("a", "b").alias("forward"), d.time_span("b", "a").alias("backward"),
                    d.time_span("a", "c").alias("missing"))


ZONES = ["America/New_York", "America/Chicago", "America/Denver", "America/Phoenix", "America/Los_Angeles"]
ZONE_SQL = "case user_id % 6 " + " ".join(f"when {i} then '{z}'" for i, z in enumerate(ZONES)) + " end"


@query("location_time", f"""select event_id, zone, {stamp("timezone(zone, timezone('UTC', ts))")} as local from
(select event_id, ts, {ZONE_SQL} as zone from events)""")
def _(spark, path):
    zone = F.element_at(F.array(*[F.lit(z) for z in ZONES]), (F.col("user_id") % 6 + 1).cast("int"))
    e = Roles(spark, path).t["events"].withColumn("zone", F.when(F.col("user_id") % 6 < 5, zone))
    return e.select("event_id", "zone", d.local_time("ts", "zone").alias("local"))


@query("split_list", """select conv_id, turn, pos, part from (select conv_id, turn, unnest(string_split(text, ',')) as part,
generate_subscripts(string_split(text, ','), 1) as pos from conversations)""")
def _(spark, path):
    c = Roles(spark, path).t["conversations"]
    return c.select("conv_id", "turn", F.posexplode_outer(F.split("text", ",")).alias("p", "part")).select(
        "conv_id", "turn", (F.col("p") + 1).alias("pos"), "part")


@query("clean_markup", """select conv_id, turn, replace(replace(replace(marked, '&#39;', ''''), '&#36;', '$'), '&#34;', '"') as cleaned from
(select conv_id, turn, replace(replace(text, 'e', '&#39;'), 'a', '&#34;') as marked from conversations)""")
def _(spark, path):
    c = Roles(spark, path).t["conversations"]
    marked = F.replace(F.replace("text", F.lit("e"), F.lit("&#39;")), F.lit("a"), F.lit("&#34;"))
    return c.select("conv_id", "turn", x.clean_markup(marked).alias("cleaned"))


@query("strip_breaks", """select page_id, md5(replace(replace(replace(html, '<br />', ''), '<br>', ''), chr(13) || chr(10), '')) as digest,
length(replace(replace(replace(html, '<br />', ''), '<br>', ''), chr(13) || chr(10), '')) as chars from pages""")
def _(spark, path):
    p = Roles(spark, path).t["pages"]
    return p.select("page_id", F.md5(x.strip_breaks("html")).alias("digest"), F.length(x.strip_breaks("html")).alias("chars"))


@query("text_functions", """select c_custkey as id, left(c_name, 8) as head, right('0' || month(date '1997-01-01' + cast(c_custkey % 700 as int)), 2) as month_text,
length(rtrim(c_name || '  ')) as len, lower(c_mktsegment) as seg, instr(c_mktsegment, 'UI') as at, trim('  ' || c_name || ' ') as trimmed,
replace(c_name, '#', '') as plain, printf('%04d', c_custkey % 10000) as padded, left(c_name, 8) || ', ' || right(c_name, 9) as person,
left(c_name, 8) || ' ' || left(right(c_name, 9), 1) || '.' as driver, cast(null as varchar) as nothing from customer""")
def _(spark, path):
    c = Roles(spark, path).t["customer"]
    month = F.month(F.date_add(F.lit("1997-01-01").cast("date"), (F.col("c_custkey") % 700).cast("int")))
    last, first = F.substring("c_name", 1, 8), F.substring("c_name", 10, 9)
    return c.select(
        F.col("c_custkey").alias("id"), F.left("c_name", F.lit(8)).alias("head"),
        F.right(F.concat(F.lit("0"), month.cast("string")), F.lit(2)).alias("month_text"),
        x.text_length(F.concat("c_name", F.lit("  "))).alias("len"), F.lower("c_mktsegment").alias("seg"),
        F.instr("c_mktsegment", "UI").alias("at"), F.trim(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("trimmed"),
        F.replace("c_name", F.lit("#"), F.lit("")).alias("plain"), F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0").alias("padded"),
        x.person_name(last, first).alias("person"), x.driver_label(last, first).alias("driver"),
        x.person_name(last, first, F.lit(None).cast("string")).alias("nothing"))


@query("convert_functions", f"""select o_orderkey as id, strftime(o_orderdate, '%m/%d/%Y') as us, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as iso,
case when try_cast(o_orderpriority as double) is null then 0 else 1 end as priority_numeric,
case when try_cast(left(o_orderpriority, 1) as double) is null then 0 else 1 end as code_numeric,
case when isodow(o_orderdate) = 7 then 1 else isodow(o_orderdate) + 1 end as weekday, year(o_orderdate) as y, month(o_orderdate) as m,
day(o_orderdate) as d, monthname(o_orderdate) as month_text from orders""")
def _(spark, path):
    o = Roles(spark, path).t["orders"]
    num = lambda c: x.is_numeric(c).cast("int")
    return o.select(F.col("o_orderkey").alias("id"), d.us_date("o_orderdate").alias("us"),
                    F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("iso"), num("o_orderpriority").alias("priority_numeric"),
                    num(F.substring("o_orderpriority", 1, 1)).alias("code_numeric"), F.dayofweek("o_orderdate").alias("weekday"),
                    F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.dayofmonth("o_orderdate").alias("d"),
                    d.month_name("o_orderdate").alias("month_text"))


@query("date_functions", f"""select event_id, {stamp('ts + interval 1 second')} as plus_second, {stamp('ts - interval 6 hour')} as minus_hours,
{day('ts + interval 10 day')} as plus_days, {day('ts + interval 3 week')} as plus_weeks, {day('cast(ts as date) + interval 1 month')} as plus_month,
year(ts) * 100 + month(ts) as yyyymm, {day("date_trunc('month', ts)")} as month_first from events""")
def _(spark, path):
    e = Roles(spark, path).t["events"]
    add = lambda unit, n: F.timestamp_add(unit, F.lit(n), F.col("ts"))
    return e.select("event_id", add("SECOND", 1).alias("plus_second"), add("HOUR", -6).alias("minus_hours"),
                    F.to_date(add("DAY", 10)).alias("plus_days"), F.to_date(add("WEEK", 3)).alias("plus_weeks"),
                    F.add_months(F.to_date("ts"), 1).alias("plus_month"), d.yyyymm("ts").alias("yyyymm"),
                    d.yyyymm_to_date(d.yyyymm("ts")).alias("month_first"))


@query("null_and_conditional", f"""{with_roles('r_shipped')} select order_id, status,
case status when 'D' then 'DONE' when 'P' then 'DONE' when 'R' then 'RECV' end as status_group,
{day('coalesce(reconciled, completed, stamp)')} as latest, case when scheduled is null then 1 else 0 end as unscheduled,
case when date_diff('minute', scheduled, completed) > 15 then 'N' else 'Y' end as met from r_shipped""")
def _(spark, path):
    s = Roles(spark, path).shipped_orders()
    return s.select("order_id", "status", status_group("status").alias("status_group"),
                    F.to_date(F.coalesce("reconciled", "completed", "stamp")).alias("latest"),
                    F.col("scheduled").isNull().cast("int").alias("unscheduled"),
                    yes_no(d.minutes_between("scheduled", "completed") > 15, "N", "Y").alias("met"))


@query("type_labels", """select c_custkey as id, case c_nationkey % 4 when 0 then 'B&M' when 1 then 'NET + SWC' when 2 then 'B&M + NET + SWC'
else 'Unknown Type' end as label from customer""")
def _(spark, path):
    code = F.element_at(F.array(*[F.lit(v) for v in ("B&M", "-NS", "BNS", "???")]), F.col("c_nationkey") % 4 + 1)
    return Roles(spark, path).t["customer"].withColumn("code", code).select(F.col("c_custkey").alias("id"), type_label("code").alias("label"))


@query("pct_of", f"""select l_suppkey as id, {pct('f', 'n', 4)} as pct4, {ratio('f', 'n', 6)} as share, {pct('f', 'z', 2)} as none,
printf('%.2f', {pct('f', 'n', 2)}) || '%' as text from (select l_suppkey, count(case when l_returnflag = 'R' then 1 end) f, count(*) n,
count(case when l_returnflag = '?' then 1 end) z from lineitem group by 1)""")
def _(spark, path):
    l = Roles(spark, path).t["lineitem"].groupBy("l_suppkey").agg(
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("f"), F.count("*").alias("n"),
        F.count(F.when(F.col("l_returnflag") == "?", 1)).alias("z"))
    return l.select(F.col("l_suppkey").alias("id"), pct_of("f", "n", "decimal(9,4)").alias("pct4"), share_of("f", "n").alias("share"),
                    pct_of("f", "z").alias("none"), pct_of("f", "n", as_text=True).alias("text"))


@query("money_share", f"""select l_suppkey as id, {money_ratio('r', 'a')} as share from (select l_suppkey,
sum(case when l_returnflag = 'R' then cast(l_extendedprice as decimal(19,4)) else 0 end) r, sum(cast(l_extendedprice as decimal(19,4))) a
from lineitem group by 1)""")
def _(spark, path):
    price = F.col("l_extendedprice").cast("decimal(19,4)")
    l = Roles(spark, path).t["lineitem"].groupBy("l_suppkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", price)).alias("r"), F.sum(price).alias("a"))
    return l.select(F.col("l_suppkey").alias("id"), money_share("r", "a").alias("share"))
