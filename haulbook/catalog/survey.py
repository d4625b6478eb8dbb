"""Survey roll-ups, feedback and escalations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulbook.operators.reshape import YES_NO_QUESTIONS, subregion_rollup
from haulbook.plans import survey as sv

from .registry import query, ratio, stamp
from .roles import Roles, with_roles

# Each line answers one question: lines 1-3 yes/no by line status, 4-7 graded by return flag.
ANS = "case when n <= 3 then (case st when 'O' then 'y' else 'n' end) else (case flag when 'A' then 'm' when 'N' then 'x' else 'f' end) end"
STATUS = "case n when 7 then 'U' when 6 then 'O' when 5 then 'E' when 4 then 'A' else 'C' end"


def _counts_sql():
    cols = ["count(*) as total"] + [f"count(case when {STATUS} = '{c}' then 1 end) as {n}" for n, c in sv.RESULT_CODES.items()]
    cols.append(f"count(case when {STATUS} = 'C' then 1 end) as usable")
    for q in sv.YES_NO + sv.GRADED:
        k, letters = int(q[1:]), "yn" if q in sv.YES_NO else "mxf"
        cols.append(f"count(case when n = {k} then 1 end) as x{q}")
        cols += [f"count(case when n = {k} and {ANS} = '{a}' then 1 end) as n{q}{a}" for a in letters]
    return ", ".join(cols)


def _shares_sql():
    out = [f"{ratio(f'n{q}y', f'x{q}', 6)} as p{q}" for q in sv.YES_NO]
    return ", ".join(out + [f"{ratio(f'n{q}{g}', f'x{q}', 6)} as p{q}{g}" for q in sv.GRADED for g in "mxf"])


ROLES = with_roles("r_survey", "r_budgets", "r_locations")
LEAF = f"{ROLES}, leaf as (select client_id, site_id, month, {_counts_sql()} from r_survey group by all)"
PAIRS = """pairs as (select distinct c.company_id client_company, coalesce(c.region_id, st.region_id) region_id,
  coalesce(rtrim(r.r_name), c.state || ' Region') region_name, b.client_id, trim(c.name) client_name, b.site_id, s.name site_name
  from r_budgets b join r_locations c on c.location_id = b.client_id join r_locations s on s.location_id = b.site_id
  left join region r on r.r_regionkey = c.region_id
  left join r_states st on c.region_id is null and st.state = left(c.state || ' Region', 2))"""
SUMS = ", ".join(f"sum({c})::bigint as {c}" for c in sv.COUNTS)
LEVELS = f"""{LEAF}, {PAIRS},
reg as (select client_company, month, region_id, region_name, {SUMS} from leaf join pairs using (client_id, site_id) group by all),
levels as (select 40 as level, client_company, month, region_id, region_name, client_id, client_name, site_id, site_name, {', '.join(sv.COUNTS)}, site_name as provider
  from leaf join pairs using (client_id, site_id)
 union all select 20, client_company, month, region_id, region_name, null, 'Many', null, 'Many', {', '.join(sv.COUNTS)}, region_name from reg
 union all select 10, client_company, month, 0, 'All', null, 'All', null, 'All', {', '.join(f'sum({c})::bigint' for c in sv.COUNTS)}, 'Region: All' from reg group by client_company, month)"""


def _pairs(r):
    return sv.budgeted_pairs(r.budgets(), r.locations(), r.regions(), r.states())


def _counts(r):
    return sv.survey_counts(r.survey_results(), r.survey_answers(), ["client_id", "site_id", "month"])


@query("budgeted_pairs", f"{ROLES}, {PAIRS} select client_company, region_id, region_name, client_id, client_name, site_id, site_name from pairs")
def _(spark, path):
    return _pairs(Roles(spark, path)).select("client_company", "region_id", "region_name", "client_id", "client_name", "site_id", "site_name")


@query("survey_counts", f"{LEAF} select *, {_shares_sql()} from leaf")
def _(spark, path):
    return _counts(Roles(spark, path))


def _levels(r):
    return sv.survey_levels(_pairs(r), _counts(r))


@query("hierarchy_rollup", f"{LEVELS} select *, {_shares_sql()} from levels")
def _(spark, path):
    return _levels(Roles(spark, path))


@query("subregion_rollup", f"""{LEVELS}, head as (select *, level = 20 and substr(region_name, 1, 9) in ('AMERICA', 'ASIA') as sub from levels),
moved as (select case when sub then 30 else level end as level, client_company, month, region_id, region_name, {', '.join(sv.COUNTS)} from head
union all select 20, client_company, month, min(region_id) * -100000, substr(region_name, 1, 9), {', '.join(f'sum({c})::bigint' for c in sv.COUNTS)} from head where sub group by client_company, month, substr(region_name, 1, 9))
select *, {_shares_sql()} from moved""")
def _(spark, path):
    rolled = _levels(Roles(spark, path)).drop("client_id", "client_name", "site_id", "site_name", "provider")
    return subregion_rollup(rolled, sv.COUNTS, ["client_company", "month"], sv.share_columns(), ["AMERICA", "ASIA"])


@query("sequence_levels", f"""{LEVELS} select client_company, month, provider, region_id, total,
row_number() over (partition by client_company, month order by provider, region_id) as seqno from levels where level = 20""")
def _(spark, path):
    return sv.numbered_levels(_levels(Roles(spark, path)), 20).select("client_company", "month", "provider", "region_id", "total", "seqno")


def _questions_sql(levels, label=""):
    parts = []
    for q, name in YES_NO_QUESTIONS.items():
        parts.append((name, f"p{q}", f"round(1 - p{q}, 6)", "null"))
    for q, name in sv.GRADED_QUESTIONS.items():
        parts.append((name, f"p{q}m", f"p{q}f", f"p{q}x"))
    body = " union all ".join(
        f"""select level, client_company, month, region_id, region_name, client_name, case when level = 20 then '{label}' else '' end || provider as provider,
        '{n}' as question, {m} as meet, {f} as fail, cast({x} as double) as exceed from shares""" for n, m, f, x in parts)
    keep = ", ".join(map(str, levels))
    return f"{LEVELS}, shares as (select *, {_shares_sql()} from levels where level in ({keep})) {body}"


def _review(spark, path, **opts):
    r = Roles(spark, path)
    return sv.survey_review(_pairs(r), r.survey_results(), r.survey_answers(), **opts)


@query("survey_review", _questions_sql((10, 20, 40)))
def _(spark, path):
    return _review(spark, path)


@query("survey_review_regional", _questions_sql((10, 20), "Region: "))
def _(spark, path):
    return _review(spark, path, levels=(10, 20), region_label="Region: ")


@query("survey_review_whole", _questions_sql((10,)))
def _(spark, path):
    return _review(spark, path, levels=(10,))


@query("questions_to_rows", _questions_sql((20,)))
def _(spark, path):
    return _review(spark, path, levels=(20,))


@query("region_fill", f"{ROLES}, {PAIRS} select region_id, region_name, count(*) as pairs from pairs group by 1, 2")
def _(spark, path):
    return _pairs(Roles(spark, path)).groupBy("region_id", "region_name").agg(F.count("*").alias("pairs"))


@query("survey_quality_check", """select strftime(o_orderdate, '%Y') as month, count(*) as surveys_ever,
count(case when o_orderdate >= '1997-01-01' and o_orderdate <= '1997-12-31' then 1 end) as surveys_in_window from lineitem join orders on l_orderkey = o_orderkey group by 1""")
def _(spark, path):
    return sv.survey_quality_check(Roles(spark, path).survey_results(), "1997-01-01", "1997-12-31", ["month"])


@query("missing_regions", f"{ROLES}, {PAIRS} select client_id, site_id, region_name from pairs where region_id is null")
def _(spark, path):
    return sv.missing_regions(_pairs(Roles(spark, path))).select("client_id", "site_id", "region_name")


NOTE = "rtrim(replace(replace(replace(n.note, '&#39;', ''''), '&#36;', '$'), '&#34;', '\"'), ' ')"
NOTE_BASE = f"""s.order_id, case n.type when 'system' then 'Escalation' else n.type end as type_name, {stamp('n.created')} as created,
 monthname(n.created) as month, {NOTE} as feedback"""
NOTE_FROM = "from r_notes n join r_note_results s using (result_id)"
PLACES = """join r_orders o on o.order_id = s.order_id join r_patients p on p.patient_id = o.patient_id join r_locations c on c.location_id = p.client_id
 join r_locations t on t.location_id = p.site_id join r_states st on st.state = c.state left join region re on re.r_regionkey = c.region_id"""
NOTE_ROLES = with_roles("r_notes", "r_note_results", "r_orders", "r_patients", "r_locations")
FINISHED = "s.status = 'C' and s.finished >= '1996-01-10' and s.finished <= '1996-02-20'"
CREATED = "s.status = 'C' and n.created >= '1996-01-10' and n.created <= '1996-02-20' and n.type = 'system'"


def _feedback(spark, path, places=True, fn=sv.feedback_extract, **opts):
    r = Roles(spark, path)
    where = dict(patients=r.patients(), locations=r.locations(), regions=r.regions(), states=r.states(), orders=r.orders()) if places else {}
    return fn(r.notes(), r.note_results(), r.lookup(), "1996-01-10", "1996-02-20", **where, **opts)


@query("feedback_simple", f"{NOTE_ROLES} select {NOTE_BASE} {NOTE_FROM} where {FINISHED}")
def _(spark, path):
    return _feedback(spark, path, places=False)


@query("feedback_extract", f"{NOTE_ROLES} select {NOTE_BASE}, rtrim(coalesce(re.r_name, c.state || ' Region')) as region, rtrim(c.name) as client {NOTE_FROM} {PLACES} where {FINISHED}")
def _(spark, path):
    return _feedback(spark, path)


@query("feedback_with_ids", f"""{NOTE_ROLES} select {NOTE_BASE}, rtrim(re.r_name) as region, rtrim(t.name) as client, c.company_id as client_company,
coalesce(c.region_id, st.region_id) as region_id, p.client_id, p.site_id, t.company_id as site_company {NOTE_FROM} {PLACES} where {FINISHED} and c.company_id = 101""")
def _(spark, path):
    return _feedback(spark, path, region_default=None, name_of="site", ids=True, client_company=101)


@query("escalations", f"{NOTE_ROLES} select {NOTE_BASE}, rtrim(coalesce(re.r_name, c.state)) as region, rtrim(t.name) as client {NOTE_FROM} {PLACES} where {CREATED}")
def _(spark, path):
    return _feedback(spark, path, fn=sv.escalations)


@query("escalations_simple", f"{NOTE_ROLES} select {NOTE_BASE} {NOTE_FROM} where {CREATED}")
def _(spark, path):
    return _feedback(spark, path, places=False, fn=sv.escalations)
