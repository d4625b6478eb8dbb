"""Customer survey roll-ups, feedback and escalations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from haulbook.functions.dates import month_name
from haulbook.functions.numbers import count_if, share_of
from haulbook.functions.text import clean_markup
from haulbook.functions.windows import in_window
from haulbook.operators.lookups import join_code, region_fill
from haulbook.operators.ranking import sequence_rows
from haulbook.operators.reshape import GRADED_QUESTIONS, hierarchy_rollup, questions_to_rows

# Survey result codes and the count each one feeds.
RESULT_CODES = {"no_contact": "U", "opted_out": "O", "not_engaged": "E", "aborted": "A", "done": "C"}
YES_NO = ["Q1", "Q2", "Q3"]
GRADED = list(GRADED_QUESTIONS)
ESCALATION = "Escalation"

STATUS_COUNTS = ["total", "no_contact", "opted_out", "not_engaged", "aborted", "usable", "done"]
ANSWER_COUNTS = [c for q in YES_NO for c in (f"x{q}", f"n{q}y", f"n{q}n")] + \
                [c for q in GRADED for c in (f"x{q}", f"n{q}m", f"n{q}x", f"n{q}f")]
COUNTS = STATUS_COUNTS + ANSWER_COUNTS


def share_columns() -> dict[str, Column]:
    """Answer shares from answer counts; 0 with no answers."""
    out = {f"p{q}": share_of(f"n{q}y", f"x{q}") for q in YES_NO}
    out |= {f"p{q}{g}": share_of(f"n{q}{g}", f"x{q}") for q in GRADED for g in "mxf"}
    return out


def budgeted_pairs(budgets: DataFrame, locations: DataFrame, regions: DataFrame, states: DataFrame, *,
                   client_company: int | None = None, site_company: int | None = None) -> DataFrame:
    """Client-site pairs ever budgeted, with the client's region or ``ST Region`` and its negative state id."""
    client = locations.select(F.col("location_id").alias("client_id"), F.trim("name").alias("client_name"),
                              F.col("company_id").alias("client_company"), "region_id", "state")
    site = locations.select(F.col("location_id").alias("site_id"), F.col("name").alias("site_name"),
                            F.col("company_id").alias("site_company"))
    if client_company is not None:
        client = client.filter(F.col("client_company") == client_company)
    if site_company is not None:
        site = site.filter(F.col("site_company") == site_company)
    named = (budgets.select("client_id", "site_id").distinct().join(client, "client_id").join(site, "site_id")
             .join(regions.select(F.col("id").alias("region_id"), F.rtrim("name").alias("_region")), "region_id", "left")
             .withColumn("region_id", F.when(F.col("_region").isNotNull(), F.col("region_id")))
             .withColumn("region_name", F.coalesce("_region", F.concat("state", F.lit(" Region")))))
    return region_fill(named.drop("_region"), states)


def missing_regions(pairs: DataFrame) -> DataFrame:
    """Pairs whose region id could not be worked out."""
    return pairs.filter(F.col("region_id").isNull())


def survey_counts(results: DataFrame, answers: DataFrame, keys: list[str]) -> DataFrame:
    """Result and answer counts and answer shares per key.

    ``results`` has the keys, result_id and status; ``answers`` has the keys,
    result_id, question and answer (y/n, or m/x/f).
    """
    codes = ", ".join(f"'{c}'" for c in RESULT_CODES.values())
    count = lambda cond, name: F.expr(f"count(case when {cond} then 1 end) as {name}")
    by_status = results.groupBy(*keys).agg(
        count(f"status in ({codes})", "total"),
        *[count(f"status = '{code}'", name) for name, code in RESULT_CODES.items()],
        count(f"status = '{RESULT_CODES['done']}'", "usable"))

    def answered(q: str, letters: str) -> list[Column]:
        anything = ", ".join(f"'{a}'" for a in letters)
        return [count(f"question = '{q}' and answer in ({anything})", f"x{q}"),
                *[count(f"question = '{q}' and answer = '{a}'", f"n{q}{a}") for a in letters]]

    by_answer = answers.groupBy(*keys).agg(*[c for q in YES_NO for c in answered(q, "yn")],
                                           *[c for q in GRADED for c in answered(q, "mxf")])
    out = by_status.join(by_answer, keys, "left").na.fill(0, ANSWER_COUNTS)
    return out.select(*keys, *COUNTS, *[c.alias(n) for n, c in share_columns().items()])


def survey_levels(pairs: DataFrame, counts: DataFrame, client: str = "client_company",
                  month: str = "month", region_label: str = "") -> DataFrame:
    """Leaf, region and whole rows of each client company and month; pairs without surveys stay out."""
    leaf = (pairs.select(client, "region_id", "region_name", "client_id", "client_name", "site_id", "site_name")
            .join(counts, ["client_id", "site_id"]))
    out = hierarchy_rollup(leaf, COUNTS, [client, month], ["region_id", "region_name"], share_columns())
    label = F.when(F.col("level") == 10, "Region: All").when(
        F.col("level") == 20, F.concat(F.lit(region_label), "region_name")).otherwise(F.col("site_name"))
    return out.withColumn("provider", label)


def survey_review(pairs: DataFrame, results: DataFrame, answers: DataFrame, *, client: str = "client_company",
                  levels: tuple[int, ...] = (10, 20, 40), region_label: str = "",
                  null_when_empty: bool = False) -> DataFrame:
    """Question rows at whole (10), region (20) and client (40) level, per client company and month.

    ``results`` and ``answers`` carry client_id, site_id and month. Variants take all
    levels, whole and region, or the whole alone.
    """
    counts = survey_counts(results, answers, ["client_id", "site_id", "month"])
    rolled = survey_levels(pairs, counts, client, region_label=region_label)
    keep = ["level", client, "month", "region_id", "region_name", "client_name", "provider"]
    rows = rolled.filter(F.col("level").isin(list(levels)))
    return questions_to_rows(rows, keep, null_when_empty)


def numbered_levels(rolled: DataFrame, level: int, client: str = "client_company") -> DataFrame:
    """Rows of one level numbered by provider within each client company and month."""
    rows = rolled.filter(F.col("level") == level)
    return sequence_rows(rows, [client, "month"], ["provider", "region_id", "client_id", "site_id"]
                         if level == 40 else ["provider", "region_id"])


def survey_quality_check(results: DataFrame, start, end, keys: list[str] = (), upper: str = "midnight") -> DataFrame:
    """Surveys ever and in the window."""
    known = results.filter(F.col("status").isin(list(RESULT_CODES.values())))
    return known.groupBy(*keys).agg(F.count("*").alias("surveys_ever"),
                                    count_if(in_window("finished", start, end, upper)).alias("surveys_in_window"))


def feedback_extract(notes: DataFrame, results: DataFrame, lookup: DataFrame, start, end, *,
                     patients: DataFrame | None = None, locations: DataFrame | None = None,
                     regions: DataFrame | None = None, states: DataFrame | None = None,
                     orders: DataFrame | None = None, by: str = "finished", note_type: str | None = None,
                     region_default: str | None = "state_region", client_company: int | None = None,
                     name_of: str = "client", ids: bool = False, upper: str = "midnight") -> DataFrame:
    """Survey notes in the window with type, month, cleaned text and, given the location tables, region and client.

    The window applies to the survey's finish or, ``by="created"``, to the note.
    ``region_default``: a client without a region shows ``ST Region`` (state_region),
    the state (state), or nothing (None). ``ids`` adds the hierarchy ids. Clients in an
    unknown state drop out, as do orders whose patient is unknown.
    """
    results = results.filter(F.col("status").isin(list(RESULT_CODES.values()))).select("result_id", "order_id", "finished")
    if by == "finished":
        results = results.filter(in_window("finished", start, end, upper))
    else:
        notes = notes.filter(in_window("created", start, end, upper))
    out = notes.select("result_id", "type", "note", "created").join(results, "result_id")
    out = join_code(out, lookup, "QAFT", "type", "type_name", how="inner")
    if note_type is not None:
        out = out.filter(F.col("type_name") == note_type)
    cols = ["order_id", "type_name", "created", month_name("created").alias("month"),
            F.rtrim(clean_markup("note")).alias("feedback")]
    if locations is None:
        return out.select(*cols)
    people = patients.select("patient_id", "client_id", "site_id")
    site = locations.select(F.col("location_id").alias("site_id"), F.col("name").alias("_site"),
                            F.col("company_id").alias("site_company"))
    client = (locations.join(states.select(F.col("region_id").alias("state_id"), "state"), "state")
              .select(F.col("location_id").alias("client_id"), F.col("name").alias("_client"), "region_id", "state",
                      "state_id", F.col("company_id").alias("client_company")))
    if client_company is not None:
        client = client.filter(F.col("client_company") == client_company)
    client = client.join(regions.select(F.col("id").alias("region_id"), F.col("name").alias("_region")), "region_id", "left")
    default = {"state_region": F.concat("state", F.lit(" Region")), "state": F.col("state"), None: F.lit(None).cast("string")}
    out = (out.join(orders.select("order_id", "patient_id"), "order_id").join(people, "patient_id")
           .join(client, "client_id").join(site, "site_id"))
    cols += [F.rtrim(F.coalesce("_region", default[region_default])).alias("region"),
             F.rtrim("_client" if name_of == "client" else "_site").alias("client")]
    if ids:
        cols += ["client_company", F.coalesce("region_id", "state_id").alias("region_id"), "client_id", "site_id", "site_company"]
    return out.select(*cols)


def escalations(notes: DataFrame, results: DataFrame, lookup: DataFrame, start, end, **places) -> DataFrame:
    """Notes of type Escalation by creation date; without location tables only order, type, date and text."""
    return feedback_extract(notes, results, lookup, start, end, by="created", note_type=ESCALATION,
                            region_default="state", name_of="site", **places)
