"""Repeat deliveries, missed item pairs and their summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from haulbook.functions.dates import days_between, day_index, minutes_between, month_name, yyyymm
from haulbook.functions.numbers import pct_of
from haulbook.functions.text import person_name
from haulbook.functions.windows import period_start, period_starts, shift_periods, valid_in_month
from haulbook.operators.aggregates import elapsed_buckets, item_list, keep_first_of_group
from haulbook.operators.intervals import prefix_ranks, running_at
from haulbook.operators.lookups import override_flags
from haulbook.operators.reshape import union_distinct
from haulbook.operators.scan import ID_BLOCK, scan_before, time_levels
from haulbook.sources.sinks import staged

# Items and equipment that are counted apart, and the fee product.
OXYGEN_ITEMS = [147, 794]
SERVICE_ITEM = 227
NOT_DISPOSABLE_ITEMS = [147, 794, 227, 796, 797, 89, 308, 764, 295, 296]
OXYGEN_EQUIPMENT = 8734
FEE_PRODUCT = 25400

REDELIVERED = "[Re-Del]"
#: Notes of orders that cannot count as a delivery; all other orders are valid predecessors.
INVALID = ["PickupOnly", "NoDetails", "StandingO2", "Service"]


def order_windows(df: DataFrame, ts: str, kind: str, lookback_days: int) -> DataFrame:
    """Put each order into every period whose look-back span holds it: from its own to the one ``lookback_days`` later.

    Adds window_start. The look-back may be longer than a period: an order then lies in several later ones.
    """
    last = F.date_add(F.to_date(ts), lookback_days)
    return df.withColumn("window_start", F.explode(period_starts(kind, F.col(ts), last)))


def _windows(kind: str, days: int, first, last) -> Column:
    """Array of the wanted windows whose look-back span holds the order."""
    starts = period_starts(kind, F.col("completed"), F.date_add(F.to_date("completed"), days))
    if first is not None:
        starts = F.filter(starts, lambda w: w >= F.lit(first).cast("date"))
    if last is not None:
        starts = F.filter(starts, lambda w: w <= F.lit(last).cast("date"))
    return starts


def budget_months(budgets: DataFrame) -> DataFrame:
    """The months in which each client-site pair is valid: those of its budgets that are not for a sub-unit."""
    return (budgets.filter(F.coalesce("sub_unit", F.lit(0)) == 0)
            .select(F.col("client_id").alias("_c"), F.col("site_id").alias("_s"), "begin_yyyymm", "end_yyyymm"))


def with_valid_pair(df: DataFrame, pairs: DataFrame, valid: Column) -> DataFrame:
    return df.join(pairs, (F.col("client_id") == F.col("_c")) & (F.col("site_id") == F.col("_s")) & valid, "left_semi")


def placed_orders(orders: DataFrame, patients: DataFrame, pairs: DataFrame, *, kind: str = "M", days: int = 5,
                  first=None, last=None) -> DataFrame:
    """Completed orders of patients on client-site pairs that are valid in the month of one of the order's windows, once each.

    ``first`` and ``last`` bound the wanted window starts. Patients of type M are left out. ``several`` marks patients who
    are listed under more than one pair: their orders need not be valid in the same windows.
    """
    base = orders.filter(F.col("completed").isNotNull())
    if first is not None:
        base = base.filter(F.col("completed") >= F.date_sub(F.lit(first).cast("date"), days).cast("timestamp_ntz"))
    if last is not None:
        base = base.filter(F.col("completed") < shift_periods(kind, F.lit(last).cast("date"), 1).cast("timestamp_ntz"))
    base = base.select("order_id", "patient_id", F.coalesce("driver_id", F.lit(0)).alias("driver_id"),
                       F.coalesce("route_number", F.lit(0)).alias("route_number"), "completed", "reason")
    own, place = Window.partitionBy("patient_id"), F.struct("client_id", "site_id")
    people = (patients.filter(F.trim("type") != "M").select("patient_id", "client_id", "site_id")
              .withColumn("several", F.min(place).over(own) != F.max(place).over(own)))
    return with_valid_pair(base.join(people, "patient_id"), pairs,
                           F.exists(_windows(kind, days, first, last), lambda w: valid_in_month(yyyymm(w))))


def in_windows(placed: DataFrame, pairs: DataFrame, *, kind: str = "M", days: int = 5, first=None, last=None) -> DataFrame:
    """One row per order and window in whose month its pair is valid."""
    out = order_windows(placed, "completed", kind, days)
    if first is not None:
        out = out.filter(F.col("window_start") >= F.lit(first).cast("date"))
    if last is not None:
        out = out.filter(F.col("window_start") <= F.lit(last).cast("date"))
    return with_valid_pair(out, pairs, valid_in_month(yyyymm("window_start")))


def raw_orders(orders: DataFrame, patients: DataFrame, budgets: DataFrame, *, kind: str = "M", days: int = 5,
               first=None, last=None) -> DataFrame:
    """Completed orders of patients on client-site pairs that are valid in the window's month.

    ``first`` and ``last`` bound the wanted window starts. A pair counts only through
    a budget that is not for a sub-unit; patients of type M are left out.
    """
    pairs, span = budget_months(budgets), {"kind": kind, "days": days, "first": first, "last": last}
    return in_windows(placed_orders(orders, patients, pairs, **span), pairs, **span).drop("several")


COUNTS = ["dme_count", "o2_count", "disposable_count", "service_count", "paired_count", "pickup_count", "fee_count"]


def order_contents(order_keys: DataFrame, details: DataFrame, equipment_lines: DataFrame,
                   client_equip: DataFrame | None, sub_items: DataFrame | None) -> DataFrame:
    """Per order with lines the number of rental, oxygen, disposable, service, paired, pickup and fee lines.

    ``order_keys`` has order_id, client_id, site_id. Lines are counted per order and product before any join, so an
    order with very many lines stays small. Pickup lines need no product: they are counted per order from one column,
    and the two counts meet on the exchange they share, so no join has rows without a key.
    """
    keys = order_keys.select("order_id", "client_id", "site_id").dropDuplicates(["order_id"])
    counted = (details.filter(F.col("order_id").isNotNull() & F.col("product_id").isNotNull()).groupBy("order_id", "product_id")
               .agg(F.count("*").alias("_n")))
    picked = details.filter(F.col("reference_order_id").isNotNull()).groupBy(F.col("reference_order_id").alias("order_id")).agg(F.count("*").alias("pickup_count"))
    kinds = equipment_lines.withColumn("own_item", F.col("item_id"))
    if sub_items is not None:
        marks = sub_items.select(F.col("sub_item").alias("own_item"), F.lit(True).alias("_paired")).distinct()
        kinds = kinds.join(marks, "own_item", "left")
    else:
        kinds = kinds.withColumn("_paired", F.lit(False))
    lines = counted.join(keys, "order_id").join(kinds, "product_id")
    if client_equip is not None:
        lines = override_flags(lines, client_equip)

    def total(cond: str) -> str:
        return f"coalesce(sum(case when {cond} then _n end), 0)"

    listed = lambda items: ", ".join(map(str, items))
    odd = f"equipment_id = {OXYGEN_EQUIPMENT}"
    oxygen_items = f"disposable and item_id in ({listed(OXYGEN_ITEMS)})"
    values = {
        "dme_count": total(f"not oxygen and not disposable and not ({odd})"),
        "o2_count": f"{total('oxygen')} + {total(oxygen_items)} + {total(odd)}",
        "disposable_count": total(f"disposable and item_id not in ({listed(NOT_DISPOSABLE_ITEMS)})"),
        "service_count": total(f"disposable and item_id = {SERVICE_ITEM}"),
        "paired_count": total("_paired"),
        "fee_count": f"coalesce(max(case when product_id = {FEE_PRODUCT} then _n end), 0)",
    }
    delivered = lines.groupBy("order_id").agg(*[F.expr(f"{v} as {n}") for n, v in values.items()])
    return delivered.join(picked, "order_id", "full").select("order_id", *[F.coalesce(n, F.lit(0)).alias(n) for n in COUNTS])


def exclusion_note() -> Column:
    """Why an order cannot count as a delivery; NULL when it can. The first rule that fits wins."""
    dme, o2, disp = F.col("dme_count"), F.col("o2_count"), F.col("disposable_count")
    service, pickup = F.col("service_count"), F.col("pickup_count")
    nothing = dme + o2 + disp + service == 0
    return (F.when(nothing & (pickup > 0), "PickupOnly").when(nothing & (pickup == 0), "NoDetails")
            .when((o2 > 0) & (dme == 0), "StandingO2").when(service > 0, "Service"))


def _strict_predecessors(placed: DataFrame, pairs: DataFrame, span: dict, block: int) -> DataFrame:
    """Predecessors by time, then id, within each window, found before the orders are dealt to their windows.

    All orders of a patient with one client-site pair are valid in the same windows, and the last window of an order never falls
    along (completed, order_id). So an order's predecessor in a window is its last valid order of all if that one reaches the
    window, else there is none. One scan over the orders, one row each, finds it. The invalid orders passed over are counted from
    sums per last window: the few that end within the order's own windows are kept beside it. Orders of patients with
    ``several`` pairs are dealt to their windows first, and each window is scanned by itself.
    """
    starts, keys, reach = _windows(**span), ["_own", "patient_id"], F.date_add(F.to_date("completed"), span["days"])
    alone = F.array(F.lit(None).cast("date"))
    rows = with_valid_pair(placed.withColumn("_own", F.explode(F.when(F.col("several"), starts).otherwise(alone))), pairs,
                           F.col("_own").isNull() | valid_in_month(yyyymm("_own")))
    found = scan_before(rows, keys, ["completed", "order_id"], time_levels("completed", "order_id", block),
                        F.when(F.col("note").isNull(), F.struct("order_id", "driver_id", "route_number", "completed")),
                        F.when(F.col("note").isNull(), 0).otherwise(1)).withColumn("_last", period_start(span["kind"], reach))
    ends = (rows.withColumn("_last", period_start(span["kind"], reach)).groupBy(*keys, "_last")
            .agg(F.sum(F.when(F.col("note").isNull(), 0).otherwise(1)).alias("_n")))
    w = Window.partitionBy(*keys).orderBy("_last")
    ends = ends.select(F.col("_own").alias("_o"), F.col("patient_id").alias("_p"), F.col("_last").alias("_l"),
                       F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_upto"),
                       F.collect_list(F.when(F.col("_n") > 0, F.struct(F.col("_last").alias("at"), F.col("_n").alias("n"))))
                       .over(w.rowsBetween(-span["days"], Window.currentRow)).alias("_ends"))
    counted = found.join(ends, F.col("_own").eqNullSafe(F.col("_o")) & (F.col("patient_id") == F.col("_p")) & (F.col("_last") == F.col("_l")), "left")
    dealt = counted.withColumn("window_start", F.explode(F.when(F.col("_own").isNull(), starts).otherwise(F.array("_own"))))
    dealt = with_valid_pair(dealt, pairs, valid_in_month(yyyymm("window_start")))
    reached = period_start(span["kind"], F.date_add(F.to_date("found.completed"), span["days"])) >= F.col("window_start")
    within = F.aggregate("_ends", F.lit(0).cast("long"), lambda n, e: n + F.when(e["at"] >= F.col("window_start"), e["n"]).otherwise(0))
    skipped = F.when(reached, F.col("before") - F.col("found_before")).otherwise(within - (F.col("_upto") - F.col("before")))
    return (dealt.withColumn("pre", F.when(reached, F.col("found"))).withColumn("skipped", skipped)
            .drop("_own", "_o", "_p", "_l", "_last", "_upto", "_ends", "before", "found", "found_before"))


def _lowest_id_predecessors(df: DataFrame, keys: list[str]) -> DataFrame:
    """Orders completed at one instant point at the lowest other id among them.

    A search for a valid predecessor that reaches such a group takes its lowest id,
    else its second lowest, and ends there without result (``no_valid``) when both are
    invalid or the order itself would be the answer.
    """
    at = [*keys, "completed"]
    payload = F.struct("order_id", "driver_id", "route_number", "completed", F.col("note").isNull().alias("ok"))
    lows = df.groupBy(*at).agg(F.min(payload).alias("_g1"), F.min("order_id").alias("_low"))
    second = (df.join(lows.select(*at, "_low"), at).filter(F.col("order_id") > F.col("_low")).groupBy(*at).agg(F.min(payload).alias("_g2")))
    lows = lows.drop("_low").join(second, at, "left")
    g1, g2 = F.col("_g1"), F.col("_g2")
    pick = (F.when(g1["ok"], g1).when(g2["ok"], g2))
    stop = F.struct(pick.alias("pick"), F.lit(True).alias("stop"))
    groups = scan_before(lows, keys, ["completed"], [{"_hour": F.date_trunc("hour", "completed")}], F.when(g2.isNotNull() | g1["ok"], stop))
    groups = groups.select(*at, "_g1", "_g2", F.col("found").alias("_earlier"))
    own = F.col("order_id")
    tied = g2.isNotNull()
    is1 = own == g1["order_id"]
    is2 = own == g2["order_id"]
    in_group = (F.when(is1 & g2["ok"], g2).when(~is1 & g1["ok"], g1).when(~is1 & ~is2 & g2["ok"], g2))
    found = F.when(tied, in_group).otherwise(F.col("_earlier.pick"))
    return (df.join(groups, at)
            .withColumn("no_valid", F.coalesce(found.isNull() & (tied | F.col("_earlier.stop")), F.lit(False)))
            .withColumn("pre", found).withColumn("skipped", F.lit(None).cast("long"))
            .drop("_g1", "_g2", "_earlier"))


def redelivery(orders: DataFrame, details: DataFrame, patients: DataFrame, budgets: DataFrame,
               equipment_lines: DataFrame, *, client_equip: DataFrame | None = None,
               sub_items: DataFrame | None = None, kind: str = "M", days: int = 5, first=None, last=None,
               ties: str = "strict", block: int = ID_BLOCK) -> DataFrame:
    """Label every order of each window with the one reason it is or is not a repeat delivery.

    The predecessor is the last valid order of the patient before it. ``ties`` says how
    orders completed at the same instant are ordered: ``strict`` by id, or ``lowest_id``,
    where each points at the lowest other id of its instant and several orders may share
    a predecessor, of which all but the lowest id become ``2xPost``. One row per window and
    order, the look-back days before the window included (``in_period`` tells).
    """
    if ties not in ("strict", "lowest_id"):
        raise ValueError("ties is 'strict' or 'lowest_id'")
    span = {"kind": kind, "days": days, "first": first, "last": last}
    pairs = staged(budget_months(budgets))
    placed = staged(placed_orders(orders, patients, pairs, **span))
    contents = order_contents(placed, details, equipment_lines, client_equip, sub_items)
    base = staged(placed.join(contents, "order_id", "left").na.fill(0, COUNTS).withColumn("note", exclusion_note()))
    if ties == "strict":
        linked = _strict_predecessors(base, pairs, span, block).withColumn("no_valid", F.lit(False))
    else:
        linked = _lowest_id_predecessors(staged(in_windows(base, pairs, **span)), ["window_start", "patient_id"])
    for c in ("order_id", "driver_id", "route_number", "completed"):
        linked = linked.withColumn(f"pre_{c}", F.col(f"pre.{c}"))
    minutes = minutes_between("coalesce(pre_completed, completed)", "completed")
    same_run = (F.col("driver_id") == F.col("pre_driver_id")) & (F.col("route_number") == F.col("pre_route_number"))
    linked = linked.withColumn("minutes", minutes).drop("pre")
    linked = linked.withColumn("note", F.coalesce(
        "note",
        F.when(F.col("no_valid"), "NoValidPre")
        .when(F.col("pre_route_number").isNull(), "NoPreOrd")
        .when(F.col("minutes") > days * 1440, "GT>Days")
        .when((F.col("minutes") == 0) & same_run, "SameStop")
        .when((F.col("minutes") < 1440) & same_run & (days_between("pre_completed", "completed") == 0), "SameRoute")))
    if ties == "strict":  # two candidates never share a predecessor: the later one follows the earlier
        linked = linked.withColumn("_keep", F.lit(1)).withColumn("_pre", F.lit(None))
    else:
        group = F.when(F.col("note").isNull(), F.col("pre_order_id"))
        linked = keep_first_of_group(linked.withColumn("_pre", group), ["window_start", "_pre"], "order_id", "_keep")
    note = F.coalesce("note", F.when(F.col("_keep") == 0, "2xPost").otherwise(REDELIVERED))
    in_period = period_start(kind, F.col("completed")) == F.col("window_start")
    return (linked.withColumn("note", note)
            .withColumn("redelivery", F.when(F.col("note") == REDELIVERED, 1).otherwise(0))
            .withColumn("in_period", in_period).drop("_pre", "_keep", "no_valid", "several"))


RUN = ["window_start", "patient_id", "run_after"]


def skipped_runs(labelled: DataFrame) -> DataFrame:
    """The skipped orders as runs: one row per invalid order with its run and its place in it, from 1.

    A run is all invalid orders of a window's patient between two valid ones; ``run_after`` names it by the valid order before
    it, null at the patient's start. An order with ``skipped`` = k passed over the places k … 1 of its run. The labels
    hold all of this already (needs ``ties="strict"``), so nothing is sorted or shuffled, and no run is cut.
    """
    return labelled.filter(F.col("note").isin(INVALID)).select(
        "window_start", "patient_id", F.col("pre_order_id").alias("run_after"), (F.col("skipped") + 1).alias("place"), "order_id", "note")


def skipped_orders(labelled: DataFrame, width: int | None = None, block: int = 4096) -> DataFrame:
    """The ids and notes each order skipped on the way to its predecessor, nearest first, as text.

    Whole lists by default: their total length grows with the square of a run's, as the wish for such text does;
    ``skipped_runs`` says the same in one row per order. ``width`` cuts each text, and then an order reads only the
    nearest orders that can show: an id with its comma takes 3 characters or more, so width / 3 + 1 rows, in blocks of
    ``block`` places that overlap by one such frame.
    """
    runs = skipped_runs(labelled).select(*RUN, F.col("place").alias("_at"), F.struct("order_id", "note").alias("_skip"))
    asks = labelled.filter(F.col("skipped") > 0).select(
        "window_start", "patient_id", F.col("pre_order_id").alias("run_after"), F.col("skipped").alias("_at"), "order_id", "skipped")
    # A question about places k … 1 stands just after place k.
    both = runs.unionByName(asks, allowMissingColumns=True)
    if width is None:
        w = Window.partitionBy(*RUN).orderBy("_at", F.col("order_id").isNotNull(), "order_id").rowsBetween(Window.unboundedPreceding, -1)
        seen = both.withColumn("_prior", F.collect_list("_skip").over(w))
    else:
        frame = width // 3 + 1
        home = F.expr(f"_at div {block}")
        spill = F.when((F.col("_at") % block >= block - frame) & F.col("_skip").isNotNull(), F.array(home, home + 1)).otherwise(F.array(home))
        w = Window.partitionBy(*RUN, "_block").orderBy("_at", F.col("order_id").isNotNull(), "order_id").rowsBetween(Window.unboundedPreceding, -1)
        near = Window.partitionBy(*RUN, "_block").orderBy("_at").rangeBetween(-frame, 0)
        seen = both.withColumn("_block", F.explode(spill)).withColumn("_prior", F.collect_list("_skip").over(near))
    nearest = F.reverse("_prior")
    text = lambda f: F.array_join(F.transform(nearest, f), ", ") if width is None else F.substring(F.array_join(F.transform(nearest, f), ", "), 1, width)
    return (seen.filter(F.col("order_id").isNotNull())
            .select("window_start", "patient_id", "order_id", "skipped", text(lambda x: x["order_id"].cast("string")).alias("skipped_ids"),
                    text(lambda x: x["note"]).alias("skipped_notes")))


def redelivered_order_items(labelled: DataFrame, lines: DataFrame) -> DataFrame:
    """Item lists of redelivered or fee-charged orders and of their predecessors."""
    hit = labelled.filter((F.col("redelivery") == 1) | (F.col("fee_count") > 0))
    wanted = union_distinct(hit.select("order_id"), hit.select(F.col("pre_order_id").alias("order_id"))).dropna()
    return wanted.join(item_list(lines.join(wanted, "order_id", "left_semi")), "order_id", "left")


def _stock_events(df: DataFrame, start: Column, *cols) -> DataFrame:
    """+n on the day a line starts to count (null: always) and -n on the day it stops; lines that never count are dropped."""
    live = df.withColumn("_from", start).filter(F.coalesce(F.col("_from") < F.col("back"), F.lit(True)))
    step = F.explode(F.array(F.struct(F.col("_from").alias("day"), F.col("n").alias("weight")),
                             F.struct(F.col("back").alias("day"), (-F.col("n")).alias("weight"))))
    ends = live.select(*cols, "back", step.alias("_s"))
    return ends.filter((F.col("_s.weight") > 0) | F.col("back").isNotNull()).select(*cols, "_s.day", "_s.weight")


def _first_midnight(ts: str) -> Column:
    """The first day whose midnight is not before the stamp."""
    return day_index(ts) + F.expr(f"if(cast(to_date({ts}) as timestamp_ntz) = {ts}, 0, 1)")


def paired_items(labelled: DataFrame, orders: DataFrame, item_lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """Sub-items on redeliveries and whether their main item went out with them.

    ``item_lines`` has order_id, item_id, check_out, check_in, other_status, one row per
    detail line and equipment. A main item counts on the same stop (patient, day, driver,
    route) when it went out by that day, and on earlier orders when it went out by the
    sub-item's day, in both cases unless it came back before that day. A pair is missed
    when the stop lacks main items but earlier orders still have them. A sub-item without a check-out finds none.

    Stock is swept: main lines become plus and minus events on days, and running sums per stop, and per patient and
    item, answer all questions of a key at once. Earlier orders are those of stops up to the question's: events are
    held in a tree over the days a patient's questions ask about, one copy with one such day, so no line is ever
    matched to another. The grouped sub and main lines are stored, since several sums read them.
    """
    lines = item_lines.join(pairs.select(F.col("sub_item").alias("item_id")).distinct(), "item_id", "left_semi")
    chosen = labelled.filter((F.col("redelivery") == 1) & (F.col("paired_count") > 0)).select("order_id").distinct()
    placed = orders.filter(F.col("completed").isNotNull()).select(
        "order_id", "patient_id", day_index("completed").alias("stop_day"), "driver_id", "route_number")
    subs = staged(lines.join(placed.join(chosen, "order_id", "left_semi"), "order_id")
                  .groupBy("order_id", "patient_id", "stop_day", "driver_id", "route_number",
                           F.col("item_id").alias("sub_item"), day_index("check_out").alias("day"))
                  .agg(F.count("*").alias("lines")))
    asked = subs.filter(F.col("day").isNotNull())

    wanted = subs.select("patient_id", "sub_item").distinct()
    mains = (item_lines.join(pairs.select("sub_item", F.col("main_item").alias("item_id")).distinct(), "item_id")
             .filter(F.col("check_out").isNotNull())
             .groupBy("order_id", "sub_item", day_index("check_out").alias("out_day"), _first_midnight("check_out").alias("out_from"),
                      (day_index("coalesce(check_in, other_status)") + 1).alias("back")).agg(F.count("*").alias("n")))
    mains = staged(mains.join(placed, "order_id").join(wanted, ["patient_id", "sub_item"], "left_semi")
                   .groupBy("patient_id", "stop_day", "driver_id", "route_number", "sub_item", "out_day", "out_from", "back").agg(F.sum("n").alias("n")))

    stop = ["patient_id", "stop_day", "driver_id", "route_number", "sub_item"]
    known = F.col("driver_id").isNotNull() & F.col("route_number").isNotNull()
    same = mains.filter(known)
    by_day = _stock_events(same.filter(F.col("out_day") <= F.col("stop_day")), F.lit(None).cast("int"), *stop)
    by_stamp = _stock_events(same, F.col("out_from"), *stop)
    zero = F.lit(0).cast("long")
    events = (by_day.withColumnRenamed("weight", "stop_count").withColumn("stop_prior", zero)
              .unionByName(by_stamp.withColumnRenamed("weight", "stop_prior").withColumn("stop_count", zero)))
    at_stop = running_at(events, asked.filter(known), stop, "day", ["stop_count", "stop_prior"])

    pair = ["patient_id", "sub_item"]
    point_nodes, asked_nodes = prefix_ranks(mains, asked, pair, "stop_day")
    spread = mains.join(point_nodes, [*pair, "stop_day"]).withColumn("node", F.explode("nodes"))
    reads = (asked.select(*pair, "stop_day", "day").distinct().join(asked_nodes, [*pair, "stop_day"]).withColumn("node", F.explode("nodes"))
             .select(*pair, "stop_day", "day", "node"))
    node = [*pair, "node"]
    parts = running_at(_stock_events(spread, F.col("out_from"), *node).withColumnRenamed("weight", "part"), reads, node, "day", ["part"])
    so_far = reads.join(parts, [*node, "day"]).groupBy(*pair, "stop_day", "day").agg(F.sum("part").alias("all_prior"))

    out = (subs.join(at_stop, [*stop, "day"], "left").join(so_far, [*pair, "stop_day", "day"], "left")
           .na.fill(0, ["stop_count", "stop_prior", "all_prior"])
           .withColumn("prior_count", F.col("all_prior") - F.col("stop_prior")))
    sums = out.groupBy(*stop, "stop_count", "prior_count").agg(F.sum("lines").alias("_subs"))
    per_stop = sums.groupBy(*stop).agg(
        F.max(F.when(F.col("_subs") <= F.col("stop_count"), 1).otherwise(0)).alias("valid_on_stop"),
        F.max(F.when(F.col("_subs") <= F.col("stop_count") + F.col("prior_count"), 1).otherwise(0)).alias("found"))
    marked = out.join(per_stop, stop, "left")
    missed = F.when((F.col("found") == 1) & (F.col("valid_on_stop") == 0), 1).otherwise(0)
    return marked.select("order_id", "patient_id", "stop_day", "driver_id", "route_number", "sub_item",
                         F.col("day").alias("out_day"), "lines", "stop_count", "prior_count",
                         F.coalesce("valid_on_stop", F.lit(0)).alias("valid_on_stop"),
                         F.coalesce("found", F.lit(0)).alias("found"), missed.alias("missed"))


def redelivery_summary(labelled: DataFrame, pairs_marked: DataFrame | None, patients: DataFrame,
                       locations: DataFrame, companies: DataFrame, regions: DataFrame, states: DataFrame, *,
                       bands: int = 7, percents: bool = True) -> DataFrame:
    """Orders, redeliveries, missed pairs and time bands per window, provider site, client and region.

    Clients in a state that is not on the state list drop out.
    """
    if pairs_marked is not None:
        missed = pairs_marked.groupBy("order_id").agg(F.max("missed").alias("missed_pair"))
        labelled = labelled.join(missed, "order_id", "left")
    else:
        labelled = labelled.withColumn("missed_pair", F.lit(0))
    per_pair = labelled.filter("in_period").groupBy("window_start", "client_id", "site_id").agg(
        F.count("*").alias("orders"), F.sum("redelivery").alias("redeliveries"),
        F.sum(F.coalesce("missed_pair", F.lit(0))).alias("missed_pairs"),
        *elapsed_buckets("minutes", "redelivery", bands, percents=False))
    site = (locations.select(F.col("location_id").alias("site_id"), F.col("name").alias("_site"), F.col("company_id"))
            .join(companies.select(F.col("id").alias("company_id"), F.col("name").alias("_firm")), "company_id"))
    client = (locations.join(states.select("state"), "state", "left_semi")
              .select(F.col("location_id").alias("client_id"), F.col("name").alias("_client"), "region_id", "state")
              .join(regions.select(F.col("id").alias("region_id"), F.col("name").alias("_region")), "region_id", "left"))
    names = [F.rtrim(F.concat("_firm", F.lit(", "), "_site")).alias("provider"), F.rtrim("_client").alias("client"),
             F.rtrim(F.coalesce("_region", F.concat("state", F.lit(" Region")))).alias("region")]
    hours = [(k + 1) * 24 for k in range(bands)]
    counts = ["orders", "redeliveries", "missed_pairs", *[f"n_{h}h" for h in hours]]
    named = (per_pair.join(site, "site_id").join(client, "client_id")
             .groupBy("window_start", *names).agg(*[F.sum(c).alias(c) for c in counts]))
    pcts = [pct_of("missed_pairs", "orders", "decimal(9,4)").alias("pct_missed_pairs"),
            pct_of("redeliveries", "orders", "decimal(9,4)").alias("pct_redelivery")]
    if percents:
        pcts += [pct_of(f"n_{h}h", "orders", "decimal(9,4)").alias(f"pct_{h}h") for h in hours]
    return named.select(month_name("window_start").alias("month"), "*", *pcts)
