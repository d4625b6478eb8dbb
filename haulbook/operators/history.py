"""Milestones and views from an order's action log.

``history`` has history_id, order_id, action, at, user_id. One aggregate over
the log finds every milestone of an order at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from haulbook.functions.text import code_in, same_code

# Action codes in the log.
NEW, RECEIVED, SCHEDULED, ENROUTE, VIEWED, COMPLETED, RECONCILED = "NOd", "Rec", "Sch", "EnR", "LVB", "Cmp", "Rcd"


def _last(cond: Column) -> Column:
    return F.max(F.when(cond, F.col("history_id")))


def milestone_columns() -> list[Column]:
    """Aggregates: the last id of new, of new-or-received, of scheduled and of en-route, with the acting users."""
    def user_of(cond: Column) -> Column:
        return F.max_by("user_id", F.when(cond, F.col("history_id")))

    sch, enr = same_code("action", SCHEDULED), same_code("action", ENROUTE)
    return [
        _last(same_code("action", NEW)).alias("new_id"),
        _last(code_in("action", [NEW, RECEIVED])).alias("received_id"),
        _last(sch).alias("scheduled_id"), user_of(sch).alias("scheduled_by"),
        _last(enr).alias("enroute_id"), user_of(enr).alias("enroute_by"),
    ]


def milestone_ids(history: DataFrame) -> DataFrame:
    return history.groupBy("order_id").agg(*milestone_columns())


def up_to_last(history: DataFrame, cond: Column) -> DataFrame:
    """The log rows of each order up to its last row that meets the condition: one exchange by order, no join."""
    last = _last(cond).over(Window.partitionBy("order_id"))
    return history.withColumn("_until", last).filter(F.col("history_id") <= F.col("_until")).drop("_until")


def view_milestones(history: DataFrame, extra: list[Column] = ()) -> DataFrame:
    """Milestones plus the view counts and times that depend on them.

    views_before: views up to the scheduling; first_view*: first view from the
    receipt on; last_view*: last view up to the scheduling. ``extra`` aggregates join
    the same pass over the log. The log is exchanged by order once: the markers are worked out over each order's rows and put
    beside them, and one aggregate on the same exchange finds everything else.
    """
    whole = Window.partitionBy("order_id")
    marked = (history.withColumn("_received", _last(code_in("action", [NEW, RECEIVED])).over(whole))
              .withColumn("_scheduled", _last(same_code("action", SCHEDULED)).over(whole)))
    viewed, at = same_code("action", VIEWED), F.col("history_id")
    before, after = viewed & (at <= F.col("_scheduled")), viewed & (at >= F.col("_received"))
    return marked.groupBy("order_id").agg(
        *milestone_columns(), *extra,
        F.nullif(F.count(F.when(before, 1)), F.lit(0)).alias("views_before"),
        F.min(F.when(after, at)).alias("first_view_id"),
        F.min_by("at", F.when(after, at)).alias("first_view"),
        F.max(F.when(before, at)).alias("last_view_id"),
        F.max_by("at", F.when(before, at)).alias("last_view"),
    )


def views_before(history: DataFrame) -> DataFrame:
    return view_milestones(history).select("order_id", "scheduled_id", "views_before")


def first_view_after(history: DataFrame) -> DataFrame:
    return view_milestones(history).select("order_id", "received_id", "first_view_id", "first_view")


def last_view_before(history: DataFrame) -> DataFrame:
    return view_milestones(history).select("order_id", "scheduled_id", "last_view_id", "last_view")


def first_by(cond: Column, value: str) -> Column:
    """Aggregate: the value of the earliest row that meets the condition, ties by history id."""
    return F.min_by(value, F.when(cond & F.col("at").isNotNull(), F.struct("at", "history_id")))


def first_columns(actions: dict[str, Column], value: str = "user_id") -> list[Column]:
    """Aggregates: ``<name>_at`` and ``<name>_by`` of the earliest action that meets each named condition."""
    return [first_by(cond, src).alias(f"{name}_{end}") for name, cond in actions.items()
            for end, src in (("at", "at"), ("by", value))]


def first_per_key(history: DataFrame, actions: dict[str, Column], value: str = "user_id") -> DataFrame:
    return history.groupBy("order_id").agg(*first_columns(actions, value))


def min_created(annotations: DataFrame, inventory_orders: DataFrame,
                item_type: int = 8, annotation_type: int = 4) -> DataFrame:
    """Earliest annotation of the given kind per order."""
    first = (annotations.filter((F.col("item_type") == item_type) & (F.col("annotation_type") == annotation_type))
             .groupBy("item_id").agg(F.min("created").alias("created")))
    return (first.join(inventory_orders, F.col("item_id") == F.col("inventory_order_id"))
            .groupBy("order_id").agg(F.min("created").alias("synced")))
