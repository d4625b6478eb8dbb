"""Order lists and counts for one client company."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from haulbook.functions.dates import hours_between
from haulbook.functions.text import person_name
from haulbook.functions.windows import in_window
from haulbook.operators.aggregates import conditional_counts, count_orders_by


def client_orders(orders: DataFrame, patients: DataFrame, locations: DataFrame, start, end, *,
                  client_company: int | None = None, dme_ids: list[int] | None = None, status: str | None = None,
                  within_hours: int | None = None, over_hours: int | None = None,
                  upper: str = "midnight") -> DataFrame:
    """Orders completed in the window for a client company or for provider ids.

    ``status`` picks pickups or deliveries; ``within_hours`` keeps those completed that
    soon after scheduling; ``over_hours`` those completed later than that after the due time.
    """
    base = orders.filter(in_window("completed", start, end, upper))
    if dme_ids is not None:
        base = base.filter(F.col("dme_id").isin(dme_ids))
    if status is not None:
        base = base.filter(F.trim("status") == status)
    if within_hours is not None:
        base = base.filter(hours_between("scheduled", "completed") <= within_hours)
    if over_hours is not None:
        base = base.filter(hours_between("schedule_end", "completed") > over_hours)
    people = patients.select("patient_id", "client_id", "site_id", "last_name", "first_name")
    out = base.join(people, "patient_id")
    if client_company is not None:
        own = locations.filter(F.col("company_id") == client_company).select(F.col("location_id").alias("client_id"))
        out = out.join(own, "client_id", "left_semi")
    return out.withColumn("patient", person_name("last_name", "first_name"))


def pickup_summary(selected: DataFrame, hours: int = 48, keys: list[str] = ()) -> DataFrame:
    """Orders, pickups, and pickups done within the hours, from a ``client_orders`` result."""
    pickup = F.trim("status") == "P"
    return conditional_counts(selected, {
        "total_orders": F.lit(True), "total_pickups": pickup,
        "pickups_within": pickup & (hours_between("scheduled", "completed") <= hours)}, list(keys))


def orders_by_patient(selected: DataFrame) -> DataFrame:
    """Deliveries per patient name."""
    return count_orders_by(selected.filter(F.trim("status") == "D"), "patient")
