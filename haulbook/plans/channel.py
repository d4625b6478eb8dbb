"""Phone against system orders, and the census average."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from haulbook.functions.dates import month_name, yyyymm
from haulbook.functions.windows import in_window
from haulbook.operators.aggregates import mean_over_months
from haulbook.operators.filters import not_in_list
from haulbook.operators.lookups import fallback_lookup, region_fill

# User types, reasons and billing mode of the channel report, and the own company's id.
PHONE_USER_TYPES = ["D", "S"]
DROPPED_REASONS = ["X", "S", "W", "V"]
HOME_CARE = "H"
OWN_COMPANY = 2


def order_channel(orders: DataFrame, patients: DataFrame, locations: DataFrame, companies: DataFrame,
                  regions: DataFrame, states: DataFrame, users: DataFrame, user_locations: DataFrame, start, end, *,
                  house_name: str, client_company: int | None = None, site_company: int | None = None,
                  own_company: int = OWN_COMPANY, upper: str = "midnight") -> DataFrame:
    """Each delivered or picked-up order as phone or system, phone split into network and own company.

    An order is phone when its user is of a phone type or carries the house's own
    ``house_name`` as first name. Home-care clients and the dropped reasons stay out.
    """
    base = orders.filter(in_window("stamp", start, end, upper) & F.trim("status").isin("D", "P"))
    base = not_in_list(base, "reason", DROPPED_REASONS).select("order_id", "patient_id", "ordered_by", "stamp")
    client = locations.filter(F.trim("billing_mode") != HOME_CARE).select(
        F.col("location_id").alias("client_id"), F.trim("name").alias("client"), F.col("company_id").alias("client_company"),
        F.col("region_id"), "state")
    site = locations.select(F.col("location_id").alias("site_id"), F.col("name").alias("site"),
                            F.col("company_id").alias("site_company"))
    if client_company is not None:
        client = client.filter(F.col("client_company") == client_company)
    if site_company is not None:
        site = site.filter(F.col("site_company") == site_company)
    firm = lambda k, n: companies.select(F.col("id").alias(k), F.trim("name").alias(n))
    who = users.select(F.col("user_id").alias("ordered_by"), F.col("type").alias("_type"), "first", F.trim("full").alias("ordered_by_name"))
    out = (base.join(patients.select("patient_id", "client_id", "site_id"), "patient_id")
           .join(client, "client_id").join(site, "site_id")
           .join(firm("client_company", "hospice"), "client_company").join(firm("site_company", "provider"), "site_company")
           .join(who, "ordered_by")
           .join(regions.select(F.col("id").alias("region_id"), F.trim("name").alias("_region")), "region_id", "left"))
    no_region = F.coalesce("region_id", F.lit(0)) == 0
    out = (out.withColumn("region", F.when(no_region, F.trim(F.concat("state", F.lit(" Region")))).otherwise(F.col("_region")))
           .withColumn("region_id", F.when(~no_region, F.col("region_id"))))
    out = region_fill(out, states, "region_id", "region").withColumn("region_id", F.coalesce("region_id", F.lit(0)))
    out = fallback_lookup(out, user_locations, "ordered_by", "client_company", "site_company")
    phone = F.when(F.trim("_type").isin(PHONE_USER_TYPES) | (F.lower("first") == house_name.lower()), 1).otherwise(0)
    own = F.coalesce((F.col("user_company") == own_company) & (F.trim("user_level") == "D"), F.lit(False))
    out = out.withColumn("phone", F.coalesce(phone, F.lit(0)))
    return out.select("hospice", "region_id", "region", "client", "provider", "site", "phone",
                      (1 - F.col("phone")).alias("system"),
                      F.when(own, 0).otherwise(F.col("phone")).alias("phone_network"),
                      F.when(own, F.col("phone")).otherwise(0).alias("phone_own"),
                      "order_id", month_name("stamp").alias("month"), "ordered_by_name").distinct()


def census_average(patient_days: DataFrame, start, end) -> DataFrame:
    """Mean monthly patient count per pair over the months of the window."""
    inside = patient_days.filter((F.col("yyyymm") >= yyyymm(F.lit(start).cast("date")))
                                 & (F.col("yyyymm") <= yyyymm(F.lit(end).cast("date"))))
    return mean_over_months(inside, ["hospice", "region", "client", "site", "dme"], "yyyymm", "patient_count")
