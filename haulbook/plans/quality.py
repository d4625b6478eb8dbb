"""Delivery accuracy and inventory counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from haulbook.functions.numbers import count_if, pct_of
from haulbook.functions.text import code_in_string
from haulbook.functions.windows import in_window

# Checks recorded per order, and the security role of drivers.
CHECKS = ["ir_correct", "wo_match", "instruct", "dme", "signature", "notes", "replied"]
DRIVER_ROLE = 17
OWN_COMPANY = 2


def kit_errors(lines: DataFrame) -> DataFrame:
    """1 where the kit asks for a serial number or oxygen lot and a line with a checked status lacks it."""
    checked = code_in_string("status")

    def missing(count: str, number: str) -> Column:
        return F.when(checked & (F.coalesce(count, F.lit(0)) != 0) & F.col(number).isNull(), 1).otherwise(0)

    return (lines.withColumn("serial_missing", missing("serial_count", "serial_number"))
            .withColumn("oxygen_missing", missing("o2_count", "o2_lot")))


def accuracy_flags(df: DataFrame, with_pickup_oxygen: bool = False) -> DataFrame:
    """missing_order_stat, and totally_accurate: 0 accurate, 1 not, NULL without recorded checks."""
    names = ["serial_delivery", "oxygen_delivery", "serial_pickup", *CHECKS]
    if with_pickup_oxygen:
        names.append("oxygen_pickup")
    errors = sum((F.coalesce(n, F.lit(0)) for n in names), F.lit(0))
    return (df.withColumn("missing_order_stat", F.col("has_stats").isNull())
            .withColumn("totally_accurate", F.when(F.col("has_stats").isNull(), F.lit(None).cast("int"))
                        .when(errors == 0, 0).otherwise(1)))


def driver_accuracy(orders: DataFrame, details: DataFrame, patients: DataFrame, locations: DataFrame,
                    kit_list: DataFrame, order_stats: DataFrame, users: DataFrame, drivers: DataFrame, start, end, *,
                    company: int = OWN_COMPANY, upper: str = "midnight", with_pickup_oxygen: bool = False) -> DataFrame:
    """Per order of a driver: missing serial and oxygen numbers, the seven checks and the overall verdict.

    ``drivers`` has user_id and role.
    """
    site = (locations.filter(F.col("company_id") == company)
            .select(F.col("location_id").alias("site_id"), F.col("name").alias("site_name")))
    staff = drivers.filter(F.col("role") == DRIVER_ROLE).select(F.col("user_id").alias("driver_id")).distinct()
    base = (orders.filter(in_window("completed", start, end, upper)).join(staff, "driver_id", "left_semi")
            .join(patients.select("patient_id", "client_id", "site_id"), "patient_id").join(site, "site_id")
            .select("order_id", F.to_date("completed").alias("completed_on"), "driver_id", "client_id", "site_id", "site_name"))

    # A line counts for the order that delivered it and for the one that picked it up: both sides come from one pass.
    sides = F.explode(F.array(F.struct(F.col("order_id").alias("_order"), F.lit("delivery").alias("_side")),
                              F.struct(F.col("reference_order_id").alias("_order"), F.lit("pickup").alias("_side"))))
    lines = (details.select(sides.alias("_s"), "status", "serial_number", "o2_lot", "product_id")
             .select(F.col("_s._order").alias("order_id"), F.col("_s._side").alias("side"), "status", "serial_number", "o2_lot", "product_id")
             .filter(F.col("order_id").isNotNull()).join(base, "order_id").join(kit_list, ["product_id", "client_id", "site_id"]))
    keys = ["order_id", "completed_on", "site_id", "site_name", "driver_id"]
    errors = kit_errors(lines).groupBy(*keys).agg(*[F.sum(F.when(F.col("side") == p, F.col(f"{n}_missing")).otherwise(0)).alias(f"{n}_{p}")
                                                    for p in ("delivery", "pickup") for n in ("serial", "oxygen")])
    stats = order_stats.withColumn("has_stats", F.lit(True))
    names = users.select(F.col("user_id").alias("driver_id"), F.concat("first", F.lit(" "), "last").alias("driver_name"))
    out = errors.join(stats, "order_id", "left").join(names, "driver_id")
    return accuracy_flags(out, with_pickup_oxygen).drop("has_stats")


def inventory_past_due(daily: DataFrame, sites: DataFrame, start, end, upper: str = "midnight") -> DataFrame:
    """Per site the past-due, tracked and all items; past due as a share of tracked, tracked as a share of all."""
    counted = daily.filter(in_window("at", start, end, upper)).groupBy("site_id").agg(
        count_if(F.col("count_due") < 0).alias("past_due"),
        count_if(F.coalesce("inventory_ref", F.lit(0)) > 0).alias("tracked"),
        F.count("*").alias("items"))
    names = sites.filter(F.trim("type") == "S").select(F.col("location_id").alias("site_id"), F.col("name").alias("site_name"))
    return counted.join(names, "site_id", "left").select(
        "site_id", "site_name", "past_due", "tracked", "items",
        pct_of("past_due", "tracked", "decimal(9,2)").alias("pct_past_due"),
        pct_of("tracked", "items", "decimal(5,2)").alias("pct_tracked"))
