"""Joins to lookup tables.

Spark sizes each side and broadcasts it only below its own threshold; nothing
here forces a broadcast except of fixed constant tables.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F


def lookup_group(lookup: DataFrame, group: str, *names: str) -> DataFrame:
    """One group of the shared lookup table as (code, name[, description]), one row per code."""
    return (lookup.filter(F.col("group") == group)
            .groupBy(F.trim("code").alias("code"))
            .agg(*[F.min(n).alias(n) for n in (names or ("name",))]))


def join_code(df: DataFrame, lookup: DataFrame, group: str, on: str, name: str,
              default: str | None = None, how: str = "left") -> DataFrame:
    """Attach the lookup name of a code; a missing code may stand for ``default``."""
    codes = lookup_group(lookup, group).select(F.col("code").alias("_code"), F.col("name").alias(name))
    key = F.trim(on) if default is None else F.coalesce(F.trim(on), F.lit(default))
    return df.join(codes, key == F.col("_code"), how).drop("_code")


def dedupe_lookup(lookup: DataFrame, key: str, *names: str) -> DataFrame:
    """One row per key, so that a code listed in several groups cannot multiply rows."""
    return lookup.groupBy(key).agg(*[F.min(n).alias(n) for n in names])


def semi_join(df: DataFrame, other: DataFrame, on) -> DataFrame:
    return df.join(other, on, "left_semi")


def anti_join(df: DataFrame, other: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows without a partner; NULL keys on the other side are ignored."""
    keys = [on] if isinstance(on, str) else on
    return df.join(other.select(*keys).dropna(), keys, "left_anti")


def spread_left_join(df: DataFrame, other: DataFrame, keys: list[str], spread_by: str) -> DataFrame:
    """Left join in which the rows without a key, which have no partner, are dealt over the tasks by ``spread_by``."""
    missing = reduce(or_, [F.col(k).isNull() for k in keys])
    salt = F.when(missing, 1 + F.pmod(F.xxhash64(spread_by), F.lit(65_521))).otherwise(F.lit(0))
    return df.withColumn("_spread", salt).join(other.withColumn("_spread", F.lit(0).cast("long")), [*keys, "_spread"], "left").drop("_spread")


def star_join(orders: DataFrame, patients: DataFrame, locations: DataFrame, companies: DataFrame) -> DataFrame:
    """Order to patient, site, client and both companies."""
    site = locations.select(F.col("location_id").alias("site_id"), F.col("name").alias("site_name"),
                            F.col("company_id").alias("site_company"))
    client = locations.select(F.col("location_id").alias("client_id"), F.col("name").alias("client_name"),
                              F.col("company_id").alias("client_company"), F.col("region_id"),
                              F.col("state").alias("client_state"))
    firm = companies.select(F.col("id").alias("client_company"), F.col("abbr").alias("client_company_abbr"))
    return (orders.join(patients, "patient_id").join(site, "site_id")
            .join(client, "client_id").join(firm, "client_company"))


def fallback_lookup(df: DataFrame, user_locations: DataFrame, user: str, first: str, second: str) -> DataFrame:
    """The user's place at company ``first``, else at company ``second``: adds user_company and user_level."""
    one = (user_locations.groupBy("user_id", "company_id")
           .agg(F.min_by("type", F.struct("type", "location_id")).alias("level")))

    def place(n: int, company: str) -> DataFrame:
        return one.select(F.col("user_id").alias(f"_u{n}"), F.col("company_id").alias(f"_c{n}"),
                          F.col("level").alias(f"_l{n}"))

    out = df
    for n, company in ((1, first), (2, second)):
        out = out.join(place(n, company), (F.col(user) == F.col(f"_u{n}")) & (F.col(company) == F.col(f"_c{n}")), "left")
    return (out.withColumn("user_company", F.coalesce("_c1", "_c2"))
            .withColumn("user_level", F.when(F.col("_c1").isNotNull(), F.col("_l1")).otherwise(F.col("_l2")))
            .drop("_u1", "_c1", "_l1", "_u2", "_c2", "_l2"))


def equipment_lines(product_equip: DataFrame, equipment: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Product to equipment to item, one row per product and equipment."""
    out = product_equip.join(equipment, "equipment_id")
    if items is not None:
        out = out.join(items.select("item_id", F.col("name").alias("item_name"), "category"), "item_id")
    return out


def override_flags(lines: DataFrame, client_equip: DataFrame) -> DataFrame:
    """Client-and-site settings of an equipment win over its general ones."""
    own = client_equip.select("client_id", "site_id", "equipment_id", F.col("item_id").alias("_item"),
                              F.col("oxygen").alias("_oxygen"), F.col("disposable").alias("_disposable"))
    return (lines.join(own, ["client_id", "site_id", "equipment_id"], "left")
            .withColumn("item_id", F.coalesce("_item", "item_id"))
            .withColumn("oxygen", F.coalesce("_oxygen", "oxygen"))
            .withColumn("disposable", F.coalesce("_disposable", "disposable"))
            .drop("_item", "_oxygen", "_disposable"))


def region_fill(df: DataFrame, states: DataFrame, region_id: str = "region_id",
                region_name: str = "region_name") -> DataFrame:
    """Rows without a region get the negative id of the state their region name starts with."""
    st = states.select(F.col("region_id").alias("_rid"), F.col("state").alias("_st"))
    return (df.join(st, F.substring(region_name, 1, 2) == F.col("_st"), "left")
            .withColumn(region_id, F.coalesce(region_id, "_rid")).drop("_rid", "_st"))


def flag_matches(df: DataFrame, qualified: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """1 on rows whose key is among the qualified groups, else 0; groups without rows change nothing."""
    marks = qualified.select(*keys).distinct().withColumn("_hit", F.lit(1))
    return df.join(marks, keys, "left").withColumn(flag, F.coalesce("_hit", F.lit(0))).drop("_hit")
