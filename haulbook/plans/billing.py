"""Contract pairs, billed items and top items."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from haulbook.functions.dates import yyyymm_to_date
from haulbook.functions.numbers import MONEY
from haulbook.functions.text import label_with_id
from haulbook.functions.windows import OPEN_END
from haulbook.operators.aggregates import net_nonzero_totals
from haulbook.operators.intervals import range_join
from haulbook.operators.ranking import share_of_group, top_n_per_group
from haulbook.operators.reshape import (
    combine_types, densify, months_to_columns, pad_to_n, total_across_months, type_label,
)
from haulbook.sources.sinks import staged

OWN_COMPANY = 2
NATIONAL = "National: All Regions"


def budget_months(budgets: DataFrame, months: DataFrame) -> DataFrame:
    """Budgets repeated for each wanted month they cover.

    ``months`` is the list of wanted months (yyyymm), with or without gaps. A range and a month meet in the one block
    of months they share (``range_join``): the list is not read beforehand, and an open end costs no more than a closed one.
    """
    number = lambda m: F.expr(f"({m}) div 100 * 12 + ({m}) % 100 - 1")
    ranges = (budgets.filter(F.col("begin_yyyymm").isNotNull()).withColumn("_from", number("begin_yyyymm"))
              .withColumn("_to", number(f"coalesce(end_yyyymm, {OPEN_END})")))
    wanted = months.select("yyyymm").distinct().filter(F.col("yyyymm").isNotNull()).withColumn("_at", number("yyyymm"))
    return (range_join(ranges, "_from", "_to", wanted, "_at").drop("_from", "_to", "_at")
            .withColumn("sub_unit", F.coalesce("sub_unit", F.lit(0))))


def contract_pairs(activity: DataFrame, budgets: DataFrame, contracts: DataFrame, locations: DataFrame,
                   months: DataFrame, *, own_company: int = OWN_COMPANY) -> DataFrame:
    """Active and budgeted client-site pairs per month with budget, contract, owner and contract type.

    ``activity`` has yyyymm, client_id, sub_unit, site_id. A pair without a budget of its
    own sub-unit takes the main one and is marked -1. Type is B&M for own sites, else NET
    or SWC by the contract's owner.
    """
    key = ["yyyymm", "client_id", "sub_unit", "site_id"]
    active = (activity.withColumn("sub_unit", F.coalesce("sub_unit", F.lit(0))).filter(F.col("site_id") > 0)
              .join(months.select("yyyymm").distinct(), "yyyymm", "left_semi").select(*key).distinct())
    planned = budget_months(budgets, months)
    one = planned.groupBy(*key).agg(F.min(F.struct("budget_id", "contract_id", "network_type")).alias("_b"))
    idle = one.select(*key).join(active, key, "left_anti")
    pairs = active.withColumn("activity", F.lit(1)).unionByName(idle.withColumn("activity", F.lit(0)))
    main = (one.filter(F.col("sub_unit") == 0)
            .select("yyyymm", "client_id", "site_id", F.col("_b").alias("_main")))
    out = pairs.join(one, key, "left").join(main, ["yyyymm", "client_id", "site_id"], "left")
    borrowed = F.col("_b").isNull() & F.col("_main").isNotNull()
    out = (out.withColumn("activity", F.when(borrowed, -1).otherwise(F.col("activity")))
           .withColumn("_b", F.coalesce("_b", "_main"))
           .select(*key, "activity", "_b.budget_id", "_b.contract_id", "_b.network_type"))
    own = (locations.filter(F.col("company_id") == own_company)
           .select(F.col("location_id").alias("site_id"), F.lit(True).alias("_own")).distinct())
    out = (out.join(contracts.select("contract_id", F.col("owner_company").alias("_owner")), "contract_id", "left")
           .join(own, "site_id", "left").withColumn("owner", F.coalesce("_owner", F.lit(own_company))))
    kind = F.when(F.col("_own"), "B&M").when(F.col("owner") == own_company, "NET").otherwise("SWC")
    return out.withColumn("contract_type", kind).select(
        *key, "activity", "budget_id", "contract_id", "network_type", "owner", "contract_type")


def typed_items(billed: DataFrame, equipment: DataFrame, pairs: DataFrame) -> DataFrame:
    """Monthly net totals per client, site and item, with contract type and region of the pair.

    ``billed`` has yyyymm, client_id, site_id, equipment_id, total; ``pairs`` has
    yyyymm, client_id, site_id, contract_type, region_id, region_name, one row each.
    """
    key = ["yyyymm", "client_id", "site_id"]
    net = net_nonzero_totals(billed.join(equipment.select("equipment_id", "item_id"), "equipment_id")
                             .withColumn("total", F.col("total").cast(MONEY)), [*key, "item_id"], "total")
    net = net.withColumn("total", F.col("total").cast(MONEY))
    return net.join(pairs.select(*key, "contract_type", "region_id", "region_name"), key, "left")


def billable_items(billed: DataFrame, equipment: DataFrame, pairs: DataFrame) -> DataFrame:
    """The typed items and their copies under the combined contract types."""
    return combine_types(staged(typed_items(billed, equipment, pairs)))


CELL = ["contract_type", "region_id", "region_name", "yyyymm", "item_id"]


def monthly_cells(typed: DataFrame) -> DataFrame:
    """Totals per type, region, month and item, combined types included: all that the top lists need, computed once.

    Items are summed to cells first and the few cells are combined, so no item row is copied. A type counts as present
    through any of its items, those of no region included.
    """
    cells = staged(typed.filter(F.col("contract_type").isNotNull()).groupBy(*CELL).agg(F.sum("total").cast("decimal(28,4)").alias("total")))
    known = combine_types(cells).filter(F.col("region_id").isNotNull())
    return staged(known.groupBy(*CELL).agg(F.sum("total").cast("decimal(28,4)").alias("total")))


def top_lists(cells: DataFrame, n: int = 5, keys: list[str] = ("contract_type",)) -> DataFrame:
    """Top items per contract type (or per region and type) with their share of the group's total."""
    totals = cells.groupBy(*keys, "item_id").agg(F.sum("total").alias("total"))
    return top_n_per_group(share_of_group(totals, list(keys), "total"), list(keys), n, "total", ["item_id"])


def monthly_shares(cells: DataFrame, chosen: DataFrame, on: list[str]) -> DataFrame:
    """Cells of the chosen items with the month's total over all items of the region and type."""
    group = cells.groupBy(*CELL[:-1]).agg(F.sum("total").alias("group_total"))
    return cells.join(chosen.select(*on), on, "left_semi").join(group, CELL[:-1])


def _wide(shares: DataFrame, keys: list[str], start, n_months: int) -> DataFrame:
    wide = months_to_columns(shares.withColumn("_month", yyyymm_to_date("yyyymm")), keys, "_month", start, n_months)
    return total_across_months(wide, n_months)


def top_items(typed: DataFrame, names: DataFrame, start, *, n: int = 5, n_months: int = 3,
              scope: str = "national") -> DataFrame:
    """Top items with their monthly shares side by side, from the typed items.

    ``national``: the top list of each type; months are the sums of the regions that
    billed the item. ``by_region``: the national list in every region, 0 where a region
    billed none. ``regional``: each region's own list, padded to n rows.
    """
    cells = monthly_cells(typed)
    label = names.select("item_id", F.trim("name").alias("item_name"))
    months = [f"m{i + 1}_{x}" for i in range(n_months) for x in ("total", "share")]
    region_keys = CELL[:3]
    contract = type_label("contract_type").alias("contract")
    if scope == "regional":
        chosen = top_lists(cells, n, region_keys)
        on = [*region_keys, "item_id"]
        wide = _wide(monthly_shares(cells, chosen, on), on, start, n_months)
        named = wide.join(label, "item_id").select(*on, "item_name", "months_total", *months)
        zero = {c: F.lit(0).cast(named.schema[c].dataType) for c in ("item_id", "months_total", *months)}
        return pad_to_n(named, region_keys, n, "item_name", zero).select("*", contract)
    national = top_lists(cells, n)
    regional = monthly_shares(cells, national, ["contract_type", "item_id"])
    if scope == "by_region":
        wide = _wide(regional, [*region_keys, "item_id"], start, n_months)
        shown = [c for c in months if c.endswith("share")]
        out = densify(wide, national.join(label, "item_id").select("contract_type", "item_id", "item_name"),
                      cells.select(*region_keys).distinct(), ["contract_type"], [*region_keys, "item_id"], shown)
        return out.select("*", contract)
    if scope != "national":
        raise ValueError("scope is 'national', 'by_region' or 'regional'")
    wide = _wide(regional, ["contract_type", "item_id"], start, n_months)
    return (wide.join(label, "item_id").withColumn("region_name", F.lit(NATIONAL))
            .select("contract_type", contract, "region_name", "item_id", "item_name",
                    label_with_id("item_name", "item_id").alias("item"), "months_total", *months))
