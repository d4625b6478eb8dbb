"""Grouped counts, percentages and lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from haulbook.functions.numbers import count_if, pct_of

from .lookups import spread_left_join
from .scan import ID_BLOCK

# Item categories counted per order.
SERVICE_CATEGORY, SERVICE_NAME = 234, "Service Call"
CATEGORY_GROUPS = {
    "beds": [130, 132, 272],
    "concentrators": [166, 167],
    "lal": [137],
    "wheelchairs": [115, 116, 117, 118, 119],
}


def conditional_counts(df: DataFrame, conds: dict[str, Column], keys: list[str] = ()) -> DataFrame:
    """One count per named condition."""
    return df.groupBy(*keys).agg(*[count_if(c).alias(n) for n, c in conds.items()])


def count_orders_by(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("order_count"))


def flag_counts_per_key(lines: DataFrame, key: str = "order_id", groups: dict[str, list] = CATEGORY_GROUPS,
                        service: Column | None = None) -> DataFrame:
    """Per order the number of lines in each category group and of service-call lines."""
    if service is None:
        service = (F.col("category") == SERVICE_CATEGORY) & (F.lower("item_name") == SERVICE_NAME.lower())
    return conditional_counts(lines, {"service_calls": service,
                                      **{n: F.col("category").isin(v) for n, v in groups.items()}}, [key])


def elapsed_buckets(minutes: str, weight: str = "1", bands: int = 7, total: str = "count(*)",
                    percents: bool = True) -> list[Column]:
    """Aggregates: weighted counts per 24-hour band (the first from 0 inclusive) and their share of ``total``.

    Arguments are column names or SQL text.
    """
    out = []
    for k in range(1, bands + 1):
        lower = f"{minutes} > {(k - 1) * 1440} and " if k > 1 else ""
        n = f"coalesce(sum(case when {lower}{minutes} <= {k * 1440} then {weight} end), 0)"
        out.append(F.expr(n).cast("long").alias(f"n_{k * 24}h"))
        if percents:
            out.append(pct_of(n, total, "decimal(9,4)").alias(f"pct_{k * 24}h"))
    return out


def mean_over_months(df: DataFrame, keys: list[str], month: str, value: str) -> DataFrame:
    """Sum per month, then the mean over the months present."""
    monthly = df.groupBy(*keys, month).agg(F.sum(value).alias("_m"))
    return monthly.groupBy(*keys).agg(
        (F.sum("_m") / F.count("*").cast("decimal(10,1)")).cast("decimal(18,6)").alias("mean"),
        F.count("*").alias("months"))


def net_nonzero_totals(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Net total and record count per key; zero records are dropped first, zero sums afterwards."""
    return (df.filter(F.col(value) != 0).groupBy(*keys)
            .agg(F.sum(value).alias("total"), F.count("*").alias("records"))
            .filter(F.col("total") != 0))


def error_lines_per_order(delivered: DataFrame, picked_up: DataFrame, keys: list[str]) -> DataFrame:
    """Error flags of delivery lines and of pickup lines summed per order."""
    kinds = [(n, df, p) for df, p in ((delivered, "delivery"), (picked_up, "pickup")) for n in ("serial", "oxygen")]
    names = [f"{n}_{p}" for n, _, p in kinds]

    def side(df: DataFrame, p: str) -> DataFrame:
        return df.select(*keys, *[(F.col(f"{n}_missing") if q == p else F.lit(0)).alias(f"{n}_{q}")
                                  for n, _, q in kinds])

    both = side(delivered, "delivery").unionByName(side(picked_up, "pickup"))
    return both.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


def concat_notes(df: DataFrame, key: str, text: str, order: str, sep: str = ", ",
                 block: int = ID_BLOCK, max_chars: int = 500_000_000) -> DataFrame:
    """The notes of a key as text, in the order of an integer id: one row per key and part, whatever the size.

    Notes are joined per id block first, then the blocks. A running length cuts a key into parts 0, 1, … that each start
    at most ``max_chars`` further on, with nothing lost; ordinary keys have part 0 only. The separator also
    stands between parts. Join ``first_part`` where a key must keep its one row.
    """
    blocks = (df.filter(F.col(text).isNotNull())
              .withColumn("_block", F.expr(f"{order} div {block}"))
              .groupBy(key, "_block")
              .agg(F.expr(f"listagg({text}, '{sep}') within group (order by {order})").alias("_text"),
                   F.count("*").alias("_n")))
    size = F.sum(F.length("_text").cast("long")).over(
        Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    return (blocks.withColumn("part", F.floor(F.coalesce(size, F.lit(0)) / max_chars))
            .groupBy(key, "part")
            .agg(F.expr(f"listagg(_text, '{sep}') within group (order by _block)").alias("notes"),
                 F.sum("_n").alias("note_count")))


def first_part(parts: DataFrame, key: str) -> DataFrame:
    """One row per key: its first part and the number of its parts. The others stay in ``parts`` for an export."""
    return parts.groupBy(key).agg(F.min_by("notes", "part").alias("notes"), F.count("*").alias("note_parts"))


def item_list(lines: DataFrame, key: str = "order_id") -> DataFrame:
    """``{2x} Bed[Delivered], …`` by equipment name and status."""
    counted = lines.groupBy(key, "equipment_name", "status_name").agg(F.count("*").alias("_n"))
    return (counted.withColumn("_label", F.concat(F.lit("{"), F.col("_n").cast("string"), F.lit("x} "),
                                                  F.col("equipment_name"), F.lit("["), F.col("status_name"), F.lit("]")))
            .groupBy(key)
            .agg(F.expr("listagg(_label, ', ') within group (order by equipment_name || chr(1) || status_name)")
                 .alias("item_list")))


def keep_first_of_group(df: DataFrame, keys: list[str], id_col: str, flag: str) -> DataFrame:
    """1 on the lowest id of each group (and on rows without a group), 0 on the others. Rows without a group are spread over the tasks."""
    firsts = (df.select(*keys, id_col).dropna(subset=keys).groupBy(*keys).agg(F.min(id_col).alias("_first"), F.count("*").alias("_n"))
              .filter(F.col("_n") > 1).drop("_n"))
    return (spread_left_join(df, firsts, keys, id_col)
            .withColumn(flag, F.when(F.col("_first").isNull() | (F.col("_first") == F.col(id_col)), 1).otherwise(0))
            .drop("_first"))


def latest_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(value).alias(value))


def site_summary(orders: DataFrame, sites: DataFrame, groups: list[str]) -> DataFrame:
    """Service calls per site by item group, idle sites included.

    ``orders`` has site_id, service_call and a 0/1 flag per group. Percentages are
    of service calls; the service-call percentage is of all orders.
    """
    svc = F.col("service_call") == 1
    other = sum((F.col(g) for g in groups), F.lit(0)) == 0
    totals = orders.groupBy("site_id").agg(
        F.count("*").alias("orders"), count_if(svc).alias("service_calls"),
        *[count_if(svc & (F.col(g) == 1)).alias(g) for g in groups], count_if(svc & other).alias("other"))
    joined = sites.select("site_id", "site_name").join(totals, "site_id", "left")
    return _with_percents(joined, groups)


def company_summary(site_rows: DataFrame, groups: list[str]) -> DataFrame:
    """Grand total of the site rows."""
    names = ["orders", "service_calls", *groups, "other"]
    total = site_rows.agg(*[F.sum(n).alias(n) for n in names])
    return _with_percents(total.select(F.lit(0).alias("site_id"), F.lit("All").alias("site_name"), *names), groups)


def _with_percents(df: DataFrame, groups: list[str]) -> DataFrame:
    cols = [pct_of(g, "service_calls", as_text=True).alias(f"pct_{g}") for g in [*groups, "other"]]
    return df.select("*", *cols, pct_of("service_calls", "orders", as_text=True).alias("pct_service_calls"))
