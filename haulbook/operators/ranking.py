"""Row numbers, predecessors, top lists and shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from haulbook.functions.numbers import money_share

from .scan import ID_BLOCK, scan_before, time_levels


def sequence_rows(df: DataFrame, keys: list[str], order: list, name: str = "seqno") -> DataFrame:
    """Row number within the keys; end ``order`` with a unique column."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def previous_order(df: DataFrame, keys: list[str], ts: str, id_col: str, payload: list[str],
                   out: str = "prev", block: int = ID_BLOCK) -> DataFrame:
    """The order before each one in (time, id) order, as a struct of ``payload``."""
    return previous_valid_order(df, keys, ts, id_col, F.lit(True), payload, out, block).drop("skipped")


def previous_valid_order(df: DataFrame, keys: list[str], ts: str, id_col: str, valid: Column,
                         payload: list[str], out: str = "prev", block: int = ID_BLOCK) -> DataFrame:
    """The last valid order before each one, and how many invalid ones lie between (``skipped``), in one scan.

    Rows with a null key are one group. ``block`` is the number of ids a task takes of one stamp; results do not depend on it.
    """
    found = scan_before(df, keys, [ts, id_col], time_levels(ts, id_col, block), F.when(valid, F.struct(*payload)), F.when(valid, 0).otherwise(1))
    return (found.withColumn("skipped", F.col("before") - F.coalesce("found_before", F.lit(0)))
            .withColumnRenamed("found", out).drop("before", "found_before"))


def top_n_per_group(df: DataFrame, keys: list[str], n: int, by: str, tie: list[str], name: str = "rank") -> DataFrame:
    """The n rows with the largest value per group; ties by ``tie``, which must be unique."""
    w = Window.partitionBy(*keys).orderBy(F.col(by).desc(), *tie)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def share_of_group(df: DataFrame, keys: list[str], value: str, digits: int = 3) -> DataFrame:
    """Each row's part of its group's total. Totals are aggregated first and joined back."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias("group_total"))
    return df.join(totals, keys).withColumn("share", money_share(value, "group_total", digits))


def sort_report(df: DataFrame, *order) -> DataFrame:
    """Rows in report order; end ``order`` with a unique column."""
    return df.orderBy(*order)


def limit_n(df: DataFrame, n: int, *order) -> DataFrame:
    """Overall top n."""
    return df.orderBy(*order).limit(n)


def dynamic_sort(df: DataFrame, key: str | None, columns: dict[str, Column], default: str) -> DataFrame:
    """Sort by a caller-named key; ids sort as numbers padded to 25 digits, ties by the default key."""
    wanted = columns.get(key, columns[default]) if key else columns[default]
    return df.orderBy(wanted, columns[default])


def padded_id(c: str) -> Column:
    return F.lpad(F.col(c).cast("string"), 25, "0")
