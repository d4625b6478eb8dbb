"""Base tables, constant tables and fixed lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from haulbook.functions.numbers import yes_no

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def load_tables(spark: SparkSession, path: str, names: list[str] = TABLES) -> dict[str, DataFrame]:
    """Parquet tables by name, with the columns that their files have now."""
    return {n: spark.read.parquet(f"{path}/{n}.parquet") for n in names}


CONFIG_ROWS = 10_000     # constant tables up to so many rows are marked for broadcast


def config_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A constant lookup, marked for broadcast while it is small; a longer list is left to Spark's own size check."""
    table = spark.createDataFrame(rows, schema)
    return F.broadcast(table) if len(rows) <= CONFIG_ROWS else table


# States by the negative id of their region.
STATES = {
    -1: "DE", -2: "NJ", -3: "PA", -4: "GA", -5: "CT", -6: "MA", -7: "MD", -8: "SC", -9: "NH", -10: "VA", -11: "NY",
    -12: "NC", -13: "RI", -14: "VT", -15: "KY", -16: "TN", -17: "OH", -18: "LA", -19: "IN", -20: "MS", -21: "IL",
    -22: "AL", -23: "ME", -24: "MO", -25: "AR", -26: "MI", -27: "FL", -28: "TX", -29: "IA", -30: "WI", -31: "CA",
    -32: "MN", -33: "OR", -34: "KS", -35: "WV", -36: "NV", -37: "NE", -38: "CO", -39: "ND", -40: "SD", -41: "MT",
    -42: "WA", -43: "ID", -44: "WY", -45: "UT", -46: "OK", -47: "NM", -48: "AZ", -49: "AK", -50: "HI", -51: "DC",
}

# Sub-items and the main items they go out with.
BEDS = [9, 25, 795, 838]
CONCENTRATORS = [50]
WHEELCHAIRS = [320, 321, 322, 323, 324, 325, 326, 327, 328, 329, 330, 331, 332, 333, 334, 335, 336, 337, 338, 339,
               340, 695, 696, 697, 698, 699, 700, 746, 775, 783, 790, 791, 792, 793, 847, 848, 893, 894, 895, 896]
ITEM_PAIRS = {
    47: BEDS,
    49: BEDS,
    150: [27, 28, 29, 30, 55],
    175: [187],
    183: [187, 189],
    184: [187, 189],
    195: BEDS,
    235: [128, 342],
    236: [128, 342],
    237: [128, 342],
    238: [128, 342],
    239: [128, 342],
    240: [128, 342],
    241: CONCENTRATORS,
    250: CONCENTRATORS,
    251: CONCENTRATORS,
    312: WHEELCHAIRS,
    313: WHEELCHAIRS,
    825: BEDS,
}


def state_regions(spark: SparkSession) -> DataFrame:
    return config_table(spark, list(STATES.items()), "region_id int, state string")


def item_pairs(spark: SparkSession, pairs: dict[int, list[int]] = ITEM_PAIRS) -> DataFrame:
    return config_table(spark, [(m, s) for s, mains in pairs.items() for m in mains], "main_item int, sub_item int")


def describe_pairs(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """``[ sub ] paired with [ main ]``; NULL when either item is unknown."""
    def named(key: str, out: str) -> DataFrame:
        return items.select(F.col("item_id").alias(key), F.trim("name").alias(out))

    return (pairs.join(named("main_item", "_main"), "main_item", "left")
            .join(named("sub_item", "_sub"), "sub_item", "left")
            .withColumn("description", F.concat(F.lit("[ "), "_sub", F.lit(" ] paired with [ "), "_main", F.lit(" ]")))
            .drop("_main", "_sub"))


def freshness_check(orders: DataFrame, end, stamp: str = "stamp") -> DataFrame:
    """Newest order stamp against the window's end, a column, date or ISO text."""
    end = F.lit(end).cast("timestamp_ntz")
    note: Column = yes_no(end > F.col("newest"), "WARNING UPDATE DATABASE", "DB OKAY")
    return orders.agg(F.max(stamp).alias("newest")).select("newest", note.alias("info"))
