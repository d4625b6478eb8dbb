"""An exclusive scan per key, in blocks: totals of blocks are scanned and carried back, so no task holds a whole key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

ID_BLOCK = 65_536      # ids in one block


def time_levels(ts: str, id_col: str, block: int = ID_BLOCK) -> list[dict[str, Column]]:
    """Blocks that follow (ts, id), coarse to fine: the hour; then the stamp and an id block."""
    return [{"_hour": F.date_trunc("hour", ts)}, {"_at": F.col(ts), "_idb": F.expr(f"{id_col} div {block}")}]


def _carry_back(rows: DataFrame, carried: DataFrame, part: list[str]) -> DataFrame:
    """``carried`` joined to the rows of its block; a null key or stamp is a block of its own."""
    named = carried.select(*[F.col(c).alias(f"_c{c}") for c in part], "_cw", "_cl")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_c{c}")) for c in part])
    return rows.join(named, same, "left").drop(*[f"_c{c}" for c in part])


def _prefix(df: DataFrame, keys: list[str], levels: list[list[str]], order: list[str]) -> DataFrame:
    """Add ``_before``, the weights of all earlier rows of the key, and ``_last``, the last earlier value with the weights
    before it. A row has weight ``_w`` and perhaps a value ``_v``, which lies ``_t`` behind the row's own start."""
    part = [*keys, *[c for level in levels for c in level]]
    earlier = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumn("_before", F.coalesce(F.sum("_w").over(earlier), F.lit(0)))
    out = out.withColumn("_mark", F.when(F.col("_v").isNotNull(), F.struct(F.col("_v").alias("v"), (F.col("_before") + F.col("_t")).alias("t"))))
    out = out.withColumn("_last", F.last("_mark", ignorenulls=True).over(earlier))
    if not levels:
        return out
    blocks = (out.groupBy(*part).agg(F.sum("_w").alias("_w"), F.max_by("_mark", F.when(F.col("_mark").isNotNull(), F.struct(*order))).alias("_m"))
              .select(*part, "_w", F.col("_m.v").alias("_v"), F.coalesce("_m.t", F.lit(0)).alias("_t")))
    carried = _prefix(blocks, keys, levels[:-1], levels[-1]).select(*part, F.col("_before").alias("_cw"), F.col("_last").alias("_cl"))
    base = F.coalesce("_cw", F.lit(0))
    own = F.when(F.col("_last").isNotNull(), F.struct(F.col("_last.v").alias("v"), (F.col("_last.t") + base).alias("t")))
    return (_carry_back(out, carried, part).withColumn("_last", F.coalesce(own, F.col("_cl"))).withColumn("_before", F.col("_before") + base)
            .drop("_cw", "_cl"))


def scan_before(df: DataFrame, keys: list[str], order: list[str], levels: list[dict[str, Column]], value: Column,
                weight: Column | None = None) -> DataFrame:
    """For each row the last value before it in its key that is not null (``found``), ``before``, the sum of the weights of
    the rows before it, and ``found_before``, that sum at the row the value came from.

    ``levels`` name columns, coarse to fine, that never fall along ``order``. Rows are windowed per finest block; one
    summary a block, its weight and last value, is scanned in the next coarser block, and so on; the carries are joined
    back. All keys take this path, large or small, and nothing runs while the frame is built. The wide rows are
    shuffled once by block; everything above them has one row a block. ``order`` ends with a unique column.
    """
    base = df.withColumn("_w", F.lit(0).cast("long") if weight is None else weight.cast("long")).withColumn("_v", value).withColumn("_t", F.lit(0).cast("long"))
    for level in levels:
        base = base.withColumns(level)
    names = [list(level) for level in levels]
    out = _prefix(base, keys, names, order)
    return (out.withColumn("before", F.col("_before")).withColumn("found", F.col("_last.v")).withColumn("found_before", F.col("_last.t"))
            .drop("_w", "_v", "_t", "_before", "_mark", "_last", *[n for level in names for n in level]))
