"""Joins of ranges with points, and counts of what came before, by blocks of power-of-two length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

LEVELS = 18    # block lengths up to 2^17: month numbers up to the year 9999 fit


def point_blocks(point: str) -> Column:
    """The block of each length that holds the point, as (bits, number). Points are 0 or more."""
    return F.expr(f"transform(sequence(0, {LEVELS - 1}), _k -> struct(_k as bits, shiftright({point}, _k) as number))")


def range_blocks(low: str, high: str) -> Column:
    """The fewest blocks that together are low … high, both included: at most two of a length; none for an empty range."""
    left, right = f"shiftright({low} + shiftleft(1, _k) - 1, _k)", f"shiftright({high} + 1, _k)"
    one = lambda cond, number: f"if({left} < {right} and {cond}, struct(_k as bits, {number} as number), null)"
    return F.expr(f"filter(flatten(transform(sequence(0, {LEVELS - 1}), _k -> array({one(f'{left} % 2 = 1', left)}, "
                  f"{one(f'{right} % 2 = 1', f'{right} - 1')}))), _s -> _s is not null)")


def range_join(ranges: DataFrame, low: str, high: str, points: DataFrame, point: str) -> DataFrame:
    """Each range with each point it holds: an equi-join on the blocks both have in common, exactly one for a match.

    A range meets a point in one block only, since its blocks do not overlap. Nothing about the points is read beforehand:
    a range is cut into at most 2 * ``LEVELS`` blocks however long it is, a point lies in ``LEVELS``.
    """
    left = ranges.withColumn("_b", F.explode(range_blocks(low, high)))
    right = points.withColumn("_b", F.explode(point_blocks(point)))
    return left.join(right, "_b").drop("_b")


def prefix_ranks(points: DataFrame, asked: DataFrame, keys: list[str], at: str) -> tuple[DataFrame, DataFrame]:
    """Where points and questions stand among the distinct questions of their key, for counts of points at or before each.

    Both frames come back reduced to their distinct (keys, at) with ``nodes``. A point lies in the nodes of a binary
    indexed tree over its key's questions, a question reads the nodes that make up its prefix; each has at most log2(questions) + 1,
    one with a single question. Points after the last question have none.
    """
    both = points.select(*keys, at).distinct().withColumn("_q", F.lit(0)).unionByName(asked.select(*keys, at).distinct().withColumn("_q", F.lit(1)))
    w = Window.partitionBy(*keys)
    upto = F.sum("_q").over(w.orderBy(at, "_q").rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int")
    placed = both.withColumn("_upto", upto).withColumn("_all", F.sum("_q").over(w).cast("int"))
    rank = "_upto"       # of a point: the questions before it, so its own first question is the next one
    inside = F.expr(f"filter(transform(sequence(0, length(bin(_all))), _k -> if(shiftright({rank}, _k) % 2 = 0, "
                    f"shiftleft(shiftright({rank}, _k) + 1, _k), 0)), _n -> _n between 1 and _all)")
    read = F.expr(f"filter(transform(sequence(0, length(bin({rank}))), _k -> if(shiftright({rank}, _k) % 2 = 1, "
                  f"shiftleft(shiftright({rank}, _k), _k), 0)), _n -> _n > 0)")
    part = lambda q, nodes: placed.filter(F.col("_q") == q).select(*keys, at, nodes.alias("nodes"))
    return part(0, inside), part(1, read)


def running_at(events: DataFrame, asked: DataFrame, keys: list[str], at: str, weights: list[str]) -> DataFrame:
    """Sums of the events' weights at or before each asked place, per key: keys, at and one column per weight.

    An event whose place is null was always there. Events and questions are reduced to one row per key and place
    before they are sorted, so a key never has more rows than places, and one sweep answers all its questions.
    """
    e = events.select(*keys, at, *weights, F.lit(False).alias("_asked"))
    q = asked.select(*keys, at, *[F.lit(0).cast(events.schema[w].dataType).alias(w) for w in weights], F.lit(True).alias("_asked"))
    rows = e.unionByName(q).groupBy(*keys, at).agg(*[F.sum(w).alias(w) for w in weights], F.max("_asked").alias("_asked"))
    w = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select(*keys, at, "_asked", *[F.sum(c).over(w).alias(c) for c in weights]).filter("_asked").drop("_asked")
