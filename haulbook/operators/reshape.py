"""Pivots, padding, densifying, roll-ups and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from haulbook.functions.dates import month_index
from haulbook.functions.numbers import money_share

# Contract types, the combined types made of them, and their labels.
CONTRACT_TYPES = ["B&M", "NET", "SWC"]
COMBINED_TYPES = {
    "BN-": ["B&M", "NET"],
    "B-S": ["B&M", "SWC"],
    "-NS": ["NET", "SWC"],
    "BNS": ["B&M", "NET", "SWC"],
}
TYPE_LABELS = {
    "B&M": "B&M",
    "NET": "NET",
    "SWC": "SWC",
    "BN-": "B&M + NET",
    "B-S": "B&M + SWC",
    "-NS": "NET + SWC",
    "BNS": "B&M + NET + SWC",
}


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def combine_types(df: DataFrame, type_col: str = "contract_type", scope: list[str] = (),
                  combos: dict[str, list[str]] = COMBINED_TYPES) -> DataFrame:
    """Add copies of the rows under each combined type whose member types are all present in the scope.

    The types present are one bit each, or-ed over the rows of a scope: one number a scope says which combinations are
    complete. The frame is read twice, for that number and for the rows, so give it sums where the copies will be summed.
    """
    members = list(dict.fromkeys(m for ms in combos.values() for m in ms))
    bit = F.create_map(*[x for i, m in enumerate(members) for x in (F.lit(m), F.lit(1 << i))])
    present = df.groupBy(*scope).agg(F.bit_or(F.element_at(bit, F.col(type_col))).alias("_present"))
    copies = F.explode(F.array(*[F.struct(F.lit(c).alias("_combo"), F.lit(m).alias("_member"), F.lit(sum(1 << members.index(x) for x in ms)).alias("_need"))
                                 for c, ms in combos.items() for m in ms]))
    complete = (present.select(*scope, "_present", copies.alias("_c")).select(*scope, "_present", "_c.*")
                .filter(F.col("_present").bitwiseAND(F.col("_need")) == F.col("_need")).select(*scope, "_combo", F.col("_member").alias(type_col)))
    return df.unionByName(df.join(complete, [*scope, type_col]).withColumn(type_col, F.col("_combo")).select(*df.columns))


def type_label(c: str) -> Column:
    pairs = [x for k, v in TYPE_LABELS.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.trim(c)), F.lit("Unknown Type"))


def pad_to_n(df: DataFrame, keys: list[str], n: int, label: str, fill: dict[str, Column]) -> DataFrame:
    """Groups with fewer than n rows get ``Space Holder k`` rows."""
    short = df.groupBy(*keys).agg((F.lit(n) - F.count("*")).alias("_gap")).filter(F.col("_gap") > 0)
    pads = (short.withColumn("_k", F.explode(F.expr("sequence(1, cast(_gap as int))")))
            .withColumn(label, F.concat(F.lit("Space Holder "), F.col("_k").cast("string"))))
    for name, value in fill.items():
        pads = pads.withColumn(name, value)
    pads = pads.select(*[F.col(c) if c in pads.columns else F.lit(None).cast(df.schema[c].dataType).alias(c)
                         for c in df.columns])
    return df.unionByName(pads)


def months_to_columns(df: DataFrame, keys: list[str], month: str, start, n: int,
                      total: str = "total", group_total: str = "group_total") -> DataFrame:
    """Months side by side: mK_label, mK_total, mK_group, mK_share for the n months from ``start``."""
    first = f"date'{start}'"
    k = f"{month_index(month)} - {month_index(first)}"
    aggs, shares = [], []
    for i in range(n):
        m = f"m{i + 1}"
        aggs.append(F.expr(f"date_format(add_months({first}, {i}), 'yyyy-MM') as {m}_label"))
        for src, name in ((total, "total"), (group_total, "group")):
            aggs.append(F.expr(f"cast(coalesce(sum(case when {k} = {i} then {src} end), 0) as decimal(38,4)) as {m}_{name}"))
        shares.append(money_share(f"{m}_total", f"{m}_group").alias(f"{m}_share"))
    return df.groupBy(*keys).agg(*aggs).select("*", *shares)


def total_across_months(df: DataFrame, n: int, name: str = "months_total") -> DataFrame:
    return df.withColumn(name, F.expr(" + ".join(f"m{i + 1}_total" for i in range(n))))


def densify(rows: DataFrame, left: DataFrame, right: DataFrame, on: list[str], keys: list[str],
            values: list[str]) -> DataFrame:
    """Every row of ``left`` with every partner of ``right`` on the shared type, missing values 0."""
    grid = left.join(right, on)
    out = grid.join(rows.select(*keys, *values), keys, "left")
    for v in values:
        out = out.withColumn(v, F.coalesce(F.col(v), F.lit(0).cast(rows.schema[v].dataType)))
    return out


def _constant(df: DataFrame, c: str, word: str) -> Column:
    """What an upper row shows in a column of the leaf: a word in a text column, NULL in any other."""
    kind = df.schema[c].dataType
    return F.lit(word if kind.simpleString() == "string" else None).cast(kind)


def _summed_rows(dealt: DataFrame, group: list[str], counts: list[str], shares: dict[str, Column], region: str | None = None,
                 parent: Column | None = None) -> DataFrame:
    """Rows that carry ``_own`` (their counts and shares) as they are, however often they occur; the others summed by group, on one
    exchange. ``region`` is taken from ``_own`` too, or worked out by the aggregate ``parent``."""
    extra = [] if region is None else [parent.alias("_region")]
    sums = dealt.groupBy(*group, "_own").agg(*[F.expr(f"sum(coalesce({c}, 0)) as _s{c}") for c in counts], F.count("*").alias("_n"), *extra)
    kept = F.col("_own").isNotNull()
    place = [] if region is None else [F.when(kept, F.col(f"_own.{region}")).otherwise(F.col("_region")).alias(region)]
    out = (sums.withColumn("_copy", F.explode(F.expr("sequence(1, if(_own is null, 1, cast(_n as int)))")))
           .select(*group, "_own", *place, *[F.when(kept, F.col(f"_own.{c}")).otherwise(F.col(f"_s{c}")).alias(c) for c in counts]))
    return out.select(*group, *([region] if region else []), *counts, *[F.when(kept, F.col(f"_own.{n}")).otherwise(s).alias(n) for n, s in shares.items()])


def hierarchy_rollup(leaf: DataFrame, counts: list[str], keys: list[str], region: list[str],
                     shares: dict[str, Column]) -> DataFrame:
    """Leaf rows (level 40), one row per region (20) and one for the whole (10).

    Counts add up. Shares are recomputed at levels 20 and 10; the leaf keeps the
    shares it came with. ``keys`` (client, month, …) stay apart at every level. Each row of the leaf is dealt to its
    three levels at once, and one aggregate sums them all.
    """
    names = [c for c in leaf.columns if c not in (*counts, *keys, *region, *shares)]
    blank = {r: F.lit(0 if i == 0 else "All").cast(leaf.schema[r].dataType) for i, r in enumerate(region)}
    own = F.struct(*counts, *shares)

    def level(n: int, word: str | None) -> Column:
        return F.struct(F.lit(n).alias("level"), *[(blank[r] if n == 10 else F.col(r)).alias(r) for r in region],
                        *[(F.col(c) if word is None else _constant(leaf, c, word)).alias(c) for c in names],
                        (own if word is None else F.when(F.lit(False), own)).alias("_own"))

    dealt = leaf.select(*keys, *counts, F.explode(F.array(level(40, None), level(20, "Many"), level(10, "All"))).alias("_l"))
    return _summed_rows(dealt.select(*keys, *counts, "_l.*"), ["level", *keys, *region, *names], counts, shares)


def subregion_rollup(rolled: DataFrame, counts: list[str], keys: list[str], shares: dict[str, Column],
                     prefixes: list[str], region_id: str = "region_id", region_name: str = "region_name",
                     length: int = 9) -> DataFrame:
    """Regions that start with one of the prefixes become level 30 under a new level-20 parent.

    A row of such a region is dealt to itself and to its parent, every other row to itself; one aggregate sums the parents.
    """
    head = F.substring(region_name, 1, length)
    sub = F.coalesce((F.col("level") == 20) & head.isin(prefixes), F.lit(False))
    fill = [c for c in rolled.columns if c not in ("level", *keys, region_id, region_name, *counts, *shares)]
    own = F.struct(*counts, *shares, region_id)

    def row(parent: bool) -> Column:
        number = F.lit(20) if parent else F.when(sub, 30).otherwise(F.col("level"))
        return F.struct(number.cast("int").alias("level"), (head if parent else F.col(region_name)).alias(region_name),
                        *[(_constant(rolled, c, "Many") if parent else F.col(c)).alias(c) for c in fill],
                        (F.when(F.lit(False), own) if parent else own).alias("_own"))

    group = ["level", *keys, region_name, *fill]
    dealt = rolled.select(*keys, *counts, F.col(region_id).alias("_region"), F.explode(F.when(sub, F.array(row(False), row(True))).otherwise(F.array(row(False)))).alias("_r"))
    dealt = dealt.select(*keys, *counts, "_region", "_r.*")
    # A parent's number comes from the lowest number under it.
    number = F.expr("min(_region) * -100000").cast(rolled.schema[region_id].dataType)
    return _summed_rows(dealt, group, counts, shares, region_id, number).select(rolled.columns)


# Survey questions in report order; yes/no questions first.
YES_NO_QUESTIONS = {"Q1": "Equipment", "Q2": "Instruction"}
GRADED_QUESTIONS = {"Q4": "Delivery Person", "Q5": "Phone Service", "Q6": "Timely Delivery", "Q7": "Timely Pickup"}


def questions_to_rows(df: DataFrame, keep: list[str], null_when_empty: bool = False) -> DataFrame:
    """Six rows per input row: question, meet, fail, exceed.

    Yes/no questions have no exceed share and fail = 1 - meet, also with no answers
    at all unless ``null_when_empty``.
    """
    rows = []
    for q, label in YES_NO_QUESTIONS.items():
        share = f"if(x{q} > 0, p{q}, null)" if null_when_empty else f"p{q}"
        rows.append((label, share, f"1 - {share}", "null"))
    for q, label in GRADED_QUESTIONS.items():
        rows.append((label, f"p{q}m", f"p{q}f", f"p{q}x"))
    num = lambda text: f"cast({text} as decimal(9,6))"
    structs = ", ".join(f"struct('{label}' as question, {num(m)} as meet, {num(f)} as fail, {num(x)} as exceed)"
                        for label, m, f, x in rows)
    return df.select(*keep, F.expr(f"explode(array({structs})) as _q")).select(*keep, "_q.*")
