"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from haulbook.llm.common import discard, stored, word_count
from haulbook.operators.scan import ID_BLOCK, scan_before

SEED = "mix-1"
MOST_COPIES = 3
BINS = 4096


def source_targets(sizes: DataFrame, most_copies: int = MOST_COPIES) -> DataFrame:
    """Source, size and target of each source.

    Sources in code point order, null last, weigh 1, 2, 3 and again. All sizes together
    are shared out by weight; a target stops at ``most_copies`` times its source's size
    and the excess goes to the others. With sources ordered by size over weight, those
    at their limit come first, so one pass of running sums finds the level at which the
    rest share. The windows here see one row per source.
    """
    everything = Window.partitionBy()
    by_ratio = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = (sizes.withColumn("_weight", (F.pmod(place - 1, F.lit(3)) + 1).cast("double"))
               .withColumn("_most", (most_copies * F.col("source_size")).cast("double"))
               .withColumn("_ratio", F.col("_most") / F.col("_weight")))
    levels = (weighed.withColumn("_total", F.sum("source_size").over(everything))
              .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_most").over(earlier), F.lit(0.0)))
                          / F.sum("_weight").over(onward)))
    level = F.coalesce(F.first(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level")), ignorenulls=True)
                       .over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(0.0))
    return levels.withColumn("target", F.least("_most", level * F.col("_weight"))).select("source", "source_size", "target")


def pareto_rank(odds_of: str = "_share"):
    """A document's random odds over its inclusion odds, brought into 0 to 1 without changing the order."""
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")), 1, 12), 16, 10)
    u = (draw.cast("double") + 0.5) / float(1 << 48)
    q = (u / (1.0 - u)) / (F.col(odds_of) / (1.0 - F.col(odds_of)))
    return q / (1.0 + q)


def _running(df: DataFrame, bins: str) -> DataFrame:
    """Of each source, the bin in which the running sum of sizes passes what is still wanted."""
    earlier = Window.partitionBy("source").orderBy(bins).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy("source", "_wanted", bins).agg(F.sum("_size").alias("_sum"))
    return (sums.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
            .filter((F.col("_before") <= F.col("_wanted")) & (F.col("_wanted") < F.col("_before") + F.col("_sum")))
            .select("source", F.col(bins).alias("_cut"), (F.col("_wanted") - F.col("_before")).alias("_left")))


ORDER = ["_rank", "doc_id", "_size", "_file", "_row"]


def numbered(docs: DataFrame, *others: Column) -> DataFrame:
    """Rows with their size in words and a place of their own, which tells apart rows that share an id.

    Rows read from files are told apart by file and row, which stay the same whenever they are read again. Rows that come from
    elsewhere are stored with a number.
    """
    wanted = ["doc_id", "source", word_count().alias("_size"), *others]
    try:
        return docs.select(*wanted, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return stored(docs.select(*wanted, F.lit("").alias("_file")).withColumn("_row", F.monotonically_increasing_id()))


def mixing_plan(base: DataFrame, most_copies: int = MOST_COPIES) -> DataFrame:
    """Per source of ``numbered`` rows: size, target, whole copies of every document, and the last place that gets one more copy.

    Each document is worth target / source size copies. The whole part is certain; the
    rest is its inclusion probability. Pareto ranks order the documents of a source, and
    documents are taken in that order up to the one that brings the words nearest to the
    target. Sums per bin of ranks find that place: twice 4096 bins, then the rows of one
    bin, scanned in blocks. Rows that share an id share a draw and follow each other by size and row number: the
    cut may fall between them, and no task holds all of them.
    """
    targets = source_targets(base.groupBy("source").agg(F.sum("_size").alias("source_size")), most_copies)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = stored(targets.withColumn("whole", F.least(F.floor(ratio), F.lit(most_copies)).cast("long"))
                  .withColumn("_wanted", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
                  .withColumn("_share", F.greatest(ratio - F.col("whole"), F.lit(0.0))))
    ranked = (base.filter("_size > 0").join(plan.filter("_share > 0").withColumnRenamed("source", "_source"),
                                            F.col("source").eqNullSafe(F.col("_source")))
              .select("source", "doc_id", "_size", "_file", "_row", "_wanted", pareto_rank().alias("_rank"))
              .withColumn("_coarse", F.floor(F.col("_rank") * BINS).cast("long"))
              .withColumn("_fine", F.floor(F.col("_rank") * (BINS * BINS)).cast("long")))

    def inside(rows: DataFrame, cut: DataFrame, bins: str) -> DataFrame:
        cut = cut.select(F.col("source").alias("_source"), "_cut", "_left")
        return (rows.join(cut, F.col("source").eqNullSafe(F.col("_source")) & (F.col(bins) == F.col("_cut")))
                .withColumn("_wanted", F.col("_left")).drop("_source", "_cut", "_left"))

    coarse = stored(_running(ranked, "_coarse"))
    middle = stored(_running(inside(ranked, coarse, "_coarse"), "_fine"))
    last = inside(inside(ranked, coarse, "_coarse"), middle, "_fine")
    blocks = [{"_by_rank": F.col("_rank")}, {"_by_id": F.col("doc_id"), "_by_size": F.col("_size"), "_by_file": F.col("_file"), "_by_row": F.expr(f"_row div {ID_BLOCK}")}]
    ends = (scan_before(last, ["source"], ORDER, blocks, F.lit(None).cast("int"), F.col("_size"))
            .filter(F.col("before") + F.col("_size") / 2.0 <= F.col("_wanted"))
            .groupBy("source").agg(F.max(F.struct(*ORDER)).alias("_end")))
    # Where no row of the bin fits, the cut is the bin's own edge.
    edge = F.struct((F.col("_cut") / float(BINS * BINS)).alias("_rank"), *[F.lit(None).cast(base.schema[c].dataType).alias(c) for c in ORDER[1:]])
    cuts = (middle.join(ends.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left")
            .select(F.col("source").alias("_owner"), F.coalesce(F.col("_end"), edge).alias("_last")))
    out = stored(plan.join(cuts, F.col("source").eqNullSafe(F.col("_owner")), "left").select("source", "source_size", "target", "whole", "_share", "_last"))
    discard(plan, coarse, middle)
    return out


def with_copies(base: DataFrame, plan: DataFrame) -> DataFrame:
    """The ``numbered`` rows with their source's ``source_size`` and ``target`` and the number of ``copies`` the mix takes."""
    keys = plan.withColumnRenamed("source", "_source")
    placed = base.join(keys, base["source"].eqNullSafe(keys["_source"]), "left").withColumn("_rank", F.when(F.col("_share") > 0, pareto_rank()))
    extra = F.col("_last._rank").isNotNull() & F.col("_rank").isNotNull() & (F.struct(*ORDER) <= F.col("_last"))
    return (placed.withColumn("copies", F.col("whole") + F.coalesce(extra, F.lit(False)).cast("long"))
            .drop("_source", "whole", "_share", "_last", "_rank"))


def mix_report(docs: DataFrame, most_copies: int = MOST_COPIES) -> DataFrame:
    """Per document: ``doc_id``, ``size`` in words, ``source_size``, ``target`` and ``taken`` words, repeats counted.

    Null text has size 0; a null source is a source of its own, the last. A document of
    size 0 takes nothing. An empty table gives no rows. Rerunning gives the same rows:
    the draw of a document is a hash of its id; rows that share an id, or have none, are still taken one by one.
    """
    base = stored(numbered(docs))
    return with_copies(base, mixing_plan(base, most_copies)).select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, most_copies: int = MOST_COPIES) -> DataFrame:
    """The mix itself: each document as often as the mix takes it, with the columns it came with."""
    names = {f"c{i}": n for i, n in enumerate(docs.columns)}
    rows = numbered(docs, F.struct(*[docs[n].alias(c) for c, n in names.items()]).alias("_content"))
    copies = (with_copies(rows, mixing_plan(stored(rows.drop("_content")), most_copies)).filter("copies > 0")
              .select("_content", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")))
    return copies.select(*[F.col(f"_content.{c}").alias(n) for c, n in names.items()])
