"""Exact dedup by distributed radix partitioning on successive bytes of the documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from haulbook.llm.common import stored, text_or_empty

#: Bytes of the first digit, and how many times wider each next digit is.
FIRST_DIGIT = 48
WIDEN = 64


def split_copies(docs: DataFrame, carry: dict[str, Column], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id``, ``keep_id``, ``group_size``, ``kept`` and the ``carry`` columns of every document.

    A document is read as its length followed by its bytes, most significant first.
    The first split takes the length and the first bytes; every later one takes the
    next and wider digit, and only documents whose group still has several members
    move on. A group is done when one document is left or its bytes have ended, so
    its members agree in every byte; no digest decides. Group counts are summed before
    the shuffle and copies meet their counts in a join that Spark may split, so a
    group of any size never sits in one task.

    Of equal texts the row with the largest id stays; of rows that repeat one id and
    text only one does. Null text counts as empty, a null id as the smallest. An empty
    table gives no rows; further columns are ignored.
    """
    body = text_or_empty(text_col).cast("binary")
    rows = docs.select(F.col(id_col).alias("_id"), *[c.alias(n) for n, c in carry.items()],
                       F.octet_length(body).alias("_size"), F.substring(body, 1, FIRST_DIGIT).alias("_digit"), body.alias("_body"))
    shared = (rows.groupBy("_size", "_digit").agg(F.count("*").alias("_n")).filter("_n > 1")
              .select("_size", "_digit", F.lit(True).alias("_shared")))
    first = stored(rows.join(shared, ["_size", "_digit"], "left")
                   .select("_id", *carry, "_size", F.monotonically_increasing_id().alias("_row"),
                           F.when(F.col("_shared"), F.concat("_size", F.lit(":"), F.hex("_digit"))).alias("_group"),
                           F.when(F.col("_shared"), F.col("_body")).alias("_body")))
    alone = first.filter("_group is null").select("_id", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                                  F.lit(True).alias("kept"), *carry)
    done, open_rows, start, width = [alone], first.filter("_group is not null"), FIRST_DIGIT, FIRST_DIGIT * WIDEN
    while True:
        digit = open_rows.select("_id", *carry, "_size", "_row", "_group", "_body", F.substring("_body", start + 1, width).alias("_digit"))
        groups = digit.groupBy("_group", "_digit").agg(F.count("*").alias("_n"), F.max(F.struct("_id", "_row")).alias("_keep"),
                                                       F.min("_row").alias("_next"))
        start += width
        more = (F.col("_n") > 1) & (F.col("_size") > start)
        step = stored(digit.join(groups, ["_group", "_digit"])
                      .select("_id", *carry, "_size", "_row", F.col("_next").cast("string").alias("_group"), "_n", "_keep",
                              more.alias("_more"), F.when(more, F.col("_body")).alias("_body")))
        done.append(step.filter("not _more").select("_id", F.col("_keep._id").alias("keep_id"), F.col("_n").alias("group_size"),
                                                    (F.col("_keep._row") == F.col("_row")).alias("kept"), *carry))
        open_rows, width = step.filter("_more"), width * WIDEN
        if open_rows.isEmpty():
            return reduce(DataFrame.unionByName, done)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` (see ``split_copies``)."""
    sha = F.sha2(text_or_empty(text_col).cast("binary"), 256)
    return (split_copies(docs, {"text_sha256": sha}, id_col, text_col)
            .select(F.col("_id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    columns = [f"c{i}" for i in range(len(docs.columns))]
    kept = split_copies(docs, {c: docs[n] for c, n in zip(columns, docs.columns)}, id_col, text_col).filter("kept")
    return kept.select(*[F.col(c).alias(n) for c, n in zip(columns, docs.columns)])
