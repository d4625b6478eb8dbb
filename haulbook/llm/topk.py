"""Exact top-k search by no-random-access aggregation over sorted lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

BLOCK = 8192        # candidates whose lists one task sorts
CHUNK = 2048        # queries that meet a block at once
SLICE = 256         # queries whose bounds are held at once
LONG = (1 << 63) - 1


def nearest(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query, candidate, score) of each query's ``k`` best candidates, ties to the smaller id.

    Every component of the candidates is a list sorted by value, and a query reads each
    list from the end its own sign favours. After the first ``depth`` entries of all
    lists, an entry not read yet lies between the list's last value read and its far
    end, which bounds every score from both sides; no entry is looked up out of turn. A
    query stops when so few candidates can still reach its k-th lower bound that their
    full scores are resolved, or when the lists have ended. Components are whole numbers. Bounds are
    sums in double precision, widened by what rounding can do to them; final scores are
    sums of whole numbers, exact at any size, and are ranked before they are cut to the range of a long.
    """
    n = len(ids)
    exact_rows, exact_queries = rows, queries
    rows, queries = rows.astype(np.float64), queries.astype(np.float64)
    reach = float(np.abs(rows).max(initial=0))
    slack = np.abs(queries).sum(axis=1) * reach * 2.0 ** -50 * (rows.shape[1] + 1)
    wide = int(np.abs(exact_rows).max(initial=0)) * int(np.abs(exact_queries).max(initial=0)) * max(rows.shape[1], 1) >= 1 << 63
    if wide:
        exact_rows, exact_queries = exact_rows.astype(object), exact_queries.astype(object)
    ordered = np.sort(rows, axis=0)
    low, high = ordered[0], ordered[-1]
    plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
    open_queries, out = np.arange(len(queries)), []
    depth = max(k + 1, n // 8)
    while len(open_queries):
        depth = min(depth, n)
        top, bottom = ordered[n - depth], ordered[depth - 1]       # the last values read from either end
        read_top, read_bottom = rows >= top, rows <= bottom
        above, below = np.where(read_top, rows, top), np.where(read_bottom, rows, bottom)
        least, most = np.where(read_top, rows, low), np.where(read_bottom, rows, high)
        later = []
        for cut in range(0, len(open_queries), SLICE):
            at = open_queries[cut:cut + SLICE]
            lower = plus[at] @ least.T + minus[at] @ most.T - slack[at][:, None]
            upper = plus[at] @ above.T + minus[at] @ below.T + slack[at][:, None]
            own = query_ids[at][:, None] == ids[None, :]
            lower[own] = upper[own] = -np.inf
            kth = np.partition(lower, max(n - k, 0), axis=1)[:, max(n - k, 0)] if n > k else np.full(len(at), -np.inf)
            able = (upper >= kth[:, None]) & ~own
            for row, count in enumerate(able.sum(axis=1)):
                if depth < n and count > max(4 * k, n // 16):
                    later.append(at[row])
                    continue
                left = np.flatnonzero(able[row])
                score = [int(x) for x in exact_rows[left] @ exact_queries[at[row]]]
                best = sorted(range(len(left)), key=lambda b: (-score[b], ids[left[b]]))[:k]
                out.extend((int(query_ids[at[row]]), int(ids[left[b]]), min(max(score[b], -LONG - 1), LONG)) for b in best)
        open_queries, depth = np.array(later, dtype=np.int64), depth * 2
    return out


def _matrix(cells: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(cells), width), dtype=np.int64)
    for i, cell in enumerate(cells):
        out[i, :len(cell)] = cell
    return out


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` best inner products of each query.

    Components become floor(256 * x). Queries are the rows whose id is divisible by
    ``every``; candidates are all rows but the query's own. Vectors that are null or hold
    null or non-finite components, and rows without an id, take no part; rows that
    repeat an id count once, with the smallest vector. A shorter vector ends in zeros.
    An empty table gives no rows, a lone vector no partners. A score beyond a long is shown as the
    largest or smallest one.

    Candidates are dealt into blocks by id hash and queries into chunks, and each pair of
    them is one group of bounded size: all its sorted lists fit a task. The best of the
    blocks meet by query.
    """
    x = F.col(vector_col)
    sound = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    whole = (vectors.filter(F.col(id_col).isNotNull() & F.coalesce(sound, F.lit(False)))
             .select(F.col(id_col).cast("long").alias("_id"), F.transform(x, lambda v: F.floor(v.cast("double") * 256)).alias("_v"))
             .groupBy("_id").agg(F.min("_v").alias("_v")))
    asks = F.pmod("_id", F.lit(every)) == 0
    counts = whole.agg(F.count("*").alias("n"), F.sum(asks.cast("int")).alias("q"), F.max(F.size("_v")).alias("w")).first()
    blocks, chunks, width = -(-counts.n // BLOCK) or 1, -(-(counts.q or 0) // CHUNK) or 1, counts.w or 0
    block = F.pmod(F.xxhash64("_id"), F.lit(blocks)).cast("int")
    chunk = F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(chunks)).cast("int")
    candidates = whole.select("_id", "_v", block.alias("_b"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("_c"))
    queries = whole.filter(asks).select("_id", "_v", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_b"), chunk.alias("_c"))

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            found = nearest(left["_id"].to_numpy(), _matrix(left["_v"], width), right["_id"].to_numpy(), _matrix(right["_v"], width), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    pairs = (candidates.groupBy("_b", "_c").cogroup(queries.groupBy("_b", "_c"))
             .applyInPandas(best, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
