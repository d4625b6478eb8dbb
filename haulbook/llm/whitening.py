"""Whitening of embeddings: an exact covariance summed by Spark, its leading components by contour integration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from haulbook.llm.common import stored

COMPONENTS = 4
SCALE = 256
NODES = 8           # quadrature nodes on the upper half of the contour
SPARE = 4           # more eigenvalues than wanted that an interval may hold before it is split further
ROUNDS = 40         # contour integrations at most; three to six are usual
_LONG = (1 << 63) - 1


# ---------------------------------------------------------------- eigenvalues in an interval

def positive_eigenvalues(matrix: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are above zero, from the signs of its block pivots (inertia).

    Symmetric elimination with complete pivoting: a pivot is one diagonal entry, or a two-by-two block with an
    eigenvalue of either sign where the off-diagonal entries outweigh the diagonal.
    """
    a, found, k = matrix.copy(), 0, 0
    bound = (1 + 17 ** 0.5) / 8
    while k < len(a):
        rest = a[k:, k:]
        diagonal = np.abs(np.diagonal(rest))
        one = int(diagonal.argmax())
        off = np.abs(np.tril(rest, -1))
        p, q = np.unravel_index(off.argmax(), off.shape)
        if diagonal[one] == 0 and off[p, q] == 0:
            break
        if diagonal[one] >= bound * off[p, q]:
            rest[[0, one]] = rest[[one, 0]]
            rest[:, [0, one]] = rest[:, [one, 0]]
            found += rest[0, 0] > 0
            rest[1:, 1:] -= np.outer(rest[1:, 0] / rest[0, 0], rest[0, 1:])
            k += 1
        else:
            order = [q, p, *(i for i in range(len(rest)) if i not in (p, q))]
            rest[:] = rest[np.ix_(order, order)]
            found += 1
            rest[2:, 2:] -= rest[2:, :2] @ np.linalg.solve(rest[:2, :2], rest[:2, 2:])
            k += 2
    return int(found)


def _above(matrix: np.ndarray, value: float) -> int:
    return positive_eigenvalues(matrix - value * np.eye(len(matrix)))


def components_between(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between low and high and their unit vectors, by falling eigenvalue.

    A quadrature of shifted complex solves along a circle through low and high projects a block of vectors onto the wanted
    eigenspace; Rayleigh and Ritz give the pairs inside it, from which the next round starts. ``count`` is the inertia
    count of the interval: a round that finds another number, or whose residuals still fall, is not the last.
    """
    size = len(matrix)
    width = min(size, count + max(8, count // 2))
    points, weights = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(0.5j * np.pi * (1 + points))
    centre, radius = (low + high) / 2, (high - low) / 2
    block = np.random.default_rng(1).standard_normal((size, width))
    best = None
    for _ in range(ROUNDS):
        projected = sum(w / 2 * (radius * t * np.linalg.solve((centre + radius * t) * np.eye(size) - matrix, block.astype(complex))).real
                        for w, t in zip(weights, turn))
        basis = np.linalg.qr(projected)[0]
        values, inner = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ inner
        inside = np.flatnonzero((values > low) & (values < high))[::-1]
        if len(inside) != count:
            if width < size:
                # Too few vectors for a crowded interval: more of them.
                more = min(size, 2 * width) - width
                block = np.hstack([block, np.random.default_rng(width).standard_normal((size, more))])
                width += more
            continue
        left = np.abs(matrix @ block[:, inside] - block[:, inside] * values[inside]).max()
        if best is not None and left >= best[0] / 2:
            break
        best = (left, values[inside], block[:, inside])
    if best is None:
        raise ArithmeticError(f"{count} eigenvalues lie between {low} and {high}, but no round found as many")
    return best[1], best[2]


def leading_components(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` largest eigenvalues above rounding of a covariance, falling, and unit vectors as columns.

    Inertia counts narrow an interval below the upper bound until it holds the wanted ones and few others. A vector's
    entry of greatest size is positive. Eigenvalues within rounding of zero have no whitened value and are left out.
    """
    size, trace = len(matrix), float(np.trace(matrix))
    if not size or trace <= 0:
        return np.zeros(0), np.zeros((size, 0))
    scaled = matrix / trace
    high = 1 + 1e-9      # all eigenvalues of a covariance lie between 0 and its trace
    low, held = 1e-14 * size, _above(scaled, 1e-14 * size)
    wanted, top = min(most, held), high
    while held > wanted + SPARE and top - low > 1e-13:
        middle = (low + top) / 2
        count = _above(scaled, middle)
        if count < wanted:
            top = middle
        else:
            low, held = middle, count
    if not wanted:
        return np.zeros(0), np.zeros((size, 0))
    values, vectors = components_between(scaled, low, high, held)
    values, vectors = values[:wanted] * trace, vectors[:, :wanted]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)])
    return values, vectors * signs


# ---------------------------------------------------------------- sums over the rows

@dataclass(frozen=True)
class Whitening:
    """A fit: distinct vectors, their sums per dimension, leading eigenvalues and vectors, trace, and how far from the
    identity the covariance of the whitened fit list is."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def whole_vectors(embeddings: DataFrame, *keep: str, column: str = "embedding") -> DataFrame:
    """Rows with a vector of finite numbers, at least one, as whole numbers x = floor(256 c), beside the columns ``keep``."""
    usable = F.col(column).isNotNull() & ~F.exists(column, lambda c: c.isNull() | F.isnan(c.cast("double"))
                                                   | (F.abs(c.cast("double")) == float("inf"))) & (F.size(column) > 0)
    return embeddings.where(usable).select(*keep, F.transform(column, lambda c: F.floor(SCALE * c.cast("double")).cast("long")).alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch["x"]
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _exact_products(y: np.ndarray) -> np.ndarray:
    """y' y in whole numbers: doubles while every sum stays below 2^53, Python integers beyond."""
    most = int(max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0)))))
    rows = (1 << 53) // max(most * most, 1)
    if not rows:
        big = y.astype(object)
        return big.T @ big
    total = np.zeros((y.shape[1],) * 2, dtype=object)
    for at in range(0, len(y), rows):
        part = y[at:at + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _moments(fit: DataFrame, width: int, centre: list[int]) -> tuple[list[int], np.ndarray]:
    """Sums of y and of products of y over the fit list, y = x - centre; one partial a task, added by Spark as decimals."""
    about = np.array(centre, dtype=np.int64)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not len(batch):
                continue
            y = _matrix(batch) - about
            # Column 0 is 1, so row 0 of the products holds the sums.
            part = _exact_products(np.hstack([np.ones((len(y), 1), dtype=np.int64), y]))
            total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(width + 1)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                              pa.array([Decimal(int(v)) for v in total[i, j]], pa.decimal128(38, 0))], ["i", "j", "v"])

    sums = fit.mapInArrow(task, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((width + 1,) * 2, dtype=object)
    for r in sums:
        out[r.i, r.j] = out[r.j, r.i] = int(r.v)
    return [int(v) for v in out[0, 1:]], out[1:, 1:]


def _project(x: np.ndarray, n: int, sums: tuple[int, ...], values: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return (x - np.array([s / n for s in sums])) @ vectors / np.sqrt(values)


def fit_whitening(vectors: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    """The fit over each distinct vector x once; None without rows.

    Vectors of the most frequent length are fitted (of equally frequent ones the longest). Two passes over the stored
    distinct vectors: sums per dimension, then products about the rounded mean, both in whole numbers, so the covariance is
    exact before one rounding and does not depend on the order of the rows. A third pass measures the whitened covariance.
    Only matrices of width x width reach the driver.
    """
    fit = stored(vectors.select("x").distinct())
    widths = fit.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    if not widths:
        return None
    width, n = widths[0]
    fit = fit.where(F.size("x") == width)
    totals = fit.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s")).collect()
    sums = [int(r.s) for r in sorted(totals, key=lambda r: r.i)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    first, products = _moments(fit, width, centre)
    covariance = np.array([[(n * products[i, j] - first[i] * first[j]) / (n * n) for j in range(width)] for i in range(width)])
    values, axes = leading_components(covariance, most)
    trace = (n * sum(products[i, i] for i in range(width)) - sum(f * f for f in first)) / (n * n)
    many = len(values)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((many + 1, many + 1))
        for batch in batches:
            w = np.hstack([np.ones((len(batch), 1)), _project(_matrix(batch), n, sums, values, axes)]) if len(batch) else np.zeros((0, many + 1))
            total += w.T @ w
        i, j = (v.ravel() for v in np.indices(total.shape))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])

    error = 0.0
    if many:
        got = np.zeros((many + 1, many + 1))
        for r in fit.mapInArrow(task, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
            got[r.i, r.j] = r.v
        mean = got[0, 1:] / n
        error = float(np.abs(got[1:, 1:] / n - np.outer(mean, mean) - np.eye(many)).max())
    return Whitening(n, tuple(sums), values, axes, trace, error)


_COLUMNS = ("component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")


def whiten(embeddings: DataFrame, most: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: up to ``most`` rows per usable vector.

    Vectors that are null, empty, or hold null or non-finite entries take no part, nor do vectors of another length than
    the most frequent one. Repeated rows and ids each come out, though a repeated vector is fitted once. Components with
    an eigenvalue within rounding of zero are left out: one distinct vector, or an empty table, gives no row. ``deviation``
    is null beyond a long. Products are exact for |x| up to 2^50. Other columns are not read.
    """
    rows = whole_vectors(embeddings, "vec_id", column=column)
    kind = rows.schema["vec_id"].dataType.simpleString()
    fit = fit_whitening(rows, most)
    schema = f"vec_id {kind}, {_COLUMNS}"
    if fit is None or not len(fit.values):
        return rows.sparkSession.createDataFrame([], schema)
    n, sums, values, axes, trace, error = fit.n, fit.sums, fit.values, fit.vectors, fit.trace, fit.identity_error
    many, width = len(values), len(sums)
    explained = values / trace

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch)
            far = n * max(abs(int(x.max())), abs(int(x.min()))) + max(abs(s) for s in sums)
            whole = np.int64 if width * far * far <= _LONG else object
            away = ((n * x.astype(whole) - np.array(sums, dtype=whole)) ** 2).sum(axis=1)
            deviation = pa.array([int(d) if d <= _LONG else None for d in away], pa.int64())
            which = np.repeat(np.arange(len(x)), many)
            component = np.tile(np.arange(many), len(x))
            same = lambda v, kind: pa.array(np.full(len(which), v), kind)
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"].take(pa.array(which)), pa.array(component + 1, pa.int32()), same(n, pa.int64()), deviation.take(pa.array(which)),
                 pa.array(_project(x, n, sums, values, axes).ravel()), pa.array(explained[component]), same(error, pa.float64())],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.where(F.size("x") == width).mapInArrow(task, schema)


def whitened_report(embeddings: DataFrame) -> DataFrame:
    return whiten(embeddings)
