"""Whitening against a full eigendecomposition of an exact covariance, and the interval solver on hard spectra."""

from fractions import Fraction
from math import floor, isfinite, isnan, inf, nan

import numpy as np
import pytest

from haulbook.llm.whitening import components_between, leading_components, positive_eigenvalues, whiten


def with_spectrum(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))[0]
    m = q * np.array(values) @ q.T
    return (m + m.T) / 2


@pytest.mark.parametrize("values", [[3, 2, 1], [1, 1, 1, 1], [5, -1, -2, 0.5], [0, 0, -1, 2], list(np.linspace(-3, 7, 40))])
def test_inertia(values):
    m = with_spectrum(values, 1)
    for shift in (-2.5, -0.5, 0.3, 1.5, 2.5, 6.9):
        assert positive_eigenvalues(m - shift * np.eye(len(m))) == sum(v > shift for v in values)
    assert positive_eigenvalues(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1 and positive_eigenvalues(np.zeros((3, 3))) == 0


@pytest.mark.parametrize("values", [
    [9, 8, 7, 6, 5, 4, 3, 2, 1], [1, 1, 1, 1, 1, 1, 1], [1, 1 - 1e-9, 1 - 2e-9, 0.5, 0.5 - 1e-10, 0.1], [1e6, 1, 1e-6, 1e-9],
    [4, 3], [7], [2, 1, 0, 0, 0], list(np.exp(-np.arange(64) / 7)), [1 + 1e-3 * k for k in range(64)], [1.0] * 200])
def test_leading_components(values):
    m = with_spectrum(values, 2)
    got, axes = leading_components(m, 4)
    exact = np.linalg.eigvalsh(m)[::-1]
    k = min(4, int((exact > 1e-13 * np.trace(m) * len(m)).sum()))
    assert len(got) >= min(k, 4) and np.allclose(got[:k], exact[:k], rtol=1e-12, atol=1e-13 * exact[0])
    assert np.allclose(axes.T @ axes, np.eye(len(got)), atol=1e-12)
    assert np.abs(m @ axes - axes * got).max() <= 1e-11 * exact[0]


def test_a_missed_eigenvalue_is_noticed():
    m = with_spectrum([4, 3, 2, 1])
    with pytest.raises(ArithmeticError):
        components_between(m, 1.5, 5, 4)


def brute(rows, most=4):
    """vec_id, component -> (n, deviation, |whitened|, explained) by a full decomposition."""
    ok = [(i, [floor(256 * float(c)) for c in v]) for i, v in rows if v and all(c is not None and isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in ok})
    n, d = len(fit), len(fit[0])
    s = [sum(x[k] for x in fit) for k in range(d)]
    cov = np.array([[float(Fraction(sum((n * x[a] - s[a]) * (n * x[b] - s[b]) for x in fit), n ** 3)) for b in range(d)] for a in range(d)])
    values, axes = np.linalg.eigh(cov)
    out = []
    for i, x in ok:
        away = np.array([float(Fraction(n * x[k] - s[k], n)) for k in range(d)])
        for c in range(min(most, d)):
            e, u = values[-1 - c], axes[:, -1 - c]
            out.append((i, c + 1, n, sum((n * x[k] - s[k]) ** 2 for k in range(d)), abs(away @ u / e ** 0.5), e / np.trace(cov)))
    return sorted(out, key=str)


@pytest.mark.parametrize("width,rows", [(8, 60), (3, 25)])
def test_whitened_rows(spark, width, rows):
    draw = np.random.default_rng(width)
    data = [(int(i), [float(np.float32(v)) for v in draw.standard_normal(width) * np.arange(1, width + 1)]) for i in range(rows)]
    data += data[:4] + [(900, data[1][1])] * 30 + [(None, data[2][1]), (901, None), (902, []), (903, [nan] * width), (904, [inf] + [0.0] * (width - 1)),
                                                   (905, [None] + [0.0] * (width - 1)), (906, [1e4] * width)]
    docs = spark.createDataFrame([(i, v, "a", 2) for i, v in data], "vec_id long, embedding array<double>, x string, n int")
    got = whiten(docs.repartition(3)).collect()
    want = brute(data)
    mine = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got), key=str)
    assert [m[:4] for m in sorted(mine, key=lambda m: str(m[:4]))] == [w[:4] for w in sorted(want, key=lambda w: str(w[:4]))]
    for m, w in zip(sorted(mine, key=lambda m: (str(m[:4]), m[4])), sorted(want, key=lambda w: (str(w[:4]), w[4]))):
        assert m[4:] == pytest.approx(w[4:], rel=1e-7, abs=1e-7)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_edges(spark):
    kind = "vec_id long, embedding array<float>"
    assert whiten(spark.createDataFrame([], kind)).collect() == []
    assert whiten(spark.createDataFrame([(1, [0.5, 1.5]), (2, [0.5, 1.5])], kind)).collect() == []
    line = whiten(spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [2.0, 2.0]), (4, [9.0])], kind)).collect()
    assert sorted((r.vec_id, r.component) for r in line) == [(1, 1), (2, 1), (3, 1)]
    assert [round(abs(r.whitened), 9) for r in sorted(line, key=lambda r: r.vec_id)] == [round(1.5 ** 0.5, 9), 0.0, round(1.5 ** 0.5, 9)]
    # Products beyond 2^53 stay exact, and a deviation beyond a long is null.
    far = whiten(spark.createDataFrame([(1, [1e11, 0.0]), (2, [-1e11, 1.0]), (3, [5.0, 7.0])], kind.replace("float", "double"))).collect()
    assert {r.deviation for r in far} == {None, *[r.deviation for r in far if r.vec_id == 3]} and far[0].identity_error < 1e-6
