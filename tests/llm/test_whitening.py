"""Whitening against a plain eigendecomposition, and the eigensolver on hard spectra."""

import math
from collections import Counter

import numpy as np
import pytest
from llm_docs import SF_SMALL

from perkspark.llm import op13_feast_whitening as op13

SCHEMA = "vec_id long, embedding array<double>, component int, n long, whitened double"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, 0.5) for i, v in vectors], SCHEMA)


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def check(got, vectors, most=32, tolerance=1e-8):
    rows = [(i, v) for i, v in vectors if usable(v)]
    dims = max(len(v) for _, v in rows)
    x = [[math.floor(64 * c) + 1_000_000 for c in [*v, *[0.0] * (dims - len(v))]] for _, v in rows]
    n = len(x)
    sums = [sum(r[j] for r in x) for j in range(dims)]
    centred = np.array([[(n * r[j] - sums[j]) / n for j in range(dims)] for r in x])
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    k = min(most, int((values > 4 * dims * 2.3e-16 * values[-1]).sum())) if values[-1] > 0 else 0
    values, axes = values[::-1][:k], vectors_[:, ::-1][:, :k]
    assert len(got) == n * k
    whole = [sum((n * r[j] - sums[j]) ** 2 for j in range(dims)) for r in x]
    deviations = Counter((i, d if d < 1 << 63 else None) for (i, _), d in zip(rows, whole, strict=True))
    for c in range(k):
        own = [r for r in got if r["component"] == c + 1]
        assert Counter((r["vec_id"], r["deviation"]) for r in own) == deviations and {r["n"] for r in own} == {n}
        assert all(abs(r["explained"] - values[c] / values_sum(centred, n)) <= 1e-9 * r["explained"] for r in own)
        assert max(r["identity_error"] for r in own) <= 1e-9
        gap = min([abs(values[c] - v) for j, v in enumerate(values) if j != c] or [values[0]])
        if gap > 1e-6 * values[0] and len({i for i, _ in rows}) == n:  # else any basis will do
            want = {i: w for (i, _), w in zip(rows, centred @ axes[:, c] / np.sqrt(values[c]), strict=True)}
            found = {r["vec_id"]: r["whitened"] for r in own}
            sign = np.sign(sum(want[i] * found[i] for i in want))
            assert max(abs(want[i] - sign * found[i]) for i in want) < tolerance


def values_sum(centred, n):
    return (centred**2).sum() / n


def test_query_against_plain_eigendecomposition(spark):
    vectors = [(r["vec_id"], [float(c) for c in r["embedding"]]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    check(op13.op13_feast_whitening(spark, SF_SMALL).collect(), vectors)


def test_defined_cases(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.normal(0, 3, 5)]) for i in range(200)]
    vectors += [(300, None), (301, [1.0, None, 0.0]), (302, [math.nan] * 5), (303, [math.inf, 0.0]), (304, []), (305, [2.0, 3.0]), (306, [1.0] * 5)]
    check(op13.whiten(frame(spark, vectors)).collect(), vectors)
    check(op13.whiten(frame(spark, vectors), most=2).collect(), vectors, most=2)
    repeated = [*vectors, (0, [9.0, 1.0, 0.0, 0.0, 4.0]), (None, [1.0, 2.0, 3.0, 4.0, 5.0])]
    check(op13.whiten(frame(spark, repeated)).collect(), repeated)
    large = [*vectors, (400, [3e6, 1.0, 0.0, 0.0, 0.0])]
    check(op13.whiten(frame(spark, large)).collect(), large, tolerance=1e-5)
    for few in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, []), (2, [])], [(i, [1.0, 2.0]) for i in range(9)]):
        assert op13.whiten(frame(spark, few)).count() == 0
    huge = op13.whiten(frame(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0])])).collect()
    assert [r["deviation"] for r in huge] == [None] * len(huge) and huge
    with pytest.raises(Exception, match="dimensions"):
        op13.whiten(frame(spark, [(1, [0.0] * (op13.MOST_DIMENSIONS + 1))]))


def spectrum(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        [5.0] * 40,
        [9.0] * 3 + [4.0] * 30 + [1.0] * 10,
        [1e9, 1e9, 1e3, 1.0, 1.0, 1.0, 0.5],
        list(np.linspace(1, 100, 64)),
        list(1.5 ** np.arange(50)),
        [1 + 1e-9 * i for i in range(40)],
        [3.0],
        [2.0, 0.0, 0.0],
        [7.0, 7.0 - 1e-13, 1.0],
    ],
)
def test_components_of_hard_spectra(values):
    v = spectrum(values)
    v = (v + v.T) / 2
    got, axes = op13.components(v, 32)
    want = np.sort(values)[::-1]
    want = want[want > 4 * len(values) * 2.3e-16 * want[0]][:32]
    assert len(got) == len(want) and np.allclose(got, want, rtol=0, atol=1e-12 * want[0])
    assert np.abs(axes.T @ axes - np.eye(len(want))).max() < 1e-12
    assert np.abs(v @ axes - axes * got).max() < 1e-12 * want[0]


def test_inertia_counts():
    v = spectrum([4.0, 4.0, 3.0, 1.0, 0.5, -2.0])
    shifts = np.array([5.0, 3.5, 2.0, 0.7, 0.0, -3.0])
    assert op13.count_above(*op13.tridiagonal(v), shifts).tolist() == [0, 2, 3, 4, 5, 6]
