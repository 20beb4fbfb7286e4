"""Operator 11: the solver against numpy, the operator against a brute-force version."""

import numpy as np
import pytest
from pyspark.sql import Row

from ledgerlint.llm import queries, whitening
from ledgerlint.sources.tables import read_table

RNG = np.random.default_rng(5)
ROTATION = np.linalg.qr(RNG.normal(size=(8, 8)))[0]
MATRICES = {
    "one": RNG.normal(size=(1, 1)),
    "two": RNG.normal(size=(2, 2)),
    "wide": RNG.normal(size=(2, 6)),
    "rows alike": np.ones((5, 4)),
    "zero": np.zeros((3, 3)),
    "equal values": np.diag([3.0, 3, 3, 1, 1]),
    "equal values, turned": np.diag([5.0, 5, 5, 5, 5, 1, 1, 0]) @ ROTATION,
    "nearly equal": np.diag([5.0, 5 + 1e-13, 5 + 2e-13, 5, 4, 1, 1, 0]) @ ROTATION,
    "graded": np.diag([1, 1e-3, 1e-6, 1e-9, 1e-12]) @ np.linalg.qr(RNG.normal(size=(5, 5)))[0],
    "64": RNG.normal(size=(300, 64)),
    "200": RNG.normal(size=(220, 200)),
}


@pytest.mark.parametrize("name", MATRICES)
def test_solver_equals_numpy(name):
    a = MATRICES[name]
    values, found = whitening.directions(whitening.fold(None, a), 4)
    want = np.zeros(a.shape[1])
    s = np.linalg.svd(a, compute_uv=False) ** 2
    want[: len(s)] = s
    top = max(want[0], 1e-300)
    assert np.allclose(values, want, rtol=0, atol=1e-13 * top)
    assert found.shape[1] == min(4, int((want > 1e-24 * top).sum()) if want[0] else 0)
    assert abs(found.T @ found - np.eye(found.shape[1])).max(initial=0) < 1e-12
    assert abs(a.T @ a @ found - found * values[: found.shape[1]]).max(initial=0) < 1e-12 * top


def test_small_values_keep_their_digits():
    diagonal, above = np.array([1.0, 1e-4, 1e-8]), np.array([1e-5, 1e-9])
    got = np.sqrt(whitening.squared_singular_values(diagonal, above))
    assert got[0] * got[1] * got[2] == pytest.approx(1e-12, rel=1e-12)  # the determinant


def test_blocks_and_rounds_give_one_triangle():
    a = RNG.normal(size=(1000, 6))
    r = None
    for at in range(0, 1000, 77):
        r = whitening.fold(r, a[at: at + 77])
    assert np.allclose(r.T @ r, a.T @ a)


def brute_force(rows, k=4):
    good = [(i, [float(c) for c in v]) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(256 * np.array([v for _, v in good]))
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    cov = np.cov(fit.T, bias=True)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    z = (x - s / n) @ vectors[:, :k] / np.sqrt(values[:k])
    deviation = [int(sum(int(d) ** 2 for d in n * row - s)) for row in x]
    return {i: (n, deviation[j], z[j]) for j, (i, _) in enumerate(good)}, values[:k] / np.trace(cov)


def check(out, rows, k=4):
    want, explained = brute_force(rows, k)
    got = out.toPandas()
    assert len(got) == len(want) * k and got.identity_error.max() < 1e-9 and got.identity_error.nunique() == 1
    signs = {}
    for r in got.itertuples():
        n, deviation, z = want[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.explained - explained[r.component - 1]) < 1e-12
        assert abs(abs(r.whitened) - abs(z[r.component - 1])) < 1e-8
        if abs(r.whitened) > 1e-6:
            signs.setdefault(r.component, set()).add(r.whitened * z[r.component - 1] > 0)
    assert all(len(s) == 1 for s in signs.values())


def test_query_equals_brute_force(spark, sf_small):
    rows = [(r.vec_id, r.embedding) for r in read_table(spark, sf_small, "embeddings").select("vec_id", "embedding").collect()]
    out = queries.op11_whitening(spark, sf_small)
    assert [f"{c} {t}" for c, t in out.dtypes[:7]] == [
        "vec_id bigint", "component int", "n bigint", "deviation bigint", "whitened double", "explained double", "identity_error double"]
    check(out, rows)


def test_odd_rows(spark):
    base = [[float(c) for c in RNG.normal(size=5)] for _ in range(60)]
    rows = [(i, v) for i, v in enumerate(base)] + [(100 + i, base[0]) for i in range(40)]  # copies count once in the fit
    odd = [(200, None), (201, []), (202, [1.0, None, 0.0, 0.0, 0.0]), (203, [float("nan")] * 5), (204, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
           (205, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, i, "x", 1) for i, v in rows + odd], "vec_id bigint, embedding array<double>, n bigint, x string, slot int")
    check(whitening.whiten(df.repartition(7)), rows)
    check(whitening.whiten(df, k=2), rows, k=2)
    null = spark.createDataFrame([(None, v) for v in base], "vec_id bigint, embedding array<double>")
    assert whitening.whiten(null).where("vec_id is null").count() == 240


def test_nothing_to_whiten(spark):
    schema = "vec_id bigint, embedding array<float>"
    empty = whitening.whiten(spark.createDataFrame([], schema))
    assert empty.count() == 0 and len(empty.columns) == 7
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([Row(1, [1.0, 2.0]), Row(2, [1.0, 2.0])], schema)).count() == 0
    line = whitening.whiten(spark.createDataFrame([Row(i, [float(i), 2.0, 3.0]) for i in range(9)], schema)).toPandas()
    assert set(line.component) == {1} and np.allclose(line.explained, 1)


def test_sums_beyond_64_bits_fail(spark):
    df = spark.createDataFrame([(i, [float(10 ** 15 * (i + 1)), 1.0]) for i in range(4)], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        whitening.whiten(df).count()
