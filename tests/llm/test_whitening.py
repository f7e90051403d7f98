import math

import numpy as np
import pytest

from tidemark.llm import whitening
from tidemark.llm.common import stored, table
from tidemark.llm.queries import QUERIES


def expected(rows, components=4):
    """By hand: exact integers, and a dense eigenvalue problem."""
    x = {}
    for at, (i, v) in enumerate(rows):
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            x[at] = (i, tuple(math.floor(256 * float(c)) for c in v))
    fit = sorted({v for _, v in x.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    e, axes = np.linalg.eigh(y.T @ y / n)
    e, axes = e[::-1], axes[:, ::-1]
    out = {}
    for at, (i, v) in x.items():
        own = np.array([(n * c - s) / n for c, s in zip(v, sums)])
        out[at] = (i, n, sum((n * c - s) ** 2 for c, s in zip(v, sums)), [own @ axes[:, k] / math.sqrt(e[k]) for k in range(components)],
                   [e[k] / e.sum() for k in range(components)])
    return out


def by_row(found):
    out = {}
    for r in found:
        out.setdefault(r.vec_id, {})[r.component] = r
    return out


def test_query_equals_dense_eigenvectors(spark, small):
    rows = [(r.vec_id, r.embedding) for r in table(spark, small, "embeddings").select("vec_id", "embedding").collect()]
    want = {i: (n, dev, w, ex) for i, n, dev, w, ex in expected(rows).values()}
    got = by_row(QUERIES["op12_embedding_whitening"](spark, small).collect())
    assert set(got) == set(want) and len(got) == len(rows)
    signs = [None] * 4
    for i, (n, dev, w, ex) in want.items():
        for k in range(4):
            r = got[i][k + 1]
            assert (r.n, r.deviation) == (n, dev) and math.isclose(r.explained, ex[k], rel_tol=1e-12) and 0 <= r.identity_error < 1e-12
            signs[k] = signs[k] or math.copysign(1, r.whitened * w[k])
            assert abs(r.whitened - signs[k] * w[k]) < 1e-9


@pytest.mark.parametrize("seed", range(40))
def test_solver_on_random_matrices(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(1, 40))
    a = rng.standard_normal((d, d)) * np.exp(rng.uniform(-9, 9, d) * (seed % 3))
    if seed % 4 == 1:  # of low rank
        a[:, d // 2:] = a[:, :1] * rng.standard_normal(d - d // 2)
    if seed % 4 == 2:  # with equal eigenvalues
        q = np.linalg.qr(rng.standard_normal((d, d)))[0]
        a = np.diag(np.repeat([3.0, 2.0, 1.0], [d // 3, d // 3, d - 2 * (d // 3)])) @ q
    r = np.linalg.qr(a, mode="r")
    diagonal, above, v = whitening.bidiagonal(r)
    assert np.allclose(v.T @ v, np.eye(d), atol=1e-13)
    b = np.diag(diagonal) + np.diag(above, 1)
    assert np.allclose(b.T @ b, v.T @ (a.T @ a) @ v, atol=1e-12 * np.abs(a.T @ a).max())
    squares, want = whitening.dqds(diagonal, above), np.linalg.svd(b, compute_uv=False) ** 2
    assert np.allclose(squares, want, rtol=1e-11, atol=1e-28 * want[0] + 1e-24 * want[0])
    values, axes, trace = whitening.principal(r, 1, 4)
    m = a.T @ a
    assert np.allclose(axes @ axes.T, np.eye(len(axes)), atol=1e-10)
    for e, z in zip(values, axes):
        assert np.linalg.norm(m @ z - e * z) < 1e-11 * values[0]
    assert math.isclose(trace, np.trace(m), rel_tol=1e-12)


def test_small_singular_values_are_accurate():
    """A graded matrix: a plain eigenvalue solver loses the small values, dqds does not."""
    diagonal, above = 10.0 ** -np.arange(0, 60, 4), 10.0 ** -np.arange(1, 57, 4)
    squares = whitening.dqds(diagonal, above)
    assert math.isclose(float(np.log(squares).sum()), 2 * float(np.log(diagonal).sum()), rel_tol=1e-12)  # the determinant


def test_edge_rows(spark):
    rng = np.random.default_rng(3)
    base = [(i, [float(c) for c in rng.standard_normal(6)]) for i in range(50)]
    odd = [(100, None), (101, [0.0, None, 0.0, 0.0, 0.0, 0.0]), (102, [0.0] * 5 + [math.nan]), (103, [0.0] * 5 + [math.inf]), (104, [1e300] + [0.0] * 5)]
    same = [(3, base[3][1]), (None, base[4][1]), *[(200 + i, base[5][1]) for i in range(200)], (500, [-0.0] * 6)]
    other = [(600, [1.0, 2.0]), (601, [])]
    rows = base + odd + same + other
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, n int, x string").repartition(5)
    found = whitening.whitened(frame, keep=stored, fan_in=2)
    out = found.withColumnRenamed("id", "vec_id").collect()
    want = expected(base + same)
    assert len(out) == 4 * (len(base) + len(same) + len(other))
    by_id = {i: (n, dev) for i, n, dev, _, _ in want.values()}
    for r in out:
        if r.vec_id in (600, 601):
            assert r.whitened is None and r.deviation is None
        else:
            assert (r.n, r.deviation) == by_id[r.vec_id] == (51, by_id[r.vec_id][1]) and r.identity_error < 1e-12


def test_flat_and_empty_tables(spark):
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)], "vec_id long, embedding array<float>")
    out = whitening.whitened(flat, keep=stored).collect()
    assert {r.component for r in out} == {1, 2, 3} and all((r.whitened is None) == (r.component > 1) for r in out)
    assert all(math.isclose(r.explained, 1.0 if r.component == 1 else 0.0, abs_tol=1e-12) for r in out)
    one = whitening.whitened(flat.limit(1), keep=stored).collect()
    assert len(one) == 3 and all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.identity_error is None for r in one)
    assert whitening.whitened(flat.limit(0), keep=stored).count() == 0
    nothing = spark.createDataFrame([(1, []), (2, None)], "vec_id long, embedding array<float>")
    assert whitening.whitened(nothing, keep=stored).count() == 0


def test_large_sums_are_exact(spark):
    frame = spark.createDataFrame([(i, [float(2.0 ** 40 + i * 2.0 ** 20), float(i)]) for i in range(4)], "vec_id long, embedding array<double>")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    got = {r.id: r.deviation for r in whitening.whitened(frame, keep=stored).collect()}
    want = {i: d for i, _, d, _, _ in expected(rows, 2).values()}
    assert got == {i: d if d < 1 << 63 else None for i, d in want.items()}
