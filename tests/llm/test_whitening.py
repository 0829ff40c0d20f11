import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lookback.llm.whitening import jacobi_davidson, whitened

SCHEMA = "vec_id long, embedding array<float>, x int, id string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, "c") for i, v in rows], SCHEMA).repartition(parts)


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 90), st.integers(1, 12), st.floats(0.5, 1.0), st.integers(0, 1000))
def test_eigenpairs_to_double_precision(size, wanted, decay, seed):
    rng = np.random.default_rng(seed)
    wanted = min(wanted, size)
    q = np.linalg.qr(rng.standard_normal((size, size)))[0]
    matrix = (q * decay ** np.arange(size)) @ q.T
    matrix = (matrix + matrix.T) / 2
    values, axes = jacobi_davidson(lambda b: matrix @ b, size, wanted)
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1][:wanted]).max() < 1e-12
    assert np.abs(matrix @ axes - axes * values).max() < 1e-12
    assert np.abs(axes.T @ axes - np.eye(wanted)).max() < 1e-12


def test_few_products_for_a_large_matrix():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((400, 500)) * 0.98 ** np.arange(400)[:, None]
    matrix, count = a @ a.T, []
    values, axes = jacobi_davidson(lambda b: count.append(b.shape[1]) or matrix @ b, 400, 10)
    assert np.abs(matrix @ axes - axes * values).max() < 1e-11 * values[0]
    assert len(count) < 120 and max(count) <= 14


def by_hand(vectors, wanted):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    away = n * x - sums
    centred = away.astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:wanted], axes[:, ::-1][:, :wanted]
    return (away**2).sum(axis=1).tolist(), values, axes, centred @ axes / np.sqrt(values), values / (centred**2).sum() * n


@pytest.mark.parametrize("size, wanted", [(24, 6), (7, 32)])
def test_rows_equal_dense_linear_algebra(spark, size, wanted):
    rng = np.random.default_rng(size)
    good = (rng.standard_normal((300, size)) * 0.8 ** np.arange(size)).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(good)]
    rows += [(5, rows[5][1]), (None, rows[9][1])]
    odd = [None, [], [1.0] * (size - 1), [math.nan] * size, [math.inf] + [0.0] * (size - 1), [None] + [0.0] * (size - 1)]
    got = whitened(frame(spark, rows + [(900 + i, v) for i, v in enumerate(odd)]), wanted=wanted)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    held = got.collect()
    k = min(size, wanted)
    assert len(held) == len(rows) * k
    deviation, values, axes, white, explained = by_hand([v for _, v in rows], k)
    assert Counter((r.vec_id, r.component, r.n, r.deviation) for r in held) == Counter(
        (i, c, len(rows), d) for (i, _), d in zip(rows, deviation, strict=True) for c in range(1, k + 1)
    )
    for c in range(k):
        own = {r.vec_id: r for r in held if r.component == c + 1}
        mine = np.array([own[i].whitened for i, _ in rows])
        assert min(np.abs(mine - white[:, c]).max(), np.abs(mine + white[:, c]).max()) < 1e-6
        assert abs(own[0].explained / explained[c] - 1) < 1e-9
    assert {r.identity_error for r in held} == {held[0].identity_error} and held[0].identity_error < 1e-9


def test_equal_vectors_and_none_give_no_rows(spark):
    assert whitened(frame(spark, [(i, [1.0, 2.0]) for i in range(9)])).count() == 0
    assert whitened(frame(spark, [(1, None), (2, [])])).count() == 0
    assert whitened(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitened(frame(spark, [(1, [3.0])])).count() == 0


def test_components_end_at_the_rank(spark):
    rows = [(i, [float(i % 7), 2.0 * (i % 7), 5.0, float(i % 3)]) for i in range(50)]
    held = whitened(frame(spark, rows)).collect()
    assert {r.component for r in held} == {1, 2} and held[0].identity_error < 1e-9


def test_long_distances_are_exact_or_null(spark):
    rows = [(0, [0.0, 1.0]), (1, [1e6, 1.0]), (2, [3e9, 2.0]), (3, [1e30, 0.5])]
    got = {r.vec_id: r.deviation for r in whitened(frame(spark, rows)).where("component = 1").collect()}
    x = [[min(math.floor(64 * float(np.float32(c))), 1 << 40) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(col) for col in zip(*x)]
    want = [sum((4 * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    assert got == {i: w if w < 1 << 63 else None for i, w in enumerate(want)}
