"""Whitening against brute force with another eigensolver and exact integers."""

import math

import numpy as np
import pytest

from priorframe.llm import whitening


def brute(rows, components=32):
    kept = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    n, sums = len(kept), [sum(col) for col in zip(*[x for _, x in kept], strict=True)]
    y = np.array([[(n * a - s) / n for a, s in zip(x, sums, strict=True)] for _, x in kept])
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)) for _, x in kept]
    return [i for i, _ in kept], n, e, y @ u / np.sqrt(e), deviation, np.trace(y.T @ y / n)


def check(df, rows, components=32):
    ids, n, e, white, deviation, trace = brute(rows, components)
    out = df.collect()
    assert len(out) == len(ids) * len(e)
    assert {r.n for r in out} == {n} and len({r.identity_error for r in out}) == 1
    assert out[0].identity_error < 1e-9
    by_id = {}
    for r in out:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    sign = {}
    for row, i in enumerate(ids):
        for c in range(1, len(e) + 1):
            r = by_id[i][c]
            assert r.deviation == deviation[row]
            assert abs(r.explained - e[c - 1] / trace) < 1e-10
            want = white[row, c - 1]
            if abs(want) > 1e-6:
                sign.setdefault(c, np.sign(want * r.whitened))
            assert abs(sign.get(c, 1) * want - r.whitened) < 1e-6


def test_whole_table(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    check(whitening.whiten(df.repartition(5)), [(r.vec_id, r.embedding) for r in df.collect()])


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    scale = np.array([9.0, 5, 3, 2, 1, 0.7])
    rows = [(i, (rng.normal(size=6) * scale).tolist()) for i in range(200)]
    odd = [(900, None), (901, []), (902, [float("nan")] * 6), (903, [None, 1.0, 2.0, 3.0, 4.0, 5.0]), (904, [math.inf] * 6)]
    df = spark.createDataFrame([(i, v, 1, 2, 3.0) for i, v in rows + odd], "vec_id bigint, embedding array<double>, dim int, at int, whitened double")
    check(whitening.whiten(df.repartition(4)), rows)
    check(whitening.whiten(df, components=2), rows, 2)
    assert whitening.whiten(df.limit(0)).collect() == []
    again = whitening.whiten(df.unionAll(df)).collect()
    assert len(again) == 2 * 200 * 6 and {r.n for r in again} == {400}


def test_no_variance_and_other_lengths(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 5.0]), (3, [1.0, 2.0, 4.0]), (4, [7.0, 7.0]), (None, [1e300, 0.0, 0.0, 1.0]), (6, [0.0, 1.0, 0.0, 0.0])]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    by_id = {}
    for r in out:
        by_id.setdefault(r.vec_id, []).append(r)
    assert set(by_id) == {1, 2, 3, None, 6}  # a single vector of its length has no variance
    assert [r.component for r in by_id[1]] == [1] and by_id[1][0].n == 3 and by_id[None][0].n == 2
    assert math.isclose(abs(by_id[2][0].whitened), math.sqrt(1.5)) and by_id[None][0].deviation is None
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 5, "vec_id int, embedding array<double>")).collect() == []


@pytest.mark.parametrize("rank", [1, 4, 9])
def test_factor_and_rotations(rank):
    rng = np.random.default_rng(rank)
    m = rng.normal(size=(rank, 9)) * np.logspace(0, -5, rank)[:, None]
    a = m.T @ m
    factor = whitening.pivoted_cholesky(a)
    assert factor.shape == (9, rank) and np.allclose(factor @ factor.T, a, atol=1e-14)
    squares, unit = whitening.one_sided_jacobi(factor)
    assert np.allclose(unit.T @ unit, np.eye(rank), atol=1e-13)
    exact = np.linalg.svd(m, compute_uv=False) ** 2
    assert np.allclose(squares, exact, rtol=1e-6) and np.allclose(unit * squares @ unit.T, a, atol=1e-14)
    pairs = [p for i, j in whitening.rounds_of_pairs(rank) for p in zip(i.tolist(), j.tolist(), strict=True)]
    assert len(pairs) == len(set(pairs)) == rank * (rank - 1) // 2
