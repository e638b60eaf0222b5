"""Whitening against the covariance's own decomposition."""

import numpy as np
import pytest

from quartermill.llm.whitening import Spectrum, rank_one, whiten


def scatter(rows):
    off = rows - rows.mean(0)
    return off.T @ off


def rows_of(seed, n, d, case):
    rng = np.random.default_rng(seed)
    x = np.floor(rng.normal(size=(n, d)) * 10 * (1 + np.arange(d) % 5))
    if case == "repeats":
        x = x[rng.integers(0, max(1, n // 4), n)]
    if case == "equal columns" and d > 2:
        x[:, 1], x[:, 2] = x[:, 0], 3
    if case == "one direction":
        x = np.outer(x[:, 0], np.ones(d))
    if case == "scales":
        x = x * 10.0 ** -np.arange(d)
    return x


@pytest.mark.parametrize("case", ["plain", "repeats", "equal columns", "one direction", "scales"])
@pytest.mark.parametrize("n,d", [(1, 3), (2, 1), (40, 4), (30, 20), (200, 16)])
def test_updates_and_merges_give_the_scatter(case, n, d):
    x = rows_of(n, n, d, case)
    whole, halves = Spectrum(d), [Spectrum(d), Spectrum(d)]
    for k, row in enumerate(x):
        whole.add(row)
        halves[k * 3 // (2 * n)].add(row)
    halves[0].merge(halves[1])
    want = scatter(x)
    for s in (whole, halves[0]):
        size = max(np.abs(want).max(), 1e-9)
        assert np.abs((s.vectors * s.values) @ s.vectors.T - want).max() < 1e-11 * size * d
        assert np.abs(s.vectors.T @ s.vectors - np.eye(d)).max() < 1e-11
        assert np.all(np.diff(s.values) >= -1e-9 * size) and np.allclose(s.mean, x.mean(0)) and s.n == n


def test_rank_one_keeps_what_it_does_not_touch():
    values, vectors = rank_one(np.array([1.0, 2.0, 2.0, 5.0]), np.eye(4), 2.0, np.array([0.0, 1.0, 1.0, 0.0]))
    assert np.allclose(values, [1, 2, 5, 6])
    assert np.allclose((vectors * values) @ vectors.T, np.diag([1.0, 2, 2, 5]) + 2 * np.outer([0, 1, 1, 0], [0, 1, 1, 0]))


def brute(vectors, components=16):
    x = np.floor(np.array(vectors, float) * 64).astype(int) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    covariance = (fit - s / n).T @ (fit - s / n) / n
    e, q = np.linalg.eigh(covariance)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    return n, ((n * x - s) ** 2).sum(1), ((x - s / n) @ q) / np.sqrt(e), e / np.trace(covariance)


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_same_as_numpy(frame, partitions):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 20)) * (1 + np.arange(20)) / 20
    x[250:] = x[:50]
    df = frame("vec_id long, embedding array<double>", [(k, v.tolist()) for k, v in enumerate(x)]).repartition(partitions)
    out = {r["vec_id"]: r for r in whiten(df).collect()}
    n, deviation, whitened, explained = brute(x)
    assert len(out) == 300 and all(out[k]["n"] == n == 250 and out[k]["deviation"] == deviation[k] for k in out)
    mine = np.array([out[k]["whitened"] for k in range(300)])
    sign = np.sign((mine * whitened).sum(0))
    assert np.abs(mine * sign - whitened).max() < 1e-8
    assert np.allclose(out[0]["explained"], explained, rtol=1e-10) and out[0]["identity_error"] < 1e-10
    assert len({tuple(r["explained"]) for r in out.values()}) == 1


def test_rows_that_take_no_part_and_other_columns(frame):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 5), (2, None, 5), (3, [nan, 1.0], 5), (4, [inf, 1.0], 5), (5, [None, 1.0], 5), (6, [], 5), (None, [3.0, -1.0], 6), (8, [0.0, 0.5], 7), (8, [0.0, 0.5], 7)]
    out = whiten(frame("vec_id long, embedding array<float>, n int", rows))
    assert out.columns == ["vec_id", "embedding", "n", "deviation", "whitened", "explained", "identity_error"]
    got = sorted(((r["vec_id"], r["n"], r["deviation"]) for r in out.collect()), key=str)
    n, deviation, _, _ = brute([[1, 2], [3, -1], [0, 0.5], [0, 0.5]])
    assert got == sorted([(1, n, deviation[0]), (None, n, deviation[1]), (8, n, deviation[2]), (8, n, deviation[3])], key=str)


def test_few_directions(frame):
    rows = [(k, [float(k), 2.0 * k, 7.0]) for k in range(6)]
    assert {len(r["whitened"]) for r in whiten(frame("vec_id long, embedding array<double>", rows)).collect()} == {1}
    alone = whiten(frame("vec_id long, embedding array<double>", [(1, [1.0, 2.0])] * 3)).collect()
    assert [r["whitened"] for r in alone] == [[]] * 3 and all(r["deviation"] == 0 for r in alone)


def test_empty_table_and_lengths(frame):
    assert whiten(frame("vec_id long, embedding array<float>", [])).collect() == []
    assert whiten(frame("vec_id long, embedding array<float>", [(1, None)])).collect() == []
    with pytest.raises(ValueError, match="lengths"):
        whiten(frame("vec_id long, embedding array<float>", [(1, [1.0]), (2, [1.0, 2.0])]))


def test_large_entries_stay_exact_or_are_an_error(frame):
    x = [[2.0**19 * k, 2.0**19 / 3 * k * k] for k in range(3)]
    out = {r["vec_id"]: r for r in whiten(frame("vec_id long, embedding array<double>", list(enumerate(x)))).collect()}
    n, deviation, _, _ = brute(x)
    assert all(out[k]["n"] == n and out[k]["deviation"] == deviation[k] for k in range(3))
    huge = frame("vec_id long, embedding array<double>", [(1, [2.0**40]), (2, [0.0])])
    with pytest.raises(Exception, match="(?i)overflow|too large|int too big"):
        whiten(huge).collect()
