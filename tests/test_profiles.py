"""SVD++, asymmetric SVD and FISM against NumPy, whatever the blocks."""

import numpy as np
import pytest

from ratingloom.operators import gradient, profiles, routed
from tests.conftest import cells
from tests.test_routed import arrays

LR = 0.1


@pytest.fixture(params=[3, 32768])
def small_blocks(request, monkeypatch):
    monkeypatch.setattr(routed, "BLOCK_ROWS", request.param)
    monkeypatch.setattr(routed, "ROUTE_BLOCKS", 2)
    monkeypatch.setattr(routed, "HOT_ROUTES", 2)
    monkeypatch.setattr(routed, "PARTIAL_ROWS", 7)


def svdpp(r, p, q, steps, lam, mean, lr=LR):
    """Users p, b; items q, b, y; ``lam``: one weight, or one per entry of either side."""
    lam_p, lam_q = lam if isinstance(lam, tuple) else (lam, lam)
    seen, k = r > 0, p.shape[1] - 1
    nu, ni = seen.sum(axis=1)[:, None], seen.sum(axis=0)[:, None]
    pushes = seen.T @ nu

    def profile():
        return seen @ q[:, k + 1 :] / np.sqrt(nu)

    def guess():
        return mean + p[:, k:] + q[:, k : k + 1].T + (p[:, :k] + profile()) @ q[:, :k].T

    for _ in range(steps):
        err = np.where(seen, r - guess(), 0.0)
        gu = err @ q[:, :k]
        x = p[:, :k] + profile()
        to_p = np.concatenate([gu, err.sum(axis=1)[:, None]], axis=1) / nu
        to_q = np.concatenate([err.T @ x, err.sum(axis=0)[:, None]], axis=1) / ni
        to_y = seen.T @ (gu / np.sqrt(nu)) / pushes
        p = p + lr * (to_p - lam_p * p)
        q = q + lr * (np.concatenate([to_q, to_y], axis=1) - lam_q * q)
    return p, q, guess()


def asvd(r, b, q, steps, lam, mean):
    """Users b; items q, b, x, y."""
    seen = r > 0
    k = (q.shape[1] - 1) // 3
    nu, ni = seen.sum(axis=1)[:, None], seen.sum(axis=0)[:, None]
    pushes = seen.T @ nu

    def profile():
        gap = np.where(seen, r - mean - b - q[:, k : k + 1].T, 0.0)
        return gap, (gap @ q[:, k + 1 : 2 * k + 1] + seen @ q[:, 2 * k + 1 :]) / np.sqrt(nu)

    def guess():
        return mean + b + q[:, k : k + 1].T + profile()[1] @ q[:, :k].T

    for _ in range(steps):
        gap, z = profile()
        err = np.where(seen, r - guess(), 0.0)
        gu = err @ q[:, :k] / np.sqrt(nu)
        to_q = np.concatenate([err.T @ z, err.sum(axis=0)[:, None]], axis=1) / ni
        to_xy = np.concatenate([gap.T @ gu, seen.T @ gu], axis=1) / pushes
        b = b + LR * (err.sum(axis=1)[:, None] / nu - lam * b)
        q = q + LR * (np.concatenate([to_q, to_xy], axis=1) - lam * q)
    return b, q, guess()


def fism(r, q, steps, lam, alpha):
    """Items q, b, p; scores take an item's own vector out of the sum of its history."""
    seen = r > 0
    k = (q.shape[1] - 1) // 2
    nu, ni = seen.sum(axis=1)[:, None], seen.sum(axis=0)[:, None]
    norm = np.where(nu > 1, np.maximum(nu - 1.0, 1.0) ** -alpha, 0.0)
    pushes = seen.T @ (nu - 1)

    def guess():
        total = seen @ q[:, k + 1 :]
        own = (q[:, :k] * q[:, k + 1 :]).sum(axis=1)
        without = q[:, k] + norm * (total @ q[:, :k].T - own)
        whole = q[:, k] + np.maximum(nu, 1.0) ** -alpha * (total @ q[:, :k].T)
        return np.where(seen, without, whole)

    for _ in range(steps):
        err = np.where(seen, 1.0 - guess(), 0.0)
        total = seen @ q[:, k + 1 :]
        scaled = err * norm
        to_q = scaled.T @ total - scaled.sum(axis=0)[:, None] * q[:, k + 1 :]
        to_b = err.sum(axis=0)[:, None]
        gu = err @ q[:, :k]
        to_p = (seen * norm).T @ gu - scaled.sum(axis=0)[:, None] * q[:, :k]
        share = np.where(pushes > 0, to_p / np.maximum(pushes, 1), 0.0)
        q = q + LR * (np.concatenate([to_q / ni, to_b / ni, share], axis=1) - lam * q)
    return q, guess(), np.where(seen, 1.0 - guess(), 0.0)


def first(ratings, user, item, k):
    return arrays(gradient.start(ratings, user, item, 0, 2.0 / k, -0.5))


def same_scores(model, ratings, guess):
    pairs = ratings.select("user_id").distinct().crossJoin(ratings.select("item_id").distinct())
    for (u, i), score in cells(model.score(pairs), "user_id", "item_id", "score").items():
        assert score == pytest.approx(guess[u, i], abs=1e-9)


def test_svdpp(ratings, matrix, small_blocks):
    mean = matrix[matrix > 0].mean()
    p, q = first(ratings, gradient.Layout(p=3, b=1), gradient.Layout(q=3, b=1, y=3), 3)
    p, q, guess = svdpp(matrix, p, q, 3, 0.02, mean)
    model = profiles.fit_svdpp(ratings, 3, 3, LR)
    for got, want in zip(arrays(model.factors.state), (p, q), strict=True):
        assert np.allclose(got, want, atol=1e-12)
    same_scores(model, ratings, guess)


def test_asvd(ratings, matrix, small_blocks):
    mean = matrix[matrix > 0].mean()
    b, q = first(ratings, gradient.Layout(b=1), gradient.Layout(q=3, b=1, x=3, y=3), 3)
    b, q, guess = asvd(matrix, b, q, 3, 0.02, mean)
    model = profiles.fit_asvd(ratings, 3, 3, LR)
    for got, want in zip(arrays(model.factors.state), (b, q), strict=True):
        assert np.allclose(got, want, atol=1e-12)
    same_scores(model, ratings, guess)


def test_fism(ratings, matrix, small_blocks):
    _, q = first(ratings, gradient.Layout(p=1), gradient.Layout(q=3, b=1, p=3), 3)
    q, guess, err = fism(matrix, q, 3, 0.02, 0.5)
    model = profiles.fit_fism(ratings, 3, 3, LR, 0.02, 0.5)
    got = model.factors.state.select("id", "v").orderBy("id").collect()
    assert np.allclose([r.v for r in got], q, atol=1e-12)
    same_scores(model, ratings, guess)
    assert model.loss(0.3).first()["loss"] == pytest.approx((err**2).sum() + 0.15 * (q**2).sum())


def test_history_of_the_error_and_the_changes(ratings, matrix):
    mean = matrix[matrix > 0].mean()
    p, q = first(ratings, gradient.Layout(p=2, b=1), gradient.Layout(q=2, b=1, y=2), 2)
    seen = matrix > 0
    history = profiles.fit_svdpp(ratings, 2, 3, LR, track=True).factors.history
    for entry in history:
        p1, q1, guess = svdpp(matrix, p, q, 1, 0.02, mean)
        assert entry["rmse"] == pytest.approx(np.sqrt(((matrix - guess)[seen] ** 2).mean()))
        assert entry["p_change"] == pytest.approx(np.linalg.norm(p1 - p))
        p, q = p1, q1
    assert [h["iteration"] for h in history] == [1, 2, 3]


@pytest.mark.parametrize("fit", [profiles.fit_svdpp, profiles.fit_asvd, profiles.fit_fism])
def test_odd_tables(spark, fit):
    kind = "user_id long, item_id long, rating double, v int, z string"
    assert fit(spark.createDataFrame([], kind), 2, 2).factors.state.isEmpty()
    rows = [(-5, 1, 2.0, 1, "x"), (-5, 1, 2.0, 1, "x"), (7, 1, 4.0, 2, None), (2**62, 3, 1.0, 3, "y")]
    nulls = [(None, 1, 3.0, 1, "z"), (7, None, 3.0, 1, "z")]
    clean = fit(spark.createDataFrame(rows, kind), 2, 2)
    odd = fit(spark.createDataFrame(rows + nulls, kind), 2, 2)
    pairs = spark.createDataFrame([(-5, 1), (7, 1), (7, 3), (7, 99), (None, 1)], "user_id long, item_id long")
    got, want = (cells(m.score(pairs).distinct(), "user_id", "item_id", "score") for m in (odd, clean))
    assert set(want) == {(-5, 1), (7, 1), (7, 3)}
    if fit is profiles.fit_fism:
        assert got == pytest.approx(want)
    else:  # the mean is over all rows that have a rating
        assert set(got) == set(want)
