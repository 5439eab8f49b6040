import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.operators import diagnostics, gradient, routed
from tests.conftest import cells


def trained(r, p, q, steps, lr, lam, biased=False, mean=0.0, floor=False):
    """All states of plain mean-gradient descent; with ``biased`` the last entry of a vector is its bias."""
    seen, states = r > 0, []
    k = p.shape[1] - biased
    for _ in range(steps):
        guess = mean + p[:, :k] @ q[:, :k].T + (p[:, k:] + q[:, k:].T if biased else 0.0)
        err = np.where(seen, r - guess, 0.0)
        to_p, to_q = q.copy(), p.copy()
        if biased:
            to_p[:, k], to_q[:, k] = 1.0, 1.0
        gp, gq = err @ to_p / seen.sum(axis=1)[:, None], err.T @ to_q / seen.sum(axis=0)[:, None]
        p, q = p + lr * (gp - lam * p), q + lr * (gq - lam * q)
        if floor:
            p, q = np.maximum(p, 0), np.maximum(q, 0)
        states.append((p, q))
    return states


def first_state(ratings, k, scale, low, bias=0):
    state = gradient.start(ratings, gradient.Layout(p=k, b=bias), gradient.Layout(q=k, b=bias), 0, scale, low)
    return arrays(state)


def arrays(state):
    rows = state.select("side", "id", "v").collect()
    sides = [sorted((r.id, r.v) for r in rows if r.side == s) for s in ("u", "i")]
    return [np.array([v for _, v in side]) for side in sides]


@pytest.mark.parametrize("block_rows", [3, 40, 32768])
def test_training_equals_numpy_whatever_the_blocks(ratings, matrix, block_rows, monkeypatch):
    monkeypatch.setattr(routed, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(routed, "ROUTE_BLOCKS", 2)
    monkeypatch.setattr(routed, "HOT_ROUTES", 2)
    monkeypatch.setattr(routed, "PARTIAL_ROWS", 7)
    p, q = first_state(ratings, 3, 2.0 / 3, -0.5)
    want = trained(matrix, p, q, 4, 0.1, 0.02)
    model = gradient.fit_funk_svd(ratings, 3, 4, 0.1, track=True)
    for got, exact in zip(arrays(model.factors.state), want[-1]):
        assert np.allclose(got, exact, atol=1e-12)
    seen = matrix > 0
    before = (p, q)
    for entry, (p, q) in zip(model.factors.history, want, strict=True):
        assert entry["rmse"] == pytest.approx(np.sqrt(((matrix - p @ q.T)[seen] ** 2).mean()))
        assert entry["p_change"] == pytest.approx(np.linalg.norm(p - before[0]))
        assert entry["q_change"] == pytest.approx(np.linalg.norm(q - before[1]))
        before = (p, q)


def test_biases_and_the_floor_equal_numpy(ratings, matrix, monkeypatch):
    monkeypatch.setattr(routed, "BLOCK_ROWS", 25)
    p, q = first_state(ratings, 2, 1.0, -0.5, bias=1)
    mean = matrix[matrix > 0].mean()
    want = trained(matrix, p, q, 3, 0.1, 0.02, biased=True, mean=mean)[-1]
    for got, exact in zip(arrays(gradient.fit_biased_mf(ratings, 2, 3, 0.1).factors.state), want):
        assert np.allclose(got, exact, atol=1e-12)
    p, q = first_state(ratings, 2, 1.0, 0.0)
    want = trained(matrix, p, q, 3, 0.9, 0.02, floor=True)[-1]
    for got, exact in zip(arrays(gradient.fit_nmf(ratings, 2, 3, 0.9).factors.state), want):
        assert np.allclose(got, exact, atol=1e-12) and (got >= 0).all()


def test_kept_states_and_their_error_curve(ratings, matrix):
    keep = diagnostics.snapshot_iterations(7)
    p, q = first_state(ratings, 2, 1.0, -0.5)
    want = trained(matrix, p, q, 7, 0.1, 0.02)
    model = gradient.fit_funk_svd(ratings, 2, 7, 0.1, keep=keep)
    seen = matrix > 0
    curve = cells(gradient.error_curve(model, ratings), "iteration", "n", "rmse")
    assert sorted(i for i, _ in curve) == keep == [1, 5, 7]
    for (iteration, n), rmse in curve.items():
        p, q = want[iteration - 1]
        for got, exact in zip(arrays(model.factors.snapshots.filter(F.col("iteration") == iteration)), (p, q)):
            assert np.allclose(got, exact, atol=1e-12)
        assert n == seen.sum() and rmse == pytest.approx(np.sqrt(((matrix - p @ q.T)[seen] ** 2).mean()))


def test_training_ends_at_rest(ratings, matrix):
    p, q = first_state(ratings, 2, 1.0, -0.5)
    seen = matrix > 0
    errors = [np.sqrt(((matrix - p @ q.T)[seen] ** 2).mean()) for p, q in [(p, q)] + trained(matrix, p, q, 40, 0.3, 0.02)]
    ends = next(n for n in range(1, 40) if errors[n - 1] - errors[n] < 0.05 * errors[n - 1])
    model = gradient.fit_funk_svd(ratings, 2, 40, 0.3, track=True, tol=0.05, keep=[1])
    assert len(model.factors.history) == ends + 1  # a pass measures the state it begins with
    kept = {r.iteration for r in model.factors.snapshots.select("iteration").distinct().collect()}
    assert kept == {1, ends + 1}  # the last state is always kept


def test_pmf_loss_has_both_priors(ratings, matrix):
    p, q = first_state(ratings, 2, 1.0, -0.5)
    p, q = trained(matrix, p, q, 2, 0.1, 0.1)[-1]
    want = (((matrix - p @ q.T)[matrix > 0] ** 2).sum() + 0.3 * (p**2).sum() + 0.7 * (q**2).sum()) / 2
    model = gradient.fit_pmf(ratings, 2, 2, 0.1, 0.1, 0.1)
    assert gradient.pmf_loss(model, ratings, 0.3, 0.7).first()["loss"] == pytest.approx(want)
    nothing = gradient.pmf_loss(model, ratings.limit(0), 0.3, 0.7).first()["loss"]
    assert nothing == pytest.approx((0.3 * (p**2).sum() + 0.7 * (q**2).sum()) / 2)


def test_odd_tables(spark):
    kind = "user_id long, item_id long, rating double, block string, v int"
    empty = gradient.fit_funk_svd(spark.createDataFrame([], kind), 2, 2, track=True)
    assert empty.factors.state.count() == 0 and empty.factors.history[-1]["rmse"] is None
    rows = [(-5, 1, 2.0, "x", 1), (-5, 1, 2.0, "x", 1), (7, 1, 4.0, None, 2), (2**62, 3, 1.0, "y", 3)]
    nulls = [(None, 1, 3.0, "z", 1), (7, None, 3.0, "z", 1), (7, 3, None, "z", 1)]
    clean = gradient.fit_funk_svd(spark.createDataFrame(rows, kind), 2, 2, 0.1)
    odd = gradient.fit_funk_svd(spark.createDataFrame(rows + nulls, kind), 2, 2, 0.1)
    for got, want in zip(arrays(odd.factors.state), arrays(clean.factors.state), strict=True):
        assert np.allclose(got, want)
