"""The trained queries against NumPy on the smallest tables."""

import numpy as np
import pytest

import __spark_entry__
from ratingloom.operators import gradient, solvers
from ratingloom.operators.catalog import ALGORITHMS
from ratingloom.plans import trained
from tests.conftest import cells
from tests.test_profiles import first, svdpp
from tests.test_routed import first_state
from tests.test_routed import trained as descended

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    ratings = trained._events(spark, SF).dropna().cache()
    rows = ratings.toPandas()
    users, items = np.unique(rows["user_id"]), np.unique(rows["item_id"])
    r = np.zeros((users.size, items.size))
    r[np.searchsorted(users, rows["user_id"]), np.searchsorted(items, rows["item_id"])] = rows["rating"]
    return ratings, users, items, r


def check(spark, name, events, scores):
    """Every user gets the best unseen items of the scores."""
    _, users, items, r = events
    scores = np.where(r > 0, -np.inf, scores)
    got = cells(__spark_entry__.queries()[name](spark, SF), "user_id", "item_id", "score")
    assert len(got) == sum(min(trained.TOP, n) for n in (r == 0).sum(axis=1))
    for (user, item), score in got.items():
        u, i = np.searchsorted(users, user), np.searchsorted(items, item)
        assert score == pytest.approx(scores[u, i], abs=2e-6)
        assert (scores[u] > score + 1e-5).sum() < trained.TOP


def test_als_at_the_rank_of_the_catalogue(spark, events):
    ratings, _, _, r = events
    defaults = ALGORITHMS["ALS"].defaults()
    k, lam = int(defaults["k"]), defaults["lambda_reg"]
    assert k >= 20 and defaults["iterations"] >= 10
    q = np.array([v for _, v in sorted((x.item_id, x.q) for x in solvers._first_items(ratings, k, 0).collect())])
    p = np.zeros((r.shape[0], k))
    for _ in range(int(defaults["iterations"])):
        for mine, other, seen, values in ((p, q, r > 0, r), (q, p, (r > 0).T, r.T)):
            for n in range(len(mine)):
                v = other[seen[n]]
                mine[n] = np.linalg.solve(v.T @ v + lam * np.eye(k), v.T @ values[n, seen[n]])
    check(spark, "m1_als_trained", events, p @ q.T)


def test_gradient_training_at_the_rank_of_the_catalogue(spark, events):
    ratings, _, _, r = events
    defaults = ALGORITHMS["FunkSVD"].defaults()
    k, steps = int(defaults["k"]), int(defaults["iterations"])
    p, q = first_state(ratings, k, 2.0 / k, -0.5)
    p, q = descended(r, p, q, steps, trained.RATE, defaults["lambda_reg"])[-1]
    assert np.sqrt(((r - p @ q.T)[r > 0] ** 2).mean()) < 0.75 * np.sqrt((r[r > 0] ** 2).mean())
    check(spark, "m3_funk_svd_trained", events, p @ q.T)


def test_svdpp_with_the_parameters_of_the_catalogue(spark, events):
    ratings, _, _, r = events
    d = ALGORITHMS["SVD++"].defaults()
    k = int(d["k"])
    assert k == 100 and d["iterations"] >= 20
    p, q = first(ratings, gradient.Layout(p=k, b=1), gradient.Layout(q=k, b=1, y=k), k)
    lam = (
        np.repeat([d["lambda_p"], d["lambda_bu"]], [k, 1]),
        np.repeat([d["lambda_q"], d["lambda_bi"], d["lambda_y"]], [k, 1, k]),
    )
    _, _, guess = svdpp(r, p, q, int(d["iterations"]), lam, r[r > 0].mean(), d["learning_rate"])
    check(spark, "m7_svdpp_trained", events, guess)
