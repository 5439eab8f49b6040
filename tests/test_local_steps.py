"""Steps that keep the owners' vectors with their block: same results, and only the other side travels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.operators import gradient, profiles, routed, solvers
from tests.conftest import cells


@pytest.fixture
def sent(monkeypatch):
    """Sides whose rows were sent to the blocks."""
    names, send = [], routed.Blocks.sent
    monkeypatch.setattr(routed.Blocks, "sent", lambda self, name, table: names.append(name) or send(self, name, table))
    return names


@pytest.mark.parametrize("full", [0, 32])
def test_sums_of_a_block_equal_numpy(full, monkeypatch):
    monkeypatch.setattr(routed, "GRID_CELLS", full)
    rng = np.random.default_rng(3)
    o, t = np.sort(np.concatenate([np.arange(5), rng.integers(0, 5, 20)])), rng.integers(0, 4, 25)  # pairs come twice
    w, p, q = rng.random(25), rng.random((5, 3)), rng.random((4, 3))
    block = routed.Cells(o, t, 5, 4)
    assert np.allclose(block.products(p, q), [p[a] @ q[b] for a, b in zip(o, t)])
    for weights in (w, None):
        x = np.ones(25) if weights is None else weights
        assert np.allclose(block.to_owners(weights, q), [(x[o == a, None] * q[t[o == a]]).sum(axis=0) for a in range(5)])
        assert np.allclose(block.to_others(weights, p), [(x[t == b, None] * p[o[t == b]]).sum(axis=0) for b in range(4)])
    p[0] = np.inf  # an owner that left the numbers touches the ids it rated, no other
    assert np.isfinite(block.to_others(w, p)).all(axis=1).tolist() == [not ((o == 0) & (t == b)).any() for b in range(4)]


@pytest.mark.parametrize("values", [3, 400])
def test_packed_ratings_come_back(values):
    import pandas as pd

    rng = np.random.default_rng(4)
    owner, other, rating = rng.integers(-3, 20, 900), rng.integers(0, 300, 900), rng.integers(0, values, 900) / 7
    row = routed._pack(pd.DataFrame({"block": 0, "owner": owner, "other": other, "rating": rating})).iloc[0]
    o, t, r = routed._unpacked(row.o, row.t, row.r, row.c)
    assert sorted(zip(row.owners[o], row.others[t], r)) == sorted(zip(owner, other, rating))
    assert len(row.o) + len(row.t) + len(row.c) < 900 * 4


def test_users_are_sent_once_however_many_steps(ratings, sent):
    gradient.fit_funk_svd(ratings, 2, 3, 0.1)
    assert sent.count("owners") == 1 and sent.count("others") == 3


@pytest.mark.parametrize("fit", [profiles.fit_svdpp, profiles.fit_asvd, profiles.fit_fism])
def test_profile_models_send_users_at_most_once(spark, sent, fit):
    rows = [(1, 1, 2.0), (1, 2, 4.0), (2, 1, 5.0), (3, 2, 1.0), (None, 2, 3.0), (3, None, 3.0), (4, 9, None)]
    model = fit(spark.createDataFrame(rows, "user_id long, item_id long, rating double"), 2, 2)
    assert sent.count("owners") == (fit is not profiles.fit_fism) and sent.count("others") == 2
    ids = {(r.side, r.id) for r in model.factors.state.collect()}
    assert {("i", None), ("i", 9)} < ids  # ids without a rating keep a row
    if fit is not profiles.fit_fism:
        assert {("u", None), ("u", 4)} < ids


@pytest.mark.parametrize("options", [{}, {"biases": True}, {"alpha": 40.0}])
def test_one_pass_least_squares(ratings, monkeypatch, options):
    monkeypatch.setattr(routed, "BLOCK_ROWS", 40)
    cut, made = routed.Blocks.of, []
    monkeypatch.setattr(solvers.Blocks, "of", lambda *a: made.append(a) or cut(*a))
    found = []
    for locally in (True, False):
        if not locally:
            monkeypatch.setattr(solvers, "sums_are_smaller", lambda blocks, k: False)
        model = solvers.fit_als(ratings, 3, 2, **options)
        found.append([cells(t, k, v) for t, k, v in ((model.users, "user_id", "p"), (model.users, "user_id", "bu"),
                                                     (model.items, "item_id", "q"), (model.items, "item_id", "bi"))])
        assert len(made) == (1 if locally else 3)  # no blocks of items
    for one, two in zip(*found, strict=True):
        assert one.keys() == two.keys() and all(np.allclose(one[x], two[x], atol=1e-9) for x in one)


def test_steps_broadcast_nothing(ratings):
    blocks = routed.Blocks.of(ratings)
    items = gradient.start(ratings, gradient.Layout(), gradient.Layout(q=2), 0, 1.0, 0.0).filter(F.col("side") == "i")
    plan = blocks.sent("others", items.select("id", "v"))._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
