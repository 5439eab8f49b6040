"""Scores over many edges: blocks of users that are sent the edges of what they rated."""

import numpy as np
import pytest

from ratingloom.operators import sparse_scores
from ratingloom.operators.recommend import top_n
from tests.test_sparse_scores import expected, got, table


@pytest.fixture
def small(monkeypatch):
    for name, size in (("RATINGS_PER_BLOCK", 8), ("EDGES_PER_BLOCK", 6), ("HELD_BLOCKS", 2)):
        monkeypatch.setattr(sparse_scores, name, size)


@pytest.mark.parametrize(("kind", "k", "epsilon"), [("neighbours", 2, 1e-8), ("neighbours", 3, 0.0), ("sum", 0, 0.0), ("deviation", 0, 0.0)])
def test_many_blocks_of_users_and_targets(spark, small, kind, k, epsilon):
    ratings, edges = table(11, 30, 16)
    r = spark.createDataFrame([*ratings, (None, 3, 1.0), (5, None, 2.0), (999, 1, 2.0)], "user_id long, item_id long, rating double")
    e = spark.createDataFrame(edges, "item_i long, item_j long, w double, f double")
    rule = sparse_scores.Rule(kind, k, epsilon)
    want = expected(ratings, edges, kind, k, epsilon)
    have = got(sparse_scores.sparse_scores(r, e, rule))
    assert have.keys() == want.keys() and np.allclose([have[p] for p in want], list(want.values()))
    pairs = [*list(want)[::4], (99, 3), (-20, 1000)]
    asked = got(sparse_scores.sparse_scores(r, e, rule, spark.createDataFrame(pairs * 2, "user_id long, item_id long")))
    assert asked.keys() == {p for p in pairs if p in want} and np.allclose([want[p] for p in asked], list(asked.values()))
    ranked = {}
    for (u, i), s in want.items():
        ranked.setdefault(u, []).append((-round(s, 9), i))
    best = top_n(sparse_scores.sparse_scores(r, e, rule, n=2), None, 2)
    assert {(x["user_id"], x["rank"], x["item_id"]) for x in best.collect()} == {(u, n + 1, i) for u, s in ranked.items() for n, (_, i) in enumerate(sorted(s)[:2])}


def test_edges_are_not_repeated_for_all_blocks_of_users(spark, small):
    """Users of one group never get the edges of the other's items, however many blocks there are."""
    ratings = [(u, u * 10 + i, 1.0) for u in range(20) for i in range(4)]
    edges = [(u * 10 + 5, u * 10 + i, 0.5, 1.0) for u in range(20) for i in range(4)]
    r = spark.createDataFrame(ratings, "user_id long, item_id long, rating double")
    e = spark.createDataFrame(edges, "item_i long, item_j long, w double, f double")
    scores = sparse_scores.sparse_scores(r, e, sparse_scores.Rule("sum"))
    assert "Generate" not in scores._jdf.queryExecution().executedPlan().toString()
    assert got(scores) == {(u, u * 10 + 5): 2.0 for u in range(20)}


def test_cells_of_users_and_target_groups(spark, small, monkeypatch):
    """Parts beyond the open ones are kept packed; an edge is sent to each block of users once, whatever the groups."""
    for name, size in (("HELD_PARTS", 4), ("OPEN_PARTS", 1), ("HELD_ROWS", 50)):
        monkeypatch.setattr(sparse_scores, name, size)
    ratings, edges = table(11, 30, 16)
    r = spark.createDataFrame(ratings, "user_id long, item_id long, rating double")
    e = spark.createDataFrame(edges, "item_i long, item_j long, w double, f double")
    rule = sparse_scores.Rule("neighbours", 3, 1e-8)
    want = expected(ratings, edges, "neighbours", 3, 1e-8)
    for groups in (1, 3):
        have = got(routed(spark, r, e, rule, groups, monkeypatch))
        assert have.keys() == want.keys() and np.allclose([have[p] for p in want], list(want.values()))


def routed(spark, r, e, rule, groups, monkeypatch):
    if groups > 1:  # as if there were rows for that many tasks
        monkeypatch.setattr(sparse_scores, "HELD_PARTS", 10**6)
        rows = (groups * groups) * 5_000
    else:
        rows = r.count()
    return sparse_scores._routed_scores(r, e, 3, rows, rule, None, None, True)


def test_edges_travel_packed_from_where_they_are_read(spark, small):
    r = spark.createDataFrame([(u, i, 1.0) for u in range(9) for i in range(4)], "user_id long, item_id long, rating double")
    e = spark.createDataFrame([(i, j, 0.5, 1.0) for i in range(4) for j in range(4) if i != j], "item_i long, item_j long, w double, f double")
    plan = sparse_scores.sparse_scores(r, e, sparse_scores.Rule("sum"))._jdf.queryExecution().executedPlan().toString()
    assert "collect_list(struct" not in plan and "collect_list(named_struct" not in plan
