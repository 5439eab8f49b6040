"""Block scoring and the rule trie against plain loops, in one block and in many."""

import random

import numpy as np
import pytest

from ratingloom.operators import neighbors, rule_trie, rules, sparse_scores
from ratingloom.operators.recommend import top_n


def table(seed=3, users=25, items=14):
    rng = random.Random(seed)
    ratings = [(u * 7 - 20, i * 3, float(rng.randint(1, 5))) for u in range(users) for i in range(items) if rng.random() < 0.4]
    edges = [(i * 3, j * 3, rng.choice([0.0, 0.5, -0.5, rng.uniform(-1, 1)]), float(rng.randint(1, 9))) for i in range(items + 2) for j in range(items) if i != j and rng.random() < 0.6]
    return ratings, edges


def expected(ratings, edges, kind, k=3, epsilon=1e-8, unseen=True):
    out, seen = {}, {(u, i) for u, i, _ in ratings}
    met = {}
    for u, j, r in ratings:
        for i, source, w, f in edges:
            if source == j and not (unseen and (u, i) in seen) and (kind != "neighbours" or w):
                met.setdefault((u, i), []).append((-round(abs(w), 9), j, w, r, f))
    for pair, entries in met.items():
        if kind == "neighbours":
            near = sorted(entries)[:k]
            below = sum(abs(e[2]) for e in near)
            if epsilon or below > 1e-8:
                out[pair] = sum(e[2] * e[3] for e in near) / (below + epsilon)
        elif kind == "sum":
            out[pair] = sum(e[2] * e[3] for e in entries)
        else:
            out[pair] = sum((e[3] + e[2]) * e[4] for e in entries) / sum(e[4] for e in entries)
    return out


def got(df):
    rows = df.collect()
    found = {(r["user_id"], r["item_id"]): r["score"] for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.fixture(params=[(200_000, 500_000), (20, 30)], ids=["one block", "many blocks"])
def blocks(request, monkeypatch):
    monkeypatch.setattr(sparse_scores, "RATINGS_PER_BLOCK", request.param[0])
    monkeypatch.setattr(sparse_scores, "EDGES_PER_BLOCK", request.param[1])


@pytest.mark.parametrize("kind", ["neighbours", "sum", "deviation"])
def test_scores_as_in_loops(spark, blocks, kind):
    ratings, edges = table()
    r = spark.createDataFrame([*ratings, (None, 3, 1.0), (5, None, 2.0), (5, 3, None)], "user_id long, item_id long, rating double")
    e = spark.createDataFrame(edges, "item_i long, item_j long, w double, f double")
    rule = sparse_scores.Rule(kind, 3, 1e-8)
    for unseen in (True, False):
        want = expected(ratings, edges, kind, unseen=unseen)
        have = got(sparse_scores.sparse_scores(r, e, rule, unseen=unseen))
        assert have.keys() == want.keys() and np.allclose([have[p] for p in want], list(want.values()))
    pairs = [*list(want)[::3], (99, 3), (-20, 1000)]
    targets = spark.createDataFrame(pairs + pairs[:4], "user_id long, item_id long")
    asked = got(sparse_scores.sparse_scores(r, e, rule, targets, unseen=False))
    assert asked.keys() == {p for p in pairs if p in want} and np.allclose([want[p] for p in asked], list(asked.values()))
    best = top_n(sparse_scores.sparse_scores(r, e, rule, n=2, unseen=False), None, 2)
    ranked = {}
    for (u, i), s in want.items():
        ranked.setdefault(u, []).append((-round(s, 9), i))
    assert {(x["user_id"], x["rank"], x["item_id"]) for x in best.collect()} == {(u, n + 1, i) for u, s in ranked.items() for n, (_, i) in enumerate(sorted(s)[:2])}


def test_small_steps_and_empty_tables(spark, monkeypatch):
    ratings, edges = table(5)
    columns = [np.array(c) for c in zip(*ratings, strict=True)] + [np.array(c) for c in zip(*edges, strict=True)]
    row = dict(zip(["users", "items", "ratings", "targets", "sources", "weights", "freqs"], columns, strict=True), asked_users=None, asked_items=None)
    monkeypatch.setattr(sparse_scores, "STEP", 40)
    rows = [r for b in sparse_scores._meeting(row, sparse_scores.Rule("sum"), None, True) for r in b.to_pylist()]
    want = expected(ratings, edges, "sum")
    assert len(rows) == len(want) and all(np.isclose(want[r["user_id"], r["item_id"]], r["score"]) for r in rows)
    none = spark.createDataFrame([], "user_id long, item_id long, rating double")
    few = spark.createDataFrame(edges[:3], "item_i long, item_j long, sim double, f double")
    assert neighbors.propagate(none, few).collect() == []
    some = spark.createDataFrame(ratings, "user_id long, item_id long, rating double")
    assert neighbors.propagate(some, few.limit(0)).collect() == []


@pytest.mark.parametrize(("rules_per_block", "ratings_per_block", "step"), [(200_000, 100_000, 1_000_000), (5, 30, 7)])
def test_rules_fire_as_in_loops(spark, monkeypatch, rules_per_block, ratings_per_block, step):
    monkeypatch.setattr(rule_trie, "RULES_PER_BLOCK", rules_per_block)
    monkeypatch.setattr(rule_trie, "RATINGS_PER_BLOCK", ratings_per_block)
    rng = random.Random(2)
    ratings = [(u, i * 5 - 10) for u in range(40) for i in range(9) if rng.random() < 0.5]
    found = [(sorted(rng.sample(range(-10, 35, 5), rng.randint(1, 4))), [rng.choice([40, 45, 0, -10])], rng.random()) for _ in range(60)]
    found.append(([1000, 2000], [40], 1.0))
    frame = spark.createDataFrame([(u, i, 1.0) for u, i in ratings] * 2, "user_id long, item_id long, rating double")
    scores = rules.rule_scores(frame, spark.createDataFrame(found, "antecedent array<long>, consequent array<long>, confidence double"))
    want = {}
    for u in range(40):
        mine = {i for v, i in ratings if v == u}
        for antecedent, (item,), confidence in found:
            if mine.issuperset(antecedent) and item not in mine:
                want[u, item] = max(confidence, want.get((u, item), 0))
    assert got(scores) == want
    monkeypatch.setattr(rule_trie, "STEP", step)
    best = {}
    for antecedent, (item,), confidence in found:
        best[tuple(antecedent), item] = max(confidence, best.get((tuple(antecedent), item), 0))
    trie = rule_trie._Trie([np.array(a) for a, _ in best], np.array([i for _, i in best]), np.array(list(best.values())))
    users, items = (np.array(c) for c in zip(*ratings, strict=True))
    fired = {(r["user_id"], r["item_id"]): r["score"] for b in rule_trie._fire(trie, users, items) for r in b.to_pylist()}
    assert fired == want


def test_no_plan_expands_histories(spark):
    ratings, edges = table()
    r = spark.createDataFrame(ratings, "user_id long, item_id long, rating double")
    e = spark.createDataFrame(edges, "item_i long, item_j long, sim double, f double")
    plan = neighbors.item_knn_scores(r, e, 3, n=5)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "MapInArrow" in plan
