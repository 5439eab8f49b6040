import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.operators import embeddings, gradient, linear, profiles, ranking, recommend, routed, rules, solvers
from tests.conftest import cells, random_matrix, to_ratings


def test_three_miners_agree(ratings, matrix):
    found = {}
    for name, miner in (("apriori", rules.apriori), ("eclat", rules.eclat), ("fp", rules.fp_growth)):
        found[name] = {tuple(r["items"]): r["count"] for r in miner(ratings, 0.2).collect()}
    assert found["apriori"] == found["eclat"] == found["fp"]
    assert max(len(s) for s in found["apriori"]) >= 3
    seen = matrix > 0
    for items, count in found["apriori"].items():
        assert count == seen[:, list(items)].all(axis=1).sum() >= rules.min_count(len(matrix), 0.2)


def test_rules_and_scores(ratings, matrix):
    sets = rules.apriori(ratings, 0.2)
    support = {tuple(r["items"]): r["support"] for r in sets.collect()}
    found = rules.association_rules(sets, "confidence", 0.6).collect()
    assert any(len(r.consequent) > 1 for r in found)
    best = {}
    for r in found:
        whole = tuple(sorted(r.antecedent + r.consequent))
        assert r.confidence == pytest.approx(support[whole] / support[tuple(r.antecedent)])
        assert r.lift == pytest.approx(r.confidence / support[tuple(r.consequent)])
        for u, row in enumerate(matrix):
            if all(row[i] > 0 for i in r.antecedent):
                for i in r.consequent:
                    if row[i] == 0:
                        best[u, i] = max(best.get((u, i), 0), r.confidence)
    scores = rules.rule_scores(ratings, rules.association_rules(sets, "confidence", 0.6))
    assert cells(scores, "user_id", "item_id", "score") == pytest.approx(best)


@pytest.mark.parametrize("block", [3, 5, 64])
def test_ease_is_the_closed_form(ratings, matrix, block):
    g = matrix.T @ matrix + 20.0 * np.eye(matrix.shape[1])
    p = np.linalg.inv(g)
    want = -p / np.diag(p)[None, :]
    np.fill_diagonal(want, 0)
    for row in linear.fit_ease(ratings, 20.0, block=block).collect():
        assert row.sim == pytest.approx(want[row.item_j, row.item_i], abs=1e-9)


def test_slim_comes_to_rest_at_the_optimum_whatever_the_blocks(ratings, matrix):
    l1, l2, n = 0.02, 0.01, len(matrix)
    g, want = matrix.T @ matrix, np.zeros((matrix.shape[1],) * 2)
    for _ in range(2000):  # plain coordinate descent, far beyond rest
        for k in range(len(g)):
            row = np.maximum((g[k] - g[k] @ want + g[k, k] * want[k]) / n - l1, 0) / (g[k, k] / n + l2)
            row[k] = 0
            want[k] = row
    for block, tol, near in ((7, 1e-4, 1e-2), (64, 1e-9, 1e-6)):
        w = np.zeros_like(want)
        for (target, rated), value in cells(linear.fit_slim(ratings, l1, l2, tol, block=block), "item_i", "item_j", "sim").items():
            w[rated, target] = value
        assert np.abs(w - want).max() < near
    slope = matrix.T @ (matrix @ w - matrix) / n + l2 * w + l1
    off = ~np.eye(len(w), dtype=bool)
    assert np.abs(slope[(w > 0) & off]).max() < 1e-6
    assert slope[(w == 0) & off].min() > -1e-6


def test_slim_on_odd_tables(spark):
    schema = "user_id long, item_id long, rating double"
    assert linear.fit_slim(spark.createDataFrame([], schema)).isEmpty()
    assert linear.fit_slim(spark.createDataFrame([(1, 7, 3.0), (2, 7, 4.0)], schema)).isEmpty()


def test_als_matches_numpy(ratings, matrix):
    model = solvers.fit_als(ratings, 3, 2, 0.1)
    q0 = np.array([r.q for r in solvers._first_items(ratings, 3, 0).orderBy("item_id").collect()])
    seen, r = matrix > 0, matrix.astype(float)
    p = np.zeros((len(r), 3))
    q = q0.copy()
    for _ in range(2):
        for u in range(len(r)):
            m = seen[u]
            p[u] = np.linalg.solve(q[m].T @ q[m] + 0.1 * np.eye(3), q[m].T @ r[u, m])
        for i in range(r.shape[1]):
            m = seen[:, i]
            q[i] = np.linalg.solve(p[m].T @ p[m] + 0.1 * np.eye(3), p[m].T @ r[m, i])
    got = cells(model.score(ratings), "user_id", "item_id", "score")
    for (u, i), score in got.items():
        assert score == pytest.approx(p[u] @ q[i], abs=1e-8)


@pytest.mark.parametrize("how", [{}, {"biases": True}, {"alpha": 40.0}])
def test_hot_ids_get_the_same_solution(ratings, monkeypatch, how):
    plain = cells(solvers.fit_als(ratings, 2, 2, 0.1, **how).score(ratings), "user_id", "item_id", "score")
    monkeypatch.setattr(routed, "BLOCK_ROWS", 4)  # most ids lie in several blocks
    monkeypatch.setattr(routed, "SOLVE_ROWS", 3)
    split = cells(solvers.fit_als(ratings, 2, 2, 0.1, **how).score(ratings), "user_id", "item_id", "score")
    assert split == pytest.approx(plain)


def test_als_objective_falls(ratings):
    history = solvers.fit_als(ratings, 2, 3, 0.1, track=True).history
    assert [h["rmse"] for h in history] == sorted((h["rmse"] for h in history), reverse=True)


@pytest.mark.parametrize("scale", [True, False])
def test_svd_matches_numpy(spark, scale):
    rng = np.random.default_rng(3)
    dense = np.round(rng.random((25, 3)) @ rng.random((3, 9)) * 5 + 0.1 * rng.random((25, 9)), 3)
    model = solvers.fit_svd(to_ratings(spark, dense), 3)
    u, s, vt = np.linalg.svd(dense, full_matrices=False)
    assert model.sigma == pytest.approx(s[:3], rel=1e-8)
    want = (u[:, :3] * (s[:3] if scale else 1.0)) @ vt[:3]
    for (a, b), score in cells(model.score(to_ratings(spark, dense), scale), "user_id", "item_id", "score").items():
        assert score == pytest.approx(want[a, b], abs=1e-6)


@pytest.mark.parametrize("fit", [gradient.fit_funk_svd, gradient.fit_biased_mf, profiles.fit_svdpp, profiles.fit_asvd])
def test_training_error_falls(ratings, fit):
    errors = [fit(ratings, 2, steps, 0.1).train_rmse().first()[0] for steps in (1, 4)]
    assert errors[1] < errors[0]


def test_nmf_stays_non_negative(ratings):
    state = gradient.fit_nmf(ratings, 3, 3, 0.2).factors.state
    assert state.select(F.min(F.array_min("v"))).first()[0] >= 0


def test_salted_training_equals_plain(ratings, monkeypatch):
    plain = cells(gradient.fit_funk_svd(ratings, 2, 2, 0.1).score(ratings), "user_id", "item_id", "score")
    monkeypatch.setattr(gradient, "hot_keys", lambda df, key: [0, 1, 2])
    salted = cells(gradient.fit_funk_svd(ratings, 2, 2, 0.1).score(ratings), "user_id", "item_id", "score")
    assert salted == pytest.approx(plain)


def hashed(a, b, seed):
    return pow(int(a) * 1103515245 + int(b) * 998244353 + seed * 715225739, 5, 2147483647)


@pytest.mark.parametrize("width", [65_536, 4])
def test_negatives_are_the_drawn_unseen_items(spark, width, monkeypatch):
    monkeypatch.setattr(ranking, "SLICE", width)
    matrix = random_matrix(20, 15, 0.4, seed=9)
    matrix[0] = 3  # has seen everything
    df = to_ratings(spark, matrix)
    got = ranking.NegativeSampler(df).draw(3, seed=4).collect()
    items = sorted({i for row in matrix for i in np.flatnonzero(row)})
    want = set()
    for u, row in enumerate(matrix):
        free = [i for i in items if row[i] == 0]
        for i in np.flatnonzero(row):
            for draw in (1, 2, 3):
                wide = hashed(u, i, 4 + draw * 101) * 2147483647 + hashed(i, u, 4 + draw * 101 + 1)
                if free:
                    want.add((u, int(i), draw, free[wide % len(free)]))
    assert {(r.user_id, r.item_id, r.draw, r.neg) for r in got} == want
    assert all(r.user_id != 0 for r in got)


def test_bpr_orders_train_pairs_better_than_chance(spark):
    matrix = np.kron(np.eye(2, dtype=int), np.ones((8, 6), dtype=int)) * 4
    rng = np.random.default_rng(0)
    df = to_ratings(spark, matrix * (rng.random(matrix.shape) < 0.8))
    model = ranking.fit_bpr(df, 2, 8, 2.0, 0.0)
    assert ranking.train_auc(model, df).first()[0] > 0.6


@pytest.mark.parametrize("kind, rows", [("plain", 5), ("margin", 5), ("plain", 2)])
def test_block_scores_rank_like_the_model(ratings, matrix, kind, rows):
    model = ranking.fit_pairwise(ratings, 2, 1, 0.5, kind=kind)
    users, items = model.block_factors()
    best = recommend.score_blocks(users, items, 3, ratings, block_rows=rows).collect()
    pairs = ratings.select("user_id").distinct().crossJoin(ratings.select("item_id").distinct())
    score = cells(model.score(pairs), "user_id", "item_id", "score")
    for u in {r.user_id for r in best}:
        mine = [r.item_id for r in sorted((r for r in best if r.user_id == u), key=lambda r: r["rank"])]
        free = [i for i in range(matrix.shape[1]) if matrix[u, i] == 0]
        assert mine == sorted(free, key=lambda i: (-round(score[u, i], 8), i))[:3]


def test_two_tower_loss_falls(ratings):
    before = ranking.contrastive_loss(ranking.fit_two_tower(ratings, 4, epochs=0), ratings)
    after = ranking.contrastive_loss(ranking.fit_two_tower(ratings, 4, epochs=3, lr=0.5), ratings)
    assert after < before


def test_cbow_examples_have_one_row_per_centre_for_long_histories(spark):
    df = spark.range(2000).selectExpr("1L AS user_id", "id AS item_id").union(
        spark.createDataFrame([(2, 1), (2, 2), (2, 2), (3, 9)], "user_id long, item_id long"))
    found = embeddings.cbow_examples(df)
    sizes = found.groupBy("user_id", F.size("context").alias("n")).count().collect()
    assert {(r.user_id, r.n): r["count"] for r in sizes} == {(1, 1999): 2000, (2, 1): 2}
    assert found.filter("user_id = 2 AND center = 1").first().context == [2]


def test_skip_gram_profiles(spark):
    groups = [([1, 2, 3, 10], 50), ([4, 5, 6], 50), ([7, 8], 50), ([1, 4], 50), ([9], 50)]
    rows, user = [], 0
    for items, times in groups:
        for _ in range(times):
            rows += [(user, i) for i in items]
            user += 1
    liked = spark.createDataFrame(rows, "user_id long, item_id long")
    pairs = {(r.center, r.context): r.n for r in embeddings.skip_gram_pairs(liked).collect()}
    assert pairs[2, 3] == 50 and pairs[1, 4] == 50 and (2, 7) not in pairs
    vectors = embeddings.item_vectors(embeddings.fit_skip_gram(liked.select("item_id"), liked, 4, 6, 2.0))
    near = {(r.item_id, r.similar_id): r.sim for r in embeddings.similar_items(vectors, 9).collect()}
    assert near[2, 3] > near[2, 7]


def test_similar_items_of_a_zero_vector(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0])], "item_id long, v array<double>")
    got = {(r.item_id, r.similar_id): r.sim for r in embeddings.similar_items(df, 2).collect()}
    assert got[1, 2] == pytest.approx(1.0) and got[1, 3] == 0.0 and (1, 1) not in got


def test_sequences(spark):
    rows = [(1, 10, 1), (1, 11, 2), (1, 12, 3), (1, 13, 4), (2, 5, 1)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, ts long")
    got = embeddings.sequences(df, max_len=2).collect()
    assert [(r.user_id, r.input, r.target) for r in got] == [(1, [12, 13], [13, 14])]
    longer = embeddings.sequences(df, max_len=5).first()
    assert longer.input == [0, 0, 11, 12, 13] and longer.target == [0, 0, 12, 13, 14]
