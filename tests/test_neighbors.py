import numpy as np
import pytest

from ratingloom.operators import neighbors, pairs
from ratingloom.operators.prepare import history_chunks
from tests.conftest import TOY, cells, random_matrix, to_ratings


def brute_pairs(matrix):
    r = np.asarray(matrix, dtype=float)
    seen = (r > 0).astype(float)
    n, dot, cross = seen.T @ seen, r.T @ r, r.T @ seen
    size = r.shape[1]
    return {
        (i, j): (int(n[i, j]), dot[i, j], cross[i, j] - cross[j, i])
        for i in range(size) for j in range(i + 1, size) if n[i, j] > 0
    }


@pytest.mark.parametrize("chunk,dense", [(1024, 512), (1024, 0), (3, 512), (1, 512)])
def test_pair_stats_whatever_the_chunk(spark, ratings, matrix, chunk, dense, monkeypatch):
    monkeypatch.setattr(pairs, "DENSE_ITEMS", dense)
    monkeypatch.setattr(pairs, "PAIRS_PER_STEP", 50)
    got = {(r.item_i, r.item_j): (r.n_co, r.dot, r.diff) for r in pairs.pair_stats(ratings, chunk).collect()}
    want = brute_pairs(matrix)
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key])


def test_long_history_is_cut_into_bounded_chunks(spark):
    rows = [(1, i, 1.0) for i in range(500)] + [(2, i, 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    tiles = history_chunks(df, ["rating"], limit=50).collect()
    assert max(len(t["items"]) for t in tiles) < 100
    assert sum(t["user_id"] == 2 for t in tiles) == 1
    assert sorted(i for t in tiles if t["user_id"] == 1 for i in t["items"]) == list(range(500))


def test_toy_facts(toy):
    dev = {(r.item_i, r.item_j): (r.dev, r.freq) for r in neighbors.slope_one_deviations(toy).collect()}
    assert dev[0, 3] == (1.0, 3) and dev[3, 0] == (-1.0, 3)
    assert cells(neighbors.popularity(toy), "item_id", "score") == {(0,): 12, (1,): 5, (2,): 12, (3,): 11, (4,): 12, (5,): 13}


def brute_similarity(matrix, metric):
    r = np.asarray(matrix, dtype=float)
    if metric == "adjusted_cosine":
        r = r - np.where(r > 0, r.mean(axis=1, keepdims=True), 0)
    if metric == "pearson":
        with np.errstate(all="ignore"):
            return np.nan_to_num(np.corrcoef(r.T))
    size = np.linalg.norm(r, axis=0)
    return (r.T @ r) / np.outer(np.where(size > 0, size, 1), np.where(size > 0, size, 1))


@pytest.mark.parametrize("metric", ["cosine", "adjusted_cosine", "pearson"])
def test_item_similarity_and_scores(ratings, matrix, metric):
    sim = brute_similarity(matrix, metric)
    count = (matrix > 0).T.astype(int) @ (matrix > 0).astype(int)
    sim = np.where(count >= 3, sim, 0) * count / (count + 4.0)
    np.fill_diagonal(sim, 0)
    edges = neighbors.item_similarity(ratings, metric, min_support=3, shrinkage=4)
    for row in edges.collect():
        assert row.sim == pytest.approx(sim[row.item_i, row.item_j], abs=1e-9)
    got = cells(neighbors.item_knn_scores(ratings, edges, k=4), "user_id", "item_id", "score")
    for u in range(len(matrix)):
        rated = np.flatnonzero(matrix[u])
        for i in np.flatnonzero(matrix[u] == 0):
            best = sorted(rated, key=lambda j: (-round(abs(sim[i, j]), 9), j))[:4]
            want = (sim[i, best] @ matrix[u, best]) / (np.abs(sim[i, best]).sum() + 1e-8)
            assert got.get((u, i), 0.0) == pytest.approx(want, abs=1e-7)


def test_target_scores_equal_full_scores(ratings):
    edges = neighbors.item_similarity(ratings)
    full = cells(neighbors.item_knn_scores(ratings, edges, 5), "user_id", "item_id", "score")
    pairs_df = neighbors.item_knn_scores(ratings, edges, 5).select("user_id", "item_id").filter("user_id < 9")
    part = cells(neighbors.item_knn_scores(ratings, edges, 5, targets=pairs_df), "user_id", "item_id", "score")
    assert part and all(full[k] == pytest.approx(v) for k, v in part.items())


@pytest.mark.parametrize("metric", ["cosine", "pearson"])
@pytest.mark.parametrize("k", [2, 6, 40])
def test_user_knn_counts_zero_neighbours_as_slots(spark, metric, k):
    matrix = random_matrix(14, 9, 0.35, seed=5)
    r = matrix.astype(float)
    mean = np.divide(r.sum(1), (r > 0).sum(1), out=np.zeros(len(r)), where=(r > 0).sum(1) > 0)
    base = r - np.where(r > 0, mean[:, None], 0) if metric == "pearson" else r
    size = np.linalg.norm(base, axis=1)
    sim = base @ base.T / np.outer(np.where(size > 0, size, 1), np.where(size > 0, size, 1))
    np.fill_diagonal(sim, 0)
    df = to_ratings(spark, matrix)
    got = cells(neighbors.user_knn_scores(df, neighbors.user_similarity(df, metric), k), "user_id", "item_id", "score")
    for u in range(len(r)):
        if not r[u].any():
            continue
        for i in np.flatnonzero(r[u] == 0):
            raters = [v for v in np.flatnonzero(r[:, i]) if v != u]
            near = sorted(raters, key=lambda v: (-round(sim[u, v], 9), v))[:k]
            den = sum(abs(sim[u, v]) for v in near if abs(round(sim[u, v], 9)) > 0)
            if den > 0:
                num = sum(sim[u, v] * (r[v, i] - mean[v]) for v in near)
                assert got[u, i] == pytest.approx(min(5, max(0, mean[u] + num / den)), abs=1e-6)
            else:
                assert (u, i) not in got


def test_slope_one_scores(ratings, matrix):
    stats = brute_pairs(matrix)
    got = cells(neighbors.slope_one_scores(ratings, neighbors.slope_one_deviations(ratings)), "user_id", "item_id", "score")
    for (u, j), score in got.items():
        num = den = 0.0
        for i in np.flatnonzero(matrix[u]):
            n, _, diff = stats.get((min(i, j), max(i, j)), (0, 0, 0))
            dev = (diff if j < i else -diff) / n if n else 0
            num, den = num + (matrix[u, i] + dev) * n, den + n
        assert score == pytest.approx(num / den)
        assert matrix[u, j] == 0


def test_popular_for_users_skips_seen(toy):
    got = neighbors.popular_for_users(toy, 2).collect()
    best = {}
    for row in sorted(got, key=lambda r: (r.user_id, r["rank"])):
        best.setdefault(row.user_id, []).append(row.item_id)
    assert best == {0: [5, 2], 1: [2, 1], 2: [4], 3: [5, 0], 4: [3, 1]}
    assert all(TOY[u][i] == 0 for u, items in best.items() for i in items)


def test_popular_for_users_at_the_edges(spark, monkeypatch):
    schema = "user_id long, item_id long, rating double"
    assert neighbors.popular_for_users(spark.createDataFrame([], schema), 3).isEmpty()
    monkeypatch.setattr(neighbors, "hot_keys", lambda df, key: [r[0] for r in df.select(key).distinct().collect() if r[0] is not None])  # all are hot
    rows = spark.createDataFrame([(1, 10, 2.0), (1, 11, 1.0), (2, 10, 2.0), (None, 11, 5.0)], schema)
    got = {(r.user_id, r.item_id, r.score, r["rank"]) for r in neighbors.popular_for_users(rows, 5).collect()}
    assert got == {(2, 11, 6.0, 1), (None, 10, 4.0, 1)}  # user 1 has seen everything


def test_pagerank_weights(ratings, matrix):
    seen = (matrix > 0).astype(float)
    c = seen.T @ seen
    np.fill_diagonal(c, 0)
    w = c / c.sum(1, keepdims=True)
    pr = np.ones(len(c)) / len(c)
    for _ in range(100):
        new = 0.15 / len(c) + 0.85 * (w.T @ pr)
        if np.abs(new - pr).sum() < 1e-6:
            break
        pr = new
    want = (pr - pr.min()) / (pr.max() - pr.min())
    got = cells(neighbors.cooccurrence_pagerank(ratings), "item_id", "weight")
    assert [got[i,] for i in range(len(c))] == pytest.approx(list(want), abs=1e-9)
