"""The best of a meeting of blocks against sorting every row, and the size of blocks of large tables."""

from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.operators import recommend


def sorted_rows(users, items, scores, n):
    out = {}
    for u, row in zip(users, scores, strict=True):
        best = sorted((-round(x, 9), i, x) for i, x in zip(items, row, strict=True) if not np.isnan(x))[:n]
        out[u] = [(i, x) for _, i, x in best if np.isfinite(x)]
    return out


@pytest.mark.parametrize(("height", "width", "tile"), [(7, 5, 3), (40, 700, 2048), (40, 1500, 600), (3, 9, 2048)])
def test_best_rows_as_by_sorting(monkeypatch, height, width, tile):
    monkeypatch.setattr(recommend, "BLOCK_ROWS", tile)
    rng = np.random.default_rng(width)
    users, items = rng.permutation(height) * 3 - 5, rng.permutation(width) * 2 - 9
    p, q = rng.integers(-3, 4, (height, 2)).astype(float), rng.integers(-3, 4, (width, 2)) + rng.integers(0, 2, (width, 2)) * 2e-10
    p[0], p[1] = np.nan, 1e12
    seen = [(u, i) for u in users for i in items if rng.random() < 0.2] + [(users[2], i) for i in items] + [(users[1], 1)]
    row = SimpleNamespace(u_ids=users, i_ids=items, u_flat=p.ravel(), i_flat=q.ravel(), s_users=[u for u, _ in seen], s_items=[i for _, i in seen])
    scores = p @ q.T
    known = set(seen)
    for a, u in enumerate(users):
        for b, i in enumerate(items):
            if (u, i) in known:
                scores[a, b] = -np.inf
    want = sorted_rows(users, items, scores, 6)
    got = recommend._best_rows(row, 6)
    for u in users:
        mine = got[got.user_id == u]
        assert [(i, pytest.approx(x)) for i, x in zip(mine.item_id, mine.score, strict=True)] == want[u]


def test_large_tables_meet_in_larger_blocks(spark, monkeypatch):
    """Before, 40 rows in blocks of 2 were 400 meetings."""
    monkeypatch.setattr(recommend, "BLOCK_ROWS", 2)
    vectors = spark.range(40).select(F.col("id").alias("item_id"), F.array(F.sin("id"), F.cos("id")).alias("q"))
    users = vectors.select(F.col("item_id").alias("user_id"), F.col("q").alias("p"))
    seen = []
    packed = recommend._packed
    monkeypatch.setattr(recommend, "_packed", lambda *a: seen.append(a[4]) or packed(*a))
    rows = recommend.score_blocks(users, vectors, 3, block_rows=recommend.BLOCK_ROWS).collect()
    assert seen == [4, 4]  # 100 cells for each of 16 meetings on 4 cores
    x = np.array([[np.sin(i), np.cos(i)] for i in range(40)])
    want = np.argsort(-np.round(x @ x.T, 9), axis=1, kind="stable")[:, :3]
    assert {(r.user_id, r["rank"]): r.item_id for r in rows} == {(u, k + 1): want[u, k] for u in range(40) for k in range(3)}
