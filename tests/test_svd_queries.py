"""The SVD queries without comparison SQL run until they converge."""

from pathlib import Path

import numpy as np
import pytest

import __spark_entry__
from ratingloom.sources import views

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="needs the driver tables")


def test_svd_queries_converge(spark):
    rows = views.ratings_brands(spark, str(SF)).select("user_id", "item_id", "rating").collect()
    users, items = sorted({r.user_id for r in rows}), sorted({r.item_id for r in rows})
    dense = np.zeros((len(users), len(items)))
    for r in rows:
        dense[users.index(r.user_id), items.index(r.item_id)] = r.rating
    u, s, vt = np.linalg.svd(dense, full_matrices=False)
    scree = {r.component: r.sigma for r in __spark_entry__.queries()["d6_scree"](spark, str(SF)).collect()}
    assert [scree[c] for c in sorted(scree)] == pytest.approx(s[:5].tolist(), abs=1e-9)
    best = u[:, :10] * s[:10] @ vt[:10]
    got = __spark_entry__.queries()["m10_truncated_svd_rank_10"](spark, str(SF)).collect()
    assert len(got) == len(rows)
    assert all(r.score == pytest.approx(best[users.index(r.user_id), items.index(r.item_id)], abs=2e-6) for r in got)
