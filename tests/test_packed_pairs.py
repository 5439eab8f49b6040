import numpy as np
import pyarrow as pa
import pytest

from ratingloom.operators import neighbors, pairs
from tests.conftest import cells, random_matrix, to_ratings
from tests.test_neighbors import brute_pairs


@pytest.mark.parametrize("chunk,dense,held", [(1024, 512, 20), (1024, 0, 4_000_000), (3, 0, 20)])
def test_packed_sums_of_pairs(spark, chunk, dense, held, monkeypatch):
    monkeypatch.setattr(pairs, "PACKED_PAIRS", 0)
    monkeypatch.setattr(pairs, "BUCKET_PAIRS", 100)
    monkeypatch.setattr(pairs, "DENSE_ITEMS", dense)
    monkeypatch.setattr(pairs, "HELD_PAIRS", held)
    matrix = random_matrix(30, 20, 0.4, 8)
    got = {(r.item_i, r.item_j): (r.n_co, r.dot, r.diff) for r in pairs.pair_stats(to_ratings(spark, matrix), chunk).collect()}
    want = brute_pairs(matrix)
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key])
    few = pairs.pair_stats(to_ratings(spark, matrix), chunk, least=6, diff=False)
    assert "hashpartitioning(item_i" not in few._jdf.queryExecution().executedPlan().toString()
    assert {(r.item_i, r.item_j): r.n_co for r in few.collect()} == {k: v[0] for k, v in want.items() if v[0] >= 6}


def test_similarity_does_not_change_when_packed(ratings, monkeypatch):
    want = cells(neighbors.item_similarity(ratings, min_support=3, shrinkage=10), "item_i", "item_j", "sim")
    monkeypatch.setattr(pairs, "PACKED_PAIRS", 0)
    got = cells(neighbors.item_similarity(ratings, min_support=3, shrinkage=10), "item_i", "item_j", "sim")
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_a_pair_met_once_travels_as_its_ratings():
    """Products of a few ratings are of many values; what is sent must not hold them."""
    rng = np.random.default_rng(2)
    values = 1 + 4 * rng.random(60)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([np.sort(rng.choice(10**7, 40, False)) for _ in range(200)]), pa.array([rng.choice(values, 40) for _ in range(200)]), pa.array([0] * 200, pa.int32())],
        names=["items", "rating", "cut"],
    )
    (made,) = pairs._multiply(iter([batch]), True)
    columns = [made.column(c).to_numpy() for c in (0, 1, 2, 3, 5, 6)]
    packed = pairs._pack(columns, 5)
    sizes = [len(cell.as_py()) for cell in packed.column(2)]
    assert sum(sizes) < 5.5 * made.num_rows
    back = [np.concatenate(c) for c in zip(*(pairs._unpack(cell.as_buffer()) for cell in packed.column(2)))]
    order = np.lexsort(back[1::-1])
    assert all((a[order] == b).all() for a, b in zip(back, columns))


def test_missing_ratings_in_packed_sums(spark, monkeypatch):
    rows = [(u, i, None if (u + i) % 5 == 0 else 1.0 + (u * i) % 4) for u in range(9) for i in range(7) if (u * 3 + i) % 4]
    rows += [(u, 50, None) for u in range(9)] + [(u, None, 2.0) for u in range(9)]
    ratings = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    monkeypatch.setattr(pairs, "DENSE_ITEMS", 0)
    want = {(r.item_i, r.item_j): r for r in neighbors.item_similarity(ratings).collect()}
    monkeypatch.setattr(pairs, "PACKED_PAIRS", 0)
    got = {(r.item_i, r.item_j): r for r in neighbors.item_similarity(ratings).collect()}
    assert got.keys() == want.keys() and (1, 50) in got and got[1, 50].sim == 0
    for key, row in want.items():
        assert got[key].support == row.support and got[key].sim == pytest.approx(row.sim, nan_ok=True)
