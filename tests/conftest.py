import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ratingloom.session import local_session  # noqa: E402

# Worked example: five users, six items, 0 = missing.
TOY = [
    [5, 3, 0, 1, 4, 0],
    [4, 0, 0, 1, 3, 5],
    [1, 1, 5, 5, 0, 4],
    [0, 1, 4, 4, 0, 0],
    [2, 0, 3, 0, 5, 4],
]


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def to_ratings(spark, matrix):
    rows = [(u, i, float(v)) for u, row in enumerate(matrix) for i, v in enumerate(row) if v > 0]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double")


def random_matrix(users=30, items=12, density=0.5, seed=1):
    rng = np.random.default_rng(seed)
    return rng.integers(1, 6, (users, items)) * (rng.random((users, items)) < density)


@pytest.fixture(scope="session")
def toy(spark):
    return to_ratings(spark, TOY).cache()


@pytest.fixture(scope="session")
def matrix():
    return random_matrix()


@pytest.fixture(scope="session")
def ratings(spark, matrix):
    return to_ratings(spark, matrix).cache()


def cells(df, *cols):
    """Rows as {(keys): value}, last column the value."""
    return {tuple(row[c] for c in cols[:-1]): row[cols[-1]] for row in df.collect()}
