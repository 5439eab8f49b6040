import random

import pytest

from ratingloom.operators import tuning
from ratingloom.operators.catalog import ALGORITHMS, Choice, Range

QUICK = {
    "k": 2, "iterations": 1, "epochs": 1, "min_support": 0.2, "min_confidence": 0.5, "learning_rate": 0.05,
    "negative_sample_pool_size": 2,
}


@pytest.mark.parametrize("name", sorted(ALGORITHMS))
def test_every_model_scores_and_recommends_unseen_items(ratings, matrix, name):
    algorithm = ALGORITHMS[name]
    params = {p: v for p, v in QUICK.items() if p in algorithm.parameters}
    if name == "ItemKNN":
        params["min_support"] = 1
    fitted = algorithm.train(ratings, **params)
    best = fitted.recommend(2).select("user_id", "item_id", "score").collect()
    assert best and all(matrix[r.user_id, r.item_id] == 0 for r in best)
    per_user = {}
    for r in best:
        per_user[r.user_id] = per_user.get(r.user_id, 0) + 1
    assert max(per_user.values()) <= 2
    pairs = fitted.recommend(2).select("user_id", "item_id")
    scored = fitted.score(pairs).collect()
    assert len(scored) == len(best)
    own = {(r.user_id, r.item_id): r.score for r in scored}
    assert all(abs(own[r.user_id, r.item_id] - r.score) < 1e-6 for r in best)


def test_unknown_parameters_are_refused():
    with pytest.raises(ValueError):
        ALGORITHMS["NMF"].checked({"max_iter": 5})


def test_search_spaces_name_parameters_of_their_models():
    for name, space in tuning.SPACES.items():
        assert set(space) <= set(ALGORITHMS[name].parameters)
        for params in tuning.sampled(space, 20, 3):
            for key, value in params.items():
                assert isinstance(space[key], Choice) or space[key].low <= value <= space[key].high


def test_sampled_parameters_stay_in_range():
    space = {"k": Range(5, 100, 5, 20), "metric": Choice(("a", "b"), "a"), "rate": Range(0.0, 1.0, 0.25, 0.5)}
    for params in tuning.sampled(space, 50, random.randint(0, 9)):
        assert params["k"] % 5 == 0 and 5 <= params["k"] <= 100 and isinstance(params["k"], int)
        assert params["metric"] in ("a", "b") and params["rate"] in (0.0, 0.25, 0.5, 0.75, 1.0)
