"""Itemset counting over user buckets against plain counting."""

import itertools
import random

import numpy as np
import pytest

from ratingloom.operators import rules


@pytest.mark.parametrize("per_block", [50_000, 3])
def test_itemsets_in_any_number_of_candidate_blocks(spark, monkeypatch, per_block):
    monkeypatch.setattr(rules, "CANDIDATES_PER_BLOCK", per_block)
    rng = random.Random(6)
    baskets = [{i * 2 - 3 for i in range(6) if rng.random() < 0.7} for _ in range(40)]
    rows = [(u - 7, i, 1.0) for u, basket in enumerate(baskets) for i in basket]
    want = {}
    users = sum(map(bool, baskets))
    for size in range(1, 7):
        for items in itertools.combinations(range(-3, 9, 2), size):
            n = sum(b.issuperset(items) for b in baskets)
            if n >= rules.min_count(users, 0.2):
                want[items] = n
    frame = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    for miner in (rules.apriori, rules.eclat):
        assert {tuple(r["items"]): r["count"] for r in miner(frame, 0.2).collect()} == want


def test_counting_in_small_steps(monkeypatch):
    monkeypatch.setattr(rules, "PREFIXES_AT_ONCE", 2)
    rng = np.random.default_rng(2)
    has = rng.random((5, 128)) < 0.6
    bits = np.packbits(has, axis=1, bitorder="little").view(np.uint64)
    ids = np.array([9, 2, 7, 4, 5])
    sets = np.array([*itertools.combinations(sorted(ids.tolist()), 3), (2, 4, 100)])
    place = {int(i): k for k, i in enumerate(ids)}
    want = [int(np.logical_and.reduce([has[place[i]] for i in s]).sum()) if 100 not in s else 0 for s in sets.tolist()]
    assert rules._count_block(ids, bits, sets).tolist() == want


def test_rules_of_large_sets_need_no_int(spark):
    sets = spark.createDataFrame([([1, 2], 0.5), ([1], 0.5), ([2], 1.0)], "items array<long>, support double")
    assert rules.association_rules(sets, "confidence", 0.9).count() == 1
