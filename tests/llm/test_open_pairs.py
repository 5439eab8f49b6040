"""The exact round of the Jaccard join: which documents of a signature are held against each other."""

import itertools

import numpy as np
import pytest

from ratingloom.llm import jaccard_join


@pytest.mark.parametrize("block", [2048, 3])
@pytest.mark.parametrize("common", [25, 2])
def test_pairs_of_a_group_are_all_that_differ_in_their_label(spark, monkeypatch, block, common):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    size, blank = 40, np.zeros(jaccard_join.BINS // 8, np.uint8).tobytes()
    label = {d: 1 if d <= common else 2 if d % 2 else d for d in range(1, size + 1)}
    rows = [(s, d, 10 << 32, 1) for s, docs in ((7, range(1, size + 1)), (8, (1, 2)), (9, (5,))) for d in docs]
    useful = spark.createDataFrame(rows, "sig long, doc_id long, about long, least int")
    sketches = spark.createDataFrame([(d, bytearray(blank)) for d in label], "doc_id long, sketch binary")
    labels = spark.createDataFrame([(d, x) for d, x in label.items() if x != d], "id long, label long")
    tested = spark.createDataFrame([(1, size), (2, size)], "a long, b long")
    found = sorted((r.a, r.b) for r in jaccard_join._open_pairs(useful, sketches, labels, tested).collect())
    pairs = itertools.combinations(range(1, size + 1), 2)
    assert found == [(a, b) for a, b in pairs if label[a] != label[b] and (a, b) not in {(1, size), (2, size)}]
