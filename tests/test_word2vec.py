"""The skip-gram query without comparison SQL."""

import __spark_entry__
from ratingloom.plans import vectors


def test_word2vec_trains_from_all_pairs(spark, monkeypatch):
    """Items 1 and 20 of one long history are a pair, though far apart; the trainer must be given them."""
    liked = spark.createDataFrame([(u, i) for u in range(3) for i in range(1, 21)], "user_id long, item_id long")
    seen = []
    pairs = vectors.embeddings.skip_gram_pairs
    monkeypatch.setattr(vectors, "_liked", lambda spark, sf: (liked.select("item_id"), liked))
    monkeypatch.setattr(vectors.embeddings, "skip_gram_pairs", lambda x: seen.append(pairs(x)) or seen[0])
    got = __spark_entry__.queries()["e4_word2vec"](spark, "").collect()
    assert sorted(r.item_id for r in got) == list(range(1, 21)) and len(got[0].vector.split(",")) == 16
    met = {(r.center, r.context): r.n for r in seen[0].collect()}
    assert met == {(a, b): 3 for a in range(1, 21) for b in range(1, 21) if a != b}
