from pyspark.sql import functions as F

from ratingloom.operators import embeddings
from ratingloom.sources import files


def test_rating_times_order_the_sequences(spark, tmp_path):
    (tmp_path / "r.csv").write_text("userId,movieId,rating,timestamp\n1,9,4.0,30\n1,5,3.5,10\n1,7,2.0,20\n1,8,0.0,40\n2,5,1.0,\n")
    (tmp_path / "m.csv").write_text('movieId,title,genres\n5,"A, the",Drama|War\n')
    ratings, movies = files.read_movielens(spark, str(tmp_path / "r.csv"), str(tmp_path / "m.csv"))
    rows = ratings.select("user_id", "item_id", "rating", F.unix_timestamp("ts").alias("t")).collect()
    assert sorted(map(tuple, rows), key=str) == [(1, 5, 3.5, 10), (1, 7, 2.0, 20), (1, 9, 4.0, 30), (2, 5, 1.0, None)]
    assert movies.collect()[0].title == "A, the"
    found = embeddings.sequences(ratings, 3).collect()
    assert [(r.input, r.target) for r in found] == [([0, 6, 8], [0, 8, 10])]
