"""Models trained at the rank and the number of iterations of the catalogue, over the whole interaction table.

Statements of their steps would be too long for SQL; tests compare these queries with NumPy. Mean steps move less
than sequential ones, so the gradient models take the learning rate RATE instead of the catalogue's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.functions.columns import rounded
from ratingloom.operators import diagnostics, gradient
from ratingloom.operators.catalog import ALGORITHMS
from ratingloom.operators.recommend import score_blocks
from ratingloom.operators.splits import holdout, sides
from ratingloom.plans.registry import query
from ratingloom.sources import views

TOP = 10
RATE = 0.3
BIASED_RANK = 20


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return views.ratings_events(spark, sf).select("user_id", "item_id", "rating")


def _recommended(name: str, **params):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        best = ALGORITHMS[name].train(_events(spark, sf), **params).recommend(TOP)
        return best.withColumn("score", rounded("score"))

    return run


query("m1_als_trained")(_recommended("ALS"))
query("m2_als_biases_trained")(_recommended("ALS (Improved)"))
query("m3_funk_svd_trained")(_recommended("FunkSVD", learning_rate=RATE))
query("m6_nmf_trained")(_recommended("NMF", learning_rate=RATE))
query("m7_svdpp_trained")(_recommended("SVD++"))
query("m9_asymmetric_svd_trained")(_recommended("ASVD", learning_rate=RATE))
query("m12_wrmf_trained")(_recommended("WRMF"))
query("m13_fism_trained")(_recommended("FISM", learning_rate=RATE))


def _biased(spark: SparkSession, sf: str, **kept) -> gradient.RatingModel:
    iterations = int(ALGORITHMS["FunkSVD"].defaults()["iterations"])
    return gradient.fit_biased_mf(_events(spark, sf), BIASED_RANK, iterations, RATE, **kept)


@query("d1_training_history")
def _(spark, sf):
    history = _biased(spark, sf, track=True).factors.history
    return diagnostics.convergence(spark, history).withColumn("value", rounded("value"))


@query("d3_training_snapshots")
def _(spark, sf):
    total = int(ALGORITHMS["FunkSVD"].defaults()["iterations"])
    kept = _biased(spark, sf, keep=diagnostics.snapshot_iterations(total)).factors.snapshots
    cells = kept.select("iteration", "side", "id", F.posexplode("v").alias("factor", "value"))
    return cells.withColumn("value", rounded("value"))


@query("m5_pmf_curve")
def _(spark, sf):
    """Error on both parts of a holdout at the first, the last and every fifth iteration."""
    train, test = sides(holdout(_events(spark, sf)))
    model = gradient.fit_pmf(train, 2, 50, RATE, 0.1, 0.1, keep=diagnostics.snapshot_iterations(50))
    curves = [
        gradient.error_curve(model, rows).select(F.lit(side).alias("side"), "iteration", "n", rounded("rmse").alias("rmse"))
        for side, rows in (("train", train), ("validation", test))
    ]
    return curves[0].unionByName(curves[1])


@query("m5_pmf_trained")
def _(spark, sf):
    ratings = _events(spark, sf)
    users, items = gradient.fit_pmf(ratings, 2, 100, RATE, 0.1, 0.1).block_factors()
    return score_blocks(users, items, TOP, ratings).withColumn("score", rounded("score"))
