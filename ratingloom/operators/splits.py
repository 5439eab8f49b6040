"""Train/test splits (L1-L5). Random choice is a seeded hash, so a split can be repeated exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.columns import HASH_RANGE, mix
from ratingloom.skew import group_rank_by_hash

TEST_SHARE = 0.2


def _ranked(ratings: DataFrame, seed: int) -> DataFrame:
    hashed = ratings.withColumn("_h", mix("user_id", "item_id", seed))
    return group_rank_by_hash(hashed, "user_id", "_h", "item_id", "_rank", HASH_RANGE, size="_size")


def _labelled(ranked: DataFrame, is_test: Column) -> DataFrame:
    return ranked.withColumn("is_test", is_test).drop("_h", "_rank", "_size")


def holdout(ratings: DataFrame, seed: int = 0, share: float = TEST_SHARE) -> DataFrame:
    """Per-user holdout: users with more than one rating give max(1, floor(share * n)) of them."""
    quota = F.greatest(F.lit(1), F.floor(F.lit(share) * F.col("_size")))
    return _labelled(_ranked(ratings, seed), (F.col("_size") > 1) & (F.col("_rank") <= quota))


def leave_one_out(ratings: DataFrame, seed: int = 0) -> DataFrame:
    """One rating of every user goes to the test side."""
    hashed = F.struct(mix("user_id", "item_id", seed), F.col("item_id"))
    picked = ratings.groupBy("user_id").agg(F.min_by("item_id", hashed).alias("_test_item"))
    return ratings.join(picked, "user_id").withColumn("is_test", F.col("item_id") == F.col("_test_item")).drop(
        "_test_item"
    )


def holdout_floor(ratings: DataFrame, seed: int = 0, share: float = TEST_SHARE) -> DataFrame:
    """Per-user holdout of floor(n * share) ratings; small histories stay in train."""
    return _labelled(_ranked(ratings, seed), F.col("_rank") <= F.floor(F.col("_size") * F.lit(share)))


def global_split(ratings: DataFrame, seed: int = 42, share: float = TEST_SHARE) -> DataFrame:
    """Row-level split by hash threshold: no sort, no shuffle, and stable when rows are added."""
    return ratings.withColumn("is_test", mix("user_id", "item_id", seed) < int(share * HASH_RANGE))


def folds(ratings: DataFrame, n_folds: int = 3, seed: int = 42) -> DataFrame:
    """Fold number per rating for cross-validation."""
    return ratings.withColumn("fold", F.pmod(mix("user_id", "item_id", seed), F.lit(n_folds)).cast("int"))


def sides(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train and test tables of a labelled split."""
    return (
        labelled.filter(~F.col("is_test")).drop("is_test"),
        labelled.filter(F.col("is_test")).drop("is_test"),
    )
