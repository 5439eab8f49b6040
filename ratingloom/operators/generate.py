"""Synthetic rating data from user preferences and item features."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.functions.columns import HASH_RANGE, mix, mix_unit, tie_safe
from ratingloom.operators.recommend import BLOCK_ROWS, _packed, spread_meetings
from ratingloom.session import materialise
from ratingloom.skew import global_rank

SAMPLE_ITEMS = 5000
PREFERENCE_NOISE = 0.05


def hash_normal(a: str | Column, b: str | Column, seed: int) -> Column:
    """Standard normal noise of a pair (Box-Muller over two hashes): repeatable whatever the partitioning."""
    first = (mix(a, b, seed) + F.lit(0.5)) / F.lit(float(HASH_RANGE))
    return F.sqrt(-2 * F.log(first)) * F.cos(F.lit(2 * math.pi) * mix_unit(b, a, seed + 1))


def sample_items(items: DataFrame, n: int = SAMPLE_ITEMS, seed: int = 42, popular: DataFrame | None = None) -> DataFrame:
    """Seeded sample of ``n`` items without replacement.

    ``popular`` (item_id) restricts the choice first. If ``n`` or fewer are left, all of them are kept.
    """
    pool = items if popular is None else items.join(popular.select("item_id"), "item_id", "left_semi")
    return pool.orderBy(mix("item_id", F.lit(1), seed), "item_id").limit(n)


def cut_dimensions(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows in the given order, ranked by a range sort, so a large ``n`` does not end in one task."""
    return global_rank(df, [F.col(c) for c in order], "_rank").filter(F.col("_rank") <= n).drop("_rank")


def resize_profiles(profiles: DataFrame, users: DataFrame, features: Sequence[str]) -> DataFrame:
    """Profile cells for every user and named feature: kept where known, 0 elsewhere."""
    grid = users.select("user_id").withColumn("feature", F.explode(F.array(*[F.lit(f) for f in features])))
    known = profiles.select("user_id", "feature", "weight")
    return grid.join(known, ["user_id", "feature"], "left").fillna(0.0, ["weight"])


def random_preferences(
    profiles: DataFrame, features: Sequence[str], peaks: int, variability: int = 0, contrast: float = 1.0, seed: int = 0
) -> DataFrame:
    """Sharpened preferences of every user of ``profiles`` (user_id, feature, weight).

    The ``peaks`` (+- variability) features with the user's largest weights stand at +contrast, the others at -contrast,
    with noise, clipped to [-1, 1]. A feature without a weight comes after those with one; ties are drawn by hash.
    """
    k = len(features)
    users = profiles.select("user_id").distinct()
    grid = users.select("user_id", F.posexplode(F.array(*[F.lit(f) for f in features])).alias("_f", "feature"))
    known = grid.join(profiles.select("user_id", "feature", "weight"), ["user_id", "feature"], "left")
    spread = F.pmod(mix("user_id", F.lit(0), seed + 2), F.lit(2 * variability + 1)) - F.lit(variability)
    wanted = F.greatest(F.lit(0), F.least(F.lit(k), F.lit(peaks) + spread))
    # at most one row per feature
    order = Window.partitionBy("user_id").orderBy(tie_safe(F.col("weight")).desc_nulls_last(), mix("user_id", "_f", seed), "_f")
    level = F.when(F.row_number().over(order) <= wanted, F.lit(contrast)).otherwise(F.lit(-contrast))
    noisy = level + F.lit(PREFERENCE_NOISE) * hash_normal(F.col("user_id"), F.col("_f"), seed + 3)
    return known.select("user_id", "feature", F.greatest(F.lit(-1.0), F.least(F.lit(1.0), noisy)).alias("weight"))


def _vectors(cells: DataFrame, key: str, value: Column, features: Sequence[str], ids: DataFrame) -> DataFrame:
    entries = [F.coalesce(F.sum(F.when(F.col("feature") == f, value)), F.lit(0.0)) for f in features]
    filled = cells.groupBy(key).agg(F.array(*entries).alias("_v"))
    zero = F.array(*[F.lit(0.0) for _ in features])
    return ids.select(key).distinct().join(filled, key, "left").select(key, F.coalesce("_v", zero).alias("v"))


def raw_ideal(profiles: DataFrame, item_features: DataFrame, features: Sequence[str], users: DataFrame, items: DataFrame) -> DataFrame:
    """user_id, item_id, raw = P Q' for every user and item.

    The complete table is the result here. Blocks of users meet blocks of items and each task multiplies
    two bounded blocks.
    """
    p = _vectors(profiles, "user_id", F.col("weight"), features, users)
    q = _vectors(item_features.withColumn("_one", F.lit(1.0)), "item_id", F.col("_one"), features, items)
    user_blocks = max(1, -(-p.count() // BLOCK_ROWS))
    item_blocks = max(1, -(-q.count() // BLOCK_ROWS))
    left = _packed(p, "user_id", "v", "_ub", user_blocks, "u").withColumn(
        "_ib", F.explode(F.sequence(F.lit(0), F.lit(item_blocks - 1)))
    )
    right = _packed(q, "item_id", "v", "_ib", item_blocks, "i")

    def cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                us, its = np.asarray(row.u_ids), np.asarray(row.i_ids)
                product = np.asarray(row.u_flat).reshape(us.size, -1) @ np.asarray(row.i_flat).reshape(its.size, -1).T
                for at in range(0, us.size, 64):
                    part = us[at : at + 64]
                    yield pd.DataFrame(
                        {
                            "user_id": np.repeat(part, its.size),
                            "item_id": np.tile(its, part.size),
                            "raw": product[at : at + 64].ravel(),
                        }
                    )

    met = spread_meetings(left.join(right, "_ib"), user_blocks * item_blocks, "_ub", "_ib").select("u_ids", "u_flat", "i_ids", "i_flat")
    return met.mapInPandas(cells, "user_id long, item_id long, raw double")


def _scaled(raw: DataFrame, top: float) -> DataFrame:
    kept = materialise(raw, "ideal")
    low, high = kept.agg(F.min("raw"), F.max("raw")).first()
    scale = top / (high - low) if low is not None and high > low else 0.0
    return kept.select("user_id", "item_id", ((F.col("raw") - F.lit(low or 0.0)) * F.lit(scale)).alias("rating"))


def ideal_ratings(raw: DataFrame) -> DataFrame:
    """Raw scores rescaled to [0, 5] over all cells."""
    return _scaled(raw, 5.0)


def ideal_interactions(raw: DataFrame, threshold: float) -> DataFrame:
    """Raw scores rescaled to [0, 1]; 1 at or above the threshold, else 0."""
    hit = F.round(F.col("rating"), 9) >= F.lit(threshold)
    return _scaled(raw, 1.0).select("user_id", "item_id", F.when(hit, 1.0).otherwise(0.0).alias("rating"))


def degrade_explicit(ideal: DataFrame, noise: float, sparsity: float, seed: int = 0) -> DataFrame:
    """Normal noise, clip to [0, 5], each cell zeroed with probability ``sparsity``."""
    noisy = F.col("rating") + F.lit(noise) * hash_normal("user_id", "item_id", seed)
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(5.0), noisy))
    gone = mix_unit("user_id", "item_id", seed + 5) < sparsity
    return ideal.select("user_id", "item_id", F.when(gone, 0.0).otherwise(clipped).alias("rating"))


def degrade_implicit(ideal: DataFrame, flip: float, sparsity: float, seed: int = 0) -> DataFrame:
    """Each cell flipped with probability ``flip``; then exactly int(ones * sparsity) of the ones dropped."""
    flipped = F.when(mix_unit("user_id", "item_id", seed) < flip, 1 - F.col("rating")).otherwise(F.col("rating"))
    cells = materialise(ideal.select("user_id", "item_id", flipped.alias("rating")), "flipped")
    ones = cells.filter(F.col("rating") == 1)
    drop = int(ones.count() * sparsity)
    order = [mix("user_id", "item_id", seed + 7), F.col("user_id"), F.col("item_id")]
    gone = global_rank(ones, order, "_rank").filter(F.col("_rank") <= drop).select("user_id", "item_id", F.lit(True).alias("_gone"))
    return cells.join(gone, ["user_id", "item_id"], "left").select(
        "user_id", "item_id", F.when(F.col("_gone"), 0.0).otherwise(F.col("rating")).alias("rating")
    )
