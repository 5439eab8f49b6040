"""Top-N output and seen-item policies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.functions.columns import tie_safe
from ratingloom.operators.prepare import with_titles
from ratingloom.session import bounded_batches

BLOCK_ROWS = 2048
MEETINGS_PER_TASK = 64
MOST_ROWS = 16_384  # of a block of a large table; BLOCK_ROWS of each side are multiplied at a time
BROADCAST_BLOCKS = 4  # blocks of BLOCK_ROWS factor rows that every task may be sent


def top_n(
    scores: DataFrame,
    ratings: DataFrame | None,
    n: int = 10,
    catalogue: DataFrame | None = None,
) -> DataFrame:
    """The ``n`` best unseen items per user, ties by item id; ``ratings`` None keeps seen items.

    The rank filter is pushed below the shuffle (at most n rows per user and task).
    """
    if ratings is not None:
        scores = scores.join(ratings.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    order = Window.partitionBy("user_id").orderBy(tie_safe(F.col("score")).desc(), "item_id")
    best = scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    return best if catalogue is None else with_titles(best, catalogue)


def with_features(recommended: DataFrame, features: DataFrame) -> DataFrame:
    """Comma-joined names of the known features of each recommended item.

    An item's features are bounded by the feature list, so the grouped list is small.
    """
    named = features.groupBy("item_id").agg(
        F.concat_ws(", ", F.array_sort(F.collect_set("feature"))).alias("characteristics")
    )
    return recommended.join(named, "item_id", "left").fillna("", ["characteristics"])


def profile(profiles: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """User profile with interests ranked from strongest to weakest."""
    if users is not None:
        profiles = profiles.join(users.select("user_id"), "user_id", "left_semi")
    order = Window.partitionBy("user_id").orderBy(tie_safe(F.col("weight")).desc(), "feature")
    return profiles.withColumn("place", F.row_number().over(order))


def apply_seen(scores: DataFrame, ratings: DataFrame, policy: str) -> DataFrame:
    """What a score table says about items the user already rated.

    keep: the rating itself; drop: -infinity; zero: 0; leave: the model's score. Except under leave,
    seen pairs the model gave no score are added.
    """
    clean = scores.withColumn("score", F.nanvl("score", F.lit(0.0)))
    if policy == "leave":
        return clean
    values = {"keep": F.col("rating"), "drop": F.lit(float("-inf")), "zero": F.lit(0.0)}
    seen = ratings.select("user_id", "item_id", "rating")
    both = clean.join(seen, ["user_id", "item_id"], "full")
    return both.select(
        "user_id",
        "item_id",
        F.when(F.col("rating").isNotNull(), values[policy]).otherwise(F.col("score")).alias("score"),
    )


def _packed(factors: DataFrame, key: str, vector: str, block: str, blocks: int, prefix: str) -> DataFrame:
    """Factor rows packed into blocks chosen by hash of the id."""
    entry = F.struct(F.col(key).alias("id"), F.col(vector).alias("v"))
    return (
        factors.withColumn(block, F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"))
        .groupBy(block)
        .agg(F.collect_list(entry).alias("_rows"))
        .select(block, F.col("_rows.id").alias(f"{prefix}_ids"), F.flatten("_rows.v").alias(f"{prefix}_flat"))
    )


def spread_meetings(met: DataFrame, meetings: int, *keys: str) -> DataFrame:
    """At most about MEETINGS_PER_TASK block meetings per task, so an Arrow batch of blocks stays small."""
    if meetings <= MEETINGS_PER_TASK:
        return met
    return met.repartition(-(-meetings // MEETINGS_PER_TASK), *keys)


def score_blocks(
    users: DataFrame,
    items: DataFrame,
    n: int,
    seen: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Best ``n`` items per user by p.q, for every user x item pair.

    ``users``: user_id, p; ``items``: item_id, q. Blocks of users meet blocks of items; each meeting
    returns only the n best unseen items per user, so the full score matrix never exists as rows. The
    seen pairs of a meeting travel with it, so no over-fetching is needed.
    """
    bounded_batches(users.sparkSession)
    n_users, n_items = users.count(), items.count()
    cores = users.sparkSession.sparkContext.defaultParallelism
    if block_rows == BLOCK_ROWS and n_items > BROADCAST_BLOCKS * BLOCK_ROWS:  # larger blocks are shuffled less often
        block_rows = max(BLOCK_ROWS, min(MOST_ROWS, int((n_users * n_items / (4 * cores)) ** 0.5)))
    user_blocks = max(1, -(-n_users // block_rows))
    item_blocks = max(1, -(-n_items // block_rows))
    left = _packed(users, "user_id", "p", "_ub", user_blocks, "u").withColumn(
        "_ib", F.explode(F.sequence(F.lit(0), F.lit(item_blocks - 1)))
    )
    right = _packed(items, "item_id", "q", "_ib", item_blocks, "i")
    meetings = user_blocks * item_blocks
    few = item_blocks <= BROADCAST_BLOCKS and block_rows <= BLOCK_ROWS
    if few:
        met = left.join(F.broadcast(right), "_ib")
    else:
        # both sides are repeated and meet by both numbers, so no task gets all user blocks of an item block
        tasks = max(-(-meetings // MEETINGS_PER_TASK), min(meetings, 4 * cores))
        right = right.withColumn("_ub", F.explode(F.sequence(F.lit(0), F.lit(user_blocks - 1))))
        met = left.repartition(tasks, "_ub", "_ib").join(right.repartition(tasks, "_ub", "_ib").hint("merge"), ["_ub", "_ib"])
    if seen is not None:
        known = (
            seen.select("user_id", "item_id")
            .withColumn("_ub", F.pmod(F.xxhash64("user_id"), F.lit(user_blocks)).cast("int"))
            .withColumn("_ib", F.pmod(F.xxhash64("item_id"), F.lit(item_blocks)).cast("int"))
            .groupBy("_ub", "_ib")
            .agg(F.collect_list(F.struct("user_id", "item_id")).alias("_s"))
            .select("_ub", "_ib", F.col("_s.user_id").alias("s_users"), F.col("_s.item_id").alias("s_items"))
        )
        met = met.join(known, ["_ub", "_ib"], "left")
    else:
        none = F.array().cast("array<long>")
        met = met.withColumn("s_users", none).withColumn("s_items", none)

    def best_of_meeting(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                yield _best_rows(row, n)

    if few:
        met = spread_meetings(met, meetings, "_ub", "_ib")
    partial = met.select("u_ids", "u_flat", "i_ids", "i_flat", "s_users", "s_items").mapInPandas(
        best_of_meeting, "user_id long, item_id long, score double"
    )
    return top_n(partial, None, n)


def _best_rows(row, n: int) -> pd.DataFrame:
    users, items = np.asarray(row.u_ids), np.asarray(row.i_ids)
    by_id = np.argsort(items)
    items = items[by_id]
    p = np.asarray(row.u_flat, dtype=float).reshape(users.size, -1)
    q = np.asarray(row.i_flat, dtype=float).reshape(items.size, -1)[by_id]
    r, c = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if row.s_users is not None and len(row.s_users):
        order = np.argsort(users)
        r = order[np.searchsorted(users[order], np.asarray(row.s_users))]
        c = np.searchsorted(items, np.asarray(row.s_items))
        known = (c < items.size) & (items[np.minimum(c, items.size - 1)] == np.asarray(row.s_items))
        r, c = r[known], c[known]
    out = [_best_of_tiles(p[low : low + BLOCK_ROWS], q, r[inside] - low, c[inside], n)
           for low in range(0, users.size, BLOCK_ROWS) for inside in [(r >= low) & (r < low + BLOCK_ROWS)]]
    height = np.concatenate([np.full(len(x[0]), k * BLOCK_ROWS) for k, x in enumerate(out)]) if out else r
    user, item, score = (np.concatenate(x) for x in zip(*out)) if out else (r, c, np.zeros(0))
    return pd.DataFrame({"user_id": users[user + height], "item_id": items[item], "score": score})


def _best_of_tiles(p: np.ndarray, q: np.ndarray, r: np.ndarray, c: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Row, column and value of the ``n`` best of every row of p.q without the cells (r, c), ties by column.

    A tile only gives up what reaches the n-th best found so far, so no row of scores is sorted.
    """
    least, found = np.full(len(p), -np.inf), []
    for low in range(0, len(q), BLOCK_ROWS):
        scores = p @ q[low : low + BLOCK_ROWS].T
        here = (c >= low) & (c < low + BLOCK_ROWS)
        scores[r[here], c[here] - low] = -np.inf
        scores[np.isnan(scores)] = -np.inf
        least = np.maximum(least, _reached(scores, n))
        row, column = np.nonzero(scores >= least[:, None])
        found.append((row, column + low, scores[row, column]))
    row, column, score = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((column, -np.round(score, 9), row))
    row, column, score = row[order], column[order], score[order]
    keep = (np.arange(len(row)) - np.searchsorted(row, row) < n) & np.isfinite(score)
    return row[keep], column[keep], score[keep]


def _reached(scores: np.ndarray, n: int) -> np.ndarray:
    """Per row a bound that its n best values reach, also after rounding to nine digits."""
    height, width = scores.shape
    groups = max(128, 4 * n)
    if width >= 4 * groups:  # the n largest maxima of groups of columns are n values of the row
        deep = width // groups
        scores = scores[:, : deep * groups].reshape(height, deep, groups).max(axis=1)
        width = groups
    if width <= n:
        return np.full(height, -np.inf)
    bound = np.partition(scores, width - n, axis=1)[:, width - n]
    some = np.isfinite(bound)
    bound[some] -= 1e-9 + np.abs(bound[some]) * 1e-15
    return bound


def sample_user(ratings: DataFrame, low: int = 5, high: int = 20) -> DataFrame:
    """One user to explain: the first with low..high interactions, else the most active, else the first."""
    sizes = ratings.groupBy("user_id").agg(F.count("*").alias("n_ratings"))
    fits = F.col("n_ratings").between(low, high)
    return sizes.orderBy(
        F.when(fits, 0).otherwise(1), F.when(fits, 0).otherwise(-F.col("n_ratings")), "user_id"
    ).limit(1)


def breakdown(ratings: DataFrame, scores: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """Why a user sees a list: series history (ratings), scores (0 where liked) and top_k."""
    mine = ratings.join(users.select("user_id"), "user_id", "left_semi").select("user_id", "item_id", "rating")
    theirs = scores.join(users.select("user_id"), "user_id", "left_semi")
    history = mine.select("user_id", "item_id", F.lit("history").alias("series"), F.col("rating").alias("value"))
    shown = (
        theirs.join(mine, ["user_id", "item_id"], "left")
        .select(
            "user_id",
            "item_id",
            F.lit("score").alias("series"),
            F.when(F.col("rating").isNull(), F.col("score")).otherwise(F.lit(0.0)).alias("value"),
        )
    )
    best = top_n(theirs, mine, k).select("user_id", "item_id", F.lit("top_k").alias("series"), F.col("score").alias("value"))
    return history.unionByName(shown).unionByName(best)
