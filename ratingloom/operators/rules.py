"""Frequent itemsets and association rules."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.operators.pairs import pair_stats
from ratingloom.operators.prepare import binarise, with_titles
from ratingloom.operators.rule_trie import fired
from ratingloom.session import materialise
from ratingloom.skew import dense_ids


CANDIDATES_PER_BLOCK = 50_000
PREFIXES_AT_ONCE = 1024  # intersections held at once, 4 KB each


def min_count(n_users: int, min_support: float) -> int:
    """Smallest user count that reaches the support, without float trouble at the boundary."""
    return max(1, math.ceil(min_support * n_users - 1e-9))


def _frequent_items(seen: DataFrame, least: int) -> DataFrame:
    counts = seen.groupBy("item_id").agg(F.count("*").alias("count"))
    return counts.filter(F.col("count") >= least)


def _user_bitmaps(seen: DataFrame, frequent: DataFrame) -> DataFrame:
    """item_id, bucket, bits: which of the bucket's 32,768 users have the item.

    A popular item costs one bit per user and its users are spread over buckets, so no group holds a
    list of users. Only frequent items are kept, which bounds the table.
    """
    users = dense_ids(seen, "user_id", "_uid")
    kept = seen.join(frequent.select("item_id"), "item_id", "left_semi").join(users, "user_id")
    position = F.col("_uid") + 1
    return kept.groupBy("item_id", F.bitmap_bucket_number(position).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(position)).alias("bits")
    )


def _joined_candidates(level: DataFrame) -> DataFrame:
    """Sets one larger, from two sets that share all but the last item."""
    prefix = F.slice("items", 1, F.size("items") - 1)
    left = level.select(prefix.alias("_prefix"), F.col("items").alias("_a"), F.element_at("items", -1).alias("_x"))
    right = level.select(prefix.alias("_prefix"), F.element_at("items", -1).alias("_y"))
    return left.join(right, "_prefix").filter(F.col("_x") < F.col("_y")).select(
        F.concat("_a", F.array("_y")).alias("items")
    )


def _prune(candidates: DataFrame, level: DataFrame, size: int) -> DataFrame:
    """Keep candidates all of whose subsets with one item less are frequent."""
    subsets = candidates.select(
        "items", F.explode(F.transform("items", lambda x: F.array_except("items", F.array(x)))).alias("_sub")
    )
    known = level.select(F.col("items").alias("_sub"))
    return (
        subsets.join(known, "_sub", "left_semi").groupBy("items").agg(F.count("*").alias("_n"))
        .filter(F.col("_n") == size).select("items")
    )


def _buckets(seen: DataFrame, frequent: DataFrame) -> DataFrame:
    """One row per bucket of users: its frequent items and the bitmap of each."""
    bits = _user_bitmaps(seen, frequent)
    return bits.groupBy("bucket").agg(F.collect_list(F.struct("item_id", "bits")).alias("_r")).select("bucket", F.col("_r.item_id").alias("ids"), F.col("_r.bits").alias("bits"))


def _count_block(ids: np.ndarray, bits: np.ndarray, sets: np.ndarray) -> np.ndarray:
    """How many of a bucket's users have each candidate; candidates with the same prefix share its intersection."""
    order = np.argsort(ids)
    at = np.minimum(np.searchsorted(ids[order], sets), len(ids) - 1)
    known = (ids[order][at] == sets).all(axis=1)
    codes, counts = order[at[known]], np.zeros(len(sets), np.int64)
    prefixes, of = np.unique(codes[:, :-1], axis=0, return_inverse=True)
    by = np.argsort(of.ravel(), kind="stable")
    found = np.zeros(len(codes), np.int64)
    for lo in range(0, len(prefixes), PREFIXES_AT_ONCE):
        some = prefixes[lo : lo + PREFIXES_AT_ONCE]
        both = bits[some[:, 0]]
        for k in range(1, some.shape[1]):
            both = both & bits[some[:, k]]
        a, b = np.searchsorted(of.ravel()[by], (lo, lo + len(some)))
        for x in range(a, b, PREFIXES_AT_ONCE):
            rows = by[x : min(b, x + PREFIXES_AT_ONCE)]
            found[rows] = np.bitwise_count(both[of.ravel()[rows] - lo] & bits[codes[rows, -1]]).sum(axis=1)
    counts[known] = found
    return counts


def _counted(candidates: DataFrame, buckets: DataFrame, n_buckets: int, least: int) -> DataFrame:
    """(items, count) of the candidates that reach ``least``: bitmaps stay where they are, only counts are shuffled."""
    candidates = materialise(candidates, "candidates")
    blocks = max(1, -(-candidates.count() // CANDIDATES_PER_BLOCK))
    packed = candidates.groupBy(F.pmod(F.xxhash64("items"), F.lit(blocks)).alias("_cb")).agg(F.collect_list("items").alias("sets"))
    met = buckets.select("ids", "bits").join(F.broadcast(packed.select("sets"))) if blocks == 1 else None
    if met is None:
        left = buckets.withColumn("_cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        right = packed.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_buckets).cast("long"))))
        tasks = blocks * n_buckets
        met = left.repartition(tasks, "bucket", "_cb").join(right.repartition(tasks, "bucket", "_cb").hint("merge"), ["bucket", "_cb"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column(0)[i].values.to_numpy(zero_copy_only=False)
                bits = np.frombuffer(b"".join(batch.column(1)[i].values.to_pylist()), np.uint64).reshape(len(ids), -1)
                lists = batch.column(2)[i].values
                sets = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
                counts = _count_block(ids, bits, sets)
                some = counts > 0
                yield pa.RecordBatch.from_arrays([lists.filter(pa.array(some)), pa.array(counts[some])], ["items", "count"])

    counts = met.select("ids", "bits", "sets").mapInArrow(work, "items array<long>, count long").groupBy("items").agg(F.sum("count").alias("count"))
    return materialise(counts.filter(F.col("count") >= least), "itemsets")


def _levels(ratings: DataFrame, min_support: float, max_size: int | None, prune: bool) -> DataFrame:
    """Level-wise search: sets one larger from sets that share a prefix, counted over the bitmaps of all users."""
    seen = materialise(binarise(ratings).select("user_id", F.col("item_id").cast("long").alias("item_id"), "rating"), "transactions")
    n_users = seen.agg(F.count_distinct("user_id")).first()[0]
    least = min_count(n_users, min_support)
    items = materialise(_frequent_items(seen, least), "frequent")
    kept = seen.join(items.select("item_id"), "item_id", "left_semi")
    levels = [items.select(F.array("item_id").alias("items"), "count")]
    pairs = pair_stats(kept).filter(F.col("n_co") >= least).select(F.array("item_i", "item_j").alias("items"), F.col("n_co").alias("count"))
    level = materialise(pairs, "itemsets")
    buckets = None
    size = 2
    while (max_size is None or size <= max_size) and not level.isEmpty():
        levels.append(level)
        size += 1
        if max_size is not None and size > max_size:
            break
        if buckets is None:
            buckets = materialise(_buckets(seen, items), "bitmaps")
            n_buckets = (buckets.agg(F.max("bucket")).first()[0] or 0) + 1
        candidates = _joined_candidates(level)
        level = _counted(_prune(candidates, level, size) if prune else candidates, buckets, n_buckets, least)
    out = levels[0]
    for nxt in levels[1:]:
        out = out.unionByName(nxt)
    return out.withColumn("support", F.col("count") / F.lit(float(max(n_users, 1))))


def apriori(ratings: DataFrame, min_support: float = 0.1, max_size: int | None = None) -> DataFrame:
    """Frequent itemsets (items sorted, count, support) by candidate generation, pruning and counting."""
    return _levels(ratings, min_support, max_size, prune=True)


def eclat(ratings: DataFrame, min_support: float = 0.1, max_size: int | None = None) -> DataFrame:
    """Frequent itemsets by intersecting the user set of a prefix with those of further items, without pruning."""
    return _levels(ratings, min_support, max_size, prune=False)


def fp_growth(ratings: DataFrame, min_support: float = 0.1) -> DataFrame:
    """Frequent itemsets by MLlib's parallel FP-growth.

    Baskets hold frequent items only, so their length is bounded by the number of those.
    """
    seen = materialise(binarise(ratings), "transactions")
    n_users = seen.agg(F.count_distinct("user_id")).first()[0]
    least = min_count(n_users, min_support)
    kept = seen.join(_frequent_items(seen, least).select("item_id"), "item_id", "left_semi")
    baskets = kept.groupBy("user_id").agg(F.collect_set("item_id").alias("items"))
    n_baskets = max(1, baskets.count())
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(0.0, (least - 0.5) / n_baskets))).fit(baskets)
    return model.freqItemsets.select(
        F.array_sort("items").alias("items"),
        F.col("freq").alias("count"),
        (F.col("freq") / F.lit(float(max(n_users, 1)))).alias("support"),
    )


def association_rules(itemsets: DataFrame, metric: str = "confidence", min_threshold: float = 0.5) -> DataFrame:
    """Rules from every proper non-empty subset of every itemset, consequents of any size.

    Columns antecedent, consequent, support, antecedent_support, consequent_support, confidence, lift;
    kept where ``metric`` (confidence, support or lift) reaches the threshold.
    """
    big = itemsets.filter(F.size("items") >= 2).select("items", "support")
    masks = F.expr("sequence(1L, shiftleft(1L, size(items)) - 2)")
    split = big.select("items", "support", F.explode(masks).alias("_mask"))

    def chosen(bit: int):
        return F.expr(f"filter(items, (x, at) -> (shiftright(_mask, at) & 1) = {bit})")

    halves = split.select("support", chosen(1).alias("antecedent"), chosen(0).alias("consequent"))
    known = itemsets.select("items", "support")
    rules = halves.join(
        known.select(F.col("items").alias("antecedent"), F.col("support").alias("antecedent_support")), "antecedent"
    ).join(known.select(F.col("items").alias("consequent"), F.col("support").alias("consequent_support")), "consequent")
    rules = rules.withColumn("confidence", F.col("support") / F.col("antecedent_support")).withColumn(
        "lift", F.col("confidence") / F.col("consequent_support")
    )
    if metric not in ("confidence", "support", "lift"):
        raise ValueError(f"unknown rule metric {metric}")
    return rules.filter(F.col(metric) >= F.lit(min_threshold) - F.lit(1e-12)).select(
        "antecedent", "consequent", "support", "antecedent_support", "consequent_support", "confidence", "lift"
    )


def rule_scores(ratings: DataFrame, rules: DataFrame) -> DataFrame:
    """Score of an unseen item = highest confidence of a rule whose antecedent the user has.

    Antecedents are matched once each, however many rules share them, by walking a trie of them.
    """
    seen = binarise(ratings).select("user_id", "item_id").distinct()
    best = (
        rules.select("antecedent", "confidence", F.explode("consequent").alias("item_id"))
        .groupBy("antecedent", "item_id")
        .agg(F.max("confidence").alias("confidence"))
    )
    return fired(seen, best)


def named_itemsets(itemsets: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Itemsets with item titles (unknown ids are named as unknown), titles sorted."""
    names = with_titles(itemsets.select("items", F.explode("items").alias("item_id")), catalogue)
    titled = names.groupBy("items").agg(F.array_sort(F.collect_list("title")).alias("titles"))
    return itemsets.join(titled, "items")
