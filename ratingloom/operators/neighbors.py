"""Neighbourhood, popularity and item-item models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.functions.columns import tie_safe
from ratingloom.operators.pairs import mirrored, pair_stats
from ratingloom.operators.prepare import binarise, centred
from ratingloom.operators.sparse_scores import Rule, sparse_scores
from ratingloom.operators.user_blocks import user_blocks
from ratingloom.session import materialise
from ratingloom.skew import global_rank, hot_keys, salted_join


def popularity(ratings: DataFrame) -> DataFrame:
    """Item score = sum of its ratings."""
    return ratings.groupBy("item_id").agg(F.sum("rating").alias("score"))


def popular_for_users(ratings: DataFrame, n: int) -> DataFrame:
    """The ``n`` most popular unseen items of every user.

    A user with h seen items finds them among the first n + h places of the popularity list. Histories are
    turned into places once; which of the first n + h are free is decided inside the user's row, so only n
    places a user are looked up again, and the places that all users want are spread over many tasks.
    Users who have seen everything have no row; fewer than ``n`` come back where fewer are left.
    """
    places = global_rank(popularity(ratings), [tie_safe(F.col("score")).desc(), F.col("item_id")], "place")
    seen = salted_join(ratings.select("user_id", "item_id"), places.select("item_id", "place"), "item_id", "user_id", hot_keys(ratings, "item_id"))
    histories = seen.groupBy("user_id").agg(F.collect_set("place").alias("_seen"))  # at most the catalogue
    prefix = F.sequence(F.lit(1).cast("long"), F.size("_seen").cast("long") + F.lit(n))
    free = F.slice(F.array_except(prefix, "_seen"), 1, n)
    wanted = materialise(histories.select("user_id", F.posexplode(free).alias("_at", "place")), "places")
    met = salted_join(wanted, places, "place", "user_id", hot_keys(wanted, "place"))
    return met.select("user_id", "item_id", "score", (F.col("_at") + 1).alias("rank"))


def _unit_columns(ratings: DataFrame, value: str) -> DataFrame:
    """Ratings with ``value`` divided by the item's norm, so that pair products are cosines.

    Scaling the ratings is one join on the smaller table; scaling the pairs would be two on the larger.
    """
    norms = ratings.groupBy("item_id").agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("_norm"))
    scaled = F.when(F.col("_norm") > 0, F.col(value) / F.col("_norm")).otherwise(F.lit(0.0))
    return ratings.join(norms, "item_id").select("user_id", "item_id", scaled.alias("rating"))


def _cosine(ratings: DataFrame, value: str, wanted: dict) -> DataFrame:
    """Pairs with their cosine as ``raw``; products are divided by the norms once the pairs with too little support are gone.

    The products of unscaled values are of fewer values and travel in less space than those of unit columns.
    """
    rows = ratings.filter(F.col("item_id").isNotNull()).select("user_id", "item_id", F.col(value).alias("rating"))
    norms = rows.groupBy("item_id").agg(F.sqrt(F.sum(F.col("rating") * F.col("rating"))).alias("_norm"))
    pairs = pair_stats(rows, **wanted)
    for side in ("i", "j"):
        pairs = pairs.join(norms.select(F.col("item_id").alias(f"item_{side}"), F.col("_norm").alias(f"_n{side}")), f"item_{side}")
    none = F.col("_ni").isNull() | F.col("_nj").isNull()
    scaled = F.when((F.col("_ni") > 0) & (F.col("_nj") > 0), F.col("dot") / F.col("_ni") / F.col("_nj"))
    return pairs.withColumn("raw", scaled.when(none, F.lit(0.0)).otherwise(F.col("dot") * F.lit(0.0)))


def _pearson(ratings: DataFrame, pairs: DataFrame) -> DataFrame:
    """Correlation over full columns, missing = 0: (n Sxy - Sx Sy) / sqrt(...); constant column -> 0."""
    n_users = ratings.agg(F.count_distinct("user_id")).scalar()
    sums = ratings.groupBy("item_id").agg(
        F.sum("rating").alias("_s"), F.sum(F.col("rating") * F.col("rating")).alias("_ss")
    )
    stats = sums.withColumn("_n", n_users).withColumn("_v", F.col("_n") * F.col("_ss") - F.col("_s") * F.col("_s"))
    left = stats.select(F.col("item_id").alias("item_i"), F.col("_s").alias("_si"), F.col("_v").alias("_vi"), "_n")
    right = stats.select(F.col("item_id").alias("item_j"), F.col("_s").alias("_sj"), F.col("_v").alias("_vj"))
    joined = pairs.join(left, "item_i").join(right, "item_j")
    spread = F.col("_vi") * F.col("_vj")
    value = (F.col("_n") * F.col("dot") - F.col("_si") * F.col("_sj")) / F.sqrt(spread)
    return joined.withColumn("raw", F.when((F.col("_vi") > 1e-9) & (F.col("_vj") > 1e-9), value).otherwise(F.lit(0.0)))


def item_similarity(
    ratings: DataFrame,
    metric: str = "cosine",
    min_support: int = 2,
    shrinkage: float = 0.0,
    mean_over: str = "all",
) -> DataFrame:
    """Similarity edges in both directions: item_i, item_j, sim, support, raw (before shrinkage).

    Pairs below ``min_support`` have similarity 0 and are left out; so is the diagonal. Only co-rated
    pairs are produced (a Pearson value of a pair nobody rated together needs min_support = 0).
    """
    wanted = {"least": max(1, min_support), "diff": False}
    if metric == "cosine":
        pairs = _cosine(ratings, "rating", wanted)
    elif metric == "adjusted_cosine":
        pairs = _cosine(centred(ratings, mean_over), "centred", wanted)
    elif metric == "pearson":
        pairs = _pearson(ratings, pair_stats(ratings, **wanted))
    else:
        raise ValueError(f"unknown metric {metric}")
    weight = F.col("n_co") / (F.col("n_co") + F.lit(float(shrinkage))) if shrinkage > 0 else F.lit(1.0)
    edges = pairs.filter(F.col("n_co") >= min_support).select(
        "item_i", "item_j", (weight * F.col("raw")).alias("sim"), F.col("n_co").alias("support"), "raw"
    )
    return mirrored(edges, flip=())


def drop_seen(scores: DataFrame, ratings: DataFrame) -> DataFrame:
    return scores.join(ratings.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def item_knn_scores(
    ratings: DataFrame,
    edges: DataFrame,
    k: int = 20,
    include_seen: bool = False,
    epsilon: float = 1e-8,
    targets: DataFrame | None = None,
    n: int | None = None,
) -> DataFrame:
    """sum(sim * r) / (sum |sim| + epsilon) over the k rated items with largest |sim| to the target.

    With ``epsilon`` = 0 the score is emitted only where the denominator exceeds 1e-8. ``targets``
    limits the work to given (user_id, item_id) pairs, ``n`` to what the best n of a user are taken from.
    A pair without neighbours has score 0 and no row.
    """
    weighed = edges.select("item_i", "item_j", F.col("sim").alias("w"), F.lit(1.0).alias("f"))
    return sparse_scores(ratings, weighed, Rule("neighbours", k, epsilon), targets, n, unseen=not include_seen)


def user_similarity(ratings: DataFrame, metric: str = "cosine") -> DataFrame:
    """Edges user_id, other_id, sim: cosine, or cosine of mean-centred ratings (pearson, adjusted_cosine).

    Found block against block (``user_blocks``). The unit vectors stay with the result as ``unit_vectors``: the scores
    below take the neighbours from them and need no table of all pairs, as long as the edges are passed on unchanged.
    """
    value = "rating"
    if metric != "cosine":
        ratings, value = centred(ratings, "rated"), "centred"
    flipped = ratings.select(F.col("item_id").alias("user_id"), F.col("user_id").alias("item_id"), value)
    vectors = materialise(
        _unit_columns(flipped, value).select(F.col("item_id").alias("user_id"), F.col("user_id").alias("item_id"), F.col("rating").alias("x")),
        "unit_vectors",
    )
    edges = user_blocks(vectors, "pairs")
    edges.unit_vectors = vectors
    return edges


def user_knn_scores(
    ratings: DataFrame, edges: DataFrame, k: int = 20, low: float = 0.0, high: float = 5.0
) -> DataFrame:
    """mean_u + sum(sim * (r_v - mean_v)) / sum |sim| over the k most similar users who rated the item.

    Raters without an edge have similarity 0: they add nothing but take slots before negative
    neighbours, so negatives are admitted only for the slots that the others leave.
    """
    means = ratings.groupBy("user_id").agg(F.avg("rating").alias("mean"))
    offsets = ratings.join(means, "user_id").select(
        F.col("user_id").alias("other_id"), "item_id", (F.col("rating") - F.col("mean")).alias("gap")
    )
    vectors = getattr(edges, "unit_vectors", None)
    if vectors is not None:
        nameless = ratings.filter("user_id IS NULL").groupBy("item_id").agg(F.count("*").alias("slots"))
        sums = user_blocks(vectors, "scores", k, offsets.withColumnRenamed("other_id", "user_id"), nameless)
        return _mean_offset_scores(sums, means, low, high)
    hot = hot_keys(offsets, "other_id")
    met = salted_join(edges.filter(F.col("sim") != 0), offsets, "other_id", "user_id", hot)
    met = drop_seen(met, ratings).withColumn("sign", F.signum(tie_safe(F.col("sim")))).filter(F.col("sign") != 0)
    # the largest table of the query: one window gives both the places and the number of negatives
    group = Window.partitionBy("user_id", "item_id", "sign")
    order = group.orderBy(tie_safe(F.col("sim")).desc(), "other_id")
    placed = met.withColumn("_rn", F.row_number().over(order)).withColumn("_same", F.count("*").over(group))
    raters = ratings.groupBy("item_id").agg(F.count("*").alias("_raters"))
    admitted = (
        placed.filter(F.col("_rn") <= k)
        .join(raters, "item_id")
        .filter((F.col("sign") > 0) | (F.col("_rn") <= F.lit(k) - (F.col("_raters") - F.col("_same"))))
    )
    return _mean_offset_scores(_weighed_gaps(admitted), means, low, high)


def user_knn_fixed_scores(
    ratings: DataFrame, edges: DataFrame, k: int = 20, low: float = 1.0, high: float = 5.0
) -> DataFrame:
    """Variant: the k nearest users are fixed first, then those of them who rated the item count.

    Users without an edge have similarity 0 and come before negative neighbours, as above.
    """
    means = ratings.groupBy("user_id").agg(F.avg("rating").alias("mean"))
    offsets = ratings.join(means, "user_id").select(
        F.col("user_id").alias("other_id"), "item_id", (F.col("rating") - F.col("mean")).alias("gap")
    )
    vectors = getattr(edges, "unit_vectors", None)
    if vectors is not None:
        near = materialise(user_blocks(vectors, "near", k, offsets.withColumnRenamed("other_id", "user_id")), "near")
    else:
        near = _nearest(edges, ratings, k)
    met = salted_join(near, offsets, "other_id", "user_id", hot_keys(offsets, "other_id"))
    return _mean_offset_scores(_weighed_gaps(drop_seen(met, ratings)), means, low, high)


def _nearest(edges: DataFrame, ratings: DataFrame, k: int) -> DataFrame:
    signed = edges.withColumn("sign", F.signum(tie_safe(F.col("sim")))).filter(F.col("sign") != 0)
    order = Window.partitionBy("user_id", "sign").orderBy(tie_safe(F.col("sim")).desc(), "other_id")
    below = signed.filter(F.col("sign") < 0).groupBy("user_id").agg(F.count("*").alias("_neg"))
    others = ratings.agg(F.count_distinct("user_id") - 1).scalar()
    return (
        signed.withColumn("_rn", F.row_number().over(order))
        .filter(F.col("_rn") <= k)
        .join(below, "user_id", "left")
        .filter((F.col("sign") > 0) | (F.col("_rn") <= F.lit(k) - (others - F.coalesce("_neg", F.lit(0)))))
    )


def _weighed_gaps(met: DataFrame) -> DataFrame:
    return met.groupBy("user_id", "item_id").agg(
        F.sum(F.col("sim") * F.col("gap")).alias("num"), F.sum(F.abs("sim")).alias("den")
    )


def _mean_offset_scores(sums: DataFrame, means: DataFrame, low: float, high: float) -> DataFrame:
    raw = F.col("mean") + F.col("num") / F.col("den")
    return (
        sums.filter(F.col("den") > 0)
        .join(means, "user_id")
        .select("user_id", "item_id", F.greatest(F.lit(low), F.least(F.lit(high), raw)).alias("score"))
    )


def mean_fallback(targets: DataFrame, scores: DataFrame, ratings: DataFrame) -> DataFrame:
    """Targets with their score, or the user's mean where no neighbour rated the item."""
    means = ratings.groupBy("user_id").agg(F.avg("rating").alias("_mean"))
    return (
        targets.join(scores, ["user_id", "item_id"], "left")
        .join(means, "user_id", "left")
        .withColumn("score", F.coalesce("score", "_mean"))
        .drop("_mean")
    )


def slope_one_deviations(ratings: DataFrame) -> DataFrame:
    """item_i, item_j, dev = avg(r_i - r_j), freq, in both directions."""
    pairs = pair_stats(ratings).select(
        "item_i", "item_j", (F.col("diff") / F.col("n_co")).alias("dev"), F.col("n_co").alias("freq")
    )
    return mirrored(pairs, flip=("dev",))


def slope_one_scores(ratings: DataFrame, deviations: DataFrame, targets: DataFrame | None = None, n: int | None = None) -> DataFrame:
    """sum((r + dev) * freq) / sum(freq) over the user's rated items, for unseen items; ``targets`` and ``n`` as above."""
    weighed = deviations.select("item_i", "item_j", F.col("dev").alias("w"), F.col("freq").alias("f"))
    return sparse_scores(ratings, weighed, Rule("deviation"), targets, n)


def jaccard_edges(ratings: DataFrame, threshold: int = 2) -> DataFrame:
    """Co-occurrence similarity c_ij / (c_i + c_j - c_ij) of pairs with c_ij >= threshold."""
    seen = binarise(ratings)
    counts = seen.groupBy("item_id").agg(F.count("*").alias("_c"))
    pairs = pair_stats(seen, least=threshold, diff=False).select("item_i", "item_j", F.col("n_co").alias("support"))
    joined = pairs.join(counts.select(F.col("item_id").alias("item_i"), F.col("_c").alias("_ci")), "item_i").join(
        counts.select(F.col("item_id").alias("item_j"), F.col("_c").alias("_cj")), "item_j"
    )
    sim = F.col("support") / (F.col("_ci") + F.col("_cj") - F.col("support"))
    return mirrored(joined.select("item_i", "item_j", sim.alias("sim"), "support"), flip=())


def propagate(
    ratings: DataFrame, edges: DataFrame, weight: str = "sim", targets: DataFrame | None = None, n: int | None = None, unseen: bool = False
) -> DataFrame:
    """history @ S: score of an item = sum over the user's ratings of r * weight(item_j -> item_i)."""
    weighed = edges.select("item_i", "item_j", F.col(weight).alias("w"), F.lit(1.0).alias("f"))
    return sparse_scores(ratings, weighed, Rule("sum"), targets, n, unseen)


def cooccurrence_pagerank(
    ratings: DataFrame, alpha: float = 0.85, max_iter: int = 100, tol: float = 1e-6, normalise: bool = True
) -> DataFrame:
    """PageRank of items over the row-normalised co-occurrence graph without self links.

    Items without links keep only the base share. The rank table is written out every round; the graph
    is written once, partitioned by source item like the join that reads it.
    """
    links = mirrored(pair_stats(binarise(ratings)).select("item_i", "item_j", "n_co"), flip=())
    out = links.groupBy("item_i").agg(F.sum("n_co").alias("_out"))
    graph = materialise(
        links.join(out, "item_i").select("item_i", "item_j", (F.col("n_co") / F.col("_out")).alias("w")), "graph"
    )
    items = materialise(ratings.select("item_id").distinct(), "items")
    size = items.count()
    if size == 0:
        return items.withColumn("weight", F.lit(0.0))
    base = (1.0 - alpha) / size
    ranks = items.withColumn("pr", F.lit(1.0 / size))
    for _ in range(max_iter):
        flow = (
            graph.join(ranks.withColumnRenamed("item_id", "item_i"), "item_i")
            .groupBy(F.col("item_j").alias("item_id"))
            .agg(F.sum(F.col("w") * F.col("pr")).alias("_in"))
        )
        step = materialise(
            ranks.join(flow, "item_id", "left").select(
                "item_id",
                F.col("pr").alias("_old"),
                (F.lit(base) + F.lit(alpha) * F.coalesce("_in", F.lit(0.0))).alias("pr"),
            ),
            "ranks",
        )
        moved = step.agg(F.sum(F.abs(F.col("pr") - F.col("_old")))).first()[0]
        if moved < tol:
            break
        ranks = step.drop("_old")
    if not normalise:
        return ranks.withColumnRenamed("pr", "weight")
    low, high = ranks.agg(F.min("pr"), F.max("pr")).first()
    if not high > low:
        return ranks.select("item_id", F.lit(0.0).alias("weight"))
    return ranks.select("item_id", ((F.col("pr") - F.lit(low)) / F.lit(high - low)).alias("weight"))
