"""Item embeddings from histories and the tables around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.functions.columns import HASH_RANGE, mix
from ratingloom.operators.gradient import ITEM, Factors, Layout, apply_step, gradient_sums, inner
from ratingloom.operators.pairs import mirrored, pair_stats
from ratingloom.operators.prepare import histories
from ratingloom.operators.recommend import score_blocks, top_n
from ratingloom.session import materialise
from ratingloom.skew import hot_keys, running_totals, salted_join

POWER = 0.75


def noise_distribution(vocabulary: DataFrame, liked: DataFrame, epsilon: float = 0.0) -> DataFrame:
    """item_id, n, prob = (n^0.75 + epsilon) / total over the vocabulary; unseen items have n = 0."""
    counts = liked.groupBy("item_id").agg(F.count("*").alias("n"))
    raw = (
        vocabulary.select("item_id").distinct().join(counts, "item_id", "left")
        .select("item_id", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
        .withColumn("_w", F.pow("n", F.lit(POWER)) + F.lit(epsilon))
    )
    total = raw.agg(F.sum("_w")).scalar()
    return raw.select("item_id", "n", (F.col("_w") / total).alias("prob"))


def skip_gram_pairs(liked: DataFrame) -> DataFrame:
    """center, context, n: ordered pairs of different items of one history, with their multiplicity.

    The counts come from the pair kernel, so the pairs of a history are never listed one by one.
    """
    pairs = pair_stats(liked.select("user_id", "item_id").distinct().withColumn("rating", F.lit(1.0)))
    return mirrored(pairs.select("item_i", "item_j", F.col("n_co").alias("n")), flip=()).select(
        F.col("item_i").alias("center"), F.col("item_j").alias("context"), "n"
    )


def cbow_examples(liked: DataFrame) -> DataFrame:
    """user_id, center, context: each item of a history with all its others, one row per user and centre.

    A history of one item gives no row. By definition the output of a history grows with the square of its length.
    """
    rows = histories(liked.select("user_id", "item_id").distinct())
    rows = rows.filter(F.size("items") > 1).select("user_id", F.explode("items").alias("center"), "items")
    return rows.select("user_id", "center", F.array_remove("items", F.col("center")).alias("context"))


def draw_noise(rows: DataFrame, noise: DataFrame, a: str, b: str, per: int, seed: int, buckets: int) -> DataFrame:
    """``per`` items per row drawn from the noise distribution by inverse cumulative probability.

    ``noise``: item_id, lo, hi. The unit interval is cut into buckets; an item is listed in each bucket
    its interval touches, so the range join is an equi-join on the bucket. Draws are uniform over buckets.
    """
    draws = rows.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(per))))
    salt = F.lit(seed) + F.col("draw") * 101
    wide = mix(a, b, salt) * F.lit(HASH_RANGE) + mix(b, a, salt + 1)
    draws = draws.withColumn("_u", wide / F.lit(float(HASH_RANGE) * float(HASH_RANGE)))
    draws = draws.withColumn("_bucket", F.floor(F.col("_u") * buckets).cast("int"))
    last = F.lit(buckets - 1)
    spans = noise.select(
        F.col("item_id").alias("neg"), "lo", "hi",
        F.explode(
            F.sequence(F.floor(F.col("lo") * buckets).cast("int"), F.least(F.floor(F.col("hi") * buckets).cast("int"), last))
        ).alias("_bucket"),
    )
    met = draws.join(spans, "_bucket").filter((F.col("_u") >= F.col("lo")) & (F.col("_u") < F.col("hi")))
    return met.drop("_u", "_bucket", "lo", "hi")


def noise_intervals(noise: DataFrame) -> DataFrame:
    """item_id, lo, hi: cumulative probabilities in item order; the last interval is open at the top."""
    kept = noise.filter(F.col("prob") > 0).select("item_id", "prob")
    summed = materialise(running_totals(kept, [F.col("item_id")], {"hi": "prob"}), "noise")
    end = summed.agg(F.max("item_id")).scalar()
    return summed.select(
        "item_id", (F.col("hi") - F.col("prob")).alias("lo"),
        F.when(F.col("item_id") == end, F.lit(2.0)).otherwise(F.col("hi")).alias("hi"),
    )


def _embedding_start(vocabulary: DataFrame, k: int, seed: int, scale: float) -> Factors:
    """One row per item: v (input vector) and o (output vector)."""
    from ratingloom.functions.columns import mix_unit

    layout = Layout(v=k, o=k)
    entries = [F.lit(scale) * (mix_unit(F.col("item_id"), F.lit(f), seed) - F.lit(0.5)) for f in range(2 * k)]
    items = vocabulary.select("item_id").distinct()
    state = items.select(F.lit(ITEM).alias("side"), F.col("item_id").alias("id"), F.array(*entries).alias("v"))
    return Factors(materialise(state, "state"), Layout(), layout)


def _named(f: Factors, key: str, name: str, slice_name: str) -> DataFrame:
    return f.items().select(F.col("item_id").alias(key), f.item.slice("iv", slice_name).alias(name))


def _cells(name: str, k: int) -> list:
    return [F.col(name)[c] for c in range(k)]


def fit_skip_gram(
    vocabulary: DataFrame, liked: DataFrame, k: int, epochs: int = 10, lr: float = 0.05, negatives: int = 5, seed: int = 0
) -> Factors:
    """Skip-gram with negative sampling over pair counts: log s(v.o) + sum log s(-v.n).

    A pair met n times is one row of weight n; its noise draws carry the same weight.
    """
    pairs = materialise(skip_gram_pairs(liked), "pairs")
    noise = noise_intervals(noise_distribution(vocabulary, liked))
    buckets = max(1, noise.count())
    model = _embedding_start(vocabulary, k, seed, 2.0)
    zero = [F.lit(0.0)] * k
    for number in range(1, epochs + 1):
        centers, outs = _named(model, "center", "vc", "v"), _named(model, "item", "vo", "o")
        positive = pairs.select("center", F.col("context").alias("item"), "n", F.lit(1.0).alias("label"))
        drawn = draw_noise(pairs, noise, "center", "context", negatives, seed + 1000 * number, buckets)
        negative = drawn.select("center", F.col("neg").alias("item"), "n", F.lit(0.0).alias("label"))
        rows = positive.unionByName(negative).join(centers, "center").join(outs, "item")
        vc, vo = _cells("vc", k), _cells("vo", k)
        rows = rows.withColumn("d", F.col("n") * (F.col("label") - 1 / (1 + F.exp(-inner(vc, vo)))))
        sums = gradient_sums(
            rows,
            [
                (ITEM, F.col("center"), [F.col("d") * x for x in vo] + zero, F.col("n") * F.col("label")),
                (ITEM, F.col("item"), zero + [F.col("d") * x for x in vc], F.lit(0.0)),
            ],
        )
        model = apply_step(model, _scaled_outputs(sums, rows, k), lr, {})
    return model


def _scaled_outputs(sums: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """Input entries are divided by the item's centre count, output entries by its count as an output."""
    counts = rows.groupBy(F.col("item").alias("id")).agg(F.sum("n").cast("double").alias("n_out"))
    met = sums.join(counts, "id", "left")
    g = [F.when(F.col("n") > 0, F.col("g")[f] / F.col("n")).otherwise(F.lit(0.0)) for f in range(k)]
    g += [F.when(F.col("n_out") > 0, F.col("g")[f] / F.col("n_out")).otherwise(F.lit(0.0)) for f in range(k, 2 * k)]
    return met.select("side", "id", F.lit(1.0).alias("n"), F.array(*g).alias("g"))


def fit_cbow(
    vocabulary: DataFrame, liked: DataFrame, k: int, epochs: int = 10, lr: float = 0.05, negatives: int = 5, seed: int = 0
) -> Factors:
    """Mean of the other items' input vectors against the centre, with negative sampling.

    The context mean is the history sum less the centre, so contexts are never listed; histories with
    one item give no example.
    """
    sizes = liked.select("user_id", "item_id").distinct().groupBy("user_id").agg(F.count("*").alias("h"))
    seen = materialise(
        liked.select("user_id", "item_id").distinct().join(sizes.filter(F.col("h") > 1), "user_id"), "histories"
    )
    noise = noise_intervals(noise_distribution(vocabulary, liked, 1e-8))
    buckets = max(1, noise.count())
    hot_items, hot_users = hot_keys(seen, "item_id"), hot_keys(seen, "user_id")
    model = _embedding_start(vocabulary, k, seed, 1.0 / k)
    zero = [F.lit(0.0)] * k
    for number in range(1, epochs + 1):
        placed = salted_join(seen, _named(model, "item_id", "v", "v"), "item_id", "user_id", hot_items)
        total = placed.groupBy("user_id").agg(F.array(*[F.sum(x) for x in _cells("v", k)]).alias("s"))
        mean = [(s - v) / (F.col("h") - 1) for s, v in zip(_cells("s", k), _cells("v", k))]
        context = materialise(
            salted_join(placed, total, "user_id", "item_id", hot_users).select("user_id", "item_id", "h", F.array(*mean).alias("m")),
            "contexts",
        )
        drawn = draw_noise(context, noise, "user_id", "item_id", negatives, seed + 1000 * number, buckets)
        positive = context.select("*", F.col("item_id").alias("out"), F.lit(1.0).alias("label"))
        negative = drawn.select("user_id", "item_id", "h", "m", F.col("neg").alias("out"), F.lit(0.0).alias("label"))
        rows = positive.unionByName(negative).join(_named(model, "out", "vo", "o"), "out")
        m, vo = _cells("m", k), _cells("vo", k)
        rows = rows.withColumn("d", F.col("label") - 1 / (1 + F.exp(-inner(m, vo))))
        rows = materialise(rows.select("user_id", "item_id", "h", "m", "out", "label", "vo", "d"), "errors")
        outputs = rows.groupBy(F.col("out").alias("id")).agg(
            F.count("*").cast("double").alias("n"), F.array(*[F.sum(F.col("d") * x) for x in m]).alias("go")
        )
        per_example = rows.groupBy("user_id", "item_id", "h").agg(
            F.array(*[F.sum(F.col("d") * x) for x in vo]).alias("dh")
        )
        per_user = per_example.groupBy("user_id").agg(F.array(*[F.sum(x) for x in _cells("dh", k)]).alias("gu"))
        pushed = salted_join(per_example, per_user, "user_id", "item_id", hot_users)
        inputs = pushed.groupBy(F.col("item_id").alias("id")).agg(
            F.sum(F.col("h") - 1).cast("double").alias("updates"),
            F.array(*[F.sum((a - b) / (F.col("h") - 1)) for a, b in zip(_cells("gu", k), _cells("dh", k))]).alias("gi"),
        )
        both = inputs.join(outputs, "id", "full")
        g = [F.coalesce(F.col("gi")[c] / F.col("updates"), F.lit(0.0)) for c in range(k)]
        g += [F.coalesce(F.col("go")[c] / F.col("n"), F.lit(0.0)) for c in range(k)]
        sums = both.select(F.lit(ITEM).alias("side"), "id", F.lit(1.0).alias("n"), F.array(*g).alias("g"))
        model = apply_step(model, sums, lr, {})
    return model


def item_vectors(model: Factors) -> DataFrame:
    """item_id, v: the input vectors."""
    return _named(model, "item_id", "v", "v")


def similar_items(vectors: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most cosine-similar other items of every item; a zero vector is similar to nothing (0)."""
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    unit = vectors.withColumn("_size", size).select(
        "item_id", F.transform("v", lambda x: F.when(F.col("_size") > 0, x / F.col("_size")).otherwise(F.lit(0.0))).alias("q")
    )
    queries = unit.select(F.col("item_id").alias("user_id"), F.col("q").alias("p"))
    own = unit.select(F.col("item_id").alias("user_id"), "item_id")
    best = score_blocks(queries, unit, n, own)
    return best.select(F.col("user_id").alias("item_id"), F.col("item_id").alias("similar_id"), F.col("score").alias("sim"), "rank")


def mean_feature_vectors(item_features: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """item_id, v: element-wise mean of the vectors of the item's features."""
    met = item_features.select("item_id", "feature").join(vectors.select("feature", "v"), "feature")
    return met.groupBy("item_id").agg(F.array(*[F.avg(F.col("v")[c]) for c in range(k)]).alias("v"))


def sequences(ratings: DataFrame, max_len: int = 50, order: Sequence[str] = ("ts", "item_id")) -> DataFrame:
    """Next-item training rows: input and target of length ``max_len``, ids + 1, padded with 0 on the left.

    Only the last max_len + 1 items of a user leave the map side; users with one item have no target.
    """
    latest = Window.partitionBy("user_id").orderBy(*[F.col(c).desc() for c in order])
    kept = ratings.withColumn("_rn", F.row_number().over(latest)).filter(F.col("_rn") <= max_len + 1)
    lists = kept.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("_rn")).alias("at"), "item_id"))).alias("_s"))
    shifted = lists.select("user_id", F.transform("_s", lambda x: x["item_id"] + 1).alias("_ids")).filter(F.size("_ids") > 1)
    n = F.size("_ids") - 1
    pad = F.array_repeat(F.lit(0).cast("long"), F.lit(max_len) - n)
    return shifted.select(
        "user_id",
        F.concat(pad, F.slice("_ids", F.lit(1), n)).alias("input"),
        F.concat(pad, F.slice("_ids", F.lit(2), n)).alias("target"),
    )


def reconstruction_view(ratings: DataFrame, scores: DataFrame, n: int = 10) -> DataFrame:
    """Rated items with their reconstructed value, and the ``n`` best unrated ones (original 0)."""
    rated = ratings.select("user_id", "item_id", F.col("rating").alias("original")).join(
        scores.select("user_id", "item_id", F.col("score").alias("reconstructed")), ["user_id", "item_id"], "left"
    )
    rated = rated.fillna(0.0, ["reconstructed"])
    new = top_n(scores, ratings, n).select(
        "user_id", "item_id", F.lit(0.0).alias("original"), F.col("score").alias("reconstructed")
    )
    return rated.unionByName(new)
