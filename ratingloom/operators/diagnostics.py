"""Tables behind the diagnostic views."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.functions.columns import mix, tie_safe
from ratingloom.skew import global_rank

BINS = 50


def convergence(spark: SparkSession, history: Sequence[dict]) -> DataFrame:
    """Long table iteration, metric, value of a model's recorded history."""
    rows = [
        (int(entry["iteration"]), name, float(value))
        for entry in history
        for name, value in entry.items()
        if name != "iteration" and value is not None
    ]
    return spark.createDataFrame(rows, "iteration int, metric string, value double")


def histogram(values: DataFrame, col: str, bins: int = BINS, non_zero: bool = False) -> DataFrame:
    """Counts of equal-width bins between minimum and maximum; the last bin is closed. Empty bins are kept."""
    kept = values.filter(F.col(col).isNotNull() & ~F.isnan(col))
    if non_zero:
        kept = kept.filter(F.col(col) != 0)
    low, high = kept.agg(F.min(col), F.max(col)).first()
    spark = values.sparkSession
    if low is None:
        return spark.createDataFrame([], "bin int, low double, high double, count long")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    slot = F.least(F.floor((F.col(col) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = kept.groupBy(slot.alias("bin")).agg(F.count("*").alias("count"))
    frame = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def density_against_normal(values: DataFrame, col: str, bins: int = BINS) -> DataFrame:
    """Density histogram with the standard normal density at each bin centre."""
    counts = histogram(values, col, bins)
    total = values.filter(F.col(col).isNotNull() & ~F.isnan(col)).agg(F.count("*")).scalar()
    centre = (F.col("low") + F.col("high")) / 2
    return counts.select(
        "bin",
        centre.alias("center"),
        (F.col("count") / (total * (F.col("high") - F.col("low")))).alias("density"),
        (F.exp(-centre * centre / 2) / F.lit(math.sqrt(2 * math.pi))).alias("normal"),
    )


def vector_cells(table: DataFrame, key: str, vec: str) -> DataFrame:
    """Long form of a vector column: key, factor, value."""
    return table.select(key, F.posexplode(vec).alias("factor", "value"))


def sampled_ids(table: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` distinct ids in hash order: a repeatable sample."""
    ids = table.select(key).distinct()
    return ids.orderBy(mix(key, F.lit(1), seed), key).limit(n)


def factor_snapshot(table: DataFrame, key: str, vec: str, rows: int = 50, columns: int = 50, seed: int = 0) -> DataFrame:
    """Cells of sampled rows and sampled columns of a factor table."""
    picked = sampled_ids(table, key, rows, seed)
    cells = vector_cells(table.join(picked, key, "left_semi"), key, vec)
    width = table.select(F.max(F.size(vec))).first()[0] or 0
    if width > columns:
        frame = table.sparkSession.range(width).select(F.col("id").cast("int").alias("factor"))
        cells = cells.join(sampled_ids(frame, "factor", columns, seed), "factor", "left_semi")
    return cells


def snapshot_iterations(total: int, every: int = 5) -> list[int]:
    """Iterations at which factors are kept: the first, the last and every fifth."""
    return [i for i in range(1, total + 1) if i in (1, total) or i % every == 0]


def scatter(table: DataFrame, key: str, vec: str) -> DataFrame:
    """Points of a two-factor table."""
    return table.filter(F.size(vec) == 2).select(key, F.col(vec)[0].alias("x"), F.col(vec)[1].alias("y"))


def similarity_sample(edges: DataFrame, n: int = 100, seed: int = 0) -> DataFrame:
    """Edges between sampled ids on both axes."""
    ids = sampled_ids(edges.select(F.col("item_i").alias("id")), "id", n, seed)
    return edges.join(ids.withColumnRenamed("id", "item_i"), "item_i", "left_semi").join(
        ids.withColumnRenamed("id", "item_j"), "item_j", "left_semi"
    )


def sparsity(edges: DataFrame, items: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Items, non-zero cells and share of zero cells of an item x item table."""
    n = items.select("item_id").distinct().count()
    filled = edges.filter(F.abs("sim") > tolerance).agg(F.count("*").alias("non_zero"))
    return filled.select(
        F.lit(n).cast("long").alias("n_items"), "non_zero", (1 - F.col("non_zero") / F.lit(float(max(n * n, 1)))).alias("sparsity")
    )


def scree(components: DataFrame) -> DataFrame:
    """Share of the variance per component and its running sum. One row per component, so the window is small."""
    energy = F.col("sigma") * F.col("sigma")
    total = components.agg(F.sum(energy)).scalar()
    shares = components.withColumn("share", energy / total)
    running = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    return shares.withColumn("cumulative", F.sum("share").over(running)).select("component", "sigma", "share", "cumulative")


def error_curve(pairs: DataFrame) -> DataFrame:
    """Absolute errors sorted from largest, with their percentile 0-100; equal errors stay distinct points."""
    errors = pairs.select("user_id", "item_id", F.abs(F.col("rating") - F.col("prediction")).alias("error"))
    ranked = global_rank(errors, [tie_safe(F.col("error")).desc(), F.col("user_id"), F.col("item_id")], "rank")
    last = errors.agg(F.count("*") - 1).scalar()
    share = F.when(last > 0, (F.col("rank") - 1) / last * 100).otherwise(F.lit(0.0))
    return ranked.withColumn("percentile", share)


def popularity_bar(scores: DataFrame, n: int = 50) -> DataFrame:
    return scores.orderBy(tie_safe(F.col("score")).desc(), "item_id").limit(n)


def grid_ids(ratings: DataFrame, n_users: int = 20, n_items: int = 20) -> tuple[DataFrame, DataFrame]:
    """The first users and items, as one-column tables."""
    users = ratings.select("user_id").distinct().orderBy("user_id").limit(n_users)
    return users, ratings.select("item_id").distinct().orderBy("item_id").limit(n_items)


def prediction_grid(ratings: DataFrame, scores: DataFrame, n_users: int = 20, n_items: int = 20) -> DataFrame:
    """Original and predicted values on the first users and items; a prediction without rating is new."""
    users, items = grid_ids(ratings, n_users, n_items)

    def cut(df):
        return df.join(users, "user_id", "left_semi").join(items, "item_id", "left_semi")

    both = cut(ratings.select("user_id", "item_id", "rating")).join(
        cut(scores.select("user_id", "item_id", "score")), ["user_id", "item_id"], "full"
    )
    return both.select(
        "user_id",
        "item_id",
        F.coalesce("rating", F.lit(0.0)).alias("original"),
        F.coalesce("score", F.lit(0.0)).alias("predicted"),
        F.col("rating").isNull().alias("is_new"),
    )


def projection_2d(table: DataFrame, key: str, vec: str, n: int = 1000, seed: int = 0) -> DataFrame:
    """First two principal components of sampled vectors (a linear stand-in for a neighbour embedding)."""
    picked = table.join(sampled_ids(table, key, n, seed), key, "left_semi").withColumn("_f", array_to_vector(vec))
    fitted = PCA(k=2, inputCol="_f", outputCol="_c").fit(picked)
    placed = fitted.transform(picked).withColumn("_xy", vector_to_array("_c"))
    return placed.select(*[c for c in table.columns if c != vec], F.col("_xy")[0].alias("x"), F.col("_xy")[1].alias("y"))


def coefficient_summary(edges: DataFrame) -> DataFrame:
    """Non-zero coefficients: count, mean, minimum and maximum."""
    return edges.filter(F.col("sim") != 0).agg(
        F.count("*").alias("non_zero"), F.avg("sim").alias("mean"), F.min("sim").alias("low"), F.max("sim").alias("high")
    )


# ---- learned against known -----------------------------------------------------------------------


def factor_feature_correlation(factors: DataFrame, truth: DataFrame, vec: str = "q") -> DataFrame:
    """|Pearson| of every learned factor with every 0/1 feature, over the items both tables know.

    ``truth``: item_id, feature for the cells equal to 1. The closed form needs only sums over the items
    that have the feature, so the 0 cells are never built. A constant column has no correlation (null).
    """
    known = truth.select("item_id").distinct()
    common = factors.join(known, "item_id", "left_semi")
    cells = vector_cells(common, "item_id", vec)
    base = cells.groupBy("factor").agg(
        F.count("*").alias("n"), F.sum("value").alias("sx"), F.sum(F.col("value") * F.col("value")).alias("sxx")
    )
    met = cells.join(truth.select("item_id", "feature").distinct(), "item_id").groupBy("factor", "feature").agg(
        F.count("*").alias("sy"), F.sum("value").alias("sxy")
    )
    vx = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = F.col("n") * F.col("sy") - F.col("sy") * F.col("sy")
    corr = (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt(vx * vy)
    return met.join(base, "factor").select(
        "factor", "feature", F.when((vx > 1e-12) & (vy > 0), F.abs(corr)).alias("correlation")
    )


def expectation_gap(predictions: DataFrame, ideal: DataFrame, top: float = 5.0) -> DataFrame:
    """Prediction minus ideal, the raw ideal scores rescaled to [0, top] over the given cells.

    ``predictions``: user_id, item_id, score; ``ideal``: user_id, item_id, raw (every cell of the subset).
    """
    ends = ideal.agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).first()
    low, high = (ends["lo"] or 0.0), (ends["hi"] or 0.0)
    scale = top / (high - low) if high > low else 0.0
    both = ideal.join(predictions.select("user_id", "item_id", "score"), ["user_id", "item_id"], "left")
    scaled = (F.col("raw") - F.lit(low)) * F.lit(scale)
    score = F.coalesce("score", F.lit(0.0))
    return both.select(
        "user_id", "item_id", "raw", scaled.alias("ideal"), score.alias("prediction"), (score - scaled).alias("difference")
    )


def cell_detail(gap: DataFrame, profiles: DataFrame, features: DataFrame, user: int, item: int) -> DataFrame:
    """One cell of the expectation table with the user's profile and the item's features.

    Both lists are bounded by the feature list.
    """
    cell = gap.filter((F.col("user_id") == user) & (F.col("item_id") == item))
    p = profiles.filter(F.col("user_id") == user).groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("feature", "weight"))).alias("profile")
    )
    q = features.filter(F.col("item_id") == item).groupBy("item_id").agg(F.array_sort(F.collect_set("feature")).alias("features"))
    return cell.join(p, "user_id", "left").join(q, "item_id", "left")
