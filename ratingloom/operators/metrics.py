"""Rating and ranking metrics (V1-V5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.operators.recommend import top_n
from ratingloom.skew import running_totals


def regression_metrics(pairs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """RMSE, MAE, R2, MAPE and explained variance of (rating, prediction); all 0 when there are no rows."""
    err = F.col("rating") - F.col("prediction")
    stats = pairs.groupBy(*by).agg(
        F.count("*").alias("_n"),
        F.avg(err * err).alias("_mse"),
        F.avg(F.abs(err)).alias("_mae"),
        F.var_pop("rating").alias("_var"),
        F.var_pop(err).alias("_evar"),
        F.avg(F.abs(err / (F.col("rating") + F.lit(1e-8)))).alias("_mape"),
    )

    def share(part: str):
        flat = F.when(F.col(part) == 0, F.lit(1.0)).otherwise(F.lit(0.0))
        return F.when(F.col("_var") > 0, 1 - F.col(part) / F.col("_var")).otherwise(flat)

    def or_zero(value, name):
        return F.when(F.col("_n") > 0, value).otherwise(F.lit(0.0)).alias(name)

    return stats.select(
        *by,
        or_zero(F.sqrt("_mse"), "rmse"),
        or_zero(F.col("_mae"), "mae"),
        or_zero(share("_mse"), "r2"),
        or_zero(F.col("_mape") * 100, "mape"),
        or_zero(share("_evar"), "explained_variance"),
    )


def with_default(test: DataFrame, scores: DataFrame, default: float = 0.0) -> DataFrame:
    """Test ratings with their prediction; pairs the model does not score get ``default``."""
    predicted = scores.select("user_id", "item_id", F.col("score").alias("prediction"))
    return test.join(predicted, ["user_id", "item_id"], "left").fillna(default, ["prediction"])


def precision_recall(
    scores: DataFrame, test: DataFrame, train: DataFrame, k: int = 10, exclude_seen: bool = True
) -> DataFrame:
    """Mean over users with test items of hits / k and hits / relevant, for the k best items."""
    best = top_n(scores, train if exclude_seen else None, k).select("user_id", "item_id", F.lit(1).alias("hit"))
    per_user = (
        test.select("user_id", "item_id")
        .join(best, ["user_id", "item_id"], "left")
        .groupBy("user_id")
        .agg(F.count("hit").alias("hits"), F.count("*").alias("relevant"))
    )
    return per_user.agg(
        F.coalesce(F.avg(F.col("hits") / F.lit(k)), F.lit(0.0)).alias("precision"),
        F.coalesce(F.avg(F.col("hits") / F.col("relevant")), F.lit(0.0)).alias("recall"),
        F.count("*").alias("n_users"),
    )


def leave_one_out_metrics(scores: DataFrame, test: DataFrame, train: DataFrame, k: int = 10) -> DataFrame:
    """Precision, recall, MRR and nDCG at k of the single left-out item, ranked among unseen items."""
    best = top_n(scores, train, k).select("user_id", "item_id", "rank")
    found = test.select("user_id", "item_id").join(best, ["user_id", "item_id"], "left")
    zero = F.lit(0.0)
    return found.agg(
        F.coalesce(F.avg(F.when(F.col("rank").isNotNull(), F.lit(1.0 / k)).otherwise(zero)), zero).alias("precision_loo"),
        F.coalesce(F.avg(F.when(F.col("rank").isNotNull(), F.lit(1.0)).otherwise(zero)), zero).alias("recall_loo"),
        F.coalesce(F.avg(F.coalesce(1.0 / F.col("rank"), zero)), zero).alias("mrr_loo"),
        F.coalesce(F.avg(F.coalesce(1.0 / F.log2(F.col("rank") + 1), zero)), zero).alias("ndcg_loo"),
    )


def one_vs_rest(scored: DataFrame) -> DataFrame:
    """Rows per class plus the micro average: input class, score, label (0/1)."""
    micro = scored.withColumn("class", F.lit("micro"))
    return scored.withColumn("class", F.col("class").cast("string")).unionByName(micro)


def roc_curve(scored: DataFrame) -> DataFrame:
    """Points of the ROC curve per class: class, threshold, fpr, tpr, area (of the step up to the point).

    Equal scores are one point. Running counts are taken over one global order (class, score desc) and
    the counts of earlier classes taken off, so no class is a single task.
    """
    points = scored.groupBy("class", "score").agg(
        F.sum("label").cast("long").alias("pos"), F.sum(1 - F.col("label")).cast("long").alias("neg")
    )
    counted = running_totals(points, [F.col("class"), F.desc("score")], {"_tp": "pos", "_fp": "neg"})
    per_class = counted.groupBy("class").agg(
        F.max("_tp").alias("_tp_end"), F.max("_fp").alias("_fp_end"), F.sum("pos").alias("_p"), F.sum("neg").alias("_q")
    )
    tp = F.col("_tp") - (F.col("_tp_end") - F.col("_p"))
    fp = F.col("_fp") - (F.col("_fp_end") - F.col("_q"))
    return counted.join(per_class, "class").select(
        "class",
        F.col("score").alias("threshold"),
        (fp / F.col("_q")).alias("fpr"),
        (tp / F.col("_p")).alias("tpr"),
        (F.col("neg") * (tp - F.col("pos") / 2) / (F.col("_p") * F.col("_q"))).alias("area"),
    )


def auc(scored: DataFrame) -> DataFrame:
    """Area under the ROC curve per class, by trapezoids."""
    return roc_curve(scored).groupBy("class").agg(F.sum("area").alias("auc"))
