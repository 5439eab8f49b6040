"""Hyper-parameter reports."""

from __future__ import annotations

import itertools
import math
import random
import time
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.operators.catalog import ALGORITHMS, Choice, Range
from ratingloom.operators.metrics import precision_recall, regression_metrics, with_default
from ratingloom.operators.splits import folds

REPORT_SCHEMA = (
    "algorithm string, trial int, runtime double, params map<string,string>, type string, metrics map<string,double>"
)

_K = Range(2, 100, 4, 32)
_K10 = Range(10, 100, 10, 32)
_RATE = Range(0.0001, 0.01, 0.001, 0.001)
_METRIC = Choice(("cosine", "adjusted_cosine", "pearson"), "cosine")
_SVDPP_L2 = Range(0.001, 0.5, 0.01, 0.02)
_BIAS_L2 = Range(0.1, 20.0, 0.5, 5.0)

# The search space of each model that is tuned (low, high, step, default).
SPACES: dict[str, dict[str, Range | Choice]] = {
    "TruncatedSVD": {"k": _K},
    "ALS": {"k": _K, "iterations": Range(5, 30, 5, 10), "lambda_reg": Range(0.01, 0.5, 0.05, 0.1)},
    "ALS (Improved)": {
        "k": _K, "iterations": Range(5, 30, 5, 10), "lambda_reg": Range(0.01, 0.5, 0.05, 0.05), "lambda_biases": Range(1.0, 20.0, 2.0, 10.0),
    },
    "ALS (PySpark)": {"k": _K, "iterations": Range(5, 25, 5, 10), "lambda_reg": Range(0.01, 0.2, 0.05, 0.05)},
    "BPR": {
        "k": _K10, "iterations": Range(500, 5000, 500, 1000), "learning_rate": Range(0.001, 0.1, 0.005, 0.01), "lambda_reg": Range(0.001, 0.1, 0.005, 0.01),
    },
    "ItemKNN": {"k": Range(5, 100, 5, 20), "similarity_metric": _METRIC, "min_support": Range(0, 10, 1, 2), "shrinkage": Range(0.0, 100.0, 10.0, 0.0)},
    "UserKNN": {"k": Range(5, 100, 5, 20), "similarity_metric": _METRIC},
    "NMF": {"k": _K, "iterations": Range(50, 500, 50, 200)},
    "FunkSVD": {
        "k": _K, "iterations": Range(5, 30, 5, 10), "learning_rate": Range(0.001, 0.01, 0.001, 0.005), "lambda_reg": Range(0.01, 0.5, 0.05, 0.02),
    },
    "SVD++": {
        "k": Range(10, 200, 5, 30), "iterations": Range(5, 30, 5, 20), "learning_rate": Range(0.0001, 0.1, 0.01, 0.005),
        "lambda_p": _SVDPP_L2, "lambda_q": _SVDPP_L2, "lambda_y": _SVDPP_L2, "lambda_bu": _BIAS_L2, "lambda_bi": _BIAS_L2,
    },
    "WRMF": {"k": _K10, "iterations": Range(5, 30, 5, 10), "lambda_reg": Range(0.01, 1.0, 0.1, 0.1), "alpha": Range(1, 100, 10, 40)},
    "FM": {"k": Range(8, 64, 8, 32), "epochs": Range(5, 50, 5, 10), "learning_rate": _RATE, "lambda_reg": Range(0.0, 0.1, 0.01, 0.01)},
    "SimpleX": {
        "k": Range(8, 128, 8, 32), "epochs": Range(10, 100, 10, 30), "learning_rate": _RATE, "lambda_reg": Range(0.0, 1.0, 0.1, 0.1), "tau": Range(0.05, 1.0, 0.05, 0.1),
    },
    "EASE": {"lambda_reg": Range(10, 5000, 50, 100)},
}


def grid(**options: Sequence) -> list[dict]:
    """Every combination of the listed values, in order."""
    return [dict(zip(options, values)) for values in itertools.product(*options.values())]


def sampled(space: dict[str, Range | Choice], n: int, seed: int) -> Iterator[dict]:
    """``n`` parameter sets: whole numbers, reals on the step grid, or one of the listed options."""
    rng = random.Random(seed)
    for _ in range(n):
        chosen = {}
        for name, spec in space.items():
            if isinstance(spec, Choice):
                chosen[name] = rng.choice(spec.options)
            else:
                steps = math.floor((spec.high - spec.low) / spec.step + 1e-9)
                value = spec.low + spec.step * rng.randint(0, steps)
                chosen[name] = int(value) if spec.is_int else round(value, 10)
        yield chosen


def run_trial(name: str, params: dict, train: DataFrame, test: DataFrame, k: int = 10) -> tuple[str, dict]:
    """Fits one model and scores the test side: rating metrics, or precision and recall for implicit models."""
    algorithm = ALGORITHMS[name]
    fitted = algorithm.train(train, **params)
    if algorithm.implicit:
        row = precision_recall(fitted.recommend(k).select("user_id", "item_id", "score"), test, train, k).first()
        return "implicit", {"precision": row["precision"], "recall": row["recall"]}
    row = regression_metrics(with_default(test, fitted.score(test))).first()
    return "explicit", {c: float(row[c]) for c in row.__fields__}


def search(
    spark: SparkSession,
    train: DataFrame,
    test: DataFrame,
    spaces: dict[str, dict[str, Range | Choice] | None],
    trials: int = 20,
    seed: int = 0,
) -> DataFrame:
    """Random search: one row per trial. Each fit and each metric is a Spark job over the whole split.

    ``spaces``: algorithm -> parameter space, None for the one in SPACES, else the catalogue's own.
    """
    rows = []
    for name, space in spaces.items():
        space = SPACES.get(name, ALGORITHMS[name].parameters) if space is None else space
        for number, params in enumerate(sampled(space, trials, seed), 1):
            began = time.monotonic()
            kind, metrics = run_trial(name, params, train, test)
            rows.append((name, number, time.monotonic() - began, {p: str(v) for p, v in params.items()}, kind, metrics))
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def best_trials(report: DataFrame) -> DataFrame:
    """Per algorithm the trial with the lowest RMSE (explicit) or the highest precision (implicit)."""
    cost = F.when(F.col("type") == "implicit", -F.col("metrics")["precision"]).otherwise(F.col("metrics")["rmse"])
    order = Window.partitionBy("algorithm").orderBy(F.round(cost, 9).asc_nulls_last(), "trial")
    return report.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") == 1).drop("_rn")


def cross_validated(
    spark: SparkSession,
    train: DataFrame,
    test: DataFrame,
    settings: Sequence[dict],
    fit_score: Callable[[DataFrame, DataFrame, dict], DataFrame],
    n_folds: int = 3,
    seed: int = 42,
) -> DataFrame:
    """Metrics on ``test`` of one sub-model per setting and fold, each trained without its fold.

    ``fit_score(train, test, setting)`` returns scores. Columns: the setting's names, fold, rmse, r2, mae
    and var (mean squared distance of the predictions from the mean rating).
    """
    cut = folds(train, n_folds, seed)
    names = list(settings[0])
    centre = test.agg(F.avg("rating")).first()[0]
    rows = []
    for setting in settings:
        for fold in range(n_folds):
            part = cut.filter(F.col("fold") != fold).drop("fold")
            pairs = test.select("user_id", "item_id", "rating").join(
                fit_score(part, test, setting).select("user_id", "item_id", F.col("score").alias("prediction")),
                ["user_id", "item_id"],
            )
            spread = F.avg((F.col("prediction") - F.lit(centre)) * (F.col("prediction") - F.lit(centre)))
            err = F.col("rating") - F.col("prediction")
            got = pairs.agg(
                F.sqrt(F.avg(err * err)).alias("rmse"),
                (1 - F.avg(err * err) / F.var_pop("rating")).alias("r2"),
                F.avg(F.abs(err)).alias("mae"),
                spread.alias("var"),
            ).first()
            rows.append((*[float(setting[n]) for n in names], fold, got["rmse"], got["r2"], got["mae"], got["var"]))
    schema = ", ".join(f"{n} double" for n in names) + ", fold int, rmse double, r2 double, mae double, var double"
    return spark.createDataFrame(rows, schema)


def mean_over_folds(report: DataFrame, names: Sequence[str]) -> DataFrame:
    return report.groupBy(*names).agg(*[F.avg(m).alias(f"avg_{m}") for m in ("rmse", "r2", "mae", "var")])


def pivoted(means: DataFrame, rows: str, columns: str, value: str, levels: Sequence) -> DataFrame:
    """Heat-map table: one row per ``rows`` value, one column per level of ``columns``."""
    return means.groupBy(rows).pivot(columns, list(levels)).agg(F.first(value))


def filter_runs(
    runs: DataFrame, algorithms: Sequence[str] | None = None, datasets: Sequence[str] | None = None, start=None, end=None
) -> DataFrame:
    """Runs of the chosen algorithms and data sets between two times, newest first."""
    kept = runs
    if algorithms:
        kept = kept.filter(F.col("algorithm").isin(list(algorithms)))
    if datasets:
        kept = kept.filter(F.col("data_source").isin(list(datasets)))
    if start is not None and end is not None:
        kept = kept.filter(F.col("timestamp").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    return kept.orderBy(F.desc("timestamp"))


def run_choices(runs: DataFrame) -> DataFrame:
    """What can be chosen: distinct algorithms and data sets, first and last time."""
    ends = runs.agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    algorithms = runs.select(F.lit("algorithm").alias("field"), F.col("algorithm").alias("value")).distinct()
    datasets = runs.select(F.lit("data_source").alias("field"), F.col("data_source").alias("value")).distinct()
    times = ends.select(
        F.explode(
            F.array(
                F.struct(F.lit("first").alias("field"), F.col("first").cast("string").alias("value")),
                F.struct(F.lit("last").alias("field"), F.col("last").cast("string").alias("value")),
            )
        ).alias("c")
    ).select("c.*")
    return algorithms.unionByName(datasets).unionByName(times)
