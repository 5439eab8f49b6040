"""Readers and writers of the rating data sets, reports and run folders.

Long tables are the primary form; the wide CSV form is for small data sets and exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.operators.prepare import to_long, to_wide

RATINGS_SCHEMA = "userId long, movieId long, rating double, timestamp long"
# The 19 genre flags that end a pipe-separated item line.
GENRE_FLAGS = [
    "unknown", "Action", "Adventure", "Animation", "Children's", "Comedy", "Crime", "Documentary", "Drama", "Fantasy",
    "Film-Noir", "Horror", "Musical", "Mystery", "Romance", "Sci-Fi", "Thriller", "War", "Western",
]


def _canonical(df: DataFrame, *more: Column) -> DataFrame:
    out = df.select(F.col("userId").alias("user_id"), F.col("movieId").alias("item_id"), "rating", *more)
    return out.filter(F.col("rating") > 0)


def read_long_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV userId, movieId, rating."""
    return _canonical(spark.read.schema("userId long, movieId long, rating double").csv(path, header=True))


def read_movielens(spark: SparkSession, ratings_path: str, movies_path: str) -> tuple[DataFrame, DataFrame]:
    """Ratings with their time ``ts`` (null where the file has none) and the movie list of a MovieLens folder."""
    ratings = spark.read.schema(RATINGS_SCHEMA).csv(ratings_path, header=True)
    movies = spark.read.schema("movieId long, title string, genres string").csv(movies_path, header=True)
    return (
        _canonical(ratings, F.timestamp_seconds("timestamp").alias("ts")),
        movies.select(F.col("movieId").alias("item_id"), "title", "genres"),
    )


def read_tab_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated user, movie, rating, unix time without header."""
    raw = spark.read.schema(RATINGS_SCHEMA).csv(path, sep="\t")
    return raw.select(
        F.col("userId").alias("user_id"), F.col("movieId").alias("item_id"), "rating", F.timestamp_seconds("timestamp").alias("ts")
    )


def read_pipe_items(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated latin-1 item list: id, title, dates, url, then genre flags."""
    flags = ", ".join(f"`{g}` int" for g in GENRE_FLAGS)
    schema = f"item_id long, title string, release_date string, video_date string, url string, {flags}"
    return spark.read.schema(schema).csv(path, sep="|", encoding="ISO-8859-1")


def read_generated(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """A generated data set: long ratings, user profiles, item features and the catalogue.

    The first column of the wide files is the row name; the others are item titles or feature names.
    """

    def wide(name: str) -> DataFrame:
        df = spark.read.csv(f"{folder}/{name}", header=True)
        return df.withColumnRenamed(df.columns[0], "_key")

    def melted(name: str, key: str, column: str, value: str) -> DataFrame:
        df = wide(name)
        cells = [c for c in df.columns if c != "_key"]
        typed = df.select(F.col("_key").alias(key), *[F.col(f"`{c}`").cast("double").alias(c) for c in cells])
        return typed.unpivot([key], [f"`{c}`" for c in cells], column, value)

    return {
        "ratings": to_long(wide("ratings.csv"), "_key", "item").withColumnRenamed("_key", "user"),
        "profiles": melted("ground_truth_user_profiles.csv", "user", "feature", "weight"),
        "features": melted("ground_truth_item_features.csv", "item", "feature", "value").filter(F.col("value") == 1).drop("value"),
        "movies": spark.read.csv(f"{folder}/movies.csv", header=True),
    }


def write_generated(
    folder: str, ratings: DataFrame, items: Sequence, profiles: DataFrame, item_features: DataFrame, features: Sequence[str]
) -> None:
    """Long parquet tables, plus the wide CSV files for the given items and features.

    Wide files have one column per item, so they are for small catalogues; the long tables have no limit.
    """
    ratings.write.mode("overwrite").parquet(f"{folder}/long/ratings")
    profiles.write.mode("overwrite").parquet(f"{folder}/long/profiles")
    item_features.write.mode("overwrite").parquet(f"{folder}/long/features")
    _csv(to_wide(ratings, items), f"{folder}/ratings.csv")
    p = profiles.groupBy("user_id").pivot("feature", list(features)).agg(F.first("weight")).fillna(0.0)
    _csv(p, f"{folder}/ground_truth_user_profiles.csv")
    flags = item_features.withColumn("_one", F.lit(1))
    q = flags.groupBy("item_id").pivot("feature", list(features)).agg(F.first("_one")).fillna(0)
    _csv(q, f"{folder}/ground_truth_item_features.csv")
    catalogue = item_features.select("item_id").distinct()
    _csv(catalogue.select(F.col("item_id").alias("movieId"), F.col("item_id").alias("title")), f"{folder}/movies.csv")


def _csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def read_ground_truth(
    spark: SparkSession, folder: str, one_object: bool = True
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """features (position, feature), items (item), item map (item, feature_ids) of a ground-truth folder.

    Names are trimmed. The map file is one JSON object; with ``one_object`` False it has one object per
    line and is split like any text file. A feature's position is the # column or else its row number
    (the feature list is short and read as one piece for that).
    """
    listed = spark.read.csv(f"{folder}/latent_characteristics.csv", header=True, multiLine=True, escape='"')
    if "#" in listed.columns:
        features = listed.select(F.col("#").cast("long").alias("position"), F.trim("Feature Dimension").alias("feature"))
    else:
        ordered = listed.coalesce(1).withColumn("position", F.monotonically_increasing_id() + 1)
        features = ordered.select("position", F.trim("Feature Dimension").alias("feature"))
    items = spark.read.csv(f"{folder}/items.csv", header=True).select(F.trim("Item Name").alias("item"))
    text = spark.read.text(f"{folder}/item_feature_map.json", wholetext=one_object)
    mapped = text.select(F.explode(F.from_json("value", "map<string, array<int>>")).alias("item", "feature_ids"))
    return features, items, mapped


def read_archetypes(spark: SparkSession, path: str) -> DataFrame:
    """JSON array of titles with named characteristics, as title, characteristic, value."""
    rows = spark.read.schema("title string, characteristics map<string, int>").json(path, multiLine=True)
    return rows.select("title", F.explode("characteristics").alias("characteristic", "value"))


def write_rule_records(itemsets: DataFrame, rules: DataFrame, folder: str, n_sets: int = 50, n_rules: int = 100) -> None:
    """JSON records of the itemsets with largest support and the rules with largest confidence."""
    itemsets.orderBy(F.round("support", 9).desc(), "items").limit(n_sets).write.mode("overwrite").json(f"{folder}/itemsets")
    rules.orderBy(F.round("confidence", 9).desc(), "antecedent", "consequent").limit(n_rules).write.mode("overwrite").json(
        f"{folder}/rules"
    )


def write_report(report: DataFrame, best: DataFrame, folder: str) -> None:
    """full_report.csv and best-hp.csv; parameter and metric maps as JSON text."""
    for df, name in ((report, "full_report.csv"), (best, "best-hp.csv")):
        flat = df.withColumn("params", F.to_json("params")).withColumn("metrics", F.to_json("metrics"))
        flat.write.mode("overwrite").csv(f"{folder}/{name}", header=True, quote='"', escape='"')


def read_report(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``name`` (full_report.csv or best-hp.csv) of every report-<time> folder below ``root``, newest first."""
    schema = "algorithm string, trial int, runtime double, params string, type string, metrics string"
    df = spark.read.schema(schema).csv(f"{root}/report-*/{name}", header=True, quote='"', escape='"')
    run = F.regexp_extract(F.col("_metadata.file_path"), r"/report-([^/]+)/", 1)
    return df.select(
        run.alias("run_time"), "algorithm", "trial", "runtime",
        F.from_json("params", "map<string,string>").alias("params"), "type",
        F.from_json("metrics", "map<string,double>").alias("metrics"),
    ).orderBy(F.desc("run_time"), "algorithm", "trial")


def list_reports(spark: SparkSession, root: str, name: str = "full_report.csv") -> DataFrame:
    """Report folders, newest first."""
    return read_report(spark, root, name).select("run_time").distinct().orderBy(F.desc("run_time"))


def read_runs(
    spark: SparkSession, params_glob: str, metrics_glob: str, pattern: str = r"/(?:algorithm=)?([^/]+)/(?:run=)?([^/]+)/[^/]+$"
) -> DataFrame:
    """Runs below <algorithm>/<yyyyMMdd_HHmmss>/: algorithm, timestamp, data_source, params, metrics.

    Folders whose name is not a time are skipped. A run without metrics is kept; a params record that
    cannot be read gives data_source Error, a missing data source N/A.
    """

    def records(glob: str) -> DataFrame:
        text = spark.read.text(glob, wholetext=True).select("value", F.col("_metadata.file_path").alias("_path"))
        return text.select(
            F.regexp_extract("_path", pattern, 1).alias("algorithm"),
            F.regexp_extract("_path", pattern, 2).alias("run"),
            "value",
        )

    strings = F.from_json("value", "map<string,string>")
    params = records(params_glob).select("algorithm", "run", strings.alias("params"))
    numbers = F.transform_values(strings, lambda _, v: v.try_cast("double"))
    metrics = records(metrics_glob).select("algorithm", "run", numbers.alias("metrics"))
    source = F.when(F.col("params").isNull(), "Error").otherwise(F.coalesce(F.col("params")["data_source"], F.lit("N/A")))
    dropped = ["algorithm", "data_source", "timestamp"]
    return (
        params.join(metrics, ["algorithm", "run"], "left")
        .withColumn("timestamp", F.try_to_timestamp("run", F.lit("yyyyMMdd_HHmmss")))
        .filter(F.col("timestamp").isNotNull())
        .withColumn("data_source", source)
        .withColumn("params", F.map_filter("params", lambda k, _: ~k.isin(dropped)))
        .drop("run")
    )
