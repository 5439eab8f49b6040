"""Interaction tables derived from the order, event, part and embedding tables.

Canonical ratings columns: user_id long, item_id long, rating double (> 0; an absent row means
"not rated").
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.session import materialise


def stored(df: DataFrame) -> DataFrame:
    """The derived ratings as a table of their own, as a user of the operators would have them.

    Operators that read their ratings several times then scan a small table instead of joining the
    orders again each time.
    """
    return materialise(df, "ratings")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rated(lines: DataFrame) -> DataFrame:
    return lines.groupBy("user_id", "item_id").agg(
        (1 + 4 * (F.avg("l_quantity") - 1) / 49).alias("rating")
    )


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def ratings_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer x part: large and sparse."""
    return _rated(_order_lines(spark, sf_dir).withColumn("item_id", F.col("l_partkey")))


def ratings_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer x brand number: few items, dense."""
    part = table(spark, sf_dir, "part").select("p_partkey", brand_id().alias("item_id"))
    lines = _order_lines(spark, sf_dir)
    return _rated(lines.join(part, lines.l_partkey == part.p_partkey))


def brand_id():
    return F.regexp_extract("p_brand", r"(\d+)$", 1).cast("long")


def ratings_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User x event property with the time of the first interaction."""
    events = table(spark, sf_dir, "events").select(
        "user_id",
        F.get_json_object("props", "$.k").cast("long").alias("item_id"),
        "value",
        "ts",
    )
    return events.groupBy("user_id", "item_id").agg(
        (1 + F.least(F.lit(4), F.floor(F.round(F.avg("value"), 6) / 25))).cast("double").alias("rating"),
        F.min("ts").alias("ts"),
    )


def brand_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue for the brand ratings; even-numbered brands only, so some titles are missing."""
    part = table(spark, sf_dir, "part")
    return (
        part.select(brand_id().alias("item_id"), F.col("p_brand").alias("title"))
        .distinct()
        .filter(F.col("item_id") % 2 == 0)
    )


def part_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long item features of parts: brand, type and size band."""
    part = table(spark, sf_dir, "part")
    features = F.array(
        F.col("p_brand"),
        F.col("p_type"),
        F.concat(F.lit("SIZE_"), F.floor((F.col("p_size") - 1) / 10).cast("string")),
    )
    return part.select(F.col("p_partkey").alias("item_id"), F.explode(features).alias("feature"))


def event_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long item features of event items: the event types seen for the item at least a fifth of the time."""
    events = table(spark, sf_dir, "events").select(
        F.get_json_object("props", "$.k").cast("long").alias("item_id"), "event_type"
    )
    typed = events.groupBy("item_id", "event_type").agg(F.count("*").alias("n"))
    total = events.groupBy("item_id").agg(F.count("*").alias("total"))
    return (
        typed.join(total, "item_id")
        .filter(F.col("n") * 5 >= F.col("total"))
        .select("item_id", F.col("event_type").alias("feature"))
    )


MAX_EVENT_TYPES = 1000  # they become columns and vector entries


def event_types(spark: SparkSession, sf_dir: str) -> list[str]:
    """All event types of the table, sorted; an error beyond MAX_EVENT_TYPES."""
    found = table(spark, sf_dir, "events").select("event_type").filter("event_type IS NOT NULL").distinct().limit(MAX_EVENT_TYPES + 1).collect()
    if len(found) > MAX_EVENT_TYPES:
        raise ValueError(f"more than {MAX_EVENT_TYPES} event types")
    return sorted(row[0] for row in found)


def segment_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long user profiles (user_id, feature, weight in [-1, 1]) from the event mix of each user."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type")
    typed = events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    total = events.groupBy("user_id").agg(F.count("*").alias("total"))
    return typed.join(total, "user_id").select(
        "user_id",
        F.col("event_type").alias("feature"),
        (2.0 * F.col("n") / F.col("total") - 0.4).alias("weight"),
    )


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary labels with a score, for ROC."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    return labels.join(docs, "doc_id")
