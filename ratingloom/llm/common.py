"""Joins and components shared by the operators on documents."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.session import materialise

BROADCAST_IDS = 1_000_000  # long ids that a task may be sent, about 16 MB
BATCH_BYTES = 8 << 20  # of an Arrow batch, however long its texts
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def text_frame(docs: DataFrame) -> DataFrame:
    """``docs``, after bounding the session's Arrow batches to BATCH_BYTES where they may be larger.

    Python workers hold a batch several times over; by the default, rows alone would let long texts fill them.
    """
    spark: SparkSession = docs.sparkSession
    number, unit = re.fullmatch(r"(-?\d+)([a-z]?)b?", spark.conf.get(_BATCH_SETTING).strip().lower()).groups()
    now = int(number) << {"k": 10, "m": 20, "g": 30}.get(unit, 0)
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return docs


def only_ids(rows: DataFrame, key: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose ``key`` is (left_semi) or is not (left_anti) among ``ids``, a one-column table.

    The ids are counted first; up to BROADCAST_IDS go to every task, so that texts aren't shuffled for a filter. More
    are joined by shuffling both sides.
    """
    ids = materialise(ids.toDF(key).distinct(), "ids")
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key, how)


def components(links: DataFrame) -> DataFrame:
    """(id, label) for every id of ``links`` (a, b): the smallest id reachable.

    Each round takes the smallest label among the neighbours and then the label of that label, so long chains shrink
    quickly; rounds end when nothing changes. Every round is a written table.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialise(both, "links")
    labels = materialise(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label")), "labels")
    while True:
        seen = both.join(labels.select(F.col("id").alias("b"), F.col("label").alias("l")), "b")
        near = seen.groupBy(F.col("a").alias("id")).agg(F.min("l").alias("near"))
        step = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("label").alias("far"))
        new = step.join(jump, "next", "left").select("id", "label", F.least("next", "far").alias("next"))
        new = materialise(new, "labels")
        labels = new.select("id", F.col("next").alias("label"))
        if new.filter("label <> next").isEmpty():
            return labels
