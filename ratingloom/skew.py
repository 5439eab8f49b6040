"""Joins, ranks and running totals that hold when one key carries much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.session import materialise

HOT_MIN_ROWS = 200_000
HOT_KEYS = 1_000


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_MIN_ROWS) -> list:
    """The heaviest keys, at most HOT_KEYS of them.

    Every key left out holds fewer than ``min_rows`` rows or at most 1/HOT_KEYS of the table, so the
    list the driver receives is bounded whatever the data looks like.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") >= min_rows)
    rows = counts.orderBy(F.desc("n"), key).limit(HOT_KEYS).collect()
    return [row[0] for row in rows if row[0] is not None]


def salt_count(spark: SparkSession) -> int:
    return max(2, min(1024, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    spread: str,
    hot: Sequence,
    how: str = "inner",
    salts: int | None = None,
) -> DataFrame:
    """Equi-join on ``key`` where rows of hot keys on the big side are spread by ``spread``.

    Rows of a hot key on the small side are repeated once per salt; all other rows are left alone.
    ``how`` may be inner or left.
    """
    if not hot:
        return big.join(small, key, how)
    salts = salts or salt_count(big.sparkSession)
    is_hot = F.col(key).isin(list(hot))
    left = big.withColumn(
        "_salt", F.when(is_hot, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    )
    right = small.withColumn(
        "_salt",
        F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))),
    )
    return left.join(right, [key, "_salt"], how).drop("_salt")


def _sorted_runs(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Globally sorted copy with run number ``_run`` and position ``_pos`` inside the run.

    The upper 31 bits of monotonically_increasing_id are the partition, the lower 33 the row. The
    copy is written out so both stay fixed.
    """
    tagged = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    kept = materialise(tagged, "sorted")
    return kept.withColumn("_run", F.shiftright("_mid", 33)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    )


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """1-based rank over the whole table without a single-task window.

    The offsets table has one row per sort partition, which bounds the broadcast.
    """
    runs = _sorted_runs(df, order)
    sizes = runs.groupBy("_run").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    ranked = runs.join(F.broadcast(offsets), "_run")
    return ranked.withColumn(name, (F.col("_off") + F.col("_pos") + 1).cast("long")).drop(
        "_run", "_pos", "_mid", "_off"
    )


def running_totals(df: DataFrame, order: Sequence[Column], totals: dict[str, str]) -> DataFrame:
    """Inclusive running sums (new column -> summed column) in a global order."""
    runs = _sorted_runs(df, order)
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    sizes = runs.groupBy("_run").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in totals.items()])
    offsets = sizes.select(
        "_run", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in totals]
    )
    inside = Window.partitionBy("_run").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    out = runs.join(F.broadcast(offsets), "_run")
    for name, col in totals.items():
        out = out.withColumn(name, F.col(f"_o_{name}") + F.sum(col).over(inside))
    return out.drop("_run", "_pos", "_mid", *[f"_o_{n}" for n in totals])


def dense_ids(df: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct keys with contiguous 0-based ids in key order."""
    return global_rank(df.select(key).distinct(), [F.col(key)], name).withColumn(
        name, F.col(name) - 1
    )


def group_rank_by_hash(
    df: DataFrame, key: str, order_hash: str, tie: str, name: str, hash_range: int, buckets: int = 64, size: str | None = None
) -> DataFrame:
    """Exact 1-based rank inside each key by (order_hash, tie), and the key's row count as ``size``.

    A key's rows are ranked bucket by bucket of the hash and shifted by the sizes of the buckets
    before, so even a key with a third of all rows is sorted by many tasks.
    """
    slot = F.floor(F.col(order_hash) * F.lit(buckets) / F.lit(hash_range)).cast("int")
    cells = df.withColumn("_b", slot)
    sizes = cells.groupBy(key, "_b").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    if size is not None:
        shifts = shifts.withColumn(size, F.sum("_n").over(Window.partitionBy(key)))
    shifts = shifts.drop("_n")
    inside = Window.partitionBy(key, "_b").orderBy(order_hash, tie)
    ranked = cells.withColumn("_rn", F.row_number().over(inside))
    return (
        ranked.join(shifts, [key, "_b"])
        .withColumn(name, (F.col("_off") + F.col("_rn")).cast("long"))
        .drop("_b", "_off", "_rn")
    )
