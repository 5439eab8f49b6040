import numpy as np
from pyspark.sql import functions as F

from ratingloom import skew
from ratingloom.functions.columns import HASH_RANGE, mix
from tests.conftest import cells


def hot_table(spark):
    rows = [(0 if n % 3 == 0 else n % 7, n) for n in range(300)]
    return spark.createDataFrame(rows, "k long, n long")


def test_hot_keys_are_the_heaviest(spark):
    assert skew.hot_keys(hot_table(spark), "k", min_rows=100) == [0]
    assert skew.hot_keys(hot_table(spark), "k") == []


def test_salted_join_equals_plain_join(spark):
    big = hot_table(spark)
    small = spark.createDataFrame([(k, k * 10 + c) for k in range(6) for c in range(3)], "k long, v long")
    for how in ("inner", "left"):
        plain = sorted(map(tuple, big.join(small, "k", how).select("k", "n", "v").collect()), key=str)
        salted = skew.salted_join(big, small, "k", "n", [0], how, salts=5)
        assert sorted(map(tuple, salted.select("k", "n", "v").collect()), key=str) == plain


def test_salted_join_spreads_a_hot_key(spark):
    big = hot_table(spark)
    small = spark.createDataFrame([(0, 1)], "k long, v long")
    plan = skew.salted_join(big, small, "k", "n", [0], salts=5)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_global_rank_and_running_totals(spark):
    values = np.random.default_rng(0).integers(0, 20, 500)
    df = spark.createDataFrame([(i, int(v)) for i, v in enumerate(values)], "id long, v long").repartition(7)
    ranked = cells(skew.global_rank(df, [F.desc("v"), F.col("id")], "rank"), "id", "rank")
    order = sorted(range(500), key=lambda i: (-values[i], i))
    assert ranked == {(i,): r + 1 for r, i in enumerate(order)}
    totals = cells(skew.running_totals(df, [F.desc("v"), F.col("id")], {"t": "v"}), "id", "t")
    assert totals == {(i,): int(values[order[: r + 1]].sum()) for r, i in enumerate(order)}


def test_group_rank_by_hash_is_exact(spark):
    df = hot_table(spark).withColumn("h", mix("k", "n"))
    ranked = skew.group_rank_by_hash(df, "k", "h", "n", "r", HASH_RANGE, buckets=8).toPandas()
    want = df.toPandas().sort_values(["k", "h", "n"])
    want["r"] = want.groupby("k").cumcount() + 1
    got = {(a, b): c for a, b, c in ranked[["k", "n", "r"]].itertuples(index=False)}
    assert got == {(a, b): c for a, b, c in want[["k", "n", "r"]].itertuples(index=False)}


def test_dense_ids(spark):
    df = spark.createDataFrame([(30,), (10,), (20,), (10,)], "k long")
    assert cells(skew.dense_ids(df, "k", "i"), "k", "i") == {(10,): 0, (20,): 1, (30,): 2}
