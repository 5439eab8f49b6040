from pyspark.sql import functions as F

from ratingloom.functions.columns import HASH_RANGE, mix


def test_mix_takes_any_long(spark):
    ids = [0, 1, 2**62, 2**63 - 1, -(2**62)]
    rows = spark.createDataFrame([(u, i) for u in ids for i in ids], "u long, i long").select("u", "i", mix("u", "i", 3).alias("h")).collect()
    for r in rows:
        u, i = (x % HASH_RANGE + (x >> 31) % HASH_RANGE * 48271 for x in (r.u, r.i))
        assert r.h == pow(u * 1103515245 + i * 998244353 + 3 * 715225739, 5, HASH_RANGE)


def test_mix_tells_distant_ids_apart(spark):
    rows = spark.range(200).select("id", (F.col("id") + 1_000_003).alias("a"), (F.col("id") + HASH_RANGE).alias("b"))
    same = rows.filter((mix("id", F.lit(5)) == mix("a", F.lit(5))) | ((mix("id", F.lit(5)) == mix("b", F.lit(5))) & (F.col("id") > 0)))
    assert same.isEmpty()
