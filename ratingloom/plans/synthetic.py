"""Queries over synthetic data generation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.functions.columns import rounded
from ratingloom.operators import generate
from ratingloom.plans import sqlparts as sp
from ratingloom.plans.insight import _RAW, _events, _raw
from ratingloom.plans.registry import query
from ratingloom.sources import views

r6 = sp.r6
FEATURE_LIST = "SELECT event_type AS feature, row_number() OVER (ORDER BY event_type) - 1 AS f FROM (SELECT DISTINCT event_type FROM events)"


def _hash_normal(a: str, b: str, seed: int) -> str:
    first = f"(({sp.mix(a, b, seed)} + 0.5::DOUBLE) / {sp.HASH_RANGE}.0::DOUBLE)"
    return f"(sqrt(-2 * ln({first})) * cos(2 * pi() * {sp.unit(b, a, seed + 1)}))"


@query("g1_item_sample", f"""WITH pop AS (SELECT l_partkey AS item_id FROM lineitem GROUP BY 1 HAVING count(*) >= 30)
  SELECT p_partkey AS item_id, p_name AS title FROM part WHERE p_partkey IN (SELECT item_id FROM pop)
  ORDER BY {sp.mix('p_partkey', '1', 42)}, p_partkey LIMIT 500""")
def _(spark, sf):
    items = views.table(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))
    bought = views.table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("item_id")).agg(F.count("*").alias("n"))
    return generate.sample_items(items, 500, 42, bought.filter("n >= 30"))


@query("g2_dimension_cut", """SELECT c_custkey AS user_id, c_name AS name FROM customer ORDER BY c_custkey LIMIT 1000""")
def _(spark, sf):
    users = views.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    return generate.cut_dimensions(users, ["user_id"], 1000)


@query("g3_profile_resize", f"""WITH pr AS ({sp.PROFILES}) SELECT u.user_id, f.feature, {r6('coalesce(weight, 0)')} AS weight
  FROM (SELECT c_custkey AS user_id FROM customer) u CROSS JOIN (VALUES ('click'), ('view'), ('refund')) f(feature)
  LEFT JOIN pr ON pr.user_id = u.user_id AND pr.feature = f.feature""")
def _(spark, sf):
    users = views.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    cells = generate.resize_profiles(views.segment_profiles(spark, sf), users, ["click", "view", "refund"])
    return cells.select("user_id", "feature", rounded("weight").alias("weight"))


_PREFERENCES = f"""SELECT user_id, feature, greatest(-1, least(1, CASE WHEN rn <= greatest(0, least(5, 2 +
    ({sp.mix('user_id', '0', 2)} % 3) - 1)) THEN 0.8::DOUBLE ELSE -0.8::DOUBLE END + 0.05::DOUBLE * {_hash_normal('user_id', 'f', 3)})) AS weight
  FROM (SELECT user_id, feature, f, row_number() OVER (PARTITION BY user_id
      ORDER BY round(weight, 9) DESC NULLS LAST, {sp.mix('user_id', 'f', 0)}, f) AS rn
    FROM (SELECT DISTINCT user_id FROM pr) CROSS JOIN ({FEATURE_LIST}) x LEFT JOIN pr USING (user_id, feature))"""


def _preferences(spark, sf):
    return generate.random_preferences(views.segment_profiles(spark, sf), views.event_types(spark, sf), peaks=2, variability=1, contrast=0.8)


@query("g4_random_preferences", f"WITH pr AS MATERIALIZED ({sp.PROFILES}) SELECT user_id, feature, {r6('weight')} AS weight FROM ({_PREFERENCES})")
def _(spark, sf):
    return _preferences(spark, sf).select("user_id", "feature", rounded("weight").alias("weight"))


def _ideal(spark, sf):
    return generate.ideal_ratings(_raw(spark, sf, _events(spark, sf)))


def _implicit(spark, sf):
    return generate.ideal_interactions(_raw(spark, sf, _events(spark, sf)), 0.5)


_HIT = """, hits AS MATERIALIZED (SELECT user_id, item_id, CASE WHEN round((raw - (SELECT min(raw) FROM raw))
    / (SELECT max(raw) - min(raw) FROM raw), 9) >= 0.5 THEN 1 ELSE 0 END AS v FROM raw)"""


@query("g5_ideal_ratings", sp.with_ratings(sp.EVENTS, _RAW + f" SELECT user_id, item_id, {r6('ideal', 8)} AS rating FROM ideal"))
def _(spark, sf):
    return _ideal(spark, sf).withColumn("rating", rounded("rating", 8))


@query("g6_ideal_interactions", sp.with_ratings(sp.EVENTS, _RAW + _HIT + f" SELECT user_id, item_id, {r6('v')} AS rating FROM hits"))
def _(spark, sf):
    return _implicit(spark, sf)


@query("g7_explicit_noise", sp.with_ratings(sp.EVENTS, _RAW + f""" SELECT user_id, item_id, {r6(f'''CASE WHEN
  {sp.unit('user_id', 'item_id', 5)} < 0.7 THEN 0 ELSE greatest(0, least(5, ideal + 0.5::DOUBLE * {_hash_normal('user_id', 'item_id', 0)})) END''')}
  AS rating FROM ideal"""))
def _(spark, sf):
    return generate.degrade_explicit(_ideal(spark, sf), 0.5, 0.7).withColumn("rating", rounded("rating"))


@query("g8_implicit_noise", sp.with_ratings(sp.EVENTS, _RAW + _HIT + f""", fl AS MATERIALIZED (SELECT user_id, item_id,
    CASE WHEN {sp.unit('user_id', 'item_id')} < 0.1 THEN 1 - v ELSE v END AS v FROM hits)
  SELECT user_id, item_id, CASE WHEN v = 1 AND rn <= CAST(floor((SELECT count(*) FROM fl WHERE v = 1) * 0.7::DOUBLE) AS BIGINT)
    THEN 0.0::DOUBLE ELSE CAST(v AS DOUBLE) END AS rating
  FROM (SELECT *, row_number() OVER (PARTITION BY v ORDER BY {sp.mix('user_id', 'item_id', 7)}, user_id, item_id) AS rn FROM fl)"""))
def _(spark, sf):
    return generate.degrade_implicit(_implicit(spark, sf), 0.1, 0.7)
