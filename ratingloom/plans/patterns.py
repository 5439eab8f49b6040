"""Queries over frequent itemsets and rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.functions.columns import rounded
from ratingloom.operators import rules
from ratingloom.plans import sqlparts as sp
from ratingloom.plans.registry import query
from ratingloom.sources import views

r6 = sp.r6
SUPPORT = 0.42


def itemset_sql(support: float = SUPPORT, view: str = sp.BRANDS) -> str:
    """Table sets (items sorted, count, support) of all frequent itemsets, and r with the distinct ratings.

    Each set is extended by every larger item, until no extension is frequent.
    """
    return f"""WITH RECURSIVE r AS MATERIALIZED (SELECT DISTINCT user_id, item_id FROM ({view}))
, n AS (SELECT count(DISTINCT user_id) AS n, ceil({support}::DOUBLE * count(DISTINCT user_id) - 1e-9) AS least FROM r)
, one AS MATERIALIZED (SELECT item_id, list(user_id) AS users FROM r GROUP BY 1 HAVING count(*) >= (SELECT least FROM n))
, grown(items, users) AS (SELECT [item_id], users FROM one UNION ALL
    SELECT items, users FROM (SELECT list_append(g.items, o.item_id) AS items, list_intersect(g.users, o.users) AS users
      FROM grown g JOIN one o ON o.item_id > g.items[-1]) WHERE len(users) >= (SELECT least FROM n))
, sets AS MATERIALIZED (SELECT items, len(users) AS count, len(users) / (SELECT n FROM n)::DOUBLE AS support FROM grown)"""


def rules_sql(metric: str, threshold: float) -> str:
    return f""", halves AS (SELECT support, [x FOR x, p IN items IF (m >> (p - 1)) & 1 = 1] AS a,
    [x FOR x, p IN items IF (m >> (p - 1)) & 1 = 0] AS b FROM (SELECT items, support,
      unnest(range(1, (1 << len(items)) - 1)) AS m FROM sets WHERE len(items) > 1))
, rules AS MATERIALIZED (SELECT * FROM (SELECT h.a, h.b, h.support, s.support AS asup, t.support AS csup,
    h.support / s.support AS confidence, h.support / s.support / t.support AS lift
  FROM halves h JOIN sets s ON s.items = h.a JOIN sets t ON t.items = h.b) WHERE {metric} >= {threshold}::DOUBLE - 1e-12)"""


def _text(col: str):
    return F.array_join(F.col(col).cast("array<string>"), ",").alias(col)


def _itemsets_out(sets):
    return sets.select(_text("items"), F.col("count").cast("long").alias("count"), rounded("support").alias("support"))


_SETS_OUT = f" SELECT array_to_string(items, ',') AS items, count, {r6('support')} AS support FROM sets"


@query("f1_apriori", itemset_sql() + _SETS_OUT)
def _(spark, sf):
    return _itemsets_out(rules.apriori(views.ratings_brands(spark, sf), SUPPORT))


@query("f2_eclat", itemset_sql() + _SETS_OUT)
def _(spark, sf):
    return _itemsets_out(rules.eclat(views.ratings_brands(spark, sf), SUPPORT))


@query("f3_fp_growth", itemset_sql(0.55) + _SETS_OUT)
def _(spark, sf):
    return _itemsets_out(rules.fp_growth(views.ratings_brands(spark, sf), 0.55))


_RULES_OUT = f""" SELECT array_to_string(a, ',') AS antecedent, array_to_string(b, ',') AS consequent,
  {r6('support')} AS support, {r6('asup')} AS antecedent_support, {r6('csup')} AS consequent_support,
  {r6('confidence')} AS confidence, {r6('lift')} AS lift FROM rules"""


def _rules_out(found):
    numbers = ["support", "antecedent_support", "consequent_support", "confidence", "lift"]
    return found.select(_text("antecedent"), _text("consequent"), *[rounded(c).alias(c) for c in numbers])


@query("f4_association_rules", itemset_sql() + rules_sql("confidence", 0.5) + _RULES_OUT)
def _(spark, sf):
    return _rules_out(rules.association_rules(rules.apriori(views.ratings_brands(spark, sf), SUPPORT)))


@query("f5_rule_metric_choice", itemset_sql() + rules_sql("lift", 1.0) + _RULES_OUT)
def _(spark, sf):
    sets = rules.eclat(views.ratings_brands(spark, sf), SUPPORT)
    return _rules_out(rules.association_rules(sets, "lift", 1.0))


@query("f6_rule_scores", itemset_sql() + rules_sql("confidence", 0.8) + f""", ants AS (SELECT DISTINCT a FROM rules)
, held AS (SELECT r.user_id, a FROM ants JOIN r ON list_contains(a, r.item_id) GROUP BY 1, 2 HAVING count(*) = len(a))
  SELECT user_id, item_id, {r6('max(confidence)')} AS score FROM (SELECT h.user_id, confidence, unnest(b) AS item_id
    FROM held h JOIN rules USING (a)) x
  WHERE NOT EXISTS (SELECT 1 FROM r s WHERE s.user_id = x.user_id AND s.item_id = x.item_id) GROUP BY 1, 2""")
def _(spark, sf):
    ratings = views.stored(views.ratings_brands(spark, sf))
    found = views.stored(rules.association_rules(rules.apriori(ratings, SUPPORT), "confidence", 0.8))
    return rules.rule_scores(ratings, found).select("user_id", "item_id", rounded("score").alias("score"))


@query("f7_named_itemsets", itemset_sql() + f""", names AS ({sp.TITLES})
  SELECT titles, count FROM (SELECT items, any_value(count) AS count,
    string_agg(coalesce(title, 'Movie ID: ' || id || ' (Unknown)'), ','
      ORDER BY coalesce(title, 'Movie ID: ' || id || ' (Unknown)')) AS titles
  FROM (SELECT items, count, unnest(items) AS id FROM sets) LEFT JOIN names ON item_id = id GROUP BY 1)""")
def _(spark, sf):
    sets = rules.apriori(views.ratings_brands(spark, sf), SUPPORT)
    named = rules.named_itemsets(sets, views.brand_titles(spark, sf))
    return named.select(F.array_join("titles", ",").alias("titles"), F.col("count").cast("long").alias("count"))
