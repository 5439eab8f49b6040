"""Queries over linear item-item models."""

from __future__ import annotations

from ratingloom.functions.columns import rounded
from ratingloom.operators import embeddings, linear, neighbors
from ratingloom.plans import sqlparts as sp
from ratingloom.plans.registry import query
from ratingloom.sources import views

r6 = sp.r6
BRANDS = 25  # items of the dense ratings
TOL = 1e-11
SWEEPS = 1500  # of the comparison SQL, which has no stop rule; the operator stops by its tolerance

_GRAM = """, items AS MATERIALIZED (SELECT item_id, row_number() OVER (ORDER BY item_id) AS p FROM (SELECT DISTINCT item_id FROM r))
, gram AS MATERIALIZED (SELECT a.p AS i, b.p AS j, sum(x.rating * y.rating) AS v FROM r x JOIN r y ON x.user_id = y.user_id
  JOIN items a ON a.item_id = x.item_id JOIN items b ON b.item_id = y.item_id GROUP BY 1, 2)"""


def inverse_sql(lam: float) -> str:
    """Gauss-Jordan elimination, one table per pivot."""
    body = f"{_GRAM}, g0 AS MATERIALIZED (SELECT i, j, v + CASE WHEN i = j THEN {lam} ELSE 0 END AS v FROM gram)"
    for p in range(1, BRANDS + 1):
        body += f"""
, g{p} AS MATERIALIZED (SELECT a.i, a.j, CASE WHEN a.i = {p} AND a.j = {p} THEN 1 / d.v WHEN a.i = {p} THEN a.v / d.v
    WHEN a.j = {p} THEN -a.v / d.v ELSE a.v - c.v * w.v / d.v END AS v
  FROM g{p - 1} a JOIN g{p - 1} d ON d.i = {p} AND d.j = {p} JOIN g{p - 1} c ON c.i = a.i AND c.j = {p}
  JOIN g{p - 1} w ON w.i = {p} AND w.j = a.j)"""
    return body + f"""
, ease AS MATERIALIZED (SELECT t.item_id AS item_i, s.item_id AS item_j, -a.v / d.v AS sim FROM g{BRANDS} a
  JOIN g{BRANDS} d ON d.i = a.i AND d.j = a.i JOIN items t ON t.p = a.i JOIN items s ON s.p = a.j WHERE a.i <> a.j)"""


def slim_sql(l1: float, l2: float, digits: int = 6) -> str:
    """Cyclic coordinate descent to rest: one row and one list of weights per target, one sweep a recursion."""
    return f"""{_GRAM}, n AS (SELECT count(DISTINCT user_id) AS n FROM r)
, rows AS MATERIALIZED (SELECT i, list(v ORDER BY j) || [i::DOUBLE] AS g FROM (SELECT a.p AS i, b.p AS j, coalesce(v, 0) AS v
    FROM items a CROSS JOIN items b LEFT JOIN gram ON gram.i = a.p AND gram.j = b.p) GROUP BY 1)
, sweep AS MATERIALIZED (SELECT list(g ORDER BY i) AS gs FROM rows)
, slim AS (WITH RECURSIVE w(t, step, x) AS (
    SELECT i, 0, list_transform(g[:-2], lambda v: 0.0::DOUBLE) FROM rows
    UNION ALL SELECT t, step + 1, list_reduce([x] || gs, lambda y, d: list_transform(y, lambda v, k: CASE WHEN k <> d[-1] THEN v WHEN k = t THEN 0
      ELSE greatest((d[t] - list_dot_product(d[:-2], y) + d[k] * v) / n - {l1}, 0) / (d[k] / n + {l2}) END))
    FROM w, sweep, n WHERE step < {SWEEPS})
  SELECT t, unnest(x) AS w, generate_subscripts(x, 1) AS i FROM w WHERE step = {SWEEPS})
  SELECT t.item_id AS item_i, s.item_id AS item_j, {r6('w', digits)} AS sim FROM slim JOIN items s ON s.p = slim.i
  JOIN items t ON t.p = slim.t WHERE w > 0"""


@query("n14_ease_weights", sp.with_ratings(sp.BRANDS, inverse_sql(100.0) + f" SELECT item_i, item_j, {r6('sim')} AS sim FROM ease"))
def _(spark, sf):
    edges = linear.fit_ease(views.stored(views.ratings_brands(spark, sf)), 100.0, block=10)
    return edges.withColumn("sim", rounded("sim"))


@query("n14_ease_scores", sp.with_ratings(sp.BRANDS, inverse_sql(100.0) + f""" SELECT user_id, e.item_i AS item_id,
  {r6('sum(rating * sim)')} AS score FROM r JOIN ease e ON e.item_j = r.item_id GROUP BY 1, 2"""))
def _(spark, sf):
    ratings = views.stored(views.ratings_brands(spark, sf))
    scores = neighbors.propagate(ratings, linear.fit_ease(ratings, 100.0))
    return scores.select("user_id", "item_id", rounded("score").alias("score"))


@query("n15_slim_weights", sp.with_ratings(sp.BRANDS, slim_sql(0.001, 0.0001)))
def _(spark, sf):
    edges = linear.fit_slim(views.stored(views.ratings_brands(spark, sf)), 0.001, 0.0001, tol=TOL)
    return edges.withColumn("sim", rounded("sim"))


@query("n15_slim_scores", sp.with_ratings(sp.BRANDS, f""" SELECT user_id, w.item_i AS item_id, {r6('sum(rating * w.sim)', 3)} AS score
  FROM r JOIN ({sp.with_ratings(sp.BRANDS, slim_sql(0.001, 0.0001, digits=12))}) w ON w.item_j = r.item_id GROUP BY 1, 2"""))
def _(spark, sf):
    ratings = views.stored(views.ratings_brands(spark, sf))
    scores = neighbors.propagate(ratings, linear.fit_slim(ratings, 0.001, 0.0001, TOL))
    return scores.select("user_id", "item_id", rounded("score", 3).alias("score"))


@query("u5_reconstruction_view", sp.with_ratings(sp.EVENTS, sp.COSINE + f"""
, scores AS MATERIALIZED (SELECT h.user_id, e.i AS item_id, sum(h.rating * e.sim) AS score FROM r h JOIN edges e ON e.j = h.item_id GROUP BY 1, 2)
{sp.top_scores(10)}
  SELECT r.user_id, r.item_id, {r6('r.rating')} AS original, {r6('coalesce(s.score, 0)')} AS reconstructed FROM r
    LEFT JOIN scores s USING (user_id, item_id)
  UNION ALL SELECT user_id, item_id, 0.0, {r6('score')} FROM best"""))
def _(spark, sf):
    ratings = views.stored(views.ratings_events(spark, sf))
    edges = views.stored(neighbors.item_similarity(ratings))
    scores = neighbors.propagate(ratings, edges, targets=ratings).unionByName(neighbors.propagate(ratings, edges, n=10, unseen=True))
    view = embeddings.reconstruction_view(ratings, scores, 10)
    return view.select("user_id", "item_id", rounded("original").alias("original"), rounded("reconstructed").alias("reconstructed"))
