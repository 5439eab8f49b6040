"""Queries over item embeddings and sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.functions.columns import rounded
from ratingloom.operators import embeddings
from ratingloom.operators.prepare import binarise
from ratingloom.plans import sqlparts as sp
from ratingloom.plans.registry import query
from ratingloom.plans.sqltrain import draws
from ratingloom.sources import views

r6 = sp.r6
LR = 0.05
STEPS = 2
WORD2VEC_RANK = 16

_LIKED = ", l AS MATERIALIZED (SELECT user_id, item_id FROM r WHERE rating >= 4)"


def _noise_sql(eps: str) -> str:
    return f""", cnt AS MATERIALIZED (SELECT v.item_id, count(l.item_id) AS n FROM (SELECT DISTINCT item_id FROM r) v LEFT JOIN l USING (item_id) GROUP BY 1)
, noise AS MATERIALIZED (SELECT item_id, n, (n ^ 0.75::DOUBLE + {eps}) / (SELECT sum(n ^ 0.75::DOUBLE + {eps}) FROM cnt) AS prob FROM cnt)
, cuts AS MATERIALIZED (SELECT item_id, hi - prob AS lo, CASE WHEN item_id = (SELECT max(item_id) FROM noise WHERE prob > 0) THEN 2 ELSE hi END AS hi
  FROM (SELECT item_id, prob, sum(prob) OVER (ORDER BY item_id) AS hi FROM noise WHERE prob > 0))"""


def _noise_draws(rows: str, a: str, b: str, seed: int, per: int = 5) -> str:
    wide = f"""({sp.mix(a, b, f'{seed} + x.draw * 101')} * {sp.HASH_RANGE} + {sp.mix(b, a, f'{seed} + x.draw * 101 + 1')})
      / ({sp.HASH_RANGE}.0::DOUBLE * {sp.HASH_RANGE}.0::DOUBLE)"""
    return f"(SELECT t.*, x.draw, {wide} AS u FROM {rows} t, range(1, {per + 1}) x(draw))"


def _liked(spark, sf):
    ratings = views.ratings_events(spark, sf).select("user_id", "item_id", "rating")
    return ratings.select("item_id"), binarise(ratings, 4).select("user_id", "item_id")


@query("e1_noise_distribution", sp.with_ratings(sp.EVENTS, _LIKED + _noise_sql("1e-8") + f" SELECT item_id, n, {r6('prob', 9)} AS prob FROM noise"))
def _(spark, sf):
    vocabulary, liked = _liked(spark, sf)
    return embeddings.noise_distribution(vocabulary, liked, 1e-8).withColumn("prob", rounded("prob", 9))


_PAIRS = """, pr AS MATERIALIZED (SELECT a.item_id AS center, b.item_id AS context, count(*) AS n FROM l a JOIN l b
  ON a.user_id = b.user_id AND a.item_id <> b.item_id GROUP BY 1, 2)"""


@query("e2_skip_gram_pairs", sp.with_ratings(sp.EVENTS, _LIKED + _PAIRS + " SELECT * FROM pr"))
def _(spark, sf):
    return embeddings.skip_gram_pairs(_liked(spark, sf)[1])


@query("e3_cbow_examples", sp.with_ratings(sp.EVENTS, _LIKED + """ SELECT a.user_id, a.item_id AS center,
  string_agg(CAST(b.item_id AS VARCHAR), ',' ORDER BY b.item_id) AS context FROM l a JOIN l b
  ON a.user_id = b.user_id AND a.item_id <> b.item_id GROUP BY 1, 2"""))
def _(spark, sf):
    examples = embeddings.cbow_examples(_liked(spark, sf)[1])
    return examples.select("user_id", "center", F.array_join(F.col("context").cast("array<string>"), ",").alias("context"))


def _start(scale: float) -> str:
    return f""", e0 AS MATERIALIZED (SELECT item_id, {draws('item_id', 4, 0, scale, -0.5, ['v1', 'v2', 'o1', 'o2'])}
  FROM (SELECT DISTINCT item_id FROM r))"""


def _skip_gram_sql() -> str:
    body = _LIKED + _PAIRS + _noise_sql("0") + _start(2.0)
    for s in range(1, STEPS + 1):
        p = s - 1
        body += f"""
, x{s} AS MATERIALIZED (SELECT center, context AS item, n, 1 AS label FROM pr UNION ALL
    SELECT d.center, c.item_id, d.n, 0 FROM {_noise_draws('pr', 't.center', 't.context', 1000 * s)} d JOIN cuts c ON d.u >= c.lo AND d.u < c.hi)
, j{s} AS MATERIALIZED (SELECT x.*, a.v1, a.v2, b.o1, b.o2, n * (label - 1 / (1 + exp(-(a.v1 * b.o1 + a.v2 * b.o2)))) AS d
    FROM x{s} x JOIN e{p} a ON a.item_id = x.center JOIN e{p} b ON b.item_id = x.item)
, gc{s} AS MATERIALIZED (SELECT center, sum(d * o1) / sum(n * label) AS g1, sum(d * o2) / sum(n * label) AS g2 FROM j{s} GROUP BY 1)
, go{s} AS MATERIALIZED (SELECT item, sum(d * v1) / sum(n) AS h1, sum(d * v2) / sum(n) AS h2 FROM j{s} GROUP BY 1)
, e{s} AS MATERIALIZED (SELECT item_id, v1 + {LR} * coalesce(g1, 0) AS v1, v2 + {LR} * coalesce(g2, 0) AS v2,
    o1 + {LR} * coalesce(h1, 0) AS o1, o2 + {LR} * coalesce(h2, 0) AS o2
  FROM e{p} LEFT JOIN gc{s} ON center = item_id LEFT JOIN go{s} ON item = item_id)"""
    return body


def _cbow_sql() -> str:
    body = _LIKED + _noise_sql("1e-8") + _start(0.5) + """
, hs AS MATERIALIZED (SELECT user_id, item_id, h FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS h FROM l) WHERE h > 1)"""
    for s in range(1, STEPS + 1):
        p = s - 1
        body += f"""
, c{s} AS MATERIALIZED (SELECT user_id, item_id, h, (sum(v1) OVER (PARTITION BY user_id) - v1) / (h - 1) AS m1,
    (sum(v2) OVER (PARTITION BY user_id) - v2) / (h - 1) AS m2 FROM hs JOIN e{p} USING (item_id))
, x{s} AS MATERIALIZED (SELECT user_id, item_id, h, m1, m2, item_id AS out_, 1 AS label FROM c{s} UNION ALL
    SELECT d.user_id, d.item_id, h, m1, m2, k.item_id, 0 FROM {_noise_draws(f'c{s}', 't.user_id', 't.item_id', 1000 * s)} d
    JOIN cuts k ON d.u >= k.lo AND d.u < k.hi)
, j{s} AS MATERIALIZED (SELECT x.*, o1, o2, label - 1 / (1 + exp(-(m1 * o1 + m2 * o2))) AS d FROM x{s} x JOIN e{p} e ON e.item_id = out_)
, go{s} AS MATERIALIZED (SELECT out_, avg(d * m1) AS h1, avg(d * m2) AS h2 FROM j{s} GROUP BY 1)
, pe{s} AS MATERIALIZED (SELECT user_id, item_id, h, sum(d * o1) AS d1, sum(d * o2) AS d2 FROM j{s} GROUP BY 1, 2, 3)
, gi{s} AS MATERIALIZED (SELECT item_id AS id, sum((t1 - d1) / (h - 1)) / sum(h - 1) AS g1, sum((t2 - d2) / (h - 1)) / sum(h - 1) AS g2
    FROM (SELECT *, sum(d1) OVER (PARTITION BY user_id) AS t1, sum(d2) OVER (PARTITION BY user_id) AS t2 FROM pe{s}) GROUP BY 1)
, e{s} AS MATERIALIZED (SELECT item_id, v1 + {LR} * coalesce(g1, 0) AS v1, v2 + {LR} * coalesce(g2, 0) AS v2,
    o1 + {LR} * coalesce(h1, 0) AS o1, o2 + {LR} * coalesce(h2, 0) AS o2
  FROM e{p} LEFT JOIN gi{s} ON id = item_id LEFT JOIN go{s} ON out_ = item_id)"""
    return body


_VECTORS = f" SELECT item_id, {r6('v1')} AS v1, {r6('v2')} AS v2, {r6('o1')} AS o1, {r6('o2')} AS o2 FROM e{STEPS}"


def _vectors_out(model):
    cells = [rounded(F.col("v")[c]).alias(n) for c, n in enumerate(["v1", "v2", "o1", "o2"])]
    return model.state.select(F.col("id").alias("item_id"), *cells)


@query("e4_skip_gram_training", sp.with_ratings(sp.EVENTS, _skip_gram_sql() + _VECTORS))
def _(spark, sf):
    vocabulary, liked = _liked(spark, sf)
    return _vectors_out(embeddings.fit_skip_gram(vocabulary, liked, 2, STEPS, LR))


@query("e4_word2vec")
def _(spark, sf):
    liked = _liked(spark, sf)[1]
    vectors = embeddings.item_vectors(embeddings.fit_skip_gram(liked.select("item_id"), liked, WORD2VEC_RANK))
    return vectors.select("item_id", F.col("v").cast("string").alias("vector"))


@query("e5_cbow_training", sp.with_ratings(sp.EVENTS, _cbow_sql() + _VECTORS))
def _(spark, sf):
    vocabulary, liked = _liked(spark, sf)
    return _vectors_out(embeddings.fit_cbow(vocabulary, liked, 2, STEPS, LR))


@query("e6_similar_items", f"""WITH v AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
  n AS MATERIALIZED (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS s FROM v)
  SELECT item_id, similar_id, {r6('sim')} AS sim, rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id
    ORDER BY round(sim, 9) DESC, similar_id) AS rank FROM (SELECT a.vec_id AS item_id, b.vec_id AS similar_id,
      list_dot_product(a.e, b.e) / (a.s * b.s) AS sim FROM n a JOIN n b ON a.vec_id <> b.vec_id)) WHERE rank <= 10""")
def _(spark, sf):
    vectors = views.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("item_id"), F.col("embedding").cast("array<double>").alias("v")
    )
    return embeddings.similar_items(vectors, 10).withColumn("sim", rounded("sim"))


@query("e7_mean_feature_vectors", "SELECT label AS item_id, " + ", ".join(
    f"{r6(f'avg(embedding[{c + 1}]::DOUBLE)')} AS v{c}" for c in range(64)) + " FROM embeddings GROUP BY 1")
def _(spark, sf):
    table = views.table(spark, sf, "embeddings")
    features = table.select(F.col("label").alias("item_id"), F.col("vec_id").alias("feature"))
    vectors = table.select(F.col("vec_id").alias("feature"), F.col("embedding").cast("array<double>").alias("v"))
    means = embeddings.mean_feature_vectors(features, vectors, 64)
    return means.select("item_id", *[rounded(F.col("v")[c]).alias(f"v{c}") for c in range(64)])


@query("u4_sequences", sp.with_ratings(sp.EVENTS, """, s AS (SELECT user_id, list(item_id + 1 ORDER BY ts, item_id) AS ids FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, item_id DESC) AS rn FROM r) WHERE rn <= 51 GROUP BY 1),
  p AS (SELECT user_id, ids, repeat('0,', 51 - len(ids)) AS pad FROM s WHERE len(ids) > 1)
  SELECT user_id, pad || array_to_string(ids[:-2], ',') AS input, pad || array_to_string(ids[2:], ',') AS target FROM p"""))
def _(spark, sf):
    rows = embeddings.sequences(views.ratings_events(spark, sf), 50)
    return rows.select("user_id", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("input", "target")])
