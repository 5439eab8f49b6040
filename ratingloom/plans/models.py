"""Queries over factor, ranking and spectral models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.functions.columns import rounded
from ratingloom.operators import gradient, profiles, ranking, recommend, solvers
from ratingloom.operators.neighbors import cooccurrence_pagerank
from ratingloom.operators.prepare import binarise
from ratingloom.operators.splits import holdout, sides
from ratingloom.plans import sqlparts as sp
from ratingloom.plans import sqltrain as st
from ratingloom.plans.core import ROUNDS, _pagerank_sql
from ratingloom.plans.registry import query
from ratingloom.sources import views
from ratingloom.sources.views import stored

r6 = sp.r6
STEPS = 2
LR = 0.05
LAM = 0.02


def _events(spark, sf):
    return views.ratings_events(spark, sf).select("user_id", "item_id", "rating")


def _out(df, digits=6):
    return df.select("user_id", "item_id", rounded("score", digits).alias("score"))


def _score_sql(expr: str, tables: str) -> str:
    return f" SELECT user_id, item_id, {r6(expr)} AS score FROM r {tables}"


_BOTH = f"JOIN u{STEPS} USING (user_id) JOIN i{STEPS} USING (item_id)"
_PQ = "p1 * q1 + p2 * q2"


@query("t1_gradient_trainer", st.rated_mf(sp.EVENTS, STEPS, LR, LAM, LAM, 1.0, -0.5) + f"""
  SELECT 'u' AS side, user_id AS id, {r6('p1')} AS f0, {r6('p2')} AS f1 FROM u{STEPS}
  UNION ALL SELECT 'i', item_id, {r6('q1')}, {r6('q2')} FROM i{STEPS}""")
def _(spark, sf):
    model = gradient.fit_funk_svd(_events(spark, sf), 2, STEPS, LR, LAM, LAM)
    return model.factors.state.select("side", "id", rounded(F.col("v")[0]).alias("f0"), rounded(F.col("v")[1]).alias("f1"))


@query("m1_als", st.als(sp.EVENTS, STEPS, 0.1) + _score_sql(_PQ, _BOTH))
def _(spark, sf):
    ratings = _events(spark, sf)
    return _out(solvers.fit_als(ratings, 2, STEPS, 0.1).score(ratings))


@query("m2_als_biases", st.als(sp.EVENTS, STEPS, 0.05, biases=True) + _score_sql(f"(SELECT mu FROM g) + bu + bi + {_PQ}", _BOTH))
def _(spark, sf):
    ratings = _events(spark, sf)
    return _out(solvers.fit_als(ratings, 2, STEPS, 0.05, biases=True).score(ratings))


@query("m3_funk_svd", st.rated_mf(sp.EVENTS, STEPS, LR, LAM, LAM, 1.0, -0.5) + _score_sql(_PQ, _BOTH))
def _(spark, sf):
    ratings = _events(spark, sf)
    return _out(gradient.fit_funk_svd(ratings, 2, STEPS, LR, LAM, LAM).score(ratings))


@query("m4_mllib_als")
def _(spark, sf):
    model = solvers.fit_mllib_als(_events(spark, sf), 8, 5, 0.1)
    users, items = solvers.mllib_factors(model)
    return recommend.score_blocks(users, items, 10)


@query("m5_pmf", st.rated_mf(sp.EVENTS, STEPS, LR, 0.1, 0.2, 1.0, -0.5) + _score_sql(_PQ, _BOTH))
def _(spark, sf):
    ratings = _events(spark, sf)
    return _out(gradient.fit_pmf(ratings, 2, STEPS, LR, 0.1, 0.2).score(ratings))


@query("m5_pmf_history", f"""WITH r0 AS MATERIALIZED ({sp.EVENTS}){sp.HOLDOUT}, {st.rated_mf('SELECT * FROM r', 1, LR, 0.1, 0.1, 1.0, -0.5)
    .replace('WITH r AS MATERIALIZED (SELECT * FROM r)', 'dummy AS (SELECT 1)')}
  SELECT 'train' AS side, {r6('sqrt(avg((rating - p1 * q1 - p2 * q2) ^ 2))')} AS rmse FROM r JOIN u1 USING (user_id) JOIN i1 USING (item_id)
  UNION ALL SELECT 'validation', {r6('sqrt(avg((rating - p1 * q1 - p2 * q2) ^ 2))')} FROM test JOIN u1 USING (user_id) JOIN i1 USING (item_id)""")
def _(spark, sf):
    train, test = sides(holdout(_events(spark, sf)))
    model = gradient.fit_pmf(train, 2, 1, LR, 0.1, 0.1)

    def rmse(rows, name):
        err = F.col("rating") - F.col("score")
        met = rows.join(model.score(rows), ["user_id", "item_id"])
        return met.agg(rounded(F.sqrt(F.avg(err * err))).alias("rmse")).select(F.lit(name).alias("side"), "rmse")

    return rmse(train, "train").unionByName(rmse(test, "validation"))


@query("m6_nmf", st.rated_mf(sp.EVENTS, STEPS, LR, LAM, LAM, 1.0, 0.0, floor0=True) + _score_sql(_PQ, _BOTH))
def _(spark, sf):
    ratings = _events(spark, sf)
    return _out(gradient.fit_nmf(ratings, 2, STEPS, LR, LAM).score(ratings))


@query("m7_svdpp", st.svdpp(sp.EVENTS, STEPS, LR, LAM) + f""", z AS (SELECT user_id, sum(y1) / sqrt(count(*)) AS z1,
    sum(y2) / sqrt(count(*)) AS z2 FROM r JOIN i{STEPS} USING (item_id) GROUP BY 1)"""
       + _score_sql("(SELECT mu FROM g) + bu + bi + (p1 + z1) * q1 + (p2 + z2) * q2", _BOTH + " JOIN z USING (user_id)"))
def _(spark, sf):
    ratings = _events(spark, sf)
    return _out(profiles.fit_svdpp(ratings, 2, STEPS, LR).score(ratings))


@query("m8_biased_mf", st.biased_mf(sp.EVENTS, STEPS, LR, LAM) + _score_sql(f"(SELECT mu FROM g) + bu + bi + {_PQ}", _BOTH))
def _(spark, sf):
    ratings = _events(spark, sf)
    return _out(gradient.fit_biased_mf(ratings, 2, STEPS, LR, LAM).score(ratings))


@query("m9_asymmetric_svd", st.asvd(sp.EVENTS, STEPS, LR, LAM) + f""", b AS (SELECT *, rating - ((SELECT mu FROM g) + bu + bi) AS gap
    FROM r JOIN u{STEPS} USING (user_id) JOIN i{STEPS} USING (item_id)),
  z AS (SELECT user_id, sum(gap * x1 + y1) / sqrt(count(*)) AS z1, sum(gap * x2 + y2) / sqrt(count(*)) AS z2 FROM b GROUP BY 1)"""
       + _score_sql("(SELECT mu FROM g) + bu + bi + z1 * q1 + z2 * q2", _BOTH + " JOIN z USING (user_id)"))
def _(spark, sf):
    ratings = _events(spark, sf)
    return _out(profiles.fit_asvd(ratings, 2, STEPS, LR).score(ratings))


def _power_sql(steps: int) -> str:
    """Leading right singular vector by power iteration on R'R."""
    body = f"WITH r AS MATERIALIZED ({sp.BRANDS}), v0 AS MATERIALIZED (SELECT item_id, 1.0::DOUBLE AS v FROM (SELECT DISTINCT item_id FROM r))"
    for s in range(1, steps + 1):
        body += f"""
, y{s} AS MATERIALIZED (SELECT user_id, sum(rating * v) AS y FROM r JOIN v{s - 1} USING (item_id) GROUP BY 1)
, z{s} AS MATERIALIZED (SELECT item_id, sum(rating * y) AS z FROM r JOIN y{s} USING (user_id) GROUP BY 1)
, v{s} AS MATERIALIZED (SELECT item_id, z / (SELECT sqrt(sum(z * z)) FROM z{s}) AS v FROM z{s})"""
    return body + f"""
, p AS MATERIALIZED (SELECT user_id, sum(rating * v) AS p FROM r JOIN v{steps} USING (item_id) GROUP BY 1)
, sigma AS (SELECT sqrt(sum(p * p)) AS s FROM p)"""


@query("m10_truncated_svd", _power_sql(14) + f" SELECT user_id, item_id, {r6('p * v', 5)} AS score FROM r JOIN p USING (user_id) JOIN v14 USING (item_id)")
def _(spark, sf):
    ratings = views.ratings_brands(spark, sf)
    scores = solvers.fit_svd(ratings, 1).score(ratings)
    return scores.select("user_id", "item_id", rounded("score", 5).alias("score"))


@query("m10_truncated_svd_rank_10")
def _(spark, sf):
    ratings = views.ratings_brands(spark, sf)
    return _out(solvers.fit_svd(ratings, 10).score(ratings))


@query("m11_pure_svd", _power_sql(14) + f""" SELECT user_id, item_id, {r6('p * v / (SELECT s FROM sigma)')} AS score
  FROM r JOIN p USING (user_id) JOIN v14 USING (item_id)""")
def _(spark, sf):
    ratings = views.ratings_brands(spark, sf)
    return _out(solvers.fit_svd(ratings, 1).score(ratings, scale_sigma=False))


@query("m12_wrmf", st.als(sp.EVENTS, STEPS, 0.1, alpha=40.0) + f" SELECT user_id, item_id, {r6(_PQ, 4)} AS score FROM r {_BOTH}")
def _(spark, sf):
    ratings = _events(spark, sf)
    return _out(solvers.fit_wrmf(ratings, 2, STEPS).score(ratings), 4)


_FISM_SCORE = f""", s AS (SELECT user_id, sum(p1) AS s1, sum(p2) AS s2 FROM r JOIN i{STEPS} USING (item_id) GROUP BY 1)"""


@query("m13_fism", st.fism(sp.EVENTS, STEPS, LR, LAM) + _FISM_SCORE + _score_sql(
    "bi + c * ((s1 - p1) * q1 + (s2 - p2) * q2)", f"JOIN i{STEPS} USING (item_id) JOIN s USING (user_id) JOIN nu USING (user_id)"))
def _(spark, sf):
    ratings = _events(spark, sf)
    return _out(ranking_input_fism(ratings).score(ratings))


def ranking_input_fism(ratings):
    return profiles.fit_fism(ratings, 2, STEPS, LR, LAM)


@query("m13_fism_similarity", st.fism(sp.EVENTS, STEPS, LR, LAM) + f""" SELECT DISTINCT a.item_id AS item_i, b.item_id AS item_j,
  {r6('x.p1 * y.q1 + x.p2 * y.q2')} AS sim FROM r a JOIN r b ON a.user_id = b.user_id AND a.item_id < b.item_id
  JOIN i{STEPS} x ON x.item_id = a.item_id JOIN i{STEPS} y ON y.item_id = b.item_id""")
def _(spark, sf):
    from ratingloom.operators.pairs import pair_stats

    ratings = _events(spark, sf)
    edges = pair_stats(binarise(ratings)).select("item_i", "item_j")
    return ranking_input_fism(ratings).similarity(edges).withColumn("sim", rounded("sim"))


# ---- ranking models ----------------------------------------------------------------------------


@query("x1_negative_samples", f"WITH r AS MATERIALIZED ({sp.EVENTS}){st.NEGATIVE_TABLES}{st.negatives('n', '5', 4)} SELECT * FROM n")
def _(spark, sf):
    drawn = ranking.NegativeSampler(_events(spark, sf)).draw(4, seed=5)
    return drawn.withColumn("draw", F.col("draw").cast("long"))


@query("x1_negative_samples_parts", f"WITH r AS MATERIALIZED ({sp.PARTS}){st.NEGATIVE_TABLES}{st.negatives('n', '5', 1)} SELECT * FROM n")
def _(spark, sf):
    positives = stored(views.ratings_parts(spark, sf).select("user_id", "item_id"))  # the sampler reads them four times
    drawn = ranking.NegativeSampler(positives).draw(1, seed=5)
    return drawn.withColumn("draw", F.col("draw").cast("long"))


@query("r1_bpr", st.pairwise(sp.EVENTS, STEPS, LR, 0.01, "bpr") + _score_sql(_PQ, _BOTH))
def _(spark, sf):
    ratings = _events(spark, sf)
    return _out(ranking.fit_bpr(ratings, 2, STEPS, LR).score(ratings))


@query("r2_bpr_adaptive", st.pairwise(sp.EVENTS, STEPS, LR, 0.01, "adaptive", pool=5) + _score_sql(_PQ, _BOTH))
def _(spark, sf):
    ratings = _events(spark, sf)
    return _out(ranking.fit_bpr_adaptive(ratings, 2, STEPS, LR).score(ratings))


@query("r3_bpr_svdpp", st.pairwise(sp.EVENTS, STEPS, LR, 0.01, "profile") + f""", z AS (SELECT user_id,
    sum(y1) / sqrt(count(*)) AS z1, sum(y2) / sqrt(count(*)) AS z2 FROM r JOIN i{STEPS} USING (item_id) GROUP BY 1)"""
       + _score_sql("(p1 + z1) * q1 + (p2 + z2) * q2", _BOTH + " JOIN z USING (user_id)"))
def _(spark, sf):
    ratings = _events(spark, sf)
    return _out(ranking.fit_bpr_svdpp(ratings, 2, STEPS, LR).score(ratings))


_WEIGHTS = _pagerank_sql(ROUNDS) + f""", w AS MATERIALIZED (SELECT item_id,
  (pr - (SELECT min(pr) FROM p{ROUNDS})) / (SELECT max(pr) - min(pr) FROM p{ROUNDS}) AS w FROM p{ROUNDS})"""


@query("r4_wmfbpr", st.pairwise(sp.EVENTS, STEPS, LR, 0.01, "weighted", prefix=_WEIGHTS)
       + _score_sql("p1 * (q1 + w) + p2 * (q2 + w)", _BOTH + " JOIN w USING (item_id)"))
def _(spark, sf):
    ratings = _events(spark, sf)
    weights = cooccurrence_pagerank(ratings, tol=1e-12)
    return _out(ranking.fit_wmfbpr(ratings, 2, STEPS, LR, weights=weights).score(ratings))


@query("r5_cml", st.pairwise(sp.EVENTS, STEPS, LR, 0.0, "margin")
       + _score_sql("-sqrt((p1 - q1) ^ 2 + (p2 - q2) ^ 2)", _BOTH))
def _(spark, sf):
    ratings = _events(spark, sf)
    return _out(ranking.fit_cml(ratings, 2, STEPS, LR).score(ratings))


@query("x2_train_auc", st.pairwise(sp.EVENTS, STEPS, LR, 0.01, "bpr") + st.negatives("s", "7") + f"""
  SELECT {r6(f'''avg(CASE WHEN round(u.p1 * a.q1 + u.p2 * a.q2, 9) > round(u.p1 * b.q1 + u.p2 * b.q2, 9) THEN 1 ELSE 0 END)''')} AS auc
  FROM s JOIN u{STEPS} u USING (user_id) JOIN i{STEPS} a ON a.item_id = s.item_id JOIN i{STEPS} b ON b.item_id = s.neg""")
def _(spark, sf):
    ratings = _events(spark, sf)
    model = ranking.fit_bpr(ratings, 2, STEPS, LR)
    return ranking.train_auc(model, ratings, samples=None).select(rounded("auc").alias("auc"))


# ---- objectives --------------------------------------------------------------------------------

_HIST_STEPS = 3


def _rmse_sql(expr: str, s: int) -> str:
    return f"SELECT {s} AS iteration, {r6(f'sqrt(avg((rating - ({expr})) ^ 2))')} AS rmse FROM r JOIN u{s} USING (user_id) JOIN i{s} USING (item_id)"


@query("x3_objective_history", st.rated_mf(sp.EVENTS, _HIST_STEPS, LR, LAM, LAM, 1.0, -0.5) + " " + " UNION ALL ".join(
    _rmse_sql(_PQ, s) for s in range(1, _HIST_STEPS + 1)))
def _(spark, sf):
    model = gradient.fit_funk_svd(_events(spark, sf), 2, _HIST_STEPS, LR, LAM, LAM, track=True)
    rows = [(h["iteration"], h["rmse"]) for h in model.factors.history]
    return spark.createDataFrame(rows, "iteration int, rmse double").withColumn("rmse", rounded("rmse"))


@query("x3_als_objective", st.als(sp.EVENTS, STEPS, 0.1) + " " + _rmse_sql(_PQ, STEPS))
def _(spark, sf):
    rmse = solvers.fit_als(_events(spark, sf), 2, STEPS, 0.1).train_rmse()
    return rmse.select(F.lit(STEPS).alias("iteration"), rounded("rmse").alias("rmse"))


@query("x4_wrmf_loss", st.als(sp.EVENTS, STEPS, 0.1, alpha=40.0) + f""" SELECT {r6(f'''sum((1 + 40 * rating) * (1 - ({_PQ})) ^ 2)
  + 0.1 * ((SELECT sum(p1 * p1 + p2 * p2) FROM u{STEPS}) + (SELECT sum(q1 * q1 + q2 * q2) FROM i{STEPS}))''', 3)} AS loss FROM r {_BOTH}""")
def _(spark, sf):
    model = solvers.fit_wrmf(_events(spark, sf), 2, STEPS)
    return solvers.implicit_loss(model, 40.0, 0.1).select(rounded("loss", 3).alias("loss"))


@query("x4_pmf_loss", st.rated_mf(sp.EVENTS, STEPS, LR, 0.1, 0.2, 1.0, -0.5) + f""" SELECT {r6(f'''(sum((rating - ({_PQ})) ^ 2)
  + 0.1 * (SELECT sum(p1 * p1 + p2 * p2) FROM u{STEPS}) + 0.2 * (SELECT sum(q1 * q1 + q2 * q2) FROM i{STEPS})) / 2''', 4)} AS loss FROM r {_BOTH}""")
def _(spark, sf):
    ratings = _events(spark, sf)
    model = gradient.fit_pmf(ratings, 2, STEPS, LR, 0.1, 0.2)
    return gradient.pmf_loss(model, ratings, 0.1, 0.2).select(rounded("loss", 4).alias("loss"))


@query("x4_fism_loss", st.fism(sp.EVENTS, STEPS, LR, LAM) + _FISM_SCORE + f""" SELECT {r6(f'''sum((1 - (bi + c * ((s1 - p1) * q1 + (s2 - p2) * q2))) ^ 2)
  + 0.01 * (SELECT sum(q1 * q1 + q2 * q2 + bi * bi + p1 * p1 + p2 * p2) FROM i{STEPS})''', 4)} AS loss
  FROM r JOIN i{STEPS} USING (item_id) JOIN s USING (user_id) JOIN nu USING (user_id)""")
def _(spark, sf):
    return ranking_input_fism(_events(spark, sf)).loss(0.02).select(rounded("loss", 4).alias("loss"))


@query("x5_factor_change", st.rated_mf(sp.EVENTS, _HIST_STEPS, LR, LAM, LAM, 1.0, -0.5) + " " + " UNION ALL ".join(
    f"""SELECT {s} AS iteration, '{t}' AS side, {r6(f'sqrt(sum((a.{v}1 - b.{v}1) ^ 2 + (a.{v}2 - b.{v}2) ^ 2))')} AS change
        FROM {t}{s} a JOIN {t}{s - 1} b USING ({k})"""
    for s in range(1, _HIST_STEPS + 1) for t, v, k in (("u", "p", "user_id"), ("i", "q", "item_id"))))
def _(spark, sf):
    model = gradient.fit_funk_svd(_events(spark, sf), 2, _HIST_STEPS, LR, LAM, LAM, track=True)
    rows = [(h["iteration"], side, h[name]) for h in model.factors.history for side, name in (("u", "p_change"), ("i", "q_change"))]
    return spark.createDataFrame(rows, "iteration int, side string, change double").withColumn("change", rounded("change"))


# ---- click models and towers -------------------------------------------------------------------


@query("u1_gmf", st.click(sp.EVENTS, STEPS, LR, "gmf"))
def _(spark, sf):
    ratings = _events(spark, sf)
    return _out(ranking.fit_click_model(ratings, 2, "gmf", STEPS, LR).score(ratings))


@query("u2_factorisation_machine", st.click(sp.EVENTS, STEPS, LR, "fm"))
def _(spark, sf):
    ratings = _events(spark, sf)
    return _out(ranking.fit_click_model(ratings, 2, "fm", STEPS, LR).score(ratings))


@query("u3_two_tower")
def _(spark, sf):
    ratings = _events(spark, sf)
    users, items = ranking.fit_two_tower(ratings, 8, epochs=3).block_factors()
    return recommend.score_blocks(users, items, 10, ratings)


@query("u6_block_scores", st.als(sp.EVENTS, STEPS, 0.1) + f""" SELECT user_id, item_id, {r6('score')} AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM (
    SELECT u.user_id, i.item_id, {_PQ} AS score FROM u{STEPS} u, i{STEPS} i WHERE NOT EXISTS
      (SELECT 1 FROM r WHERE r.user_id = u.user_id AND r.item_id = i.item_id))) WHERE rank <= 10""")
def _(spark, sf):
    ratings = _events(spark, sf)
    users, items = solvers.fit_als(ratings, 2, STEPS, 0.1).block_factors()
    best = recommend.score_blocks(users, items, 10, ratings)
    return best.select("user_id", "item_id", rounded("score").alias("score"), "rank")


