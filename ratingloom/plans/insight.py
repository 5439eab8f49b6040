"""Queries over diagnostics, comparison with known truth, and tuning reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.functions.columns import rounded
from ratingloom.operators import diagnostics, generate, gradient, linear, neighbors, solvers, splits, tuning
from ratingloom.operators.catalog import Range
from ratingloom.plans import sqlparts as sp
from ratingloom.plans import sqltrain as st
from ratingloom.plans.core import _JACCARD, _METRIC_SQL
from ratingloom.plans.linearmodels import slim_sql
from ratingloom.plans.registry import query
from ratingloom.sources import views

r6 = sp.r6


def _events(spark, sf):
    return views.ratings_events(spark, sf).select("user_id", "item_id", "rating")


# ---- learned against known -----------------------------------------------------------------------


@query("a3_factor_correlation", st.als(sp.EVENTS, 2, 0.1) + f""", tr AS MATERIALIZED ({sp.EVENT_FEATURES}),
  cells AS (SELECT item_id, 0 AS factor, q1 AS x FROM i2 UNION ALL SELECT item_id, 1, q2 FROM i2),
  grid AS (SELECT c.*, f.feature, CAST(EXISTS (SELECT 1 FROM tr WHERE tr.item_id = c.item_id AND tr.feature = f.feature) AS INTEGER) AS y
    FROM cells c, (SELECT DISTINCT feature FROM tr) f WHERE c.item_id IN (SELECT item_id FROM tr))
  SELECT factor, feature, CASE WHEN min(y) < max(y) THEN {r6('abs(corr(x, y))', 5)} END AS correlation FROM grid GROUP BY 1, 2""")
def _(spark, sf):
    model = solvers.fit_als(_events(spark, sf), 2, 2, 0.1)
    corr = diagnostics.factor_feature_correlation(model.items, views.event_features(spark, sf))
    return corr.withColumn("correlation", rounded("correlation", 5))


_RAW = f""", pr AS MATERIALIZED ({sp.PROFILES}), fe AS MATERIALIZED ({sp.EVENT_FEATURES}),
  us AS (SELECT DISTINCT user_id FROM r), its AS (SELECT DISTINCT item_id FROM r),
  raw AS MATERIALIZED (SELECT us.user_id, its.item_id, coalesce(x.raw, 0) AS raw FROM us CROSS JOIN its LEFT JOIN (
    SELECT user_id, item_id, sum(weight) AS raw FROM pr JOIN fe USING (feature) GROUP BY 1, 2) x USING (user_id, item_id)),
  ideal AS MATERIALIZED (SELECT *, 5 * (raw - (SELECT min(raw) FROM raw)) / (SELECT max(raw) - min(raw) FROM raw) AS ideal FROM raw)"""


def _raw(spark, sf, ratings):
    return generate.raw_ideal(
        views.segment_profiles(spark, sf), views.event_features(spark, sf), views.event_types(spark, sf),
        ratings.select("user_id"), ratings.select("item_id"),
    )


def _gap(spark, sf):
    ratings = views.stored(_events(spark, sf))
    scores = neighbors.item_knn_scores(ratings, neighbors.item_similarity(ratings), 20, include_seen=True)
    return diagnostics.expectation_gap(scores, _raw(spark, sf, ratings))


@query("a4_expectation_gap", sp.with_ratings(sp.EVENTS, sp.COSINE + sp.knn_scores(20, seen=True) + _RAW + f"""
  SELECT user_id, item_id, {r6('raw', 8)} AS raw, {r6('ideal', 8)} AS ideal, {r6('coalesce(score, 0)', 8)} AS prediction,
    {r6('coalesce(score, 0) - ideal', 8)} AS difference FROM ideal LEFT JOIN scores USING (user_id, item_id)"""))
def _(spark, sf):
    gap = _gap(spark, sf)
    return gap.select("user_id", "item_id", *[rounded(c, 8).alias(c) for c in ("raw", "ideal", "prediction", "difference")])


@query("a5_cell_detail", sp.with_ratings(sp.EVENTS, sp.COSINE + sp.knn_scores(20, seen=True) + _RAW + f"""
  SELECT i.user_id, i.item_id, {r6('ideal')} AS ideal, {r6('coalesce(score, 0)')} AS prediction,
    (SELECT string_agg(feature, ',' ORDER BY feature) FROM pr WHERE pr.user_id = i.user_id) AS profile,
    (SELECT string_agg(feature, ',' ORDER BY feature) FROM fe WHERE fe.item_id = i.item_id) AS features
  FROM ideal i LEFT JOIN scores USING (user_id, item_id)
  WHERE i.user_id = (SELECT min(user_id) FROM r) AND i.item_id = (SELECT min(item_id) FROM r)"""))
def _(spark, sf):
    user, item = _events(spark, sf).agg(F.min("user_id"), F.min("item_id")).first()
    cell = diagnostics.cell_detail(
        _gap(spark, sf), views.segment_profiles(spark, sf), views.event_features(spark, sf), user, item
    )
    return cell.select(
        "user_id", "item_id", rounded("ideal").alias("ideal"), rounded("prediction").alias("prediction"),
        F.array_join(F.col("profile.feature"), ",").alias("profile"), F.array_join("features", ",").alias("features"),
    )


# ---- diagnostic tables ---------------------------------------------------------------------------


@query("d1_convergence_history", st.rated_mf(sp.EVENTS, 2, 0.05, 0.02, 0.02, 1.0, -0.5) + " " + " UNION ALL ".join(
    f"""SELECT {s} AS iteration, 'rmse' AS metric, {r6('sqrt(avg((rating - p1 * q1 - p2 * q2) ^ 2))')} AS value
          FROM r JOIN u{s} USING (user_id) JOIN i{s} USING (item_id)
        UNION ALL SELECT {s}, 'p_change', {r6('sqrt(sum((a.p1 - b.p1) ^ 2 + (a.p2 - b.p2) ^ 2))')} FROM u{s} a JOIN u{s - 1} b USING (user_id)
        UNION ALL SELECT {s}, 'q_change', {r6('sqrt(sum((a.q1 - b.q1) ^ 2 + (a.q2 - b.q2) ^ 2))')} FROM i{s} a JOIN i{s - 1} b USING (item_id)"""
    for s in (1, 2)))
def _(spark, sf):
    model = gradient.fit_funk_svd(_events(spark, sf), 2, 2, 0.05, 0.02, 0.02, track=True)
    return diagnostics.convergence(spark, model.factors.history).withColumn("value", rounded("value"))


def _histogram_sql(source: str, col: str) -> str:
    return f""", x AS MATERIALIZED ({source}), e AS (SELECT min({col}) AS lo, max({col}) AS hi FROM x),
  b AS (SELECT CAST(least(floor(({col} - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, count(*) AS n FROM x, e GROUP BY 1),
  h AS (SELECT CAST(range AS INTEGER) AS bin, lo + range * ((hi - lo) / 50) AS low, lo + (range + 1) * ((hi - lo) / 50) AS high,
    coalesce(n, 0) AS count FROM range(50) LEFT JOIN b ON b.bin = range, e)"""


@query("d2_similarity_histogram", sp.with_ratings(sp.EVENTS, sp.COSINE + _histogram_sql("SELECT round(sim, 9) AS s FROM edges", "s")
       + f" SELECT bin, {r6('low')} AS low, {r6('high')} AS high, count FROM h"))
def _(spark, sf):
    edges = neighbors.item_similarity(views.stored(_events(spark, sf))).select(F.round("sim", 9).alias("s"))
    bins = diagnostics.histogram(edges, "s", non_zero=True)
    return bins.select("bin", rounded("low").alias("low"), rounded("high").alias("high"), "count")


@query("d3_factor_snapshot", st.als(sp.EVENTS, 2, 0.1) + f""", pick AS (SELECT user_id FROM u2
    ORDER BY {sp.mix('user_id', '1')}, user_id LIMIT 50)
  SELECT user_id, 0 AS factor, {r6('p1')} AS value FROM u2 WHERE user_id IN (SELECT user_id FROM pick)
  UNION ALL SELECT user_id, 1, {r6('p2')} FROM u2 WHERE user_id IN (SELECT user_id FROM pick)""")
def _(spark, sf):
    users = solvers.fit_als(_events(spark, sf), 2, 2, 0.1).users
    return diagnostics.factor_snapshot(users, "user_id", "p").withColumn("value", rounded("value"))


@query("d3_factor_scatter", st.als(sp.EVENTS, 2, 0.1) + f" SELECT item_id, {r6('q1')} AS x, {r6('q2')} AS y FROM i2")
def _(spark, sf):
    items = solvers.fit_als(_events(spark, sf), 2, 2, 0.1).items
    return diagnostics.scatter(items, "item_id", "q").select("item_id", rounded("x").alias("x"), rounded("y").alias("y"))


@query("d4_similarity_sample", sp.with_ratings(sp.EVENTS, sp.COSINE + f""", pick AS (SELECT i FROM (SELECT DISTINCT i FROM edges)
    ORDER BY {sp.mix('i', '1')}, i LIMIT 30)
  SELECT i AS item_i, j AS item_j, {r6('sim')} AS sim FROM edges WHERE i IN (SELECT i FROM pick) AND j IN (SELECT i FROM pick)"""))
def _(spark, sf):
    sample = diagnostics.similarity_sample(neighbors.item_similarity(views.stored(_events(spark, sf))), 30)
    return sample.select("item_i", "item_j", rounded("sim").alias("sim"))


@query("d5_sparsity", sp.with_ratings(sp.PARTS, sp.PAIRS + f""", c AS (SELECT count(*) AS nz FROM pairs WHERE n >= 3)
  SELECT (SELECT count(DISTINCT item_id) FROM r) AS n_items, nz AS non_zero,
    {r6('1 - nz / ((SELECT count(DISTINCT item_id) FROM r) ^ 2)')} AS sparsity FROM c"""))
def _(spark, sf):
    ratings = views.stored(views.ratings_parts(spark, sf))
    edges = neighbors.item_similarity(ratings, min_support=3)
    return diagnostics.sparsity(edges, ratings).withColumn("sparsity", rounded("sparsity"))


@query("d6_scree")
def _(spark, sf):
    model = solvers.fit_svd(views.ratings_brands(spark, sf), 5)
    return diagnostics.scree(model.variance(spark).select("component", "sigma"))


@query("d7_error_curve", sp.with_ratings(sp.PARTS, f""", e AS (SELECT user_id, item_id,
    abs(rating - avg(rating) OVER (PARTITION BY user_id)) AS error FROM r)
  SELECT user_id, item_id, {r6('error')} AS error, row_number() OVER (ORDER BY round(error, 9) DESC, user_id, item_id) AS rank,
    {r6('(row_number() OVER (ORDER BY round(error, 9) DESC, user_id, item_id) - 1) / (count(*) OVER () - 1) * 100')} AS percentile FROM e"""))
def _(spark, sf):
    ratings = views.stored(views.ratings_parts(spark, sf))
    means = ratings.groupBy("user_id").agg(F.avg("rating").alias("prediction"))
    curve = diagnostics.error_curve(ratings.join(means, "user_id"))
    return curve.select("user_id", "item_id", rounded("error").alias("error"), "rank", rounded("percentile").alias("percentile"))


@query("d8_popularity_bar", sp.with_ratings(
    sp.PARTS, f" SELECT item_id, {r6('sum(rating)')} AS score FROM r GROUP BY 1 ORDER BY round(sum(rating), 9) DESC, item_id LIMIT 50"))
def _(spark, sf):
    bar = diagnostics.popularity_bar(neighbors.popularity(views.ratings_parts(spark, sf)))
    return bar.select("item_id", rounded("score").alias("score"))


@query("d9_latent_density", "WITH z AS (SELECT 1)" + _histogram_sql("SELECT CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings", "v") + f"""
  SELECT bin, {r6('(low + high) / 2')} AS center, {r6('count / ((SELECT count(*) FROM x) * (high - low))')} AS density,
    {r6('exp(-(((low + high) / 2) ^ 2) / 2) / sqrt(2 * pi())')} AS normal FROM h""")
def _(spark, sf):
    cells = diagnostics.vector_cells(views.table(spark, sf, "embeddings"), "vec_id", "embedding")
    density = diagnostics.density_against_normal(cells.select(F.col("value").cast("double").alias("v")), "v")
    return density.select("bin", *[rounded(c).alias(c) for c in ("center", "density", "normal")])


@query("d11_prediction_grid", sp.with_ratings(sp.EVENTS, sp.COSINE + sp.knn_scores(20, seen=True) + f""",
  us AS (SELECT DISTINCT user_id FROM r ORDER BY 1 LIMIT 20), its AS (SELECT DISTINCT item_id FROM r ORDER BY 1 LIMIT 20)
  SELECT user_id, item_id, {r6('coalesce(rating, 0)')} AS original, {r6('coalesce(score, 0)')} AS predicted, CAST(rating IS NULL AS INTEGER) AS is_new
  FROM r FULL JOIN scores USING (user_id, item_id) WHERE user_id IN (SELECT user_id FROM us) AND item_id IN (SELECT item_id FROM its)"""))
def _(spark, sf):
    ratings = views.stored(_events(spark, sf))
    edges = neighbors.item_similarity(ratings)
    users, items = diagnostics.grid_ids(ratings)
    history, near = ratings.join(users, "user_id", "left_semi"), edges.join(items.withColumnRenamed("item_id", "item_i"), "item_i", "left_semi")
    scores = neighbors.item_knn_scores(history, near, 20, include_seen=True)
    grid = diagnostics.prediction_grid(ratings, scores)
    return grid.select("user_id", "item_id", rounded("original").alias("original"), rounded("predicted").alias("predicted"),
                       F.col("is_new").cast("int").alias("is_new"))


@query("d12_embedding_projection")
def _(spark, sf):
    vectors = views.table(spark, sf, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    return diagnostics.projection_2d(vectors, "vec_id", "embedding")


@query("d13_slim_coefficients", f"""SELECT count(*) AS non_zero, {r6('avg(sim)', 4)} AS mean, {r6('min(sim)', 4)} AS low, {r6('max(sim)', 4)} AS high
  FROM ({sp.with_ratings(sp.BRANDS, slim_sql(0.001, 0.0001, digits=12))})""")
def _(spark, sf):
    edges = linear.fit_slim(views.stored(views.ratings_brands(spark, sf)), 0.001, 0.0001)
    out = diagnostics.coefficient_summary(edges)
    return out.select("non_zero", *[rounded(c, 4).alias(c) for c in ("mean", "low", "high")])


# ---- tuning ----------------------------------------------------------------------------------------

GRID = tuning.grid(k=[5, 20], shrinkage=[0, 10])
_SHRUNK = """, norms AS (SELECT item_id, sqrt(sum(rating * rating)) AS nrm FROM r GROUP BY 1)
, edges AS MATERIALIZED (SELECT i, j, n / (n + {s}::DOUBLE) * xy / (a.nrm * b.nrm) AS sim FROM pairs
  JOIN norms a ON a.item_id = i JOIN norms b ON b.item_id = j WHERE n >= 2)"""


def _fold_sql(setting: dict, fold: int) -> str:
    hashed = sp.mix("user_id", "item_id", 42)
    return f"""SELECT {setting['k']}.0::DOUBLE AS k, {setting['shrinkage']}.0::DOUBLE AS shrinkage, {fold} AS fold, rmse, r2, mae, var FROM (
  WITH r0 AS MATERIALIZED ({sp.EVENTS}), test AS (SELECT * FROM r0 WHERE {hashed} < {sp.HASH_RANGE // 5}),
  r AS MATERIALIZED (SELECT * FROM r0 WHERE {hashed} >= {sp.HASH_RANGE // 5} AND {hashed} % 3 <> {fold}){sp.PAIRS}{_SHRUNK.format(s=setting['shrinkage'])}
  , met AS (SELECT t.user_id, t.item_id, any_value(t.rating) AS rating, e.sim, h.rating AS hr,
      row_number() OVER (PARTITION BY t.user_id, t.item_id ORDER BY round(abs(e.sim), 9) DESC, h.item_id) AS rn
    FROM test t JOIN r h ON h.user_id = t.user_id JOIN edges e ON e.i = t.item_id AND e.j = h.item_id WHERE e.sim <> 0
    GROUP BY t.user_id, t.item_id, e.sim, h.rating, h.item_id)
  , sc AS (SELECT any_value(rating) AS rating, sum(sim * hr) / (sum(abs(sim)) + 1e-8) AS p FROM met WHERE rn <= {setting['k']} GROUP BY user_id, item_id)
  SELECT sqrt(avg((rating - p) ^ 2)) AS rmse, 1 - avg((rating - p) ^ 2) / var_pop(rating) AS r2, avg(abs(rating - p)) AS mae,
    avg((p - (SELECT avg(rating) FROM test)) ^ 2) AS var FROM sc)"""


_FOLDS_SQL = " UNION ALL ".join(_fold_sql(s, f) for s in GRID for f in range(3))


def _fold_report(spark, sf):
    train, test = splits.sides(splits.global_split(views.stored(_events(spark, sf))))

    def knn(part, pairs, setting):
        edges = neighbors.item_similarity(part, shrinkage=setting["shrinkage"])
        return neighbors.item_knn_scores(part, edges, setting["k"], targets=pairs)

    return tuning.cross_validated(spark, train, test, GRID, knn)


@query("v6_grid_search_report", f"""SELECT k, shrinkage, {r6('avg(rmse)')} AS avg_rmse, {r6('avg(r2)')} AS avg_r2, {r6('avg(mae)')} AS avg_mae,
  {r6('avg(var)')} AS avg_var FROM ({_FOLDS_SQL}) GROUP BY 1, 2""")
def _(spark, sf):
    means = tuning.mean_over_folds(_fold_report(spark, sf), ["k", "shrinkage"])
    return means.select("k", "shrinkage", *[rounded(f"avg_{m}").alias(f"avg_{m}") for m in ("rmse", "r2", "mae", "var")])


@query("v6_grid_search_pivot", f"""SELECT shrinkage, {r6('avg(CASE WHEN k = 5 THEN rmse END)')} AS "5.0",
  {r6('avg(CASE WHEN k = 20 THEN rmse END)')} AS "20.0" FROM ({_FOLDS_SQL}) GROUP BY 1""")
def _(spark, sf):
    means = tuning.mean_over_folds(_fold_report(spark, sf), ["k", "shrinkage"])
    table = tuning.pivoted(means, "shrinkage", "k", "avg_rmse", [5.0, 20.0])
    return table.select("shrinkage", rounded("`5.0`").alias("5.0"), rounded("`20.0`").alias("20.0"))


@query("v6_als_grid_search")
def _(spark, sf):
    train, test = splits.sides(splits.global_split(views.stored(_events(spark, sf))))

    def als(part, pairs, setting):
        model = solvers.fit_mllib_als(part, setting["rank"], 3, setting["reg"])
        return model.transform(pairs.select("user_id", "item_id")).selectExpr("user_id", "item_id", "double(prediction) AS score")

    report = tuning.cross_validated(spark, train, test, tuning.grid(rank=[1, 4], reg=[0.05, 0.15]), als)
    return tuning.mean_over_folds(report, ["rank", "reg"])


SPACES = {
    "ItemKNN": {"k": Range(5, 30, 5, 20), "shrinkage": Range(0.0, 20.5, 0.5, 0.0)},
    "SAR": {"threshold": Range(1, 5, 1, 2)},
}
TRIALS = 2


def _trial_sql() -> str:
    parts = []
    for number, params in enumerate(tuning.sampled(SPACES["ItemKNN"], TRIALS, 1), 1):
        inner = f"""WITH r0 AS MATERIALIZED ({sp.EVENTS}){sp.HOLDOUT}{sp.PAIRS}{_SHRUNK.format(s=params['shrinkage'])}{sp.knn_scores(params['k'])}
          {_METRIC_SQL} FROM (SELECT t.rating, coalesce(s.score, 0) AS p FROM test t LEFT JOIN scores s USING (user_id, item_id))"""
        parts.append(
            f"""SELECT 'ItemKNN' AS algorithm, {number} AS trial, 'k={params['k']};shrinkage={params['shrinkage']}' AS params,
              'explicit' AS type, unnest(['rmse', 'mae', 'r2', 'mape', 'explained_variance']) AS metric,
              unnest([rmse, mae, r2, mape, explained_variance]) AS value FROM ({inner})""")
    for number, params in enumerate(tuning.sampled(SPACES["SAR"], TRIALS, 1), 1):
        inner = f"""WITH r0 AS MATERIALIZED ({sp.EVENTS}){sp.HOLDOUT}{_JACCARD.replace('n >= 2', f"n >= {params['threshold']}")}
          , scores AS (SELECT h.user_id, e.i AS item_id, sum(e.sim) AS score FROM r h JOIN jac e ON e.j = h.item_id GROUP BY 1, 2)
          {sp.top_scores(10)} SELECT {r6('avg(hits / 10.0::DOUBLE)')} AS precision, {r6('avg(hits / relevant::DOUBLE)')} AS recall
          FROM (SELECT t.user_id, count(b.item_id) AS hits, count(*) AS relevant FROM test t LEFT JOIN best b USING (user_id, item_id) GROUP BY 1)"""
        parts.append(
            f"""SELECT 'SAR', {number}, 'threshold={params['threshold']}', 'implicit', unnest(['precision', 'recall']),
              unnest([precision, recall]) FROM ({inner})""")
    return " UNION ALL ".join(parts)


def _trials(spark, sf):
    train, test = splits.sides(views.stored(splits.holdout(views.stored(_events(spark, sf)))))
    return tuning.search(spark, train, test, SPACES, TRIALS, seed=1)


def _report_text(report):
    text = F.array_join(F.transform(F.array_sort(F.map_entries("params")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return report.select("algorithm", "trial", text.alias("params"), "type", F.explode("metrics").alias("metric", "value"))


@query("v7_trial_search", _trial_sql())
def _(spark, sf):
    return _report_text(_trials(spark, sf)).withColumn("value", rounded("value"))


_REPORT = """SELECT o_orderpriority AS algorithm, CAST((year(o_orderdate) - 1994) * 12 + month(o_orderdate) AS INTEGER) AS trial,
  CAST(count(*) AS DOUBLE) AS runtime, CASE WHEN o_orderpriority < '3' THEN 'implicit' ELSE 'explicit' END AS type,
  {cost} AS cost FROM orders GROUP BY ALL"""


def order_report(spark, sf):
    """A report-shaped table: one trial per order priority and month."""
    orders = views.table(spark, sf, "orders")
    cost = F.round(F.avg("o_totalprice"), 2)
    trial = ((F.year("o_orderdate") - 1994) * 12 + F.month("o_orderdate")).cast("int")
    rows = orders.groupBy(F.col("o_orderpriority").alias("algorithm"), trial.alias("trial")).agg(
        F.count("*").cast("double").alias("runtime"), cost.alias("_cost")
    )
    implicit = F.col("algorithm") < "3"
    return rows.select(
        "algorithm", "trial", "runtime", F.create_map(F.lit("month"), F.col("trial").cast("string")).alias("params"),
        F.when(implicit, "implicit").otherwise("explicit").alias("type"),
        F.create_map(F.when(implicit, "precision").otherwise("rmse"), F.col("_cost")).alias("metrics"),
    )


REPORT_SQL = _REPORT.format(cost="round(avg(o_totalprice), 2)")


@query("v8_best_trials", f"""SELECT algorithm, trial, runtime, type, cost AS value FROM (SELECT *, row_number() OVER (PARTITION BY algorithm
  ORDER BY round(CASE WHEN type = 'implicit' THEN -cost ELSE cost END, 9), trial) AS rn FROM ({REPORT_SQL})) WHERE rn = 1""")
def _(spark, sf):
    best = tuning.best_trials(order_report(spark, sf))
    return best.select("algorithm", "trial", "runtime", "type", F.map_values("metrics")[0].alias("value"))


RUNS_SQL = "SELECT o_orderkey AS run, o_orderpriority AS algorithm, o_orderstatus AS data_source, o_orderdate AS timestamp FROM orders"


def order_runs(spark, sf):
    return views.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("run"), F.col("o_orderpriority").alias("algorithm"),
        F.col("o_orderstatus").alias("data_source"), F.col("o_orderdate").alias("timestamp"),
    )


@query("v10_run_filter", f"""SELECT run, algorithm, data_source, strftime(timestamp, '%Y-%m-%d') AS day FROM ({RUNS_SQL})
  WHERE algorithm IN ('1-URGENT', '5-LOW') AND data_source = 'F' AND timestamp BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31'""")
def _(spark, sf):
    kept = tuning.filter_runs(order_runs(spark, sf), ["1-URGENT", "5-LOW"], ["F"], "1996-01-01", "1997-12-31")
    return kept.select("run", "algorithm", "data_source", F.date_format("timestamp", "yyyy-MM-dd").alias("day"))


@query("v10_run_choices", f"""WITH x AS ({RUNS_SQL}) SELECT DISTINCT 'algorithm' AS field, algorithm AS value FROM x
  UNION ALL SELECT DISTINCT 'data_source', data_source FROM x
  UNION ALL SELECT 'first', strftime(min(timestamp), '%Y-%m-%d %H:%M:%S') FROM x
  UNION ALL SELECT 'last', strftime(max(timestamp), '%Y-%m-%d %H:%M:%S') FROM x""")
def _(spark, sf):
    return tuning.run_choices(order_runs(spark, sf))
