"""Queries over preparation, splits, neighbourhood models, output and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.columns import rounded
from ratingloom.operators import metrics, neighbors, prepare, recommend, splits
from ratingloom.operators.pairs import mirrored, pair_stats
from ratingloom.plans import sqlparts as sp
from ratingloom.plans.registry import query
from ratingloom.skew import global_rank
from ratingloom.sources import views
from ratingloom.sources.views import stored

r6 = sp.r6
BRAND_COUNT = 25  # brands of the part table, for the columns that the comparison SQL has to name


def _scores(df: DataFrame, value: str = "score") -> DataFrame:
    return df.select("user_id", "item_id", rounded(value).alias(value))


# ---- preparation -------------------------------------------------------------------------------

_wide_cols = ", ".join(
    f"{r6(f'coalesce(max(CASE WHEN item_id = {b} THEN rating END), 0)')} AS \"{b}\"" for b in range(1, BRAND_COUNT + 1)
)


@query("p1_wide_pivot", sp.with_ratings(sp.BRANDS, f" SELECT user_id, {_wide_cols} FROM r GROUP BY user_id"))
def _(spark, sf):
    wide = prepare.to_wide(stored(views.ratings_brands(spark, sf)))
    return wide.select("user_id", *[rounded(f"`{b}`").alias(b) for b in wide.columns if b != "user_id"])


@query("p2_long_unpivot", sp.with_ratings(
    sp.BRANDS, f" SELECT user_id, CAST(item_id AS VARCHAR) AS item_id, {r6('rating')} AS rating FROM r"))
def _(spark, sf):
    wide = prepare.to_wide(stored(views.ratings_brands(spark, sf)))
    return prepare.to_long(wide).withColumn("rating", rounded("rating"))


@query("p3_dense_subset", sp.with_ratings(sp.PARTS, f""", ti AS (SELECT item_id FROM r GROUP BY 1
  ORDER BY count(*) DESC, item_id LIMIT 500), ri AS (SELECT * FROM r WHERE item_id IN (SELECT item_id FROM ti)),
  tu AS (SELECT user_id FROM ri GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 100)
  SELECT user_id, item_id, {r6('rating')} AS rating FROM ri WHERE user_id IN (SELECT user_id FROM tu)"""))
def _(spark, sf):
    dense = prepare.dense_subset(stored(views.ratings_parts(spark, sf)), n_items=500, n_users=100)
    return dense.select("user_id", "item_id", rounded("rating").alias("rating"))


@query("p4_contiguous_ids", sp.with_ratings(
    sp.PARTS, " SELECT item_id, dense_rank() OVER (ORDER BY item_id) - 1 AS item_index FROM (SELECT DISTINCT item_id FROM r)"))
def _(spark, sf):
    return prepare.contiguous_ids(views.ratings_parts(spark, sf), "item_id", "item_index")


@query("p5_binarise_any", sp.with_ratings(sp.EVENTS, " SELECT DISTINCT user_id, item_id, 1.0::DOUBLE AS rating FROM r"))
def _(spark, sf):
    return prepare.binarise(views.ratings_events(spark, sf))


@query("p6_binarise_threshold", sp.with_ratings(
    sp.PARTS, " SELECT DISTINCT user_id, item_id, 1.0::DOUBLE AS rating FROM r WHERE rating >= 4"))
def _(spark, sf):
    return prepare.binarise(views.ratings_parts(spark, sf), threshold=4)


@query("p7_title_enrichment", sp.with_ratings(sp.BRANDS, f""", t AS ({sp.TITLES})
  SELECT user_id, r.item_id, coalesce(title, 'Movie ID: ' || r.item_id || ' (Unknown)') AS title
  FROM r LEFT JOIN t ON r.item_id = t.item_id"""))
def _(spark, sf):
    named = prepare.with_titles(views.ratings_brands(spark, sf), views.brand_titles(spark, sf))
    return named.select("user_id", "item_id", "title")


@query("p7_title_resolution", f"""WITH t AS ({sp.TITLES}), refs AS (
  SELECT DISTINCT p_brand AS ref FROM part UNION SELECT DISTINCT CAST({sp.BRAND} AS VARCHAR) FROM part)
  SELECT ref, coalesce(t.title, u.title, 'Movie ID: ' || ref || ' (Unknown)') AS title FROM refs
  LEFT JOIN t ON CAST(t.item_id AS VARCHAR) = ref LEFT JOIN t u ON u.title = ref""")
def _(spark, sf):
    part = views.table(spark, sf, "part")
    refs = part.select(F.col("p_brand").alias("ref")).union(part.select(views.brand_id().cast("string"))).distinct()
    return prepare.resolve_titles(refs, views.brand_titles(spark, sf), "ref").select("ref", "title")


@query("p8_user_histories", sp.with_ratings(sp.EVENTS, """ SELECT user_id,
  string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items, count(*) AS n_items
  FROM r WHERE rating >= 4 GROUP BY 1"""))
def _(spark, sf):
    liked = prepare.binarise(views.ratings_events(spark, sf), threshold=4)
    return prepare.histories(liked).select(
        "user_id", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"),
        F.size("items").cast("long").alias("n_items"),
    )


@query("p9_means", sp.with_ratings(sp.PARTS, f""" SELECT 'global' AS level, CAST(NULL AS BIGINT) AS id,
  {r6('avg(rating)')} AS mean_rating, count(*) AS n_ratings FROM r
  UNION ALL SELECT 'user', user_id, {r6('avg(rating)')}, count(*) FROM r GROUP BY user_id
  UNION ALL SELECT 'item', item_id, {r6('avg(rating)')}, count(*) FROM r GROUP BY item_id"""))
def _(spark, sf):
    levels = prepare.rating_levels(views.ratings_parts(spark, sf))
    ids = {"global": F.lit(None).cast("long"), "user": F.col("user_id"), "item": F.col("item_id")}
    parts = [
        levels[level].select(F.lit(level).alias("level"), ids[level].alias("id"),
                             rounded("mean_rating").alias("mean_rating"), "n_ratings")
        for level in ids
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("p10_mean_centring", sp.with_ratings(sp.PARTS, f""" SELECT user_id, item_id,
  {r6('rating - avg(rating) OVER (PARTITION BY user_id)')} AS centred FROM r"""))
def _(spark, sf):
    return _scores(prepare.centred(stored(views.ratings_parts(spark, sf))), "centred")


MOVIES = """SELECT p_partkey AS item_id,
  CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE p_name || ' ' || p_partkey END AS title,
  CASE WHEN p_partkey % 41 = 0 THEN NULL WHEN p_partkey % 29 = 0 THEN 'unknown-01-01'
    ELSE CAST(1965 + p_size AS VARCHAR) || '-06-01' END AS release_date,
  CASE p_type WHEN 'STANDARD' THEN 'Action|Crime' WHEN 'ECONOMY' THEN 'Science Fiction|Family'
    WHEN 'MEDIUM' THEN 'Drama|Romance|War' WHEN 'LARGE' THEN 'Comedy|Music' WHEN 'SMALL' THEN 'Mystery|Western'
    ELSE 'Documentary|History' END AS genres,
  'A ' || p_name || CASE WHEN p_size % 3 = 0 THEN ' with a dark twist' WHEN p_size % 3 = 1 THEN
    ', a touching TRUE STORY of society' ELSE ' and an intense fight' END AS overview,
  p_retailprice * 60000 AS budget, p_size / 3.0::DOUBLE AS popularity, 5 + (p_size % 30) / 10.0::DOUBLE AS vote_average
  FROM part"""


def _movies(spark, sf):
    part = views.table(spark, sf, "part")
    return part.selectExpr(
        "p_partkey AS item_id",
        "CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE concat(p_name, ' ', p_partkey) END AS title",
        """CASE WHEN p_partkey % 41 = 0 THEN NULL WHEN p_partkey % 29 = 0 THEN 'unknown-01-01'
           ELSE concat(1965 + p_size, '-06-01') END AS release_date""",
        """CASE p_type WHEN 'STANDARD' THEN 'Action|Crime' WHEN 'ECONOMY' THEN 'Science Fiction|Family'
           WHEN 'MEDIUM' THEN 'Drama|Romance|War' WHEN 'LARGE' THEN 'Comedy|Music'
           WHEN 'SMALL' THEN 'Mystery|Western' ELSE 'Documentary|History' END AS genres""",
        """concat('A ', p_name, CASE WHEN p_size % 3 = 0 THEN ' with a dark twist' WHEN p_size % 3 = 1 THEN
           ', a touching TRUE STORY of society' ELSE ' and an intense fight' END) AS overview""",
        "p_retailprice * 60000 AS budget",
        "p_size / 3.0D AS popularity",
        "5 + (p_size % 30) / 10.0D AS vote_average",
    )


@query("p11_title_cleaning", f"""SELECT item_id, title, CAST(split_part(release_date, '-', 1) AS INTEGER) AS release_year
  FROM ({MOVIES}) WHERE title IS NOT NULL AND TRY_CAST(split_part(release_date, '-', 1) AS INTEGER) IS NOT NULL""")
def _(spark, sf):
    return prepare.clean_titles(_movies(spark, sf)).select("item_id", "title", "release_year")


def _tag_sql() -> str:
    def words(col, ws):
        return "(" + " OR ".join(f"contains(lower({col}), '{w}')" for w in ws) + ")"

    tests = {
        "Classic (Before 1980)": "y < 1980", "Old Film (1980-1999)": "y BETWEEN 1980 AND 1999",
        "Modern Film (2000-2010)": "y BETWEEN 2000 AND 2010", "Recent Film (After 2010)": "y > 2010",
        "High Budget": "budget > 80000000", "Low Budget": "budget > 0 AND budget < 10000000",
        "Popular": "popularity > 10", "Critically Acclaimed": "vote_average >= 7.5",
        "Cult / Niche": "vote_average > 5.5 AND vote_average < 7 AND popularity < 5",
    }
    tests.update({n: words("genres", w) for n, w in prepare.GENRE_WORDS.items()})
    tests.update({n: words("overview", w) for n, w in prepare.OVERVIEW_WORDS.items()})
    ids = ", ".join(f"CASE WHEN {tests[n]} THEN '{p + 1}' END" for p, n in enumerate(prepare.FEATURE_NAMES))
    return f"""SELECT item_id, concat_ws(',', {ids}) AS feature_ids FROM (SELECT *,
      CAST(split_part(release_date, '-', 1) AS INTEGER) AS y FROM ({MOVIES}) WHERE title IS NOT NULL
      AND TRY_CAST(split_part(release_date, '-', 1) AS INTEGER) IS NOT NULL)"""


@query("p12_feature_tagging", _tag_sql())
def _(spark, sf):
    tagged = prepare.tag_features(prepare.clean_titles(_movies(spark, sf)))
    return tagged.select("item_id", F.array_join(F.col("feature_ids").cast("array<string>"), ",").alias("feature_ids"))


@query("p13_feature_matrix", f"""SELECT DISTINCT item_id AS item, feature FROM ({sp.PART_FEATURES})
  WHERE item_id IN (SELECT p_partkey FROM part WHERE p_size <= 40)""")
def _(spark, sf):
    long = views.part_features(spark, sf)
    features = global_rank(long.select("feature").distinct(), [F.col("feature")], "position")
    stale = F.array(F.lit(0).cast("long"), F.lit(9999).cast("long"))  # positions outside the list
    item_map = (
        long.join(features, "feature").groupBy(F.col("item_id").alias("item"))
        .agg(F.concat(F.collect_set("position"), stale).alias("feature_ids"))
    )
    known = views.table(spark, sf, "part").filter("p_size <= 40").select(F.col("p_partkey").alias("item"))
    return prepare.feature_matrix(item_map, known, features)


@query("p14_flag_lists", """SELECT p_partkey AS item_id, concat_ws(',', CASE WHEN p_type = 'ECONOMY' THEN 'economy' END,
  CASE WHEN p_size > 25 THEN 'large' END, CASE WHEN p_retailprice > 1000 THEN 'costly' END) AS genres FROM part""")
def _(spark, sf):
    flags = views.table(spark, sf, "part").selectExpr(
        "p_partkey AS item_id", "int(p_type = 'ECONOMY') AS economy", "int(p_size > 25) AS large",
        "int(p_retailprice > 1000) AS costly",
    )
    return prepare.flags_to_list(flags, ["economy", "large", "costly"]).withColumn("genres", F.array_join("genres", ","))


@query("p15_delimited_list", f"SELECT item_id, unnest(string_split(genres, '|')) AS genre FROM ({MOVIES})")
def _(spark, sf):
    return prepare.split_list(_movies(spark, sf), "genres").select("item_id", F.explode("genres").alias("genre"))


# ---- splits ------------------------------------------------------------------------------------

_rank_sql = f"row_number() OVER (PARTITION BY user_id ORDER BY {sp.mix('user_id', 'item_id')}, item_id)"


def _split_out(df):
    return df.select("user_id", "item_id", F.col("is_test").cast("int").alias("is_test"))


@query("l1_holdout", sp.with_ratings(sp.PARTS, f""" SELECT user_id, item_id,
  CAST(size > 1 AND rk <= greatest(1, floor(0.2::DOUBLE * size)) AS INTEGER) AS is_test FROM (SELECT *,
  count(*) OVER (PARTITION BY user_id) AS size, {_rank_sql} AS rk FROM r)"""))
def _(spark, sf):
    return _split_out(splits.holdout(stored(views.ratings_parts(spark, sf))))


@query("l2_leave_one_out", sp.with_ratings(
    sp.PARTS, f" SELECT user_id, item_id, CAST({_rank_sql} = 1 AS INTEGER) AS is_test FROM r"))
def _(spark, sf):
    return _split_out(splits.leave_one_out(views.ratings_parts(spark, sf)))


@query("l3_holdout_floor", sp.with_ratings(sp.PARTS, f""" SELECT user_id, item_id,
  CAST(rk <= floor(size * 0.2::DOUBLE) AS INTEGER) AS is_test FROM (SELECT *,
  count(*) OVER (PARTITION BY user_id) AS size, {_rank_sql} AS rk FROM r)"""))
def _(spark, sf):
    return _split_out(splits.holdout_floor(stored(views.ratings_parts(spark, sf))))


@query("l4_global_split", sp.with_ratings(
    sp.PARTS, f" SELECT user_id, item_id, CAST({sp.mix('user_id', 'item_id', 42)} < {sp.HASH_RANGE // 5} AS INTEGER) AS is_test FROM r"))
def _(spark, sf):
    return _split_out(splits.global_split(views.ratings_parts(spark, sf)))


@query("l5_folds", sp.with_ratings(
    sp.PARTS, f" SELECT user_id, item_id, CAST({sp.mix('user_id', 'item_id', 42)} % 3 AS INTEGER) AS fold FROM r"))
def _(spark, sf):
    return splits.folds(views.ratings_parts(spark, sf)).select("user_id", "item_id", "fold")


# ---- neighbourhood models ----------------------------------------------------------------------


@query("n1_top_popular", sp.with_ratings(sp.EVENTS, f""", pop AS (SELECT item_id, sum(rating) AS score FROM r GROUP BY 1),
  grid AS (SELECT u.user_id, p.* FROM (SELECT DISTINCT user_id FROM r) u, pop p
    WHERE NOT EXISTS (SELECT 1 FROM r s WHERE s.user_id = u.user_id AND s.item_id = p.item_id))
  SELECT user_id, item_id, score, rank FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM grid) WHERE rank <= 10"""))
def _(spark, sf):
    return neighbors.popular_for_users(stored(views.ratings_events(spark, sf)), 10)


def _edges_out(edges):
    return edges.select("item_i", "item_j", rounded("sim").alias("sim"), "support")


@query("n2_item_cosine", sp.with_ratings(
    sp.BRANDS, sp.COSINE + f" SELECT i AS item_i, j AS item_j, {r6('sim')} AS sim, support FROM edges"))
def _(spark, sf):
    return _edges_out(neighbors.item_similarity(stored(views.ratings_brands(spark, sf)), "cosine"))


def _adjusted_sql(mean: str) -> str:
    return f"""WITH r0 AS MATERIALIZED ({sp.BRANDS}), r AS MATERIALIZED (SELECT user_id, item_id,
  rating - {mean} AS rating FROM r0){sp.COSINE}
  SELECT i AS item_i, j AS item_j, {r6('sim')} AS sim, support FROM edges"""


@query("n3_item_adjusted_cosine", _adjusted_sql(
    "sum(rating) OVER (PARTITION BY user_id) / (SELECT count(DISTINCT item_id) FROM r0)"))
def _(spark, sf):
    return _edges_out(neighbors.item_similarity(stored(views.ratings_brands(spark, sf)), "adjusted_cosine", mean_over="all"))


@query("n3_item_adjusted_cosine_rated", _adjusted_sql("avg(rating) OVER (PARTITION BY user_id)"))
def _(spark, sf):
    return _edges_out(neighbors.item_similarity(stored(views.ratings_brands(spark, sf)), "adjusted_cosine", mean_over="rated"))


@query("n4_item_pearson", sp.with_ratings(sp.BRANDS, sp.PAIRS + f""", st AS (SELECT item_id, sum(rating) AS s,
  sum(rating * rating) AS ss, (SELECT count(DISTINCT user_id) FROM r) AS n FROM r GROUP BY 1)
  SELECT i AS item_i, j AS item_j, {r6('(a.n * xy - a.s * b.s) / sqrt((a.n * a.ss - a.s * a.s) * (b.n * b.ss - b.s * b.s))')}
    AS sim, pairs.n AS support FROM pairs JOIN st a ON a.item_id = i JOIN st b ON b.item_id = j WHERE pairs.n >= 2"""))
def _(spark, sf):
    return _edges_out(neighbors.item_similarity(stored(views.ratings_brands(spark, sf)), "pearson"))


@query("n5_support_shrinkage", sp.with_ratings(sp.PARTS, sp.COSINE + f"""
  SELECT i AS item_i, j AS item_j, {r6('support / (support + 10.0::DOUBLE) * sim')} AS sim, support FROM edges"""))
def _(spark, sf):
    return _edges_out(neighbors.item_similarity(stored(views.ratings_parts(spark, sf)), "cosine", min_support=2, shrinkage=10))


@query("n6_item_knn_scores", sp.with_ratings(sp.BRANDS, sp.COSINE + sp.knn_scores(10) + f"""
  SELECT user_id, item_id, {r6('score')} AS score FROM scores"""))
def _(spark, sf):
    ratings = stored(views.ratings_brands(spark, sf))
    return _scores(neighbors.item_knn_scores(ratings, neighbors.item_similarity(ratings), k=10))


@query("n7_item_knn_all_cells", sp.with_ratings(sp.BRANDS, sp.COSINE + sp.knn_scores(10, seen=True, eps="0") + f"""
  SELECT user_id, item_id, {r6('score')} AS score FROM scores"""))
def _(spark, sf):
    ratings = stored(views.ratings_brands(spark, sf))
    edges = neighbors.item_similarity(ratings)
    return _scores(neighbors.item_knn_scores(ratings, edges, k=10, include_seen=True, epsilon=0))


_USER_EDGES = """, c AS MATERIALIZED (SELECT user_id, item_id, {value} AS x FROM r)
, un AS (SELECT user_id, sqrt(sum(x * x)) AS nrm FROM c GROUP BY 1)
, uedges AS MATERIALIZED (SELECT a.user_id, b.user_id AS other_id,
    CASE WHEN any_value(na.nrm) > 0 AND any_value(nb.nrm) > 0
      THEN sum(a.x * b.x) / any_value(na.nrm) / any_value(nb.nrm) ELSE 0 END AS sim
  FROM c a JOIN c b ON a.item_id = b.item_id AND a.user_id <> b.user_id
  JOIN un na ON na.user_id = a.user_id JOIN un nb ON nb.user_id = b.user_id GROUP BY 1, 2)"""
_CENTRED_X = "rating - avg(rating) OVER (PARTITION BY user_id)"


def _user_edges(value: str) -> str:
    return _USER_EDGES.format(value=value)


_GAPS = """, g AS MATERIALIZED (SELECT user_id AS other_id, item_id,
  rating - avg(rating) OVER (PARTITION BY user_id) AS gap FROM r)
, means AS (SELECT user_id, avg(rating) AS mean FROM r GROUP BY 1)"""


@query("n8_user_cosine", sp.with_ratings(sp.EVENTS, _user_edges("rating") +
       f" SELECT user_id, other_id, {r6('sim')} AS sim FROM uedges"))
def _(spark, sf):
    return neighbors.user_similarity(stored(views.ratings_events(spark, sf))).withColumn("sim", rounded("sim"))


@query("n8_user_pearson", sp.with_ratings(sp.EVENTS, _user_edges(_CENTRED_X) +
       f" SELECT user_id, other_id, {r6('sim')} AS sim FROM uedges"))
def _(spark, sf):
    return neighbors.user_similarity(stored(views.ratings_events(spark, sf)), "pearson").withColumn("sim", rounded("sim"))


def _user_knn_sql(value: str, k: int) -> str:
    # every rater takes part: users without a common item count with similarity 0, as in a full matrix
    return sp.with_ratings(sp.EVENTS, _user_edges(value) + _GAPS + f""", cand AS (SELECT m.user_id, g.item_id, g.other_id,
    coalesce(round(e.sim, 9), 0) AS rs, coalesce(e.sim, 0) AS sim, g.gap FROM means m JOIN g ON g.other_id <> m.user_id
    LEFT JOIN uedges e ON e.user_id = m.user_id AND e.other_id = g.other_id
    WHERE NOT EXISTS (SELECT 1 FROM r s WHERE s.user_id = m.user_id AND s.item_id = g.item_id))
  SELECT user_id, item_id, {r6('greatest(0, least(5, mean + num / den))')} AS score FROM (
    SELECT user_id, item_id, sum(sim * gap) AS num, sum(abs(sim)) AS den FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY rs DESC, other_id) AS rn FROM cand)
    WHERE rn <= {k} AND rs <> 0 GROUP BY 1, 2) JOIN means USING (user_id) WHERE den > 0""")


@query("n9_user_knn_scores", _user_knn_sql("rating", 20))
def _(spark, sf):
    ratings = stored(views.ratings_events(spark, sf))
    return _scores(neighbors.user_knn_scores(ratings, neighbors.user_similarity(ratings), k=20))


@query("n9_user_knn_pearson", _user_knn_sql(_CENTRED_X, 20))
def _(spark, sf):
    ratings = stored(views.ratings_events(spark, sf))
    return _scores(neighbors.user_knn_scores(ratings, neighbors.user_similarity(ratings, "pearson"), k=20))


@query("n10_user_knn_fixed", sp.with_ratings(sp.EVENTS, _user_edges("rating") + _GAPS + f""", near AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(sim, 9) DESC, other_id) AS rn
      FROM uedges) WHERE rn <= 20 AND sim > 0)
  SELECT user_id, item_id, {r6('greatest(1, least(5, mean + num / den))')} AS score FROM (
    SELECT n.user_id, g.item_id, sum(n.sim * g.gap) AS num, sum(abs(n.sim)) AS den FROM near n
    JOIN g ON g.other_id = n.other_id
    WHERE NOT EXISTS (SELECT 1 FROM r s WHERE s.user_id = n.user_id AND s.item_id = g.item_id) GROUP BY 1, 2)
  JOIN means USING (user_id) WHERE den > 0"""))
def _(spark, sf):
    ratings = stored(views.ratings_events(spark, sf))
    return _scores(neighbors.user_knn_fixed_scores(ratings, neighbors.user_similarity(ratings), k=20))


@query("n11_slope_one_deviations", sp.with_ratings(
    sp.BRANDS, sp.PAIRS + f" SELECT i AS item_i, j AS item_j, {r6('dev')} AS dev, n AS freq FROM pairs"))
def _(spark, sf):
    return neighbors.slope_one_deviations(stored(views.ratings_brands(spark, sf))).withColumn("dev", rounded("dev"))


@query("n12_slope_one_scores", sp.with_ratings(sp.BRANDS, sp.PAIRS + f""" SELECT h.user_id, p.i AS item_id,
  {r6('sum((h.rating + p.dev) * p.n) / sum(p.n)')} AS score FROM r h JOIN pairs p ON p.j = h.item_id
  WHERE NOT EXISTS (SELECT 1 FROM r s WHERE s.user_id = h.user_id AND s.item_id = p.i) GROUP BY 1, 2"""))
def _(spark, sf):
    ratings = stored(views.ratings_brands(spark, sf))
    return _scores(neighbors.slope_one_scores(ratings, neighbors.slope_one_deviations(ratings)))


_JACCARD = sp.PAIRS + """, cnt AS (SELECT item_id, count(*) AS c FROM r GROUP BY 1)
, jac AS MATERIALIZED (SELECT i, j, n / (a.c + b.c - n)::DOUBLE AS sim, n AS support FROM pairs
  JOIN cnt a ON a.item_id = i JOIN cnt b ON b.item_id = j WHERE n >= 2)"""


@query("n13_jaccard_edges", sp.with_ratings(
    sp.EVENTS, _JACCARD + f" SELECT i AS item_i, j AS item_j, {r6('sim')} AS sim, support FROM jac"))
def _(spark, sf):
    return _edges_out(neighbors.jaccard_edges(stored(views.ratings_events(spark, sf))))


@query("n13_cooccurrence_scores", sp.with_ratings(sp.EVENTS, _JACCARD + f""" SELECT h.user_id, e.i AS item_id,
  {r6('sum(e.sim)')} AS score FROM r h JOIN jac e ON e.j = h.item_id GROUP BY 1, 2"""))
def _(spark, sf):
    ratings = stored(views.ratings_events(spark, sf))
    from ratingloom.operators.prepare import binarise

    return _scores(neighbors.propagate(binarise(ratings), neighbors.jaccard_edges(ratings)))


@query("n16_score_propagation", sp.with_ratings(sp.BRANDS, sp.COSINE + f""" SELECT h.user_id, e.i AS item_id,
  {r6('sum(h.rating * e.sim)')} AS score FROM r h JOIN edges e ON e.j = h.item_id GROUP BY 1, 2"""))
def _(spark, sf):
    ratings = stored(views.ratings_brands(spark, sf))
    return _scores(neighbors.propagate(ratings, neighbors.item_similarity(ratings)))


ROUNDS = 40  # of the comparison SQL, which has no stop rule; the operator stops by its tolerance


def _pagerank_sql(steps: int) -> str:
    body = """, links AS MATERIALIZED (SELECT a.item_id AS i, b.item_id AS j, count(*) AS n FROM r a JOIN r b
  ON a.user_id = b.user_id AND a.item_id <> b.item_id GROUP BY 1, 2)
, graph AS MATERIALIZED (SELECT i, j, n / sum(n) OVER (PARTITION BY i) AS w FROM links)
, p0 AS MATERIALIZED (SELECT item_id, 1.0::DOUBLE / count(*) OVER () AS pr, count(*) OVER () AS n
    FROM (SELECT DISTINCT item_id FROM r))"""
    for s in range(1, steps + 1):
        body += f"""
, p{s} AS MATERIALIZED (SELECT p.item_id, p.n, 0.15::DOUBLE / p.n + 0.85::DOUBLE * coalesce(f.x, 0) AS pr FROM p{s - 1} p
    LEFT JOIN (SELECT j, sum(w * pr) AS x FROM graph JOIN p{s - 1} ON item_id = i GROUP BY 1) f ON f.j = p.item_id)"""
    return body


@query("n17_cooccurrence_pagerank", sp.with_ratings(sp.EVENTS, _pagerank_sql(ROUNDS) + f""" SELECT item_id,
  {r6(f'(pr - (SELECT min(pr) FROM p{ROUNDS})) / (SELECT max(pr) - min(pr) FROM p{ROUNDS})')} AS weight FROM p{ROUNDS}"""))
def _(spark, sf):
    ranked = neighbors.cooccurrence_pagerank(stored(views.ratings_events(spark, sf)), tol=1e-12)
    return ranked.select("item_id", rounded("weight").alias("weight"))


# ---- output and metrics ------------------------------------------------------------------------

def _on_split(view: str, split: str, body: str, k: int = 10) -> str:
    return f"WITH r0 AS MATERIALIZED ({view}){split}{sp.COSINE}{sp.knn_scores(k)}{body}"


@query("k1_top_n", sp.with_ratings(sp.BRANDS, sp.COSINE + sp.knn_scores(10) + sp.top_scores(10) + f""", t AS ({sp.TITLES})
  SELECT user_id, best.item_id, {r6('score')} AS score, rank,
    coalesce(title, 'Movie ID: ' || best.item_id || ' (Unknown)') AS title
  FROM best LEFT JOIN t ON t.item_id = best.item_id"""))
def _(spark, sf):
    ratings = stored(views.ratings_brands(spark, sf))
    scores = neighbors.item_knn_scores(ratings, neighbors.item_similarity(ratings), k=10, n=10)
    best = recommend.top_n(scores, ratings, 10, views.brand_titles(spark, sf))
    return best.select("user_id", "item_id", rounded("score").alias("score"), "rank", "title")


@query("k1_top_n_parts", sp.with_ratings(sp.PARTS, sp.COSINE + sp.knn_scores(20) + sp.top_scores(10) + f"""
  SELECT user_id, item_id, {r6('score')} AS score, rank FROM best"""))
def _(spark, sf):
    ratings = stored(views.ratings_parts(spark, sf))
    best = recommend.top_n(neighbors.item_knn_scores(ratings, neighbors.item_similarity(ratings), k=20, n=10), None, 10)
    return best.select("user_id", "item_id", rounded("score").alias("score"), "rank")


_EVENT_TOP = sp.COSINE + sp.knn_scores(20) + sp.top_scores(10)


def _event_top(spark, sf, n=10):
    ratings = stored(views.ratings_events(spark, sf))
    scores = neighbors.item_knn_scores(ratings, neighbors.item_similarity(ratings), k=20, n=n)
    return ratings, scores, recommend.top_n(scores, None, n)


@query("k2_known_characteristics", sp.with_ratings(sp.EVENTS, _EVENT_TOP + f""", f AS ({sp.EVENT_FEATURES})
  SELECT user_id, item_id, rank, coalesce(names, '') AS characteristics FROM best LEFT JOIN (SELECT item_id AS id,
  string_agg(feature, ', ' ORDER BY feature) AS names FROM f GROUP BY 1) ON id = item_id"""))
def _(spark, sf):
    _, _, best = _event_top(spark, sf)
    named = recommend.with_features(best, views.event_features(spark, sf))
    return named.select("user_id", "item_id", "rank", "characteristics")


@query("k3_profile_by_interest", f"""SELECT user_id, feature, {r6('weight')} AS weight,
  row_number() OVER (PARTITION BY user_id ORDER BY round(weight, 9) DESC, feature) AS place FROM ({sp.PROFILES})""")
def _(spark, sf):
    return recommend.profile(views.segment_profiles(spark, sf)).withColumn("weight", rounded("weight"))


_SEEN_VALUES = {"keep": "s.rating", "drop": "'-inf'::DOUBLE", "zero": "0"}
_seen_sql = " UNION ALL ".join(
    f"""SELECT '{p}' AS policy, user_id, item_id, {r6(f'CASE WHEN s.rating IS NOT NULL THEN {v} ELSE p.score END') if p != 'drop'
    else "CASE WHEN s.rating IS NOT NULL THEN '-inf'::DOUBLE ELSE " + r6('p.score') + " END"} AS score
    FROM scores p FULL JOIN r s USING (user_id, item_id)"""
    for p, v in _SEEN_VALUES.items()
) + f" UNION ALL SELECT 'leave', user_id, item_id, {r6('score')} FROM scores"


@query("k4_seen_policies", sp.with_ratings(sp.BRANDS, sp.COSINE + sp.knn_scores(10, seen=True, eps="0") + " " + _seen_sql))
def _(spark, sf):
    ratings = stored(views.ratings_brands(spark, sf))
    scores = neighbors.item_knn_scores(ratings, neighbors.item_similarity(ratings), 10, include_seen=True, epsilon=0)
    out = None
    for policy in ("keep", "drop", "zero", "leave"):
        value = rounded("score")
        if policy == "drop":
            value = F.when(F.col("score") == float("-inf"), F.col("score")).otherwise(value)
        part = recommend.apply_seen(scores, ratings, policy).select(
            F.lit(policy).alias("policy"), "user_id", "item_id", value.alias("score"))
        out = part if out is None else out.unionByName(part)
    return out


_METRIC_SQL = f""" SELECT {r6('sqrt(avg((rating - p) ^ 2))')} AS rmse, {r6('avg(abs(rating - p))')} AS mae,
  {r6('1 - avg((rating - p) ^ 2) / var_pop(rating)')} AS r2,
  {r6('100 * avg(abs((rating - p) / (rating + 1e-8)))')} AS mape,
  {r6('1 - var_pop(rating - p) / var_pop(rating)')} AS explained_variance"""


def _split_scores(spark, sf, view, split, k=10, n=10):
    train, test = splits.sides(stored(split(stored(view(spark, sf)))))
    return neighbors.item_knn_scores(train, neighbors.item_similarity(train), k=k, n=n), train, test


@query("v1_regression_metrics", _on_split(sp.BRANDS, sp.HOLDOUT, _METRIC_SQL + """ FROM (SELECT t.rating,
  coalesce(s.score, 0) AS p FROM test t LEFT JOIN scores s USING (user_id, item_id))"""))
def _(spark, sf):
    train, test = splits.sides(stored(splits.holdout(stored(views.ratings_brands(spark, sf)))))
    scores = neighbors.item_knn_scores(train, neighbors.item_similarity(train), k=10, targets=test)
    out = metrics.regression_metrics(metrics.with_default(test, scores))
    return out.select(*[rounded(c).alias(c) for c in out.columns])


_PR_SQL = f""" SELECT {r6('avg(hits / 10.0::DOUBLE)')} AS precision, {r6('avg(hits / relevant::DOUBLE)')} AS recall,
  count(*) AS n_users FROM (SELECT t.user_id, count(b.item_id) AS hits, count(*) AS relevant
  FROM test t LEFT JOIN best b USING (user_id, item_id) GROUP BY 1)"""


@query("v2_precision_recall", _on_split(sp.EVENTS, sp.HOLDOUT, sp.top_scores(10) + _PR_SQL))
def _(spark, sf):
    scores, train, test = _split_scores(spark, sf, views.ratings_events, splits.holdout)
    out = metrics.precision_recall(scores, test, train)
    return out.select(rounded("precision").alias("precision"), rounded("recall").alias("recall"), "n_users")


@query("v2_precision_recall_parts", _on_split(sp.PARTS, sp.HOLDOUT, sp.top_scores(10) + _PR_SQL))
def _(spark, sf):
    scores, train, test = _split_scores(spark, sf, views.ratings_parts, splits.holdout)
    out = metrics.precision_recall(scores, test, train)
    return out.select(rounded("precision").alias("precision"), rounded("recall").alias("recall"), "n_users")


@query("v3_leave_one_out_metrics", _on_split(sp.EVENTS, sp.LOO, sp.top_scores(10) + f""" SELECT
  {r6('avg(CASE WHEN rank IS NULL THEN 0 ELSE 0.1::DOUBLE END)')} AS precision_loo,
  {r6('avg(CASE WHEN rank IS NULL THEN 0 ELSE 1 END)')} AS recall_loo,
  {r6('avg(coalesce(1.0::DOUBLE / rank, 0))')} AS mrr_loo,
  {r6('avg(coalesce(1.0::DOUBLE / log2(rank + 1), 0))')} AS ndcg_loo
  FROM test t LEFT JOIN best b USING (user_id, item_id)"""))
def _(spark, sf):
    scores, train, test = _split_scores(spark, sf, views.ratings_events, splits.leave_one_out)
    out = metrics.leave_one_out_metrics(scores, test, train)
    return out.select(*[rounded(c).alias(c) for c in out.columns])


@query("v4_precision_recall_with_seen", f"""WITH r0 AS MATERIALIZED ({sp.EVENTS}){sp.HOLDOUT}{_JACCARD}
  , scores AS (SELECT h.user_id, e.i AS item_id, sum(e.sim) AS score FROM r h JOIN jac e ON e.j = h.item_id GROUP BY 1, 2)
  {sp.top_scores(10, drop_seen=False)}{_PR_SQL}""")
def _(spark, sf):
    train, test = splits.sides(stored(splits.holdout(stored(views.ratings_events(spark, sf)))))
    scores = neighbors.propagate(prepare.binarise(train), neighbors.jaccard_edges(train), n=10)
    out = metrics.precision_recall(scores, test, train, exclude_seen=False)
    return out.select(rounded("precision").alias("precision"), rounded("recall").alias("recall"), "n_users")


_ROC = """WITH s AS (SELECT CAST(c - 1 AS VARCHAR) AS class, CAST(embedding[c] AS DOUBLE) AS score,
    CAST(label = c - 1 AS INTEGER) AS label FROM embeddings, range(1, 11) t(c)),
  a AS (SELECT * FROM s UNION ALL SELECT 'micro', score, label FROM s),
  g AS (SELECT class, score, sum(label) AS pos, sum(1 - label) AS neg FROM a GROUP BY 1, 2),
  c AS MATERIALIZED (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY class) AS p,
    sum(neg) OVER (PARTITION BY class) AS q FROM g WINDOW w AS (PARTITION BY class ORDER BY score DESC))"""


def _class_scores(spark, sf):
    vectors = views.table(spark, sf, "embeddings")
    flat = vectors.select("label", F.posexplode(F.slice("embedding", 1, 10)).alias("class", "score"))
    return flat.select("class", F.col("score").cast("double").alias("score"),
                       (F.col("label") == F.col("class")).cast("int").alias("label"))


@query("v5_roc_curve", _ROC + f" SELECT class, score AS threshold, {r6('fp / q')} AS fpr, {r6('tp / p')} AS tpr FROM c")
def _(spark, sf):
    curve = metrics.roc_curve(metrics.one_vs_rest(_class_scores(spark, sf)))
    return curve.select("class", "threshold", rounded("fpr").alias("fpr"), rounded("tpr").alias("tpr"))


@query("v5_auc", _ROC + f""" SELECT class, {r6('sum(neg * (tp - pos / 2.0::DOUBLE) / (p * q))')} AS auc FROM c GROUP BY 1""")
def _(spark, sf):
    return metrics.auc(metrics.one_vs_rest(_class_scores(spark, sf))).withColumn("auc", rounded("auc"))


@query("v5_auc_documents", f"""WITH s AS ({sp.SCORED}) SELECT {r6('''(SELECT sum(CASE WHEN a.score > b.score THEN 1.0::DOUBLE
    WHEN a.score = b.score THEN 0.5::DOUBLE ELSE 0 END) / count(*) FROM s a JOIN s b ON a.label = 1 AND b.label = 0)''')} AS auc""")
def _(spark, sf):
    scored = views.scored_labels(spark, sf).withColumn("class", F.lit("quality"))
    return metrics.auc(scored).select(rounded("auc").alias("auc"))


@query("a1_recommendation_breakdown", sp.with_ratings(sp.EVENTS, sp.COSINE + sp.knn_scores(20, seen=True) + sp.top_scores(10)
  + f""", pick AS (SELECT user_id FROM r GROUP BY 1 ORDER BY CASE WHEN count(*) BETWEEN 5 AND 20 THEN 0 ELSE 1 END,
      CASE WHEN count(*) BETWEEN 5 AND 20 THEN 0 ELSE -count(*) END, user_id LIMIT 1)
  SELECT user_id, item_id, 'history' AS series, {r6('rating')} AS value FROM r WHERE user_id IN (SELECT user_id FROM pick)
  UNION ALL SELECT user_id, item_id, 'score', {r6('CASE WHEN s.rating IS NULL THEN p.score ELSE 0 END')} FROM scores p
    LEFT JOIN r s USING (user_id, item_id) WHERE user_id IN (SELECT user_id FROM pick)
  UNION ALL SELECT user_id, item_id, 'top_k', {r6('score')} FROM best WHERE user_id IN (SELECT user_id FROM pick)"""))
def _(spark, sf):
    ratings = stored(views.ratings_events(spark, sf).select("user_id", "item_id", "rating"))
    picked = recommend.sample_user(ratings)
    history = ratings.join(picked.select("user_id"), "user_id", "left_semi")
    scores = neighbors.item_knn_scores(history, neighbors.item_similarity(ratings), k=20, include_seen=True)
    shown = recommend.breakdown(history, scores, picked, 10)
    return shown.withColumn("value", rounded("value"))


@query("a2_sample_user", sp.with_ratings(sp.PARTS, """ SELECT user_id, count(*) AS n_ratings FROM r GROUP BY 1 ORDER BY
  CASE WHEN count(*) BETWEEN 5 AND 20 THEN 0 ELSE 1 END, CASE WHEN count(*) BETWEEN 5 AND 20 THEN 0 ELSE -count(*) END,
  user_id LIMIT 1"""))
def _(spark, sf):
    return recommend.sample_user(views.ratings_parts(spark, sf))


@query("d10_pair_support", sp.with_ratings(sp.BRANDS, sp.COSINE + f""" SELECT i AS item_i, j AS item_j, support,
  {r6('sim')} AS raw, {r6('support / (support + 5.0::DOUBLE) * sim')} AS sim FROM edges"""))
def _(spark, sf):
    edges = neighbors.item_similarity(stored(views.ratings_brands(spark, sf)), shrinkage=5)
    return edges.select("item_i", "item_j", "support", rounded("raw").alias("raw"), rounded("sim").alias("sim"))


@query("d10_slope_one_support", sp.with_ratings(
    sp.EVENTS, sp.PAIRS + f" SELECT i AS item_i, j AS item_j, n AS freq, {r6('dev')} AS dev FROM pairs WHERE i < j"))
def _(spark, sf):
    pairs = pair_stats(stored(views.ratings_events(spark, sf)))
    dev = mirrored(pairs.select("item_i", "item_j", (F.col("diff") / F.col("n_co")).alias("dev"), F.col("n_co").alias("freq")), ("dev",))
    return dev.filter("item_i < item_j").select("item_i", "item_j", "freq", rounded("dev").alias("dev"))
