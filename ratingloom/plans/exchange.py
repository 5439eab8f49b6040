"""Queries that write derived tables in an exchange format and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.functions.columns import rounded
from ratingloom.operators import prepare, rules, tuning
from ratingloom.plans import sqlparts as sp
from ratingloom.plans.core import MOVIES, _movies
from ratingloom.plans.insight import REPORT_SQL, order_report
from ratingloom.plans.patterns import SUPPORT, itemset_sql, rules_sql
from ratingloom.plans.registry import query
from ratingloom.session import scratch_path
from ratingloom.sources import files, views

r6 = sp.r6


def _events(spark, sf):
    return views.ratings_events(spark, sf).select("user_id", "item_id", "rating")


@query("s1_long_ratings_csv", sp.with_ratings(sp.EVENTS, " SELECT user_id, item_id, rating FROM r"))
def _(spark, sf):
    path = scratch_path(spark, "ratings.csv")
    named = _events(spark, sf).select(F.col("user_id").alias("userId"), F.col("item_id").alias("movieId"), "rating")
    named.write.csv(path, header=True)
    return files.read_long_csv(spark, path)


@query("s2_movielens_folder", sp.with_ratings(sp.PARTS, f""" SELECT user_id, r.item_id, {r6('rating')} AS rating, m.title, m.genres
  FROM r JOIN (SELECT item_id, title, genres FROM ({MOVIES}) WHERE title IS NOT NULL) m ON m.item_id = r.item_id"""))
def _(spark, sf):
    folder = scratch_path(spark, "movielens")
    ratings = views.ratings_parts(spark, sf).select(
        F.col("user_id").alias("userId"), F.col("item_id").alias("movieId"), "rating", F.lit(0).alias("timestamp"))
    ratings.write.csv(f"{folder}/ratings.csv", header=True)
    movies = _movies(spark, sf).filter("title IS NOT NULL").select(F.col("item_id").alias("movieId"), "title", "genres")
    movies.write.csv(f"{folder}/movies.csv", header=True)
    read, titles = files.read_movielens(spark, f"{folder}/ratings.csv", f"{folder}/movies.csv")
    return read.join(titles, "item_id").select("user_id", "item_id", rounded("rating").alias("rating"), "title", "genres")


@query("s3_tab_ratings", sp.with_ratings(sp.EVENTS, " SELECT user_id, item_id, rating, CAST(floor(epoch(ts)) AS BIGINT) AS unix_time FROM r"))
def _(spark, sf):
    path = scratch_path(spark, "u.data")
    rows = views.ratings_events(spark, sf).select("user_id", "item_id", "rating", F.unix_timestamp("ts"))
    rows.write.csv(path, sep="\t")
    read = files.read_tab_ratings(spark, path)
    return read.select("user_id", "item_id", "rating", F.unix_timestamp("ts").alias("unix_time"))


@query("s3_pipe_items", """SELECT p_partkey AS item_id, p_name || ' é' AS title, concat_ws(',', CASE WHEN p_size % 19 = 1 THEN 'Action' END,
  CASE WHEN p_size % 19 = 5 OR p_type = 'PROMO' THEN 'Comedy' END, CASE WHEN p_size % 19 = 18 THEN 'Western' END) AS genres FROM part""")
def _(spark, sf):
    path = scratch_path(spark, "u.item")
    flag = {"Action": "p_size % 19 = 1", "Comedy": "p_size % 19 = 5 OR p_type = 'PROMO'", "Western": "p_size % 19 = 18"}
    flags = [F.expr(f"int({flag.get(g, 'false')})").alias(g) for g in files.GENRE_FLAGS]
    part = views.table(spark, sf, "part")
    rows = part.select("p_partkey", F.concat("p_name", F.lit(" é")), F.lit("01-Jan-1995"), F.lit(None).cast("string"), F.lit("http://x"), *flags)
    rows.toDF(*[f"c{n}" for n in range(5 + len(flags))]).write.csv(path, sep="|", encoding="ISO-8859-1")
    listed = prepare.flags_to_list(files.read_pipe_items(spark, path), files.GENRE_FLAGS)
    return listed.select("item_id", "title", F.array_join("genres", ",").alias("genres"))


def _generated(spark, sf):
    folder = scratch_path(spark, "generated")
    ratings = views.stored(_events(spark, sf))
    items = [row[0] for row in ratings.select("item_id").distinct().orderBy("item_id").collect()]  # columns of the wide file
    files.write_generated(folder, ratings, items, views.segment_profiles(spark, sf), views.event_features(spark, sf), views.event_types(spark, sf))
    return files.read_generated(spark, folder)


@query("s4_generated_ratings", sp.with_ratings(
    sp.EVENTS, " SELECT CAST(user_id AS VARCHAR) AS user, CAST(item_id AS VARCHAR) AS item, rating FROM r"))
def _(spark, sf):
    return _generated(spark, sf)["ratings"]


@query("s7_generated_truth", f"""SELECT 'profile' AS part, CAST(user_id AS VARCHAR) AS id, feature, {r6('weight')} AS value FROM ({sp.PROFILES}) WHERE weight <> 0
  UNION ALL SELECT 'feature', CAST(item_id AS VARCHAR), feature, 1.0 FROM ({sp.EVENT_FEATURES})
  UNION ALL SELECT DISTINCT 'movie', CAST(item_id AS VARCHAR), 'title', 0.0 FROM ({sp.EVENT_FEATURES})""")
def _(spark, sf):
    data = _generated(spark, sf)
    profiles = data["profiles"].filter("weight <> 0").select(
        F.lit("profile").alias("part"), F.col("user").alias("id"), "feature", rounded("weight").alias("value"))
    features = data["features"].select(F.lit("feature").alias("part"), F.col("item").alias("id"), "feature", F.lit(1.0).alias("value"))
    movies = data["movies"].select(F.lit("movie").alias("part"), F.col("movieId").alias("id"), F.lit("title").alias("feature"), F.lit(0.0).alias("value"))
    return profiles.unionByName(features).unionByName(movies)


@query("s6_ground_truth_folder", f"""SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, feature FROM ({sp.PART_FEATURES}) WHERE item_id IN
  (SELECT p_partkey FROM part WHERE p_retailprice < 1500)""")
def _(spark, sf):
    from ratingloom.skew import global_rank

    folder = scratch_path(spark, "truth")
    long = views.part_features(spark, sf)
    names = global_rank(long.select("feature").distinct(), [F.col("feature")], "position")
    names.select(F.col("position").alias("#"), F.concat("feature", F.lit("  ")).alias("Feature Dimension")).write.csv(
        f"{folder}/latent_characteristics.csv", header=True, ignoreTrailingWhiteSpace=False)
    items = views.table(spark, sf, "part").filter("p_retailprice < 1500")
    items.select(F.concat(F.lit(" "), "p_partkey").alias("Item Name")).write.csv(
        f"{folder}/items.csv", header=True, ignoreLeadingWhiteSpace=False)
    mapped = long.join(names, "feature").groupBy("item_id").agg(F.collect_set("position").alias("_ids"))
    mapped.select(F.to_json(F.create_map(F.col("item_id").cast("string"), "_ids"))).write.text(f"{folder}/item_feature_map.json")
    features, known, item_map = files.read_ground_truth(spark, folder, one_object=False)
    return prepare.feature_matrix(item_map, known, features)


@query("s8_rule_records", itemset_sql() + rules_sql("confidence", 0.5) + f""" SELECT 'itemset' AS kind, array_to_string(items, ',') AS a, '' AS b,
    {r6('support')} AS value FROM (SELECT * FROM sets ORDER BY round(support, 9) DESC, items LIMIT 50)
  UNION ALL SELECT 'rule', array_to_string(a, ','), array_to_string(b, ','), {r6('confidence')} FROM (SELECT * FROM rules
    ORDER BY round(confidence, 9) DESC, a, b LIMIT 100)""")
def _(spark, sf):
    folder = scratch_path(spark, "records")
    sets = rules.apriori(views.ratings_brands(spark, sf), SUPPORT)
    files.write_rule_records(sets, rules.association_rules(sets), folder)

    def text(col):
        return F.array_join(F.col(col).cast("array<string>"), ",")

    read_sets = spark.read.schema("items array<long>, support double").json(f"{folder}/itemsets")
    read_rules = spark.read.schema("antecedent array<long>, consequent array<long>, confidence double").json(f"{folder}/rules")
    return read_sets.select(
        F.lit("itemset").alias("kind"), text("items").alias("a"), F.lit("").alias("b"), rounded("support").alias("value")
    ).unionByName(read_rules.select(
        F.lit("rule").alias("kind"), text("antecedent").alias("a"), text("consequent").alias("b"), rounded("confidence").alias("value")))


def _written_reports(spark, sf):
    root = scratch_path(spark, "reports")
    report = order_report(spark, sf)
    for day, kept in (("20240101_000000", report.filter("trial <= 36")), ("20240601_000000", report)):
        files.write_report(kept, tuning.best_trials(kept), f"{root}/report-{day}")
    return root


_BEST = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY algorithm
  ORDER BY round(CASE WHEN type = 'implicit' THEN -cost ELSE cost END, 9), trial) AS rn FROM ({REPORT_SQL} HAVING true) {{where}}) WHERE rn = 1"""


@query("s9_report_files", f"""SELECT '20240101_000000' AS run_time, algorithm, trial, runtime, type, cost AS value FROM ({_BEST.format(where='WHERE trial <= 36')})
  UNION ALL SELECT '20240601_000000', algorithm, trial, runtime, type, cost FROM ({_BEST.format(where='')})""")
def _(spark, sf):
    best = files.read_report(spark, _written_reports(spark, sf), "best-hp.csv")
    return best.select("run_time", "algorithm", "trial", "runtime", "type", F.map_values("metrics")[0].alias("value"))


@query("s11_report_folders", f"""SELECT run_time, count(*) AS trials, {r6('sum(cost)', 2)} AS total FROM (
  SELECT '20240101_000000' AS run_time, cost FROM ({REPORT_SQL}) WHERE trial <= 36
  UNION ALL SELECT '20240601_000000', cost FROM ({REPORT_SQL})) GROUP BY 1""")
def _(spark, sf):
    full = files.read_report(spark, _written_reports(spark, sf), "full_report.csv")
    return full.groupBy("run_time").agg(F.count("*").alias("trials"), rounded(F.sum(F.map_values("metrics")[0]), 2).alias("total"))


_RUNS = """SELECT regexp_replace(o_orderpriority, '[^A-Z]', '', 'g') AS algorithm, strftime(o_orderdate, '%Y%m') || '01_120000' AS run,
    min(o_orderstatus) AS data_source, count(*) AS k, round(avg(o_totalprice), 2) AS rmse FROM orders GROUP BY 1, 2"""


@query("s10_run_folders", f"""SELECT algorithm, strftime(strptime(run, '%Y%m%d_%H%M%S'), '%Y-%m-%d %H:%M:%S') AS timestamp,
  CASE WHEN k % 2 = 0 THEN data_source ELSE 'N/A' END AS data_source, CAST(k AS VARCHAR) AS k, rmse FROM ({_RUNS})""")
def _(spark, sf):
    root = scratch_path(spark, "runs")
    orders = views.table(spark, sf, "orders")
    runs = orders.groupBy(
        F.regexp_replace("o_orderpriority", "[^A-Z]", "").alias("algorithm"),
        F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("01_120000")).alias("run"),
    ).agg(F.min("o_orderstatus").alias("data_source"), F.count("*").alias("k"), F.round(F.avg("o_totalprice"), 2).alias("rmse"))
    broken = runs.withColumn("run", F.concat(F.lit("draft_"), "run"))  # folders that are no run
    source = F.when(F.col("k") % 2 == 0, F.col("data_source"))
    params = runs.unionByName(broken).select(
        "algorithm", "run", F.to_json(F.struct("algorithm", source.alias("data_source"), "k")).alias("value"))
    params.repartition("algorithm", "run").write.partitionBy("algorithm", "run").text(f"{root}/params")
    metrics = runs.select("algorithm", "run", F.to_json(F.struct("rmse")).alias("value"))
    metrics.repartition("algorithm", "run").write.partitionBy("algorithm", "run").text(f"{root}/metrics")
    read = files.read_runs(spark, f"{root}/params/*/*/*.txt", f"{root}/metrics/*/*/*.txt")
    return read.select(
        "algorithm", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "data_source",
        F.col("params")["k"].alias("k"), F.col("metrics")["rmse"].alias("rmse"))
