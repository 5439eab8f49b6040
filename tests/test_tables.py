import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.operators import diagnostics, generate, metrics, prepare, recommend, splits, tuning
from ratingloom.session import scratch_path
from ratingloom.sources import files
from tests.conftest import TOY, cells


def test_wide_and_long_are_inverse(toy):
    wide = prepare.to_wide(toy, range(6))
    assert [list(r)[1:] for r in wide.orderBy("user_id").collect()] == TOY
    back = prepare.to_long(wide).select("user_id", F.col("item_id").cast("long"), "rating")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, toy.collect()))


def test_dense_subset_takes_items_first(toy):
    got = prepare.dense_subset(toy, 2, 3).collect()
    assert {r.item_id for r in got} == {0, 3} and {r.user_id for r in got} == {0, 1, 2}


def test_titles_fall_back(spark, toy):
    catalogue = spark.createDataFrame([(0, "zero")], "item_id long, title string")
    named = cells(prepare.with_titles(toy.select("item_id").distinct(), catalogue), "item_id", "title")
    assert named[0,] == "zero" and named[4,] == "Movie ID: 4 (Unknown)"
    refs = spark.createDataFrame([("0",), ("zero",), ("9",)], "ref string")
    assert cells(prepare.resolve_titles(refs, catalogue, "ref"), "ref", "title") == {
        ("0",): "zero", ("zero",): "zero", ("9",): "Movie ID: 9 (Unknown)"
    }


def test_splits(spark):
    rows = [(1, 1)] + [(2, i) for i in range(3)] + [(3, i) for i in range(23)]
    df = spark.createDataFrame(rows, "user_id long, item_id long").withColumn("rating", F.lit(3.0))

    def tested(labelled):
        return {r["user_id"]: r["n"] for r in labelled.filter("is_test").groupBy("user_id").agg(F.count("*").alias("n")).collect()}

    assert tested(splits.holdout(df)) == {2: 1, 3: 4}
    assert tested(splits.holdout_floor(df)) == {3: 4}
    assert tested(splits.leave_one_out(df)) == {1: 1, 2: 1, 3: 1}
    train, test = splits.sides(splits.holdout(df, seed=5))
    assert train.count() + test.count() == len(rows)
    assert train.join(test, ["user_id", "item_id"]).count() == 0
    other = splits.holdout(df, seed=6).filter("is_test")
    assert test.join(other, ["user_id", "item_id"]).count() < 5
    assert splits.folds(df).select("fold").distinct().count() == 3


def test_regression_metrics_and_empty_test(spark):
    df = spark.createDataFrame([(4.0, 3.0), (2.0, 2.5), (5.0, 5.0)], "rating double, prediction double")
    row = metrics.regression_metrics(df).first()
    y, p = np.array([4, 2, 5.0]), np.array([3, 2.5, 5.0])
    assert row.rmse == pytest.approx(math.sqrt(((y - p) ** 2).mean()))
    assert row.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert row.explained_variance == pytest.approx(1 - (y - p).var() / y.var())
    assert row.mape == pytest.approx(np.abs((y - p) / (y + 1e-8)).mean() * 100)
    assert set(metrics.regression_metrics(df.filter("rating > 9")).first()) == {0.0}


def test_ranking_metrics(spark):
    scores = spark.createDataFrame([(1, i, 10.0 - i) for i in range(6)] + [(2, 0, 1.0)], "user_id long, item_id long, score double")
    train = spark.createDataFrame([(1, 0), (2, 5)], "user_id long, item_id long")
    test = spark.createDataFrame([(1, 2), (1, 5), (2, 4)], "user_id long, item_id long")
    row = metrics.precision_recall(scores, test, train, k=2).first()
    assert (row.precision, row.recall, row.n_users) == (0.25, 0.25, 2)
    loo = metrics.leave_one_out_metrics(scores, test.filter("item_id <> 5"), train, k=3).first()
    assert loo.mrr_loo == pytest.approx(0.25) and loo.ndcg_loo == pytest.approx(0.5 / math.log2(3))
    assert loo.recall_loo == 0.5 and loo.precision_loo == pytest.approx(1 / 6)
    nobody = metrics.precision_recall(scores, test.filter("user_id > 9"), train).first()
    assert (nobody.precision, nobody.recall) == (0.0, 0.0)


def test_auc_with_ties(spark):
    rows = [("a", 0.9, 1), ("a", 0.5, 1), ("a", 0.5, 0), ("a", 0.1, 0), ("b", 0.2, 1), ("b", 0.4, 0)]
    df = spark.createDataFrame(rows, "class string, score double, label int")
    assert cells(metrics.auc(df), "class", "auc") == {("a",): pytest.approx(0.875), ("b",): 0.0}


def test_sample_user_and_seen_policies(spark, toy):
    assert recommend.sample_user(toy).first()["user_id"] == 2
    assert recommend.sample_user(toy, 3, 3).first()["user_id"] == 3
    assert recommend.sample_user(toy, 50, 60).first()["user_id"] == 2
    scores = spark.createDataFrame([(0, 0, 1.5), (0, 2, float("nan"))], "user_id long, item_id long, score double")
    seen = toy.filter("user_id = 0 and item_id < 2")
    keep = cells(recommend.apply_seen(scores, seen, "keep"), "user_id", "item_id", "score")
    assert keep == {(0, 0): 5.0, (0, 1): 3.0, (0, 2): 0.0}
    assert cells(recommend.apply_seen(scores, seen, "drop"), "user_id", "item_id", "score")[0, 0] == float("-inf")
    assert cells(recommend.apply_seen(scores, seen, "leave"), "user_id", "item_id", "score") == {(0, 0): 1.5, (0, 2): 0.0}


def test_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.0,), (10.0,)], "v double")
    bins = [r["count"] for r in diagnostics.histogram(df, "v", 10).orderBy("bin").collect()]
    assert bins == [1, 2, 0, 0, 0, 0, 0, 0, 0, 1]
    assert sum(r["count"] for r in diagnostics.histogram(df, "v", 10, non_zero=True).collect()) == 3


def test_snapshot_iterations():
    assert diagnostics.snapshot_iterations(12) == [1, 5, 10, 12]


def test_scree_and_error_curve(spark):
    parts = spark.createDataFrame([(1, 3.0), (2, 4.0)], "component int, sigma double")
    assert [r.cumulative for r in diagnostics.scree(parts).orderBy("component").collect()] == pytest.approx([0.36, 1.0])
    pairs = spark.createDataFrame([(1, 1, 3.0, 3.0), (1, 2, 3.0, 1.0), (1, 3, 3.0, 5.0)], "user_id long, item_id long, rating double, prediction double")
    curve = sorted((r.percentile, r.error) for r in diagnostics.error_curve(pairs).collect())
    assert curve == [(0.0, 2.0), (50.0, 2.0), (100.0, 0.0)]


def test_factor_correlation(spark):
    q = np.array([[1.0, 0.2], [2.0, -0.1], [3.0, 0.4], [0.5, 0.3]])
    factors = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(q)], "item_id long, q array<double>")
    truth = spark.createDataFrame([(0, "a"), (2, "a"), (1, "b"), (2, "b"), (3, "b"), (0, "b")], "item_id long, feature string")
    got = cells(diagnostics.factor_feature_correlation(factors, truth), "factor", "feature", "correlation")
    y = np.array([1, 0, 1, 0])
    assert got[0, "a"] == pytest.approx(abs(np.corrcoef(q[:, 0], y)[0, 1]))
    assert got[0, "b"] is None


def test_generated_ratings(spark):
    users = spark.range(1, 21).select(F.col("id").alias("user_id"))
    names = ["a", "b", "c"]
    known = users.select("user_id", F.lit("b").alias("feature"), F.lit(0.5).alias("weight"))
    p = generate.random_preferences(known, names, peaks=1, variability=1, contrast=0.9)
    rows = p.collect()
    assert len(rows) == 60 and all(-1 <= r.weight <= 1 for r in rows)
    per_user = {u: sum(r.weight > 0 for r in rows if r.user_id == u) for u in range(1, 21)}
    assert set(per_user.values()) <= {0, 1, 2}
    assert all(r.weight > 0 for r in rows if r.feature == "b" and per_user[r.user_id])  # the known weight comes first
    assert generate.random_preferences(known.limit(0), names, peaks=1).isEmpty()
    assert [r.user_id for r in generate.cut_dimensions(users, ["user_id"], 3).orderBy("user_id").collect()] == [1, 2, 3]
    items = spark.range(5).select(F.col("id").alias("item_id"))
    q = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a"), (2, "c")], "item_id long, feature string")
    raw = generate.raw_ideal(p, q, names, users, items)
    assert raw.count() == 100
    weight = {(r.user_id, r.feature): r.weight for r in rows}
    got = cells(raw, "user_id", "item_id", "raw")
    assert got[3, 2] == pytest.approx(weight[3, "a"] + weight[3, "c"]) and got[3, 4] == 0.0
    ideal = generate.ideal_ratings(raw)
    low, high = ideal.agg(F.min("rating"), F.max("rating")).first()
    assert (low, high) == (0.0, pytest.approx(5.0))
    hits = generate.ideal_interactions(raw, 0.6)
    ones = hits.filter("rating = 1").count()
    kept = generate.degrade_implicit(hits, 0.0, 0.5).filter("rating = 1").count()
    assert kept == ones - int(ones * 0.5)
    noisy = generate.degrade_explicit(ideal, 0.5, 0.4)
    assert noisy.filter("rating < 0 or rating > 5").count() == 0
    assert 20 < noisy.filter("rating = 0").count() < 80


def test_profile_resize_keeps_known_cells(spark):
    users = spark.range(2).select(F.col("id").alias("user_id"))
    known = spark.createDataFrame([(0, "a", 0.5), (0, "z", 0.7), (9, "a", 0.1)], "user_id long, feature string, weight double")
    got = cells(generate.resize_profiles(known, users, ["a", "b"]), "user_id", "feature", "weight")
    assert got == {(0, "a"): 0.5, (0, "b"): 0.0, (1, "a"): 0.0, (1, "b"): 0.0}


def test_feature_tags(spark):
    rows = [("x", 1995, "Action|War", "A dark plot", 5e6, 3.0, 6.0), ("y", 2015, "Music", None, 0.0, 20.0, 8.0)]
    df = spark.createDataFrame(
        rows, "title string, release_year int, genres string, overview string, budget double, popularity double, vote_average double"
    )
    got = cells(prepare.tag_features(df), "title", "features")
    assert got["x",] == [
        "Old Film (1980-1999)", "Action / Fast-Paced", "War / Historical", "Dark / Gritty", "Plot-Driven / Complex",
        "Low Budget", "Cult / Niche",
    ]
    assert got["y",] == ["Recent Film (After 2010)", "Musical", "Popular", "Critically Acclaimed"]


def test_ground_truth_folder(spark, tmp_path):
    (tmp_path / "latent_characteristics.csv").write_text('#,Feature Dimension,About\n1, Modern ,"plain, ""new"""\n2,Classic,x\n')
    (tmp_path / "items.csv").write_text("Item Name\n Lamp \nChair\n")
    (tmp_path / "item_feature_map.json").write_text('{\n "Lamp": [1, 2, 7],\n "Ghost": [1],\n "Chair": [2]\n}\n')
    features, items, item_map = files.read_ground_truth(spark, str(tmp_path))
    got = {(r.item, r.feature) for r in prepare.feature_matrix(item_map, items, features).collect()}
    assert got == {("Lamp", "Modern"), ("Lamp", "Classic"), ("Chair", "Classic")}


def test_run_folders(spark, tmp_path):
    for run, params in (("20240102_030405", '{"data_source": "small", "k": 5}'), ("notes", "{}"), ("20240203_030405", "broken")):
        folder = tmp_path / "ItemKNN" / run
        folder.mkdir(parents=True)
        (folder / "params.json").write_text(params)
    (tmp_path / "ItemKNN" / "20240102_030405" / "metrics.json").write_text('{"rmse": 0.9}')
    runs = files.read_runs(spark, f"{tmp_path}/*/*/params.json", f"{tmp_path}/*/*/metrics.json")
    got = {str(r.timestamp): (r.algorithm, r.data_source, r.params, r.metrics) for r in runs.collect()}
    assert got["2024-01-02 03:04:05"] == ("ItemKNN", "small", {"k": "5"}, {"rmse": 0.9})
    assert got["2024-02-03 03:04:05"][1] == "Error" and len(got) == 2
    newest = tuning.filter_runs(runs, ["ItemKNN"], None, "2024-01-01", "2024-12-31").first()
    assert str(newest.timestamp) == "2024-02-03 03:04:05"


def test_archetypes_and_reports(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"title": "T", "characteristics": {"x": 1, "y": 0}}]')
    assert sorted(map(tuple, files.read_archetypes(spark, str(tmp_path / "a.json")).collect())) == [("T", "x", 1), ("T", "y", 0)]
    rows = [
        ("A", 1, 1.0, {"k": "5"}, "explicit", {"rmse": 1.2}), ("A", 2, 1.0, {"k": "9"}, "explicit", {"rmse": 1.1}),
        ("B", 1, 1.0, {}, "implicit", {"precision": 0.1}), ("B", 2, 1.0, {}, "implicit", {"precision": 0.3}),
    ]
    report = spark.createDataFrame(rows, tuning.REPORT_SCHEMA)
    best = tuning.best_trials(report)
    assert sorted((r.algorithm, r.trial) for r in best.collect()) == [("A", 2), ("B", 2)]
    root = scratch_path(spark, "reports")
    files.write_report(report, best, f"{root}/report-20240101_000000")
    files.write_report(report, best, f"{root}/report-20250101_000000")
    assert [r.run_time for r in files.list_reports(spark, root).collect()] == ["20250101_000000", "20240101_000000"]
    back = files.read_report(spark, root, "best-hp.csv").filter("algorithm = 'A'").first()
    assert back.params == {"k": "9"} and back.metrics == {"rmse": 1.1}


def test_a_user_of_3000_items_has_one_history(spark):
    df = spark.range(3000).selectExpr("7L AS user_id", "2999 - id AS item_id")
    (row,) = prepare.histories(df).collect()
    assert row.user_id == 7 and row["items"] == list(range(3000))


def test_wide_columns_come_from_the_data(spark):
    df = spark.createDataFrame([(1, 30, 2.0), (1, 4, 1.0), (2, 99, 5.0)], "user_id long, item_id long, rating double")
    wide = prepare.to_wide(df)
    assert wide.columns == ["user_id", "4", "30", "99"]
    assert {tuple(r) for r in prepare.to_long(wide).collect()} == {(1, "30", 2.0), (1, "4", 1.0), (2, "99", 5.0)}


def test_item_sample_is_the_same_rule_at_every_size(spark):
    items = spark.range(100).selectExpr("id AS item_id")
    popular = items.filter("item_id < 50")
    assert generate.sample_items(items, 10).count() == 10
    found = [r.item_id for r in generate.sample_items(items, 10, popular=popular).collect()]
    assert len(set(found)) == 10 and max(found) < 50
    assert generate.sample_items(items, 80, popular=popular).count() == 50
