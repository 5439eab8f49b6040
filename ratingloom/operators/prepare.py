"""Preparation of ratings and item attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.skew import dense_ids


def observed(ratings: DataFrame) -> DataFrame:
    """Drop the zero cells: zero means missing."""
    return ratings.filter(F.col("rating") > 0)


def to_wide(ratings: DataFrame, items: Sequence | None = None) -> DataFrame:
    """One row per user, one column per item, missing = 0. For small catalogues.

    Without ``items`` the columns are all rated items; Spark refuses more than ``spark.sql.pivotMaxValues`` of them.
    """
    if items is None:
        limit = int(ratings.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        items = sorted(r[0] for r in ratings.select("item_id").distinct().limit(limit + 1).collect())
        if len(items) > limit:
            raise ValueError(f"more than {limit} items for one column each")
    wide = ratings.groupBy("user_id").pivot("item_id", list(items)).agg(F.first("rating"))
    return wide.fillna(0.0, [str(i) for i in items])


def to_long(wide: DataFrame, key: str = "user_id", item: str = "item_id") -> DataFrame:
    """Inverse of ``to_wide``; zero cells vanish."""
    values = [c for c in wide.columns if c != key]
    stacked = wide.select(key, *[F.col(f"`{c}`").cast("double") for c in values])
    return observed(stacked.unpivot([key], [f"`{c}`" for c in values], item, "rating"))


def top_keys(ratings: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` keys with most ratings; ties go to the smaller key."""
    counts = ratings.groupBy(key).agg(F.count("*").alias("n_ratings"))
    return counts.orderBy(F.desc("n_ratings"), F.asc(key)).limit(n)


def dense_subset(ratings: DataFrame, n_items: int, n_users: int) -> DataFrame:
    """Most rated items first, then the most active users inside them."""
    of_items = ratings.join(top_keys(ratings, "item_id", n_items).select("item_id"), "item_id", "left_semi")
    users = top_keys(of_items, "user_id", n_users).select("user_id")
    return of_items.join(users, "user_id", "left_semi")


def contiguous_ids(ratings: DataFrame, key: str, name: str) -> DataFrame:
    """Mapping key -> 0-based position in key order; read backwards it is the inverse."""
    return dense_ids(ratings, key, name)


def binarise(ratings: DataFrame, threshold: float | None = None) -> DataFrame:
    """Any rating counts as 1, or only ratings at or above ``threshold``."""
    kept = ratings if threshold is None else ratings.filter(F.col("rating") >= threshold)
    return kept.select("user_id", "item_id").distinct().withColumn("rating", F.lit(1.0))


def with_titles(df: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Title per item; ids missing from the catalogue are named as unknown."""
    return df.join(catalogue.select("item_id", "title"), "item_id", "left").withColumn(
        "title", F.coalesce("title", unknown_title("item_id"))
    )


def unknown_title(col: str) -> Column:
    return F.concat(F.lit("Movie ID: "), F.col(col).cast("string"), F.lit(" (Unknown)"))


def resolve_titles(df: DataFrame, catalogue: DataFrame, ref: str) -> DataFrame:
    """Title of a string reference that is either an item id or already a title."""
    by_id = catalogue.select(F.col("item_id").cast("string").alias(ref), F.col("title").alias("_by_id"))
    named = catalogue.select(F.col("title").alias(ref)).distinct().withColumn("_is_title", F.lit(True))
    return (
        df.join(by_id, ref, "left")
        .join(named, ref, "left")
        .withColumn("title", F.coalesce(F.col("_by_id"), F.when(F.col("_is_title"), F.col(ref)), unknown_title(ref)))
        .drop("_by_id", "_is_title")
    )


def histories(ratings: DataFrame) -> DataFrame:
    """user_id, items: every user's items in order, one row per user whatever their number."""
    return ratings.groupBy("user_id").agg(F.array_sort(F.collect_list("item_id")).alias("items"))


def history_chunks(ratings: DataFrame, values: Sequence[str] = (), limit: int = 1024) -> DataFrame:
    """User histories as item arrays of about ``limit`` entries at most.

    A longer history becomes several rows (chunk 0..n_chunks-1) instead of one unbounded array; every
    user with at most ``limit`` items has exactly one.
    """
    sizes = ratings.groupBy("user_id").agg(F.count("*").alias("_n"))
    longest = sizes.agg(F.max("_n")).first()[0] or 0
    if longest <= limit:
        cut = ratings.withColumn("n_chunks", F.lit(1)).withColumn("chunk", F.lit(0))
    else:
        parts = sizes.filter(F.col("_n") > limit).select(
            "user_id", F.ceil(F.col("_n") / limit).cast("int").alias("n_chunks")
        )
        cut = (
            ratings.join(parts, "user_id", "left")
            .withColumn("n_chunks", F.coalesce("n_chunks", F.lit(1)))
            .withColumn("chunk", F.pmod(F.xxhash64("item_id"), F.col("n_chunks")).cast("int"))
        )
    entry = F.struct("item_id", *values)
    return (
        cut.groupBy("user_id", "n_chunks", "chunk")
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        .select(
            "user_id",
            "n_chunks",
            "chunk",
            F.col("entries.item_id").alias("items"),
            *[F.col(f"entries.{v}").alias(v) for v in values],
        )
    )


def rating_levels(ratings: DataFrame) -> dict[str, DataFrame]:
    """Global, per-user and per-item means and counts over rated cells."""
    stats = [F.avg("rating").alias("mean_rating"), F.count("*").alias("n_ratings")]
    return {
        "global": ratings.agg(*stats),
        "user": ratings.groupBy("user_id").agg(*stats),
        "item": ratings.groupBy("item_id").agg(*stats),
    }


def centred(ratings: DataFrame, mean_over: str = "rated", n_items: int | None = None) -> DataFrame:
    """Rating minus the user's mean over rated cells, or over all items counting missing as 0."""
    if mean_over == "rated":
        means = ratings.groupBy("user_id").agg(F.avg("rating").alias("user_mean"))
    elif mean_over == "all":
        if n_items is None:
            n_items = ratings.select("item_id").distinct().count()
        means = ratings.groupBy("user_id").agg((F.sum("rating") / F.lit(n_items)).alias("user_mean"))
    else:
        raise ValueError("mean_over must be 'rated' or 'all'")
    return ratings.join(means, "user_id").withColumn("centred", F.col("rating") - F.col("user_mean"))


def clean_titles(movies: DataFrame) -> DataFrame:
    """Rows with title and date; year is the part of the date before the first dash, and must be a number."""
    year = F.split(F.col("release_date").cast("string"), "-")[0]
    return (
        movies.dropna(subset=["title", "release_date"])
        .withColumn("release_year", year.try_cast("double"))
        .filter(F.col("release_year").isNotNull())
        .withColumn("release_year", F.col("release_year").cast("int"))
    )


# Feature names in index order (the first is index 1) and the words that give a feature.
FEATURE_NAMES = [
    "Classic (Before 1980)", "Old Film (1980-1999)", "Modern Film (2000-2010)", "Recent Film (After 2010)",
    "Action / Fast-Paced", "Adventure / Epic", "Comedy", "Romantic", "Drama", "Horror", "Thriller / Crime",
    "Sci-Fi / Space", "Fantasy / Mythic", "Animation / Family", "Mystery", "Musical", "War / Historical",
    "Documentary", "Western", "Visually Stunning", "Dark / Gritty", "Lighthearted / Feel-Good",
    "Philosophical / Existential", "Character-Driven", "Plot-Driven / Complex", "Emotional / Heartfelt",
    "Violent / Intense", "High Budget", "Low Budget", "Popular", "Critically Acclaimed", "Cult / Niche",
    "Family-Friendly", "Social / Political Theme", "Based on a True Story",
]
GENRE_WORDS = {
    "Action / Fast-Paced": ["action"],
    "Adventure / Epic": ["adventure"],
    "Comedy": ["comedy"],
    "Romantic": ["romance"],
    "Drama": ["drama"],
    "Horror": ["horror"],
    "Thriller / Crime": ["thriller", "crime"],
    "Sci-Fi / Space": ["science fiction", "sci-fi", "space"],
    "Fantasy / Mythic": ["fantasy", "myth"],
    "Animation / Family": ["animation", "family"],
    "Mystery": ["mystery"],
    "Musical": ["music"],
    "War / Historical": ["war", "history"],
    "Documentary": ["documentary"],
    "Western": ["western"],
    "Family-Friendly": ["family", "animation"],
}
OVERVIEW_WORDS = {
    "Visually Stunning": ["beautiful", "cinematography"],
    "Dark / Gritty": ["dark", "gritty", "noir"],
    "Lighthearted / Feel-Good": ["funny", "light-hearted", "joyful"],
    "Philosophical / Existential": ["philosophical", "existential"],
    "Character-Driven": ["character", "relationships"],
    "Plot-Driven / Complex": ["plot", "mystery", "twist"],
    "Emotional / Heartfelt": ["emotional", "heartfelt", "touching"],
    "Violent / Intense": ["violence", "intense", "fight"],
    "Social / Political Theme": ["war", "politics", "society"],
    "Based on a True Story": ["true story"],
}


def feature_conditions() -> dict[str, Column]:
    """Test of every feature over release_year, genres, overview, budget, popularity, vote_average."""
    year, budget = F.col("release_year"), F.col("budget")
    popularity, vote = F.col("popularity"), F.col("vote_average")

    def any_word(col: str, words: Sequence[str]) -> Column:
        text = F.lower(F.coalesce(F.col(col), F.lit("")))
        test = text.contains(words[0])
        for word in words[1:]:
            test = test | text.contains(word)
        return test

    tests = {
        "Classic (Before 1980)": year < 1980,
        "Old Film (1980-1999)": (year >= 1980) & (year < 2000),
        "Modern Film (2000-2010)": (year >= 2000) & (year <= 2010),
        "Recent Film (After 2010)": year > 2010,
        "High Budget": budget > 80_000_000,
        "Low Budget": (budget > 0) & (budget < 10_000_000),
        "Popular": popularity > 10,
        "Critically Acclaimed": vote >= 7.5,
        "Cult / Niche": (vote > 5.5) & (vote < 7) & (popularity < 5),
    }
    tests.update({name: any_word("genres", words) for name, words in GENRE_WORDS.items()})
    tests.update({name: any_word("overview", words) for name, words in OVERVIEW_WORDS.items()})
    return tests


def tag_features(movies: DataFrame) -> DataFrame:
    """``features``: the names that apply, in index order; ``feature_ids``: their 1-based indices."""
    tests = feature_conditions()
    names = F.array_compact(F.array(*[F.when(tests[n], F.lit(n)) for n in FEATURE_NAMES]))
    ids = F.array_compact(F.array(*[F.when(tests[n], F.lit(p + 1)) for p, n in enumerate(FEATURE_NAMES)]))
    return movies.withColumn("features", names).withColumn("feature_ids", ids)


def feature_matrix(item_map: DataFrame, items: DataFrame, features: DataFrame) -> DataFrame:
    """Long 0/1 item-feature cells equal to 1.

    ``item_map``: item, feature_ids (1-based); ``items``: item; ``features``: position (1-based), feature.
    Unknown items and positions outside the list are ignored.
    """
    pairs = item_map.select("item", F.explode("feature_ids").alias("position")).distinct()
    return pairs.join(items.select("item").distinct(), "item", "left_semi").join(features, "position").select(
        "item", "feature"
    )


def flags_to_list(df: DataFrame, flags: Sequence[str], name: str = "genres") -> DataFrame:
    """0/1 flag columns to the list of the flagged names."""
    listed = F.array_compact(F.array(*[F.when(F.col(f) == 1, F.lit(f)) for f in flags]))
    return df.withColumn(name, listed).drop(*flags)


def split_list(df: DataFrame, col: str, sep: str = "|") -> DataFrame:
    """Delimited string to array."""
    return df.withColumn(col, F.split(F.col(col), f"\\Q{sep}\\E"))
