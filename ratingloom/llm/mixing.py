"""Mixing sources to target weights by Pareto order sampling.

Each source has a target number of words, and each document an expected number of copies, which grows with the binary
digits of its size. A document first gets the whole copies that are certain; the fraction left is its inclusion
probability in a sample without replacement, in which documents are ranked by random odds over inclusion odds and the
first ones that fill the target are taken. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm.common import BROADCAST_IDS
from ratingloom.session import materialise

#: Modulus of the hash that gives the random odds; products of two residues fit a long.
PRIME = 2_147_483_647
SEED = 20_240_501
BUCKETS = 4096  # of the ranking of a source, so that no task ranks a whole source
WORD = r"[^\x20\x09-\x0D]+"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once; written out in full, nested powers grow beyond what can be compiled."""
    return F.element_at(F.transform(F.array(value), use), 1)


def random_unit(doc_id: str = "doc_id", seed: int = SEED) -> Column:
    """A number in (0, 1) fixed by the id, by the same arithmetic in every engine; a null id counts as -1."""
    d, p = F.coalesce(F.col(doc_id), F.lit(-1)).cast("long"), F.lit(PRIME).cast("long")

    def fifth(value: Column) -> Column:
        return _bound(value, lambda x: _bound(x * x % p, lambda xx: xx * xx % p * x % p))

    first = fifth((F.pmod(d, p) * 48_271 + F.pmod(F.floor(d / p).cast("long"), p) * 69_621 + seed) % p)
    return (fifth((first * 16_807 + seed) % p) + 0.5) / float(PRIME)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size: words of the whole text (null: 0)."""
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))


def targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, share: float = 1.0) -> DataFrame:
    """source, number, source_size and target of every source; one row per source.

    Sources in code point order, null last, take the weights in turn. Together they get ``share`` of all words by
    weight; a target stops at ``most`` times its source's words and the excess is shared again by weight. That is the
    level l with sum(min(most * size, l * weight)) = total, found in one pass over the sources ordered by the level
    at which they stop. The windows here run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("number", (F.row_number().over(by_name) - 1).cast("long")).withColumn("weight", weight.cast("long"))
    stop = F.col("source_size") * most / F.col("weight")
    ordered = Window.orderBy(stop, "number")
    whole = Window.partitionBy()
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(whole)
    total = total if share == 1.0 else total * F.lit(share)
    level = (total - F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    # the level is right at the first source that does not stop below it
    levels = sources.withColumn("_level", level).withColumn("_stop", stop)
    right = F.min(F.when(F.col("_stop") >= F.col("_level"), F.struct("_stop", "number", "_level"))).over(whole)["_level"]
    capped = (F.col("source_size") * most).cast("double")
    target = F.when(right.isNull() | (F.col("_stop") <= right), capped).otherwise(right * F.col("weight"))
    return levels.withColumn("target", target).select("source", "number", "source_size", "target")


def _expected(classes: DataFrame, most: int) -> DataFrame:
    """number, digits, sure, p, rest and spread of every source and size class; ``classes`` has few rows a source.

    Expected copies are min(most, level * digits), the level being such that they sum to the target: larger classes
    reach ``most`` first, and the level is right at the first class, from the largest on, that does not. ``sure`` are
    the whole copies, ``p`` is the fraction left, ``rest`` the words that the fractions sum to, ``spread`` the odds of
    the mean fraction.
    """
    source = Window.partitionBy("number")
    larger = source.orderBy(F.desc("digits")).rowsBetween(Window.unboundedPreceding, -1)
    own = source.orderBy(F.desc("digits")).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weighed = F.sum(F.col("words") * F.col("digits")).over(own)
    level = F.when(weighed > 0, (F.col("target") - F.coalesce(F.sum(F.col("words") * most).over(larger), F.lit(0))) / weighed)
    rows = classes.withColumn("level", level)
    right = F.max(F.when(F.col("level") * F.col("digits") <= most, F.struct("digits", "level"))).over(source)["level"]
    rows = rows.withColumn("m", F.when(right.isNull(), F.lit(float(most))).otherwise(F.least(F.lit(float(most)), right * F.col("digits"))))
    rows = rows.withColumn("sure", F.floor("m").cast("long")).withColumn("p", F.col("m") - F.floor("m"))
    rows = rows.withColumn("rest", F.col("target") - F.sum(F.col("sure") * F.col("words")).over(source))
    open_words = F.sum(F.when(F.col("p") > 0, F.col("words")).otherwise(0)).over(source)
    mean = F.when(open_words > 0, F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), F.col("rest") / open_words))).otherwise(0.5)
    return rows.withColumn("mean", mean).select(F.col("source").alias("_source"), "number", "digits", "source_size", "target", "sure", "p", "rest", (F.col("mean") / (1 - F.col("mean"))).alias("spread"))


def plan(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, share: float = 1.0) -> DataFrame:
    """doc_id, source, size, source_size, target, copies (whole times the mix takes the document), taken (its words).

    The copies expected of a document are proportional to the number of binary digits of its size, up to ``most``, so
    that long documents are preferred, but far less than in proportion to their size. Its whole copies are certain.
    The words still missing are filled by one more copy of documents in the order of random odds over inclusion odds,
    the inclusion probability being the fraction left; a document is taken if this brings the sum nearer to the
    target. So the sum misses the target by half a document at most, and reruns agree.

    Ranks are taken bucket by bucket of the ranking, shifted by the sums of the buckets before, so a source with a
    third of all rows is ranked by many tasks. Null texts have size 0; a source without words gets nothing; repeated
    rows of an id are ranked next to each other and may be taken apart; an empty table gives no rows. Extra columns
    are ignored.
    """
    digits = F.length(F.bin("size")).cast("long")
    sizes = materialise(sized(docs).withColumn("_u", random_unit()).withColumn("_digits", digits), "sizes")
    goals = targets(sizes, weights, most, share)
    sums = sizes.groupBy("source", F.col("_digits").alias("digits")).agg(F.sum("size").alias("words"))
    classes = sums.join(goals.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    expected = materialise(_expected(classes, most), "expected")
    rows = sizes.join(expected, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_digits") == F.col("digits"))).drop("_source", "_digits", "digits")
    ratio = F.when(F.col("p") > 0, (F.col("_u") / (1 - F.col("_u"))) / (F.col("p") / (1 - F.col("p"))))
    rows = rows.withColumn("_ratio", ratio)
    # the ratio times the odds of the mean fraction is about the odds of a uniform number, which spreads evenly
    even = F.col("_ratio") * F.col("spread")
    rows = rows.withColumn("_bucket", F.coalesce(F.floor(even / (1 + even) * BUCKETS), F.lit(BUCKETS)).cast("long"))

    buckets = rows.groupBy("number", "_bucket").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("number").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = buckets.select("number", "_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_shift"))
    # documents without a fraction are all in the last bucket and need no rank
    certain = rows.filter("_ratio IS NULL").withColumn("_before", F.lit(0).cast("long"))
    inside = Window.partitionBy("number", "_bucket").orderBy("_ratio", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.filter("_ratio IS NOT NULL").join(shifts, ["number", "_bucket"]).withColumn("_before", F.col("_shift") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    ranked = ranked.drop("_shift").unionByName(certain)
    more = F.col("_ratio").isNotNull() & (2 * F.col("_before") + F.col("size") <= 2 * F.col("rest"))
    copies = F.col("sure") + F.when(more, 1).otherwise(0)
    return ranked.select("doc_id", "source", "size", "source_size", "target", copies.cast("long").alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, share: float = 1.0) -> DataFrame:
    """The rows of ``docs``, each as often as the plan takes it, with all their columns, whatever the names.

    A document without words is left out where its source has no whole copies. Rows with the same id get the copies
    planned for that id together, the extra ones for the rows that come first by text; only such rows are shuffled with
    their texts if the plan may be sent to every task. An empty table gives no rows.
    """
    wanted = plan(docs, weights, most, share).groupBy(F.coalesce("doc_id", F.lit(-1)).alias("id"), F.col("doc_id").isNull().alias("none")).agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    wanted = materialise(wanted.filter("copies > 0"), "wanted")
    marked = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("id"), F.col("doc_id").isNull().alias("none"))
    joined = marked.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted, ["id", "none"])
    rows = joined.filter("rows = 1").select("row", F.col("copies").alias("n"))
    if not wanted.filter("rows > 1").isEmpty():
        place = F.row_number().over(Window.partitionBy("id", "none").orderBy("row.text"))
        again = joined.filter("rows > 1").withColumn("place", place)
        share_of = F.floor(F.col("copies") / F.col("rows")) + F.when(F.col("place") <= F.col("copies") % F.col("rows"), 1).otherwise(0)
        rows = rows.unionByName(again.select("row", share_of.cast("long").alias("n")))
    return rows.filter("n > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("row.*")
