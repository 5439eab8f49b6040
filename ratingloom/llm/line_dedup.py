"""Line dedup over levelled sorted runs of line hashes.

Batches of documents are taken from the largest ids down. A run is a table of line hashes sorted by hash, each with the
document that holds it, the largest id that has it. A new batch is merge-anti-joined against the runs: lines that no run
has get their holder from the batch and make its own run, all others stay with the holder they have. So no line is in
two runs. When a level has ``FANOUT`` runs they are compacted into one of the next level. An occurrence away from its
line's holder is a repeat. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.session import materialise, scratch_path

FANOUT = 2
LEAST_BATCHES = 4
BATCH_LINES = 1 << 30  # of a batch, about
MIN_CHARS = 20
MIN_DOCS = 3
#: Fixed value: the characters stripped from both ends, `[\x20\x09-\x0D]`.
BLANKS = " \t\n\x0b\x0c\r"
_NULL_ID = -(1 << 63)


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _hash(key: Column) -> Column:
    return F.xxhash64(key)


class LineRuns:
    """Levels of sorted runs (line, holder); a line is in one run only."""

    schema = "line long, holder long"

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[str]] = []

    def table(self) -> DataFrame:
        """All lines with their holders, as the runs have them."""
        paths = [p for level in self.levels for p in level]
        return self._read(paths) if paths else self.spark.createDataFrame([], self.schema)

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*paths)

    def add(self, lines: DataFrame) -> None:
        """Take in a batch: ``lines`` has one row per line hash and document."""
        found = lines.groupBy("line").agg(F.max("doc").alias("holder"))
        new = found.join(self.table().select("line").hint("merge"), "line", "left_anti") if self.levels else found
        self._put(0, new)

    def _put(self, level: int, rows: DataFrame) -> None:
        path = scratch_path(self.spark, f"lines-{level}")
        rows.repartition("line").sortWithinPartitions("line").write.option("compression", "zstd").parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            compacted = self._read(self.levels[level])
            self.levels[level] = []
            self._put(level + 1, compacted)

    def repeats(self, lines: DataFrame, min_docs: int) -> DataFrame:
        """(line, doc) of ``lines`` away from the line's holder, for lines in ``min_docs`` documents or more."""
        away = lines.join(self.table().hint("merge"), "line").filter("doc <> holder").select("line", "doc")
        if min_docs <= 2:
            return away
        away = materialise(away, "repeats")
        often = away.groupBy("line").agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_docs - 1).select("line")
        return away.join(often, "line", "left_semi")


def long_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(line, doc): the distinct hashes of the long lines of each document."""
    lines = F.transform(F.split(F.col("text").cast("string"), "\n"), line_key)
    hashes = F.array_distinct(F.transform(F.filter(lines, lambda x: F.char_length(x) >= min_chars), _hash))
    return docs.filter("text IS NOT NULL").select(_doc().alias("doc"), F.explode(hashes).alias("line")).distinct()


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int | None = None) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept (the lines left, joined by a line feed) of every document.

    A line of at least ``min_chars`` code points (blanks at the ends and the case of A-Z ignored) that stands in at
    least ``min_docs`` documents is dropped everywhere but in the document with the largest id. Lines are compared by
    a 64-bit hash. A null or empty text is one empty line. Rows of the same id count as one document, and so do rows
    with a null id, which is the smallest; each row is returned. Other columns are ignored.

    ``batches`` follows the number of lines. Only line hashes are shuffled, and the texts once for the result. A line in
    a third of all documents is counted by partial sums; its rows meet the runs in a join that Spark splits where it is
    skewed.
    """
    spark = docs.sparkSession
    lines = materialise(long_lines(docs, min_chars), "lines")
    batches = batches or max(LEAST_BATCHES, -(-lines.count() // BATCH_LINES))
    edges = sorted(set(lines.approxQuantile("doc", [i / batches for i in range(1, batches)], 0.01))) if batches > 1 else []
    runs = LineRuns(spark)
    upper: float | None = None
    for lower in [*reversed(edges), None]:
        batch = lines
        if upper is not None:
            batch = batch.filter(F.col("doc") <= int(upper))
        if lower is not None:
            batch = batch.filter(F.col("doc") > int(lower))
        runs.add(batch)
        upper = lower
    dropped = runs.repeats(lines, min_docs).groupBy("doc").agg(F.collect_set("line").alias("_drop"))

    split = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _doc().alias("doc"), F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n").alias("_lines"))

    def stays(line: Column) -> Column:
        key = line_key(line)
        return ~((F.char_length(key) >= min_chars) & F.array_contains(F.col("_drop"), _hash(key)))

    rows = split.join(dropped, "doc", "left")
    kept = F.when(F.col("_drop").isNull(), F.col("_lines")).otherwise(F.filter("_lines", stays))
    rows = rows.select("doc_id", F.size("_lines").cast("long").alias("n_lines"), kept.alias("_kept"))
    return rows.select("doc_id", "n_lines", (F.col("n_lines") - F.size("_kept")).cast("long").alias("n_dropped"), F.array_join("_kept", "\n").alias("kept"))
