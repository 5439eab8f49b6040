"""Language identification by rank order: a text's most frequent n-grams against one profile per language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm import textpack as tp
from ratingloom.llm.common import text_frame

PROFILE = 300  # n-grams of a profile
SAMPLE = 500  # labelled documents per language that a profile is fitted on
BUCKETS = 256  # parts that the labelled rows of a language are ranked in
BROADCAST_LANGUAGES = 256  # up to which the list of sampled documents is sent to all tasks
PIECE = 1 << 20  # characters counted at once
UNDETERMINED = "und"
MIN_SCORE = 0.2  # texts of any profile's language score about twice this or more


@dataclass(frozen=True)
class Profiles:
    """n-grams of all profiles in code order, and their place in each language's profile (-1: not in it)."""

    languages: list[str]
    grams: np.ndarray
    places: np.ndarray
    size: int


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def count_grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the 1- to 3-grams of the lower-cased words of letters, each between two marks.

    The mark stands only at the ends of an n-gram. A character takes 21 bits; the mark is 0.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for lo in range(0, len(text), PIECE):
        # one character before and one behind, for the n-grams at the edges
        piece = text[max(0, lo - 1) : lo + PIECE + 1].lower()
        codes = np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        codes[~_letters()[codes]] = 0
        if lo == 0:
            codes = np.concatenate([[0], codes])
        if lo + PIECE >= len(text):
            codes = np.concatenate([codes, [0, 0]])
        a, b, c = codes[:-2], codes[1:-1], codes[2:]
        grams = np.sort(np.concatenate([b[b > 0], ((a << 21) | b)[(a > 0) | (b > 0)], ((a << 42) | (b << 21) | c)[(b > 0)]]))
        if len(grams):
            first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            found.append((grams[first], np.diff(np.append(first, len(grams)))))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(found) == 1:
        return found[0]
    grams, inverse = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
    return grams, np.bincount(inverse, np.concatenate([n for _, n in found])).astype(np.int64)


def fit(docs: DataFrame, size: int = PROFILE, sample: int = SAMPLE) -> Profiles:
    """Profiles from ``text`` and ``lang`` of ``docs``: per language the ``size`` most frequent n-grams.

    At most ``sample`` documents of a language are used, those with the smallest hash of their id, so a hot language
    costs no more than another. Rows without a language or text are left out, other columns are ignored, and a table
    without labelled rows gives no profile. Repeated rows count once each towards the sample. What comes back to the driver has
    ``size`` rows per language.
    """
    labelled = text_frame(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    # a language's sample is among the first ``sample`` rows of its buckets, so no task ranks all rows of a hot language
    keyed = labelled.select("doc_id", "lang", F.xxhash64("doc_id").alias("_hash")).withColumn("_bucket", F.pmod("_hash", F.lit(BUCKETS)))
    for group in (["lang", "_bucket"], ["lang"]):
        order = Window.partitionBy(*group).orderBy("_hash", "doc_id")
        keyed = keyed.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= sample)
    chosen = keyed.select("doc_id", "lang").distinct()
    few = labelled.select("lang").distinct().limit(BROADCAST_LANGUAGES + 1).count() <= BROADCAST_LANGUAGES
    texts = labelled.join(F.broadcast(chosen) if few else chosen, ["doc_id", "lang"], "left_semi")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = tp.arrow_schema("lang string, gram long, n long")
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                grams, n = count_grams(text)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n, pa.int64())], schema=schema)

    counts = texts.select("lang", "text").mapInArrow(tally, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = counts.withColumn("place", place).filter(F.col("place") <= size).select("lang", "gram", "place").collect()
    languages = sorted({r.lang for r in rows})
    grams = np.array(sorted({r.gram for r in rows}), np.int64)
    places = np.full((len(grams), len(languages)), -1, np.int64)
    for r in rows:
        places[np.searchsorted(grams, r.gram), languages.index(r.lang)] = r.place - 1
    return Profiles(languages, grams, places, size)


def nearest(text: str | None, p: Profiles) -> tuple[str, float]:
    """Language with the smallest out-of-place distance (ties: the first by code point), and 1 less its share of the largest distance."""
    grams, n = count_grams(text or "")
    if not len(grams) or not p.languages:
        return UNDETERMINED, 0.0
    top = grams[np.argsort(-n, kind="stable")[: p.size]]
    at = np.minimum(np.searchsorted(p.grams, top), len(p.grams) - 1)
    places = np.where((p.grams[at] == top)[:, None], p.places[at], -1)
    moved = np.abs(places - np.arange(len(top))[:, None])
    distance = np.where(places < 0, p.size, moved).sum(axis=0)
    best = int(distance.argmin())
    return p.languages[best], 1.0 - float(distance[best]) / (p.size * len(top))


def predict(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every whole text.

    A null text, or one without a letter, is ``und`` with score 0, as is every text if no profile could be fitted.
    Rows are taken one by one: repeated rows and null ids come back, other columns are ignored. The profiles have a
    fixed size per language; no row is shuffled.
    """
    schema = "doc_id long, lang_pred string, score double"

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [nearest(text, profiles) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], schema=tp.arrow_schema(schema)
            )

    return text_frame(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(label, schema)


def accepted(docs: DataFrame, profiles: Profiles, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language can be told: not ``und`` and with at least ``min_score``.

    All columns come back, whatever their names; rows are taken one by one, and an empty table stays empty.
    """

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [nearest(text, profiles) for text in batch.column("text").to_pylist()]
            yield batch.filter(pa.array([lang != UNDETERMINED and score >= min_score for lang, score in found], pa.bool_()))

    return text_frame(docs).mapInArrow(choose, docs.schema)


def held_out(doc_id="doc_id"):
    """True for the quarter of the ids that profiles never learn from; a null id is not held out."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2
