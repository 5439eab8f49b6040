"""Documents to token ids: language ID, near-duplicate removal, benchmark decontamination, mixing, token files.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again for the
next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm import decontamination, jaccard_join, language_id, mixing, token_files
from ratingloom.session import materialise, scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can't be told; profiles learn from the labelled documents that aren't held out."""
    return language_id.accepted(docs, language_id.fit(docs.filter(~language_id.held_out())))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group."""
    return jaccard_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut benchmark passages out of the texts; ``n_chars`` follows the text."""
    clean = decontamination.remove_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return clean.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources meet their target weights."""
    return mixing.mix(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token ids; returns what the files hold: doc_id, start, n_tokens, ids_crc32."""
    path = scratch_path(spark, "token-ids")
    token_files.write(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.digest(spark, path)


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]

#: SQL can't express the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
