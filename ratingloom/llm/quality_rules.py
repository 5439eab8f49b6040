"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one integer whose bit i is set when
rule i failed. Policies are versioned masks over these bits, so that a new policy, or the effect of leaving a rule
out, needs the ledger only and never the texts again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm import textpack as tp
from ratingloom.llm.common import text_frame

REPEAT_WORDS = 8
#: The characters counted as symbols.
SYMBOLS = "#*$%&|<>"

MEASURES = "doc_id long, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


@dataclass(frozen=True)
class Rule:
    """A test that is true where a document fails; written on whole numbers, so that every engine agrees."""

    name: str
    fails: str


#: The position of a rule is its bit; append new ones, never reorder.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "100 * n_symbols > 30 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
)
#: Policy version -> names of the rules that drop a document.
POLICIES = {
    1: ("few_words", "repeated_windows"),
    2: tuple(r.name for r in RULES),
}
BASE_POLICY, CURRENT_POLICY = 1, 2


def mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    places = {r.name: i for i, r in enumerate(rules)}
    return sum(1 << places[n] for n in names)


def _repeat_words(hashes: np.ndarray, bounds: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """Per text, its words inside windows of ``size`` words that it holds twice or more."""
    at = tp.window_starts(bounds, size)
    if not len(at):
        return np.zeros(len(bounds) - 1, np.int64)
    keys = tp.mixed(tp.window_hashes(hashes, size)[at] + tp.mixed(doc[at].astype(np.uint64)))
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    found = at[np.isin(keys, twice)] if len(twice) else at[:0]
    edges = np.zeros(int(bounds[-1]) + 1, np.int64)
    np.add.at(edges, found, 1)
    np.add.at(edges, found + size, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edges)[:-1] > 0)])
    return covered[bounds[1:]] - covered[bounds[:-1]]


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text, its lines that have a word, and those of them equal to an earlier line."""
    only_newline = np.zeros(256, bool)
    only_newline[0x0A] = True
    lines = tp.words(data, offsets, only_newline)
    solid = np.concatenate([[0], np.cumsum(~tp.SPACES[data])])
    with_word = solid[lines.ends] > solid[lines.starts]
    doc = lines.doc_of_word()[with_word]
    n = np.bincount(doc, minlength=len(offsets) - 1)
    keys = tp.mixed(tp.word_hashes(lines)[with_word] + tp.mixed(doc.astype(np.uint64)))
    _, first = np.unique(keys, return_index=True)
    return n, n - np.bincount(doc[first], minlength=len(offsets) - 1)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    symbols = np.zeros(256, bool)
    symbols[list(SYMBOLS.encode())] = True
    for batch in batches:
        for lo, hi, data, offsets in tp.slices(batch.column(1)):
            w = tp.words(data, offsets, tp.SPACES)

            def per_text(flags: np.ndarray, offsets=offsets) -> np.ndarray:
                total = np.concatenate([[0], np.cumsum(flags)])
                return total[offsets[1:]] - total[offsets[:-1]]

            n_lines, n_dup = _lines(data, offsets)
            columns = [
                w.counts,
                per_text(~tp.SPACES[data] & ((data & 0xC0) != 0x80)),
                per_text(symbols[data]),
                n_lines,
                n_dup,
                _repeat_words(tp.word_hashes(w), w.bounds, w.doc_of_word(), REPEAT_WORDS),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo).cast(pa.int64()), *[pa.array(c, pa.int64()) for c in columns]], schema=tp.arrow_schema(MEASURES)
            )


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: the measurements and ``failed``, bit i set where rule i fails.

    Words are `[^\\x20\\x09-\\x0D]+`. A null or empty text has no words and fails ``few_words``. Rows are taken one by
    one, so repeated rows and null ids simply come back; other columns of ``docs`` are ignored. One pass, no shuffle.
    """
    if len(rules) > 62:
        raise ValueError("the ledger has 62 bits")
    measured = text_frame(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_measure, MEASURES)
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, r in enumerate(rules)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failed", failed)


def failed_under(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> Column:
    """True where the ledger row fails one of the named rules."""
    return F.col("failed").bitwiseAND(F.lit(mask(names, rules)).cast("long")) != 0


def apply_policy(rows: DataFrame, version: int = CURRENT_POLICY, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows with ``kept`` under one policy version."""
    return rows.withColumn("kept", ~failed_under(POLICIES[version], rules))


def ablations(rows: DataFrame, version: int = CURRENT_POLICY, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of a policy: documents that fail it, and those that would be kept if this rule alone were left out.

    Rows with equal bits are counted together first, which leaves at most 2**rules of them; the policy is applied to
    these by bitwise operations. An empty ledger gives zeros.
    """
    names = POLICIES[version]
    whole = mask(names, rules)
    counts = rows.groupBy(F.col("failed").bitwiseAND(F.lit(whole).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    sums = []
    for name in names:
        bit = mask((name,), rules)
        sums.append(F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(F.lit(bit).cast("long")) != 0, F.col("n"))), F.lit(0)).alias(f"f_{name}"))
        sums.append(F.coalesce(F.sum(F.when(F.col("bits") == bit, F.col("n"))), F.lit(0)).alias(f"o_{name}"))
    total = counts.agg(*sums)
    rows_of = [F.struct(F.lit(n).alias("rule"), F.col(f"f_{n}").alias("failing"), F.col(f"o_{n}").alias("only_this")) for n in names]
    return total.select(F.explode(F.array(*rows_of)).alias("r")).select("r.*")


def failing_in_any(rows: DataFrame, by: str) -> DataFrame:
    """Per group, the rules that some (``any_bits``) and all (``all_bits``) of its documents fail."""
    return rows.groupBy(by).agg(F.bit_or("failed").alias("any_bits"), F.bit_and("failed").alias("all_bits"))
