"""Benchmark decontamination with an FM-index per shard of training text.

A shard is a run of documents held by one task. Its words become symbols, its suffixes are sorted, and the
Burrows-Wheeler transform goes into a wavelet tree. All test phrases are searched backwards at once by rank, their
occurrences located through sampled suffix positions, and the spans merged per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm import textpack as tp
from ratingloom.llm.common import text_frame

WINDOW = 10
SAMPLE_EVERY = 8  # text positions between two sampled suffixes
SHARD_BYTES = 4 << 20  # of text in one index; one longer text is a shard of its own
BLOCK_BYTES = 32 << 20  # of benchmark text searched in one pass over the documents


class WaveletTree:
    """Ranks over a sequence of symbols: one bit level per binary digit, the highest first, stably split by it."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits = bits
        self.levels: list[tuple[np.ndarray, int]] = []
        now = symbols
        for level in range(bits - 1, -1, -1):
            digit = (now >> level) & 1
            ones = np.concatenate([[0], np.cumsum(digit)]).astype(np.int32)
            self.levels.append((ones, len(now) - int(ones[-1])))
            now = np.concatenate([now[digit == 0], now[digit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position; both arrays, answered together."""
        lo, hi = np.zeros_like(at), at
        for i, (ones, zeros) in enumerate(self.levels):
            bit = (symbol >> (self.bits - 1 - i)) & 1
            lo_ones, hi_ones = ones[lo], ones[hi]
            lo = np.where(bit, zeros + lo_ones, lo - lo_ones)
            hi = np.where(bit, zeros + hi_ones, hi - hi_ones)
        return hi - lo


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Order of all suffixes; by doubling, until no two suffixes tie."""
    n = len(codes)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        behind = np.zeros(n, np.int64)
        behind[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1 or step >= n:
            return order
        step *= 2


class FMIndex:
    """Index of a text given as runs of symbols 1..size; a pattern is found only inside a run."""

    def __init__(self, symbols: np.ndarray, run_starts: np.ndarray, size: int):
        # Before each run stands an end mark of its own, smaller than every symbol, so suffixes differ inside their run.
        runs = len(run_starts)
        text = np.zeros(len(symbols) + runs + 1, np.int64)
        at_text = np.arange(len(symbols)) + np.searchsorted(run_starts, np.arange(len(symbols)), "right")
        text[at_text] = symbols
        marks = np.flatnonzero(text == 0)
        distinct = text + len(marks)
        distinct[marks] = np.arange(len(marks))
        self.order = suffix_array(distinct)
        last = text[self.order - 1]  # position 0 is a mark and wraps to the mark at the end
        self.wavelet = WaveletTree(last, max(1, int(size).bit_length()))
        self.last = last
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size + 1))])
        # Every SAMPLE_EVERY-th position, and the first of each run, so that no step back meets a mark.
        sampled = self.order % SAMPLE_EVERY == 0
        start = np.zeros(len(text), bool)
        start[np.minimum(marks + 1, len(text) - 1)] = True
        self.sampled = sampled | start[self.order]
        self.place = np.cumsum(self.sampled) - 1
        self.positions = self.order[self.sampled]
        self.to_symbol = np.zeros(len(text), np.int64)
        self.to_symbol[at_text] = np.arange(len(symbols))
        del self.order

    def find(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of equally long patterns, one per row, searched from their last symbol."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), len(self.last), np.int64)
        live = np.arange(len(patterns))
        for j in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[live, j]
            both = self.wavelet.rank(np.tile(symbol, 2), np.concatenate([lo[live], hi[live]]))
            lo[live] = self.first[symbol] + both[: len(live)]
            hi[live] = self.first[symbol] + both[len(live) :]
            gone = hi[live] <= lo[live]
            lo[live[gone]] = hi[live[gone]] = 0
            live = live[~gone]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the symbols of the suffixes at ``rows``: step back until one is sampled."""
        out, at, steps = np.zeros(len(rows), np.int64), rows.copy(), 0
        live = np.arange(len(rows))
        while len(live):
            now = at[live]
            known = self.sampled[now]
            out[live[known]] = self.positions[self.place[now[known]]] + steps
            live, now = live[~known], now[~known]
            symbol = self.last[now]
            at[live] = self.first[symbol] + self.wavelet.rank(symbol, now)
            steps += 1
        return self.to_symbol[out]


@dataclass(frozen=True)
class Phrases:
    """Distinct test phrases: word hashes of the vocabulary in order; per length, phrases as symbols, and their items."""

    vocabulary: np.ndarray
    by_length: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # phrases; items of phrase i are items[bounds[i]:bounds[i + 1]]
    items: list[str]
    shortest: int


def phrases_of(texts: list[str | None], names: list[str], window: int = WINDOW) -> Phrases | None:
    """Every window of ``window`` words of the texts, or all words of a shorter one."""
    found: dict[int, dict[bytes, set[int]]] = {}
    column = pa.array(texts, pa.string())
    data, offsets = tp.buffers(column)
    w = tp.words(tp.LOWER[data], offsets, tp.NOT_ALNUM)
    hashes = tp.word_hashes(w)
    vocabulary, symbols = np.unique(hashes, return_inverse=True)
    symbols = symbols.astype(np.int64) + 1
    for item, (a, b) in enumerate(zip(w.bounds[:-1], w.bounds[1:], strict=True)):
        size = min(window, b - a)
        if size:
            for i in range(a, b - size + 1):
                found.setdefault(int(size), {}).setdefault(symbols[i : i + size].tobytes(), set()).add(item)
    if not found:
        return None
    by_length = []
    for size, rows in sorted(found.items()):
        table = np.frombuffer(b"".join(rows), np.int64).reshape(-1, size)
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in rows.values()])])
        by_length.append((table, bounds, np.array([i for x in rows.values() for i in sorted(x)], np.int64)))
    return Phrases(vocabulary, by_length, names, min(found))


def _hits(w: tp.Words, hashes: np.ndarray, p: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, length, item) of every occurrence in the shard's texts.

    Only runs of words of the benchmark's vocabulary inside one text, at least as long as the shortest phrase, can
    hold a phrase; the index is built over these.
    """
    none = np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(p.vocabulary, hashes), len(p.vocabulary) - 1)
    known = p.vocabulary[at] == hashes
    edge = np.zeros(len(hashes) + 1, bool)
    edge[w.bounds] = True
    begins = np.flatnonzero(known & (~np.concatenate([[False], known[:-1]]) | edge[:-1]))
    ends = np.flatnonzero(known & (~np.concatenate([known[1:], [False]]) | edge[1:])) + 1
    enough = ends - begins >= p.shortest
    begins, ends = begins[enough], ends[enough]
    if not len(begins):
        return none, none, none
    sizes = ends - begins
    run_starts = np.cumsum(sizes) - sizes
    words = np.arange(int(sizes.sum())) + np.repeat(begins - run_starts, sizes)
    index = FMIndex(at[words].astype(np.int64) + 1, run_starts, len(p.vocabulary))
    out = []
    for table, bounds, items in p.by_length:
        lo, hi = index.find(table)
        n = hi - lo
        which = np.repeat(np.arange(len(table)), n)
        rows = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + lo[which]
        first = words[index.locate(rows)]
        per = np.diff(bounds)[which]
        item = items[np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per) + np.repeat(bounds[which], per)]
        out.append((np.repeat(first, per), np.full(int(per.sum()), table.shape[1]), item))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


SPANS = "doc_id long, text string, n_words long, spans array<int>, items array<int>"


def _search(docs: DataFrame, phrases: Phrases | None, keep_text: bool) -> DataFrame:
    """Per document: words, merged hit spans as word ranges (first, end, first, end, ...) and numbers of the items found."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in tp.slices(batch.column(1), SHARD_BYTES):
                w = tp.words(tp.LOWER[data], offsets, tp.NOT_ALNUM)
                rows = hi - lo
                spans, span_bounds = np.zeros(0, np.int64), np.zeros(rows + 1, np.int64)
                items, item_bounds = spans, span_bounds
                if phrases is not None and len(w.starts):
                    first, size, item = _hits(w, tp.word_hashes(w), phrases)
                    if len(first):
                        spans, span_bounds = _merged(w, first, size)
                        doc = np.searchsorted(w.bounds, first, "right") - 1
                        pairs = np.unique(doc * len(phrases.items) + item)
                        items = pairs % len(phrases.items)
                        item_bounds = np.searchsorted(pairs // len(phrases.items), np.arange(rows + 1))
                text = batch.column(1).slice(lo, rows) if keep_text else pa.nulls(rows, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, rows), text.cast(pa.string()), pa.array(w.counts, pa.int64()), tp.lists_of(spans, span_bounds, pa.int32()), tp.lists_of(items, item_bounds, pa.int32())],
                    schema=tp.arrow_schema(SPANS),
                )

    return text_frame(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(work, SPANS)


def _merged(w: tp.Words, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.zeros(len(w.starts) + 1, np.int64)
    np.add.at(edges, first, 1)
    np.add.at(edges, first + size, -1)
    inside = np.concatenate([[False], np.cumsum(edges)[:-1] > 0])
    new_text = np.zeros(len(inside), bool)
    new_text[w.bounds[:-1][np.diff(w.bounds) > 0] + 1] = True
    begins = np.flatnonzero(inside & (~np.concatenate([[False], inside[:-1]]) | new_text)) - 1
    ends = np.flatnonzero(inside & (~np.concatenate([inside[1:], [False]]) | np.concatenate([new_text[1:], [True]])))
    doc = np.searchsorted(w.bounds, begins, "right") - 1
    spans = np.stack([begins - w.bounds[doc], ends - w.bounds[doc]], axis=1).reshape(-1)
    return spans, 2 * np.searchsorted(doc, np.arange(len(w.bounds)))


def benchmark_phrases(benchmark: DataFrame, window: int = WINDOW) -> Phrases | None:
    """The phrases of a benchmark table, None without any word. The table must fit BLOCK_BYTES; split a larger one by rows."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > BLOCK_BYTES:
        raise ValueError(f"{size} bytes of benchmark text; at most {BLOCK_BYTES} are searched in one pass")
    found = rows.orderBy("item_id", "text").collect()
    # rows of one id are one item
    names = sorted({r.item_id or "" for r in found})
    phrases = phrases_of([r.text for r in found], [r.item_id or "" for r in found], window)
    if phrases is None or len(names) == len(found):
        return phrases
    number = np.array([names.index(x) for x in phrases.items], np.int64)
    by_length = []
    for table, bounds, items in phrases.by_length:
        sets = [np.unique(number[items[a:b]]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        by_length.append((table, np.concatenate([[0], np.cumsum([len(x) for x in sets])]), np.concatenate(sets)))
    return Phrases(phrases.vocabulary, by_length, names, phrases.shortest)


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every whole text.

    Words are runs of a-z, 0-9 and non-ASCII characters after A-Z are lower-cased. A test phrase is ``window``
    consecutive words of a benchmark item, or all words of a shorter one; a word inside any occurrence is hit. Words
    are compared by a 64-bit hash. ``items_sha256`` is of the ids of the items found, sorted as strings, joined by
    commas. Null or empty texts and items have no words; rows with the same item id are one item, a null id counts as
    an empty string; repeated documents and null ids come back as they are; other columns are ignored.

    One pass over the documents, nothing is shuffled; the phrases go to every task and are bounded by BLOCK_BYTES.
    """
    phrases = benchmark_phrases(benchmark, window)
    names = phrases.items if phrases is not None else []
    found = _search(docs, phrases, keep_text=False)
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column(4).to_pylist()
            spans = [np.array(x, np.int64) for x in batch.column(3).to_pylist()]
            hit = [int((x[1::2] - x[::2]).sum()) for x in spans]
            told = [hashlib.sha256(",".join(sorted(names[i] for i in x)).encode()).hexdigest() for x in items]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(told, pa.string()), pa.array([n > 0 for n in hit], pa.bool_())],
                schema=tp.arrow_schema(schema),
            )

    return found.mapInArrow(digest, schema)


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with every hit span cut out of the text, from its first to its last word.

    What stands between the words goes with them; texts without a hit, and null texts, stay as they are. A text that
    is nothing but hits becomes empty. All columns of ``docs`` come back.
    """
    phrases = benchmark_phrases(benchmark, window)
    columns = docs.columns
    schema = docs.schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for lo, hi, data, offsets in tp.slices(batch.column(at), SHARD_BYTES):
                part = batch.slice(lo, hi - lo)
                w = tp.words(tp.LOWER[data], offsets, tp.NOT_ALNUM)
                if phrases is not None and len(w.starts):
                    first, size, _ = _hits(w, tp.word_hashes(w), phrases)
                    if len(first):
                        part = _cut(part, at, w, data, offsets, *_merged(w, first, size))
                yield part

    return text_frame(docs).mapInArrow(work, schema).select(*columns)


def _cut(part: pa.RecordBatch, at: int, w: tp.Words, data: np.ndarray, offsets: np.ndarray, spans: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    texts = part.column(at).to_pylist()
    for d in np.flatnonzero(np.diff(bounds)):
        mine = spans[bounds[d] : bounds[d + 1]].reshape(-1, 2) + w.bounds[d]
        kept, done = [], offsets[d]
        for a, b in mine:
            kept.append(data[done : w.starts[a]].tobytes())
            done = w.ends[b - 1]
        kept.append(data[done : offsets[d + 1]].tobytes())
        texts[d] = b"".join(kept).decode("utf-8", "replace")
    columns = [pa.array(texts, part.schema.field(at).type) if i == at else c for i, c in enumerate(part.columns)]
    return pa.RecordBatch.from_arrays(columns, schema=part.schema)
