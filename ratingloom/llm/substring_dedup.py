"""Substring dedup with repeated-phrase automata.

A window of WINDOW words is removed where the same words also start earlier. Three steps find all such windows:

1. Anchors. Of the short word runs in a window the one with the smallest hash is its anchor, so equal windows have
   equal anchors, and a document has about one anchor for seven windows. Anchors that occur twice or more are kept,
   each with its owner, the first document that has it.
2. Automata. Regions of text around kept anchors go to the shard of their owner. Its own phrases, confirmed as
   recurring candidates by their anchors, are compiled into an Aho-Corasick automaton, and all regions of the shard
   are streamed through it to locate every occurrence. Windows of others that stay are compared among themselves.
3. Removal. The located spans are merged per document and the other words kept.

An owner whose anchors are very frequent has its regions spread over many automata, each with the owner's phrases.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm import textpack as tp
from ratingloom.llm.common import BROADCAST_IDS, text_frame
from ratingloom.session import materialise

WINDOW = 20
ANCHOR = 6  # words of an anchor
SAMPLE = 2_000  # documents, about, in which very frequent anchors are looked for
FREQUENT, MOST_FREQUENT = 0.002, 1_000  # share of the sample's anchors from which one is spread; number of these
SPREAD = 64  # parts of a frequent anchor's rows
HOT_HITS = 10_000  # anchors that point to one owner, from which its regions are spread
CHUNK_WORDS = 200_000  # of regions whose owners share an automaton
PHRASES = 200_000  # of an automaton
ONE_CHARACTER = 30_000  # words of a vocabulary, up to which a word is one character
_NULL_ID = -(1 << 63)


def _texts(docs: DataFrame) -> DataFrame:
    """doc, doc_id, text; rows with a null id have a ``doc`` of their own, by their text, below all usual ids."""
    unnamed = F.lit(_NULL_ID) + F.coalesce(F.xxhash64(F.col("text").cast("string")), F.lit(0)).bitwiseAND(F.lit((1 << 61) - 1))
    return text_frame(docs).select(F.coalesce(F.col("doc_id").cast("long"), unnamed).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def anchors(docs: DataFrame, window: int = WINDOW, size: int = ANCHOR, frequent: Sequence[int] = ()) -> DataFrame:
    """(anchor, part, doc, lo, n): the windows lo to lo + n - 1 of the document have this anchor.

    ``part`` is 0, but for ``frequent`` anchors, whose documents are dealt over the parts 1 to SPREAD.
    """
    schema = "anchor long, part int, doc long, lo int, n int"
    often = np.sort(np.array(frequent, np.int64))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for row, _, data, offsets in tp.slices(batch.column(1)):
                w = tp.words(data, offsets, tp.SPACES)
                starts = tp.window_starts(w.bounds, window)
                if not len(starts):
                    continue
                grams = tp.window_hashes(tp.word_hashes(w), size)
                best = np.empty(len(starts), np.int64)
                views = np.lib.stride_tricks.sliding_window_view(grams, window - size + 1)
                for i in range(0, len(starts), 1 << 16):
                    best[i : i + (1 << 16)] = views[starts[i : i + (1 << 16)]].argmin(axis=1)
                best += starts
                first = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
                doc = np.searchsorted(w.bounds, starts[first], "right") - 1
                n = np.diff(np.append(first, len(starts)))
                anchor, part = tp.signed(grams[best[first]]), np.zeros(len(first), np.int32)
                if len(often):
                    hot = often[np.minimum(np.searchsorted(often, anchor), len(often) - 1)] == anchor
                    part[hot] = 1 + tp.mixed(ids[row + doc[hot]].view(np.uint64)) % np.uint64(SPREAD)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(part), pa.array(ids[row + doc]), pa.array(starts[first] - w.bounds[doc], pa.int32()), pa.array(n, pa.int32())], schema=tp.arrow_schema(schema)
                )

    return _texts(docs).select("doc", "text").filter("text IS NOT NULL").mapInArrow(work, schema)


def frequent_anchors(docs: DataFrame, window: int = WINDOW) -> list[int]:
    """Anchors that make up much of a sample of about SAMPLE documents, MOST_FREQUENT at most.

    They are only dealt out differently; what is found does not depend on them.
    """
    share = min(1.0, SAMPLE / max(1, docs.count()))
    rows = anchors(docs.sample(share, seed=7), window).groupBy("anchor").agg(F.count("*").alias("m"))
    total = rows.agg(F.sum("m")).first()[0] or 0
    top = rows.filter(F.col("m") >= max(50, FREQUENT * total)).orderBy(F.desc("m"), "anchor").limit(MOST_FREQUENT)
    return [r.anchor for r in top.collect()]


HITS = "owner long, doc long, lo int, n int, anchor long"


def recurring(rows: DataFrame) -> DataFrame:
    """(owner, doc, lo, n) for the anchors that occur more than once.

    The rows are streamed in anchor order, one is held. A part of a frequent anchor tells the first document it has;
    the first of these owns the anchor.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = tp.arrow_schema(HITS)
        held = np.zeros((0, 5), np.int64)  # the last row, if it is the only one of its group so far
        tail: tuple[int, int, int] | None = None  # anchor, part and first document of the last group
        for batch in batches:
            table = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(5)], axis=1)
            if not len(table):
                continue
            table = np.concatenate([held, table])
            start = np.flatnonzero(np.concatenate([[True], (table[1:, :2] != table[:-1, :2]).any(axis=1)]))
            n = np.diff(np.append(start, len(table)))
            owner = table[start, 2].copy()
            keep = (n > 1) | (table[start, 1] > 0)
            if not len(held) and tail is not None and tail[:2] == (table[0, 0], table[0, 1]):
                owner[0], keep[0] = tail[2], True
            held = table[-1:].copy() if not keep[-1] else table[:0]
            tail = (int(table[-1, 0]), int(table[-1, 1]), int(owner[-1]))
            rows = np.repeat(keep, n)
            if rows.any():
                found = table[rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(owner, n)[rows]), pa.array(np.ascontiguousarray(found[:, 2])), pa.array(found[:, 3], pa.int32()), pa.array(found[:, 4], pa.int32()),
                        pa.array(np.ascontiguousarray(found[:, 0]), pa.int64(), mask=found[:, 1] == 0),
                    ],
                    schema=schema,
                )

    found = materialise(rows.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "doc", "lo").mapInArrow(work, HITS), "hits")
    # at most MOST_FREQUENT rows
    owners = found.filter("anchor IS NOT NULL").groupBy("anchor").agg(F.min("owner").alias("first"), F.count("*").alias("m"))
    return found.join(F.broadcast(owners), "anchor", "left").filter("m IS NULL OR m > 1").select(F.coalesce("first", "owner").alias("owner"), "doc", "lo", "n")


REGIONS = "owner long, spread int, doc long, lo int, words string"


def regions(docs: DataFrame, hits: DataFrame, window: int = WINDOW) -> DataFrame:
    """(owner, spread, doc, lo, words): stretches of text around kept anchors, one for neighbouring anchors of an owner."""
    per_doc = hits.groupBy("doc").agg(F.collect_list(F.struct("owner", "spread", "lo", "n")).alias("hits"))
    joined = _texts(docs).select("doc", "text").join(per_doc, "doc").select("doc", "text", "hits")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = tp.arrow_schema(REGIONS)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for row, end, data, offsets in tp.slices(batch.column(1)):
                w = tp.words(data, offsets, tp.SPACES)
                lists = batch.column(2).slice(row, end - row)
                flat = lists.flatten()
                owner, spread, lo, n = (flat.field(i).to_numpy().astype(np.int64) for i in range(4))
                doc = np.repeat(np.arange(end - row), np.diff(lists.offsets.to_numpy()))
                order = np.lexsort((lo, owner, doc))
                owner, spread, lo, n, doc = owner[order], spread[order], lo[order], n[order], doc[order]
                to = lo + n + window - 1  # the word behind the last window
                # anchors of one owner in order have ends in order, so a gap is where the next begins behind the last
                new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (owner[1:] != owner[:-1]) | (lo[1:] > to[:-1])])
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(lo)) - 1
                a, b = w.bounds[doc[first]] + lo[first], w.bounds[doc[first]] + to[last]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner[first]), pa.array(spread[first], pa.int32()), pa.array(ids[row + doc[first]]), pa.array(lo[first], pa.int32()), tp.strings(data, w.starts[a], w.ends[b - 1]).cast(pa.string())],
                    schema=schema,
                )

    return joined.mapInArrow(work, REGIONS)


SPANS = "doc long, a int, b int, key long"


def _characters(codes: np.ndarray) -> str:
    """One character per code, past the surrogates."""
    codes = np.where(codes >= 0xD800, codes + 0x800, codes)
    return codes.astype("<u4").tobytes().decode("utf-32-le")


def _phrases_at(w: tp.Words, hashes: np.ndarray, phrases: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word numbers where a window equals one of the phrases, and the word number where that phrase first starts.

    ``phrases`` are word numbers in order of precedence, compiled into one automaton. A character stands for a word's
    number in the vocabulary, 0 for a word outside. As a trie node searches its children one by one, large vocabularies
    have two characters a word, from two alphabets, so that matches begin at words.
    """
    covered = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(covered, phrases, 1)
    np.add.at(covered, phrases + window, -1)
    vocabulary = np.unique(hashes[np.cumsum(covered[:-1]) > 0])
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    codes = np.where(vocabulary[at] == hashes, at + 1, 0)
    size = 1
    if len(vocabulary) > ONE_CHARACTER:
        size, base = 2, int(len(vocabulary) ** 0.5) + 2
        codes = np.column_stack([codes // base, base + codes % base]).ravel()
    text = _characters(codes)
    automaton = ahocorasick.Automaton()
    for j in phrases.tolist():
        phrase = text[j * size : (j + window) * size]
        if phrase not in automaton:
            automaton.add_word(phrase, j)
    automaton.make_automaton()
    for begin, end in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True):
        found = list(automaton.iter(text[begin * size : end * size]))
        if found:
            ends, first = zip(*found, strict=True)
            yield np.array(ends) // size + (begin - window + 1), np.array(first)


def _locate(owner: np.ndarray, spread: np.ndarray, doc: np.ndarray, lo: np.ndarray, words: pa.Array, window: int):
    """Spans to remove in regions of some owners, and the windows of spread owners that are still open."""
    data, offsets = tp.buffers(words)
    w = tp.words(data, offsets, tp.SPACES)
    hashes = tp.word_hashes(w)
    own = doc == owner
    row = w.doc_of_word()
    starts = tp.window_starts(w.bounds, window)
    d = doc[row[starts]]
    p = lo[row[starts]] + starts - w.bounds[row[starts]]

    # rank of a window by document and place; of equal phrases the first is the one to keep
    rank = np.empty(len(hashes) + 1, np.int64)
    rank[starts[np.lexsort((p, d))]] = np.arange(len(starts))
    phrases = starts[own[row[starts]]]
    phrases = phrases[np.argsort(rank[phrases])]
    first = np.full(len(hashes) + 1, -1, np.int64)
    for k in range(0, len(phrases), PHRASES):  # long regions have several automata, which bounds phrases and vocabulary
        for at, phrase in _phrases_at(w, hashes, phrases[k : k + PHRASES], window):
            known = first[at]
            first[at] = np.where((known < 0) | (rank[phrase] < rank[known]), phrase, known)
    first = first[starts]
    remove = np.zeros(len(starts), bool)
    located = np.flatnonzero(first >= 0)
    phrase_doc, phrase_lo = doc[row[first[located]]], lo[row[first[located]]] + first[located] - w.bounds[row[first[located]]]
    remove[located] = (phrase_doc < d[located]) | ((phrase_doc == d[located]) & (phrase_lo < p[located]))

    # Another owner's phrase may be a later occurrence than the first, so what stays is compared whether located or not.
    # A window in a region of the owner itself need not be: where its anchor is the owner's, all others were removed.
    rest = np.flatnonzero(~remove & ~own[row[starts]])
    keys = tp.signed(tp.window_hashes(hashes, window)[starts[rest]])
    far = spread[row[starts[rest]]] > 1
    here, here_keys = rest[~far], keys[~far]
    if len(here):
        order = np.lexsort((p[here], d[here], here_keys))
        here, here_keys = here[order], here_keys[order]
        begin = np.concatenate([[True], here_keys[1:] != here_keys[:-1]])
        first = here[np.maximum.accumulate(np.where(begin, np.arange(len(here)), 0))]
        remove[here] = (d[here] != d[first]) | (p[here] != p[first])

    gone = np.flatnonzero(remove)
    if len(gone):
        begins = np.concatenate([[True], (row[starts[gone[1:]]] != row[starts[gone[:-1]]]) | (starts[gone[1:]] > starts[gone[:-1]] + window)])
        first = np.flatnonzero(begins)
        last = np.append(first[1:], len(gone)) - 1
        spans = d[gone[first]], p[gone[first]], p[gone[last]] + window
    else:
        spans = d[:0], p[:0], p[:0]
    open_rows = rest[far]
    return spans, (d[open_rows], p[open_rows], keys[far])


def locate(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, a, b, key): words a to b - 1 go; or, with b = 0, a window at word a with this hash that is still open."""
    parts = F.when(F.col("doc") == F.col("owner"), F.sequence(F.lit(0), F.col("spread") - 1)).otherwise(F.array(F.pmod(F.xxhash64("doc"), F.col("spread")).cast("int")))
    dealt = rows.withColumn("part", F.explode(parts)).repartition("owner", "part").sortWithinPartitions("owner", "part", "doc", "lo")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = tp.arrow_schema(SPANS)
        waiting: list[pa.RecordBatch] = []

        def run(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            owner, spread, doc, lo = (table.column(i).to_numpy().astype(np.int64) for i in range(4))
            words = table.column(4).combine_chunks()
            words = words.chunk(0) if isinstance(words, pa.ChunkedArray) else words
            (d, a, b), (od, op, keys) = _locate(owner, spread, doc, lo, words, window)
            d, a, b, keys = np.concatenate([d, od]), np.concatenate([a, op]), np.concatenate([b, np.zeros(len(od), np.int64)]), np.concatenate([np.zeros(len(d), np.int64), keys])
            if len(d):
                yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(keys)], schema=schema)

        size = 0
        for batch in batches:
            owners = batch.column(0).to_numpy()
            groups = batch.column(5).to_numpy()
            change = np.flatnonzero((owners[1:] != owners[:-1]) | (groups[1:] != groups[:-1])) + 1
            if waiting and batch.num_rows:
                last = waiting[-1]
                if last.column(0)[-1].as_py() != int(owners[0]) or last.column(5)[-1].as_py() != int(groups[0]):
                    change = np.concatenate([[0], change])
            lengths = np.concatenate([[0], np.cumsum(np.diff(tp.buffers(batch.column(4))[1]))])
            done = 0
            for cut in change.tolist():
                # about six bytes a word
                if size + lengths[cut] - lengths[done] >= 6 * CHUNK_WORDS:
                    if cut > done:
                        waiting.append(batch.slice(done, cut - done))
                    yield from run(waiting)
                    waiting, size, done = [], 0, cut
            if done < batch.num_rows:
                waiting.append(batch.slice(done))
                size += int(lengths[-1] - lengths[done])
        if waiting:
            yield from run(waiting)

    return dealt.select("owner", "spread", "doc", "lo", "words", "part").mapInArrow(work, SPANS)


def spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, a, b): words a to b - 1 of the document stand in a window that also starts earlier; may overlap."""
    hits = recurring(anchors(docs, window, frequent=frequent_anchors(docs, window)))
    busy = materialise(hits.groupBy("owner").agg(F.count("*").alias("m")).filter(F.col("m") > HOT_HITS), "busy")
    spread = busy.select("owner", F.ceil(F.col("m") / HOT_HITS).cast("int").alias("spread"))
    spread = F.broadcast(spread) if busy.count() <= BROADCAST_IDS else spread
    hits = hits.join(spread, "owner", "left").withColumn("spread", F.coalesce("spread", F.lit(1)))
    found = materialise(locate(regions(docs, hits, window), window), "spans")
    pending = found.filter("b = 0")
    least = pending.groupBy("key").agg(F.min(F.struct("doc", "a")).alias("first"), F.count("*").alias("m")).filter("m > 1").select("key", "first")
    late = pending.join(least, "key").filter("doc <> first.doc OR a <> first.a").select("doc", "a", (F.col("a") + window).alias("b"))
    return found.filter("b > 0").select("doc", "a", "b").unionByName(late)


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by one space) of every document.

    Words are `[^\\x20\\x09-\\x0D]+`, unchanged. A word goes if it lies in a window of ``window`` words that also
    starts earlier: in a document with a smaller id, or earlier in the same one. Windows are judged on the input.
    A null or empty text has no words; texts shorter than a window keep all. Null ids are the smallest, in the
    order of a hash of their texts. Rows that repeat an id must repeat its text, null-id rows needn't; none of them is earlier than the other, and each comes back. An empty table
    gives no rows; other columns are ignored. Words and windows are told apart by 64-bit hashes.
    """
    gone = spans(docs, window).groupBy("doc").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    joined = _texts(docs).join(gone, "doc", "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_words long, n_removed long, kept string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in tp.slices(batch.column(1)):
                w = tp.words(data, offsets, tp.SPACES)
                part = batch.slice(row, end - row)
                lists = part.column(2)
                sizes = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], np.int64)
                flat = lists.flatten()
                at = np.repeat(w.bounds[:-1], sizes)
                edges = np.zeros(len(w.starts) + 1, np.int64)
                np.add.at(edges, at + flat.field(0).to_numpy(), 1)
                np.add.at(edges, at + flat.field(1).to_numpy(), -1)
                stays = np.cumsum(edges)[:-1] == 0
                total = np.concatenate([[0], np.cumsum(stays)])
                left = total[w.bounds[1:]] - total[w.bounds[:-1]]
                index = np.flatnonzero(stays)
                kept = [w.joined(index[total[a] : total[b]]).decode() for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(w.counts, pa.int64()), pa.array(w.counts - left, pa.int64()), pa.array(kept, pa.string())], schema=tp.arrow_schema(schema)
                )

    return joined.mapInArrow(work, schema)
