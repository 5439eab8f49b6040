"""Exact Jaccard join of word shingles by partitioning the universe of shingles.

Sets of one size band hash their shingles into the same m segments. Two sets with a Jaccard similarity of at least t
differ in at most H = (1 - t) / (1 + t) * (r + s) shingles, so with more than H segments some segment holds the same
subset in both; and if the subsets with one shingle deleted are indexed as well, each segment of two shingles or more
counts twice. The allocation decides per band between many segments with exact subsets and half as many with
one-deletion neighbourhoods, and per document which of its signatures to keep: the rarest, as many as the pigeonhole
needs. Candidates are verified on their texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm import textpack as tp
from ratingloom.llm.common import components, only_ids, text_frame
from ratingloom.session import materialise

SHINGLE = 5
#: The similarity as a fraction, for whole-number arithmetic.
ABOVE, BELOW = 3, 4
SLACK = 1.35  # segments over the number that the pigeonhole needs
NEIGHBOURHOOD_TOP = 16  # largest band whose sets index their one-deletion neighbourhoods; a row per shingle costs little there
HOT = 32  # documents that share a signature, from which it counts as equally costly
MORE = 2  # signatures kept beyond those needed, which a pair then has to share as well
BINS = 2048  # of the sketch that bounds the difference of two sets from below
BLOCK = 2048  # documents of a group that are held against each other in one step
FIRST_TRIES = 2  # partners that a document is compared with before the exact round

_SEGMENT, _TABLE, _WRAP = np.uint64(0x9FB21C651E98DF25), 0xA24BAED4963EE407, (1 << 64) - 1


def most_different(r: int, s: int) -> int:
    """Shingles in which sets of r and s elements differ at most if they link."""
    return (BELOW - ABOVE) * (r + s) // (BELOW + ABOVE)


@lru_cache(maxsize=256)
def band_segments(band: int) -> tuple[int, bool, int]:
    """(segments, with one-deletion neighbourhoods, segments of the spare table) of sizes 2**band to 2**(band + 1) - 1."""
    top = (2 << band) - 1
    need = most_different(top, top) + 1
    if top <= NEIGHBOURHOOD_TOP:
        return max(1, -(-need // 2) + 1), True, need
    return int(np.ceil(SLACK * need)), False, need


def signatures(tokens: np.ndarray, band: int, largest: int) -> tuple[np.ndarray, int]:
    """Signatures of a set in a band, and how many more than the pigeonhole needs are told by exact subsets.

    ``largest`` is the size of its largest partner in the band. A set with enough non-empty segments gives only these;
    any partner then shares one of them. One with too few adds the empty ones, or a second table of segments.
    """
    m, neighbourhood, spare = band_segments(band)
    base = np.uint64(2 * band * _TABLE & _WRAP)
    need = most_different(len(tokens), largest) + 1
    segment, sums, start, size = _segments(tokens, m, base)
    found = tp.mixed(sums + segment.astype(np.uint64) * _SEGMENT + base)
    if not neighbourhood:
        if len(segment) < need:
            empty = np.setdiff1d(np.arange(m), segment).astype(np.uint64)
            found = np.concatenate([found, tp.mixed(empty * _SEGMENT + base)])
        return found, len(segment) - need
    order = np.argsort(_place(tokens, m, base), kind="stable")
    several = np.repeat(size > 1, size)
    rest = np.repeat(sums + segment.astype(np.uint64) * _SEGMENT + base, size) - tp.mixed(tokens[order])
    found = np.concatenate([found, tp.mixed(rest[several])])
    if len(segment) + int((size > 1).sum()) < need:
        base = np.uint64((2 * band + 1) * _TABLE & _WRAP)
        segment, sums, _, _ = _segments(tokens, spare, base)
        empty = np.setdiff1d(np.arange(spare), segment).astype(np.uint64)
        more = tp.mixed(sums + segment.astype(np.uint64) * _SEGMENT + base)
        found = np.concatenate([found, more, tp.mixed(empty * _SEGMENT + base)])
    return np.unique(found), -1


def _place(tokens: np.ndarray, m: int, base: np.uint64) -> np.ndarray:
    return (tp.mixed(tokens ^ base) % np.uint64(m)).astype(np.int64)


def _segments(tokens: np.ndarray, m: int, base: np.uint64):
    """Non-empty segments, the sum of their shingles' hashes, first place and size."""
    place = _place(tokens, m, base)
    order = np.argsort(place, kind="stable")
    ordered = place[order]
    start = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    sums = np.add.reduceat(tp.mixed(tokens[order]), start)
    return ordered[start], sums, start, np.diff(np.append(start, len(tokens)))


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order; empty without words."""
    for lo, hi, data, offsets in tp.slices(column):
        w = tp.words(tp.LOWER[data], offsets, tp.SPACES)
        hashes = tp.word_hashes(w)
        windows = tp.window_hashes(hashes, SHINGLE)
        for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True):
            if b - a >= SHINGLE:
                yield np.unique(windows[a : b - SHINGLE + 1])
            elif b > a:
                yield tp.window_hashes(hashes[a:b], b - a)
            else:
                yield windows[:0]


def _texts(docs: DataFrame) -> DataFrame:
    return text_frame(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def profiles(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, two hashes that stand for the set, and its sketch: a bit for each of BINS, set if an odd number of shingles falls there.

    Sketches differ in no more bits than the sets differ in shingles.
    """
    schema = "doc_id long, n_shingles long, h1 long, h2 long, sketch binary"

    def sketch(s: np.ndarray) -> bytes:
        return np.packbits(np.bincount((tp.mixed(s) % np.uint64(BINS)).astype(np.int64), minlength=BINS) & 1).tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(len(s), s.sum(dtype=np.uint64), tp.mixed(s + np.uint64(1)).sum(dtype=np.uint64), sketch(s)) for s in shingle_sets(batch.column(1))]
            n, h1, h2 = (np.array([x[i] for x in sets], np.uint64).view(np.int64) for i in range(3))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(h1), pa.array(h2), pa.array([x[3] for x in sets], pa.binary())], schema=tp.arrow_schema(schema))

    return _texts(docs).mapInArrow(work, schema)


INDEX = "sig long, doc_id long, about long"


def index(docs: DataFrame) -> DataFrame:
    """One row per signature: sig, doc_id, about.

    A set is indexed in the band of its size and, if it has larger partners there, in the next. ``about`` packs its
    size, its exact subsets beyond those needed (0: none to spare) and which of the two bands it is.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = tp.arrow_schema(INDEX)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            made: list[np.ndarray] = []
            counts: list[tuple[int, int]] = []
            rows = 0
            for i, tokens in enumerate(shingle_sets(batch.column(1))):
                r = len(tokens)
                if r:
                    band, largest = r.bit_length() - 1, r * BELOW // ABOVE
                    for up in range(2 if largest >= 2 << band else 1):
                        found, spare = signatures(tokens, band + up, min(largest, (2 << (band + up)) - 1))
                        made.append(found)
                        counts.append((len(found), i, (r << 32) | (max(0, spare) << 1) | up))
                        rows += len(found)
                if made and (rows >= 200_000 or i == len(ids) - 1):
                    n = np.array([c[0] for c in counts])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tp.signed(np.concatenate(made))), pa.array(np.repeat(ids[[c[1] for c in counts]], n)), pa.array(np.repeat(np.array([c[2] for c in counts], np.int64), n))], schema=schema
                    )
                    made, counts, rows = [], [], 0
            if made:
                n = np.array([c[0] for c in counts])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tp.signed(np.concatenate(made))), pa.array(np.repeat(ids[[c[1] for c in counts]], n)), pa.array(np.repeat(np.array([c[2] for c in counts], np.int64), n))], schema=schema
                )

    return _texts(docs).filter("doc_id IS NOT NULL").mapInArrow(work, INDEX)


SHARED = "sig long, doc_id long, about long, first long, n long"


def shared(rows: DataFrame) -> DataFrame:
    """The index rows whose signature more than one document has, with the first of these, and how many have it, HOT + 1 for more than HOT.

    The rows are sorted by signature inside each partition and streamed; of a group never more than HOT rows are held.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = tp.arrow_schema(SHARED)
        held: np.ndarray = np.zeros((0, 3), np.int64)  # rows of the last group, which may go on
        begun: int | None = None  # first document of a hot group that goes on
        tail: int | None = None  # and its signature

        def out(table: np.ndarray, first: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*[pa.array(np.ascontiguousarray(table[:, i])) for i in range(3)], pa.array(first), pa.array(n)], schema=schema)

        def groups(table: np.ndarray) -> Iterator[pa.RecordBatch]:
            start = np.flatnonzero(np.concatenate([[True], table[1:, 0] != table[:-1, 0]]))
            n = np.diff(np.append(start, len(table)))
            keep = np.repeat(n > 1, n)
            if keep.any():
                yield out(table[keep], np.repeat(table[start, 1], n)[keep], np.repeat(np.minimum(n, HOT + 1), n)[keep])

        for batch in batches:
            table = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            if not len(table):
                continue
            if begun is not None:
                more = int(np.searchsorted(table[:, 0] != tail, True))
                if more:
                    yield out(table[:more], np.full(more, begun), np.full(more, HOT + 1))
                table = table[more:]
                if not len(table):
                    continue
                begun = None
            table = np.concatenate([held, table])
            cut = int(np.searchsorted(table[:, 0], table[-1, 0]))
            yield from groups(table[:cut]) if cut else ()
            held = table[cut:]
            if len(held) > HOT:
                begun, tail = int(held[0, 1]), int(held[0, 0])
                yield out(held, np.full(len(held), begun), np.full(len(held), HOT + 1))
                held = held[:0]
        if len(held):
            yield from groups(held)

    return rows.repartition("sig").sortWithinPartitions("sig", "doc_id").mapInArrow(work, SHARED)


def _useful(rows: DataFrame) -> DataFrame:
    """The shared rows among the rarest signatures of their document, with ``least``, the number that a pair has to share.

    All documents order signatures alike, by how many have them and then by value; those that nobody else has come
    first. Two sets that link differ in at most H segments, so with w exact subsets each has at least w - H in common
    with the other; hence, as for any prefix filter, the first H + 1 + k of both have k + 1 in common. A document
    without subsets to spare, or with one-deletion neighbourhoods, keeps all its rows and only has to share one.
    """
    mine = Window.partitionBy("doc_id", "about")
    ranked = rows.withColumn("_k", F.row_number().over(mine.orderBy("n", "sig"))).withColumn("_all", F.count("*").over(mine))
    more = F.least(_spare("about"), F.lit(MORE))
    kept = ranked.filter((_spare("about") == 0) | (F.col("_k") <= F.col("_all") - _spare("about") + more))
    return kept.withColumn("least", more + 1).drop("_k", "_all")


def _size(about: str):
    return F.shiftright(about, 32)


def _spare(about: str):
    return F.shiftright(about, 1).bitwiseAND(F.lit((1 << 31) - 1))


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, links) for the pairs (a, b): the similarity of their whole texts, which travel compressed."""
    pairs = materialise(pairs.select("a", "b"), "pairs")
    ids = pairs.select("a").union(pairs.select("b"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=6).compress
        for batch in batches:
            texts = [compress((t or "").encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], schema=tp.arrow_schema("id long, body binary"))

    texts = materialise(only_ids(_texts(docs), "doc_id", ids).mapInArrow(pack, "id long, body binary"), "bodies")
    left = pairs.join(texts.select(F.col("id").alias("a"), F.col("body").alias("x")), "a")
    joined = left.join(texts.select(F.col("id").alias("b"), F.col("body").alias("y")), "b").select("a", "b", "x", "y")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                bodies = part.column(2).to_pylist() + part.column(3).to_pylist()
                place = {b: i for i, b in enumerate(dict.fromkeys(bodies))}
                sets = list(shingle_sets(pa.array([expand(b).decode() for b in place], pa.large_string())))
                links = []
                for x, y in zip(bodies[: part.num_rows], bodies[part.num_rows :], strict=True):
                    s, t = sets[place[x]], sets[place[y]]
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    links.append(both > 0 and BELOW * both >= ABOVE * (len(s) + len(t) - both))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(links, pa.bool_())], schema=tp.arrow_schema("a long, b long, links boolean"))

    return joined.mapInArrow(compare, "a long, b long, links boolean")


def _first_pairs(rows: DataFrame) -> DataFrame:
    """Each document with the firsts of its groups that it meets most often."""
    met = rows.filter("doc_id <> first").groupBy("doc_id", "first").agg(F.count("*").alias("n"))
    best = Window.partitionBy("doc_id").orderBy(F.desc("n"), "first")
    return met.withColumn("_k", F.row_number().over(best)).filter(F.col("_k") <= FIRST_TRIES).select(F.col("first").alias("a"), F.col("doc_id").alias("b"))


def _near(rows: DataFrame) -> DataFrame:
    """(a, b, ax, bx, least): pairs of a group with different labels, fitting sizes and sketches no further apart than a link allows.

    ``rows`` has the groups (sig, i, j): the blocks i and j of the documents with a signature, in one group.
    """
    schema = "a long, b long, ax long, bx long, least int"

    def pairs(table: list[np.ndarray], sketches: np.ndarray, i: int, j: int) -> Iterator[pa.RecordBatch]:
        doc, about, least, label, block = table
        size = about >> 32
        x = np.flatnonzero(block == i)
        y = x if i == j else np.flatnonzero(block == j)
        for k in x.tolist():
            near = y[(label[y] != label[k]) & ((doc[y] > doc[k]) | (i != j))]
            most = (size[near] + size[k]) * (BELOW - ABOVE) // (BELOW + ABOVE)
            near, most = near[np.abs(size[near] - size[k]) <= most], most[np.abs(size[near] - size[k]) <= most]
            apart = np.bitwise_count(sketches[near] ^ sketches[k]).sum(axis=1, dtype=np.int64)
            near = near[apart <= most]
            if len(near):
                swap = doc[near] < doc[k]
                a, b = np.where(swap, doc[near], doc[k]), np.where(swap, doc[k], doc[near])
                ax, bx = np.where(swap, about[near], about[k]), np.where(swap, about[k], about[near])
                yield pa.RecordBatch.from_arrays([*map(pa.array, (a, b, ax, bx)), pa.array(np.minimum(least[near], least[k]), pa.int32())], schema=tp.arrow_schema(schema))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def run() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks()
            sig, i, j, *rest = (whole.column(c).to_numpy().astype(np.int64) for c in range(8))
            sketches = np.frombuffer(b"".join(whole.column(8).to_pylist()), np.uint64).reshape(-1, BINS // 64)
            start = np.flatnonzero(np.concatenate([[True], (sig[1:] != sig[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
            for lo, hi in zip(start, np.append(start[1:], len(sig)), strict=True):
                yield from pairs([c[lo:hi] for c in rest], sketches[lo:hi], int(i[lo]), int(j[lo]))

        for batch in batches:
            # groups of at most two blocks; all but the last of a batch are complete
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(3)], axis=1)
            last = int(np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))[-1]) if len(keys) else 0
            if last == 0 and held and [held[-1].column(c)[-1].as_py() for c in range(3)] == keys[0].tolist():
                held.append(batch)
                continue
            if last:
                held.append(batch.slice(0, last))
            if held:
                yield from run()
            held = [batch.slice(last)] if batch.num_rows else []
        if held:
            yield from run()

    ordered = rows.select("sig", "i", "j", "doc_id", "about", "least", "label", "block", "sketch")
    return ordered.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j").mapInArrow(work, schema)


def _open_pairs(rows: DataFrame, sketches: DataFrame, labels: DataFrame, tested: DataFrame) -> DataFrame:
    """Every pair of documents that shares enough kept signatures, not yet in one component and not yet compared, and not too far apart by its sketches.

    Documents with the commonest label of a signature need no comparison among themselves. The others are cut into
    blocks, which are held against each other and against the blocks of the commonest label, so a group of any size
    is dealt over many tasks, and a document of the commonest label is copied only once for each block of the others.
    """
    known = rows.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
    known = materialise(known.select("sig", "doc_id", "about", "least", "label"), "open")
    mixed = known.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("sig")
    known = materialise(known.join(mixed, "sig"), "mixed")
    sizes = known.groupBy("sig", "label").agg(F.count("*").alias("m")).groupBy("sig").agg(F.max(F.struct("m", "label")).alias("top"), F.sum("m").alias("all"))
    few, many = (F.ceil(n / BLOCK).cast("int") for n in (F.col("all") - F.col("top.m"), F.col("top.m")))
    known = known.join(sizes.select("sig", F.col("top.label").alias("common"), few.alias("few"), many.alias("many")), "sig").join(sketches, "doc_id")
    alike, spread = F.col("label") == F.col("common"), F.xxhash64("doc_id")
    known = known.withColumn("block", F.when(alike, F.col("few") + F.pmod(spread, F.col("many"))).otherwise(F.pmod(spread, F.col("few"))).cast("int"))
    known = known.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("few") - 1 + F.when(alike, 0).otherwise(F.col("many")))))
    known = known.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    met = _near(known).groupBy("a", "b", "ax", "bx").agg(F.count("*").alias("n"), F.min("least").alias("least"))
    return met.filter("n >= least").select("a", "b").distinct().join(tested, ["a", "b"], "left_anti")


def link(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document.

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased; a set has the distinct runs of five words, or the whole
    sequence if there are fewer. Two documents link if 4 * shared >= 3 * united shingles; the component is the
    smallest doc_id reachable. A document without words, or a null text, has an empty set and links with nothing.
    Rows that repeat an id must repeat its text and come back each; a null id has a null component and links with
    nothing. An empty table gives no rows; other columns are ignored. Shingles are told apart by 64-bit hashes.

    Documents with the same set are one class, told by two more hashes, and only its smallest id is indexed. The
    first round compares each document with a few others; the second takes every pair that is still open, so no link
    between different classes is lost. Shuffled are signatures, and the compressed texts of candidates.
    """
    about = materialise(profiles(docs), "profiles")
    same = ["n_shingles", "h1", "h2"]
    classes = about.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*same).agg(F.min("doc_id").alias("head"))
    members = materialise(about.drop("sketch").join(classes, same, "left").withColumn("head", F.when(F.col("doc_id").isNotNull(), F.coalesce("head", "doc_id"))), "classes")
    heads = only_ids(docs, "doc_id", members.filter("doc_id <> head").select("doc_id"), "left_anti")

    found = materialise(shared(index(heads)), "shared")
    useful = materialise(_useful(found), "useful")
    first = materialise(verified(docs, _first_pairs(useful)), "verified")
    links = first.filter("links").select("a", "b")
    labels = components(links)
    late = verified(docs, _open_pairs(useful, about.filter("doc_id IS NOT NULL").select("doc_id", "sketch").dropDuplicates(["doc_id"]), labels, first.select("a", "b"))).filter("links").select("a", "b")
    labels = components(links.union(late))
    out = members.join(labels.withColumnRenamed("id", "head"), "head", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("label", "head").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one document, the smallest id, of each component; of rows with the same id one stays.

    Rows with a null id stay. All columns come back; texts are not shuffled unless ids repeat.
    """
    linked = materialise(link(docs), "linked").filter("doc_id IS NOT NULL")
    kept = only_ids(docs, "doc_id", linked.filter("doc_id <> component_id").select("doc_id"), "left_anti")
    again = linked.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    if again.isEmpty():
        return kept
    once = only_ids(kept, "doc_id", again).dropDuplicates(["doc_id"])
    return only_ids(kept, "doc_id", again, "left_anti").unionByName(once)
