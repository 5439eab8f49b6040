"""Co-rating statistics of item pairs, the table behind most neighbourhood models.

Histories are packed into bounded chunks and multiplied inside Arrow batches, which return sums that
are already aggregated over the batch; item pairs are never emitted one by one per user. A history
longer than a chunk is multiplied chunk by chunk, and the chunk pairs are spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.operators.prepare import history_chunks
from ratingloom.session import bounded_batches

CHUNK = 1024
PAIRS_PER_STEP = 2_000_000
DENSE_ITEMS = 512
PACKED_PAIRS = 10_000_000  # pairs of ratings of one user
BUCKET_PAIRS = 4_000_000  # of a bucket, before equal pairs are added up
HELD_PAIRS = 3_000_000  # sums that a task holds before it sends them
MOST_TASKS = 4_096

PAIR_SCHEMA = "item_i long, item_j long, n_co long, dot double, diff double"


def pair_stats(ratings: DataFrame, chunk: int = CHUNK, least: int = 1, diff: bool = True) -> DataFrame:
    """One row per pair item_i < item_j that at least ``least`` users rated both.

    n_co: users who rated both; dot: sum of r_i * r_j; diff: sum of r_i - r_j, left out unless ``diff``.
    From PACKED_PAIRS pairs of ratings on, the sums of many histories travel as packed columns of one bucket of items
    and are added up there; a row per pair would take several times the space. A pair that a task met once travels as its
    two ratings, which are often of few values, while products rarely are.
    """
    rows = ratings.select("user_id", "item_id", "rating")
    tiles = history_chunks(rows, ["rating"], chunk)
    partial = _tile_pairs(tiles).mapInArrow(_multiply, PAIR_SCHEMA)
    values = ["n_co", "dot", "diff"] if diff else ["n_co", "dot"]
    size = F.col("n").cast("double")
    met = rows.groupBy("user_id").agg(F.count("*").alias("n")).agg(F.sum(size * (size - 1) / 2)).first()[0] or 0
    if met < PACKED_PAIRS:
        sums = partial.groupBy("item_i", "item_j").agg(*[F.sum(c).alias(c) for c in values])
        return sums.filter(F.col("n_co") >= least) if least > 1 else sums
    bounded_batches(ratings.sparkSession)
    buckets = int(met // BUCKET_PAIRS) + 1
    width = len(values)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in _multiply(batches, True):
            held.append([batch.column(c).to_numpy() for c in (*range(2 + width), 5, 6)])
            count += batch.num_rows
            if count > HELD_PAIRS:
                held = [_added(_drained(held))]
                count = held[0][0].size
                if count > HELD_PAIRS // 2:
                    yield _pack(held[0], buckets)
                    held, count = [], 0
        if count:
            yield _pack(_added(_drained(held)), buckets)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for n in range(batch.num_rows):
                if batch.column(0)[n].as_py() != bucket:
                    if held:
                        yield _whole(held, least, values)
                    bucket, held = batch.column(0)[n].as_py(), []
                held.append(_unpack(batch.column(2)[n].as_buffer()))
        if held:
            yield _whole(held, least, values)

    sent = _tile_pairs(tiles).mapInArrow(packed, "bucket long, size long, data binary")
    tasks = min(buckets, MOST_TASKS)
    sent = sent.repartitionById(tasks, F.pmod("bucket", F.lit(tasks)).cast("int")).sortWithinPartitions("bucket")
    return sent.mapInArrow(summed, "item_i long, item_j long, " + ", ".join(f"{v} {'long' if v == 'n_co' else 'double'}" for v in values))


def _drained(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Columns of all parts; the parts are let go."""
    columns = [np.concatenate(c) for c in zip(*held)]
    held.clear()
    return columns


def _added(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Rows (item_i, item_j, sums...) in order of the pair, one per pair."""
    order = np.lexsort((columns[1], columns[0]))
    columns = [c[order] for c in columns]
    i, j = columns[:2]
    heads = np.flatnonzero(np.concatenate(([True], (i[1:] != i[:-1]) | (j[1:] != j[:-1]))))
    return [i[heads], j[heads], *[np.add.reduceat(c, heads) for c in columns[2:]]]


def _pack(columns: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """One row per bucket of item_i."""
    bucket = ((columns[0].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    heads = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    ends, data = np.append(heads[1:], bucket.size), []
    for low, high in zip(heads, ends):
        data.append(_packed_pairs([c[low:high] for c in columns]))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[heads].astype(np.int64)), pa.array(ends - heads), pa.array(data, pa.binary())], names=["bucket", "size", "data"]
    )


def _packed_pairs(columns: list[np.ndarray]) -> bytes:
    """Columns i, j, n, sums..., ratings of i and j; the sums of a pair met once are left to be made of its ratings."""
    i, j, n, *sums, a, b = columns
    whole = (n > 1) | np.isnan(a) | np.isnan(b)
    parts = [np.diff(i, prepend=0), np.diff(j, prepend=0), n, np.diff(np.flatnonzero(whole), prepend=0)]
    for value in (a[~whole], b[~whole], *(v[whole] for v in sums)):
        parts += coded(value)
    return packed_arrays(parts)


def _unpack(data: pa.Buffer) -> list[np.ndarray]:
    i, j, n, at, *codes = unpacked_arrays(data)
    a, b, *sums = (decoded(*c) for c in zip(codes[::2], codes[1::2]))
    whole = np.zeros(len(i), bool)
    whole[np.cumsum(at)] = True
    columns = [np.cumsum(i), np.cumsum(j), n]
    for value, made in zip(sums, (a * b, a - b)):
        column = np.empty(len(i))
        column[whole], column[~whole] = value, made
        columns.append(column)
    return columns


def coded(value: np.ndarray) -> list[np.ndarray]:
    """Numbers as places in a table of the distinct ones, where that is shorter."""
    bits = np.ascontiguousarray(value, np.float64).view(np.int64)
    table, code = np.unique(bits, return_inverse=True)
    return [table, code] if 2 * len(table) <= len(bits) else [bits, bits[:0]]


def decoded(table: np.ndarray, code: np.ndarray) -> np.ndarray:
    return (table[code] if len(code) else table).view(np.float64)


def packed_arrays(parts: list[np.ndarray]) -> bytes:
    """Arrays of 8-byte integers compressed, with the bytes of equal weight of an array together."""
    raw = np.array([len(parts), *map(len, parts)], np.int64).tobytes()
    raw += b"".join(np.ascontiguousarray(p, np.int64).view(np.uint8).reshape(-1, 8).T.tobytes() for p in parts)
    return np.int64(len(raw)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked_arrays(data: pa.Buffer) -> list[np.ndarray]:
    size = int(np.frombuffer(data, np.int64, 1)[0])
    raw, parts = np.frombuffer(pa.decompress(memoryview(data)[8:], size, codec="zstd"), np.uint8), []
    number = int(raw[:8].view(np.int64)[0])
    at = 8 * (number + 1)
    for length in raw[8:at].view(np.int64):
        parts.append(np.ascontiguousarray(raw[at : at + 8 * length].reshape(8, -1).T).view(np.int64).ravel())
        at += 8 * length
    return parts


def _whole(held: list, least: int, values: list[str]) -> pa.RecordBatch:
    columns = _added(_drained(held))
    enough = columns[2] >= least
    return pa.RecordBatch.from_arrays([pa.array(c[enough]) for c in columns], names=["item_i", "item_j", *values])


def _tile_pairs(tiles: DataFrame) -> DataFrame:
    """Rows (items, rating, cut): cut = 0 for a chunk with itself, else the length of the first chunk.

    Every chunk of a long history sends itself to each (low, high) chunk pair it belongs to; a chunk
    pair holds two chunks at most, so no group grows with the history.
    """
    single = tiles.filter(F.col("n_chunks") == 1).select("items", "rating", F.lit(0).alias("cut"))
    other = tiles.filter(F.col("n_chunks") > 1).select(
        "user_id", "chunk", "items", "rating", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)).alias("partner")
    )
    met = (
        other.select(
            "user_id",
            F.least("chunk", "partner").alias("low"),
            F.greatest("chunk", "partner").alias("high"),
            F.struct("chunk", "items", "rating").alias("tile"),
        )
        .groupBy("user_id", "low", "high")
        .agg(F.array_sort(F.collect_list("tile")).alias("tiles"))
        .filter((F.size("tiles") == 2) | (F.col("low") == F.col("high")))
    )
    joined = met.select(
        F.flatten(F.col("tiles.items")).alias("items"),
        F.flatten(F.col("tiles.rating")).alias("rating"),
        F.when(F.col("low") == F.col("high"), 0).otherwise(F.size(F.col("tiles")[0]["items"])).alias("cut"),
    )
    return single.unionByName(joined)


def _multiply(batches: Iterator[pa.RecordBatch], parts: bool = False) -> Iterator[pa.RecordBatch]:
    """Sums by pair; with ``parts`` also the two ratings of a pair met once (NaN where sums were made at a stroke)."""
    for batch in batches:
        items, ratings = batch.column(0), batch.column(1)
        lengths = np.diff(items.offsets.to_numpy()).astype(np.int64)
        flat_items = items.flatten().to_numpy(zero_copy_only=False)
        flat_ratings = ratings.flatten().to_numpy(zero_copy_only=False)
        cuts = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
        if flat_items.size == 0:
            continue
        names, codes = np.unique(flat_items, return_inverse=True)
        if names.size <= DENSE_ITEMS and not cuts.any():
            yield from _dense_steps(names, codes, flat_ratings, lengths, parts)
            continue
        ends = np.cumsum(lengths)
        cost = np.cumsum(lengths * lengths)
        first = 0
        while first < lengths.size:
            base = cost[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(cost, base + PAIRS_PER_STEP, side="right")))
            lo = ends[first - 1] if first else 0
            hi = ends[last - 1]
            yield _sparse_step(names, codes[lo:hi], flat_ratings[lo:hi], lengths[first:last], cuts[first:last], parts)
            first = last


def _dense_steps(names, codes, ratings, lengths, parts=False) -> Iterator[pa.RecordBatch]:
    """Few distinct items: plain matrix products over the users of the batch."""
    size = names.size
    rows = np.repeat(np.arange(lengths.size), lengths)
    values = np.zeros((lengths.size, size))
    seen = np.zeros((lengths.size, size))
    values[rows, codes] = ratings
    seen[rows, codes] = 1.0
    count = seen.T @ seen
    cross = values.T @ seen
    i, j = np.nonzero(np.triu(count, 1))
    unknown = [np.full(i.size, np.nan)] * 2 if parts else []
    yield _pair_batch(
        names[i], names[j], np.rint(count[i, j]).astype(np.int64), (values.T @ values)[i, j], cross[i, j] - cross[j, i], *unknown
    )


def _sparse_step(names, codes, ratings, lengths, cuts, parts=False) -> pa.RecordBatch:
    """All position pairs p < q of every row, summed by item pair."""
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = np.arange(codes.size) - starts
    after = np.repeat(lengths, lengths) - place - 1
    p = np.repeat(np.arange(codes.size), after)
    q = np.arange(p.size) - np.repeat(np.cumsum(after) - after, after) + p + 1
    if cuts.any():
        cut = np.repeat(cuts, lengths)
        keep = (cut[p] == 0) | ((place[p] < cut[p]) & (place[q] >= cut[p]))
        p, q = p[keep], q[keep]
    swap = codes[p] > codes[q]
    p, q = np.where(swap, q, p), np.where(swap, p, q)
    key = codes[p].astype(np.int64) * names.size + codes[q]
    order = np.argsort(key, kind="stable")
    key, p, q = key[order], p[order], q[order]
    if key.size == 0:
        none = np.empty(0, dtype=np.int64)
        return _pair_batch(none, none, none, *[none.astype(float)] * (4 if parts else 2))
    heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    unique = key[heads]
    return _pair_batch(
        names[unique // names.size],
        names[unique % names.size],
        np.diff(np.append(heads, key.size)),
        np.add.reduceat(ratings[p] * ratings[q], heads),
        np.add.reduceat(ratings[p] - ratings[q], heads),
        *([ratings[p[heads]], ratings[q[heads]]] if parts else []),
    )


def _pair_batch(i, j, n, *sums) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*(pa.array(c, pa.int64()) for c in (i, j, n)), *(pa.array(c, pa.float64()) for c in sums)],
        names=["item_i", "item_j", "n_co", "dot", "diff", "a", "b"][: 3 + len(sums)],
    )


def mirrored(pairs: DataFrame, flip: tuple[str, ...] = ("diff",)) -> DataFrame:
    """Both directions of every pair; columns in ``flip`` change sign with the direction.

    One pass over the pairs, so the aggregate below is not run twice.
    """
    others = [c for c in pairs.columns if c not in ("item_i", "item_j")]
    forward = F.struct("item_i", "item_j", *others)
    backward = F.struct(
        F.col("item_j").alias("item_i"),
        F.col("item_i").alias("item_j"),
        *[(-F.col(c)).alias(c) if c in flip else F.col(c) for c in others],
    )
    return pairs.select(F.inline(F.array(forward, backward)))
