"""Scores of items from a user's history and item-item edges, block against block.

Packed histories of some users meet the packed edges of some target items in one task; where there are many edges, only
those of the items that these users have rated are sent to it. A task expands one bounded step
of ratings to their neighbours at a time, in arrays, and returns what is asked: all scored pairs, the n best of each of
its users, or the pairs given as targets. Rows for (user, target, rated item) never exist in Spark. A history is held
whole, and is no longer than the catalogue.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.columns import TIE_DIGITS
from ratingloom.operators.pairs import coded, decoded, packed_arrays, unpacked_arrays
from ratingloom.session import bounded_batches, materialise

RATINGS_PER_BLOCK = 200_000
EDGES_PER_BLOCK = 500_000  # of a target block, 16 MB; a single block of them may be sent to every task
HELD_BLOCKS = 5  # blocks of edges that a task holds where edges are routed
HELD_PARTS = 200  # blocks of ratings that a task holds packed there,
OPEN_PARTS = 20  # and unpacked
HELD_ROWS = 1_000_000  # that a task bundles by block before it sends them
STEP = 2_000_000  # entries that a task holds expanded
SCHEMA = "user_id long, item_id long, score double"
PIECES = "_cell int, _tb int, data binary"
SPREAD, PRIME = 1_103_515_245, 2**31 - 1


@dataclass(frozen=True)
class Rule:
    """How the entries (edge weight w, rating r, frequency f) of a target make its score.

    neighbours: sum(w r) / (sum |w| + epsilon) over the k entries with the largest |w|, ties by rated item, w <> 0;
    with epsilon 0 only where the denominator exceeds 1e-8. sum: sum(w r). deviation: sum((r + w) f) / sum(f).
    """

    kind: str
    k: int = 0
    epsilon: float = 0.0


class _Edges:
    """Edges of some targets by rated item."""

    def __init__(self, target: np.ndarray, source: np.ndarray, weight: np.ndarray, freq: np.ndarray, rule: Rule):
        if rule.kind == "neighbours":
            some = weight != 0
            target, source, weight, freq = target[some], source[some], weight[some], freq[some]
        by = np.argsort(source, kind="stable")
        self.targets, self.code = np.unique(target[by], return_inverse=True)
        self.source, self.weight, self.freq = source[by], weight[by], freq[by]
        self.sources, self.first = np.unique(self.source, return_index=True)
        self.count = np.diff(np.append(self.first, len(by)))

    def of(self, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First edge and number of edges of each rated item."""
        if not len(self.sources):
            return np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
        at = np.minimum(np.searchsorted(self.sources, items), len(self.sources) - 1)
        return self.first[at], np.where(self.sources[at] == items, self.count[at], 0)


class _Histories:
    """Ratings of some users, user by user."""

    def __init__(self, users: np.ndarray, items: np.ndarray, ratings: np.ndarray):
        order = np.argsort(users, kind="stable")
        self.names, start = np.unique(users[order], return_index=True)
        self.start = np.append(start, len(users))
        self.row = np.repeat(np.arange(len(self.names)), np.diff(self.start))
        self.ratings = ratings[order]
        self.items, self.item = np.unique(items[order], return_inverse=True)

    def packed(self) -> bytes:
        return packed_arrays([np.diff(self.names, prepend=0), np.diff(self.start), np.diff(self.items, prepend=0), self.item, *coded(self.ratings)])

    @classmethod
    def unpacked(cls, data: bytes) -> _Histories:
        new = cls.__new__(cls)
        names, count, items, new.item, *ratings = unpacked_arrays(pa.py_buffer(data))
        new.names, new.items, new.ratings = np.cumsum(names), np.cumsum(items), decoded(*ratings)
        new.start = np.concatenate([[0], np.cumsum(count)])
        new.row = np.repeat(np.arange(len(names)), count)
        return new


def _scored(edges: _Edges, cell: np.ndarray, edge: np.ndarray, rating: np.ndarray, rule: Rule, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells that have a score, in order, and their scores; entries come cell by cell."""
    w = edges.weight[edge]
    if rule.kind == "neighbours":
        size = np.bincount(cell, minlength=cells)
        if size.max(initial=0) > rule.k:
            many = np.flatnonzero(size[cell] > rule.k)
            order = np.lexsort((edges.source[edge[many]], -np.round(np.abs(w[many]), TIE_DIGITS), cell[many]))
            many = many[order]
            place = np.arange(len(many)) - np.searchsorted(cell[many], cell[many])
            near = np.ones(len(cell), bool)
            near[many[place >= rule.k]] = False
            cell, w, rating = cell[near], w[near], rating[near]
        above, below = np.bincount(cell, w * rating, cells), np.bincount(cell, np.abs(w), cells)
        found = np.flatnonzero(below > 1e-8 if rule.epsilon == 0 else below > 0)
        return found, above[found] / (below[found] + rule.epsilon)
    if rule.kind == "sum":
        return np.arange(cells), np.bincount(cell, w * rating, cells)
    f = edges.freq[edge]
    below = np.bincount(cell, f, cells)
    found = np.flatnonzero(below > 0)
    return found, np.bincount(cell, (rating + w) * f, cells)[found] / below[found]


def _among(keys: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which of ``keys`` are in ``some``."""
    if not len(some):
        return np.zeros(len(keys), bool)
    some = np.sort(some)
    return some[np.minimum(np.searchsorted(some, keys), len(some) - 1)] == keys


def _best(user: np.ndarray, item: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` best of each user, ties by item."""
    order = np.lexsort((item, -np.round(score, TIE_DIGITS), user))
    user = user[order]
    return order[np.arange(len(order)) - np.searchsorted(user, user) < n]


def _meeting(row: dict, rule: Rule, n: int | None, unseen: bool) -> Iterator[pa.RecordBatch]:
    edges = _Edges(*(row[c] for c in ("targets", "sources", "weights", "freqs")), rule)
    asked = None if row["asked_users"] is None else (row["asked_users"], row["asked_items"])
    for found in _met(_Histories(row["users"], row["items"], row["ratings"]), edges, asked, rule, n, unseen):
        yield _batch(*found)


def _batch(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["user_id", "item_id", "score"])


def _met(histories: _Histories, edges: _Edges, asked: tuple | None, rule: Rule, n: int | None, unseen: bool) -> Iterator[tuple]:
    """Users, items and scores; the time and space of a step follow its entries, not its users and targets."""
    names, start, width = histories.names, histories.start, len(edges.targets)
    if not width:
        return
    first, count = (x[histories.item] for x in edges.of(histories.items))
    total = np.concatenate([[0], np.cumsum(count)])
    if unseen:
        at = np.minimum(np.searchsorted(edges.targets, histories.items), width - 1)
        column = np.where(edges.targets[at] == histories.items, at, -1)[histories.item]
    if asked is not None:
        u = np.minimum(np.searchsorted(names, asked[0]), len(names) - 1)
        t = np.minimum(np.searchsorted(edges.targets, asked[1]), width - 1)
        known = (names[u] == asked[0]) & (edges.targets[t] == asked[1])
        wanted = np.unique(u[known] * width + t[known])
    lo = 0
    while lo < len(names):
        hi = max(lo + 1, int(np.searchsorted(total[start], total[start[lo]] + STEP, "right")) - 1)
        a, b = start[lo], start[hi]
        rated = np.repeat(np.arange(a, b), count[a:b])
        edge = np.repeat(first[a:b] - (total[a:b] - total[a]), count[a:b]) + np.arange(total[b] - total[a])
        cell = histories.row[rated] * width + edges.code[edge]
        order = np.argsort(cell)
        cell, edge, rated = cell[order], edge[order], rated[order]
        heads = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
        size, cells = np.diff(np.append(heads, len(cell))), cell[heads]
        keep = np.ones(len(cells), bool)
        if unseen:
            seen = np.flatnonzero(column[a:b] >= 0) + a
            keep &= ~_among(cells, histories.row[seen] * width + column[seen])
        if asked is not None:
            keep &= _among(cells, wanted[slice(*np.searchsorted(wanted, [lo * width, hi * width]))])
        kept = np.repeat(keep, size)
        cells, run = cells[keep], np.repeat(np.arange(int(keep.sum())), size[keep])
        found, score = _scored(edges, run, edge[kept], histories.ratings[rated[kept]], rule, len(cells))
        user, item = cells[found] // width, cells[found] % width
        if n is not None:
            best = _best(user, item, score, n)
            user, item, score = user[best], item[best], score[best]
        if len(score):
            yield names[user], edges.targets[item], score
        lo = hi


def _packed(rows: DataFrame, block: str, names: dict[str, str]) -> DataFrame:
    """One row per block with an array for each column."""
    entry = F.struct(*[F.col(c).alias(new) for c, new in names.items()])
    return rows.groupBy(block).agg(F.collect_list(entry).alias("_rows")).select(block, *[F.col(f"_rows.{new}").alias(new) for new in names.values()])


def _block(key: str, blocks: int):
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def sparse_scores(ratings: DataFrame, edges: DataFrame, rule: Rule, targets: DataFrame | None = None, n: int | None = None, unseen: bool = True) -> DataFrame:
    """user_id, item_id, score of the items that ``edges`` (item_i target, item_j rated, w, f) lead to.

    ``targets`` (user_id, item_id) asks for these pairs only, ``n`` for the best n of each user and block of targets,
    which hold the best n of all; ``unseen`` leaves out what the user has rated. Ids are longs; rows with a null id or
    rating add nothing; (user, item) pairs are distinct, as in any ratings table.
    """
    spark = ratings.sparkSession
    history = ratings.select(*[F.col(c).cast(t).alias(c) for c, t in (("user_id", "long"), ("item_id", "long"), ("rating", "double"))]).dropna()
    if targets is not None:
        targets = targets.select(F.col("user_id").cast("long").alias("user_id"), F.col("item_id").cast("long").alias("item_id")).dropna()
        history = history.join(targets.select("user_id").distinct(), "user_id", "left_semi")
    history = materialise(history, "history")
    edges = edges.select(*[F.col(c).cast(t).alias(c) for c, t in (("item_i", "long"), ("item_j", "long"), ("w", "double"), ("f", "double"))])
    if targets is not None:
        edges = edges.join(targets.select(F.col("item_id").alias("item_i")).distinct(), "item_i", "left_semi")
    edges = materialise(edges, "edges")
    rows = history.count()
    n_edges = edges.count()
    cores = spark.sparkContext.defaultParallelism
    item_blocks = max(1, -(-n_edges // EDGES_PER_BLOCK))
    if item_blocks > 1:
        return _routed_scores(history, edges, item_blocks, rows, rule, targets, n, unseen)
    user_blocks = max(1, -(-rows // RATINGS_PER_BLOCK), min(cores, rows // 5_000))
    left = _packed(history.withColumn("_ub", _block("user_id", user_blocks)), "_ub", {"user_id": "users", "item_id": "items", "rating": "ratings"})
    right = _packed(edges.withColumn("_ib", F.lit(0)), "_ib", {"item_i": "targets", "item_j": "sources", "w": "weights", "f": "freqs"})
    # at most about EDGES_PER_BLOCK edges, so every task may have them
    met = left.repartition(user_blocks, "_ub").join(F.broadcast(right.drop("_ib")))
    if targets is not None:
        pairs = _packed(targets.distinct().withColumn("_ub", _block("user_id", user_blocks)), "_ub", {"user_id": "asked_users", "item_id": "asked_items"})
        met = met.join(pairs, "_ub")
    else:
        met = met.withColumn("asked_users", F.lit(None).cast("array<long>")).withColumn("asked_items", F.lit(None).cast("array<long>"))
    columns = ["users", "items", "ratings", "targets", "sources", "weights", "freqs", "asked_users", "asked_items"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _meeting({c: _array(batch.column(k)[i]) for k, c in enumerate(columns)}, rule, n, unseen)

    return met.select(*columns).mapInArrow(work, SCHEMA)


def _array(cell: pa.Scalar) -> np.ndarray | None:
    return cell.values.to_numpy(zero_copy_only=False) if cell.is_valid else None


def _target_block(item, blocks: int):
    """Block of a target item, of a column or of an array."""
    if isinstance(item, np.ndarray):
        return item % PRIME * SPREAD % PRIME % blocks
    prime = F.lit(PRIME).cast("long")
    return F.pmod(F.pmod(F.pmod(item, prime) * F.lit(SPREAD), prime), F.lit(blocks).cast("long")).cast("int")


def _routed_scores(
    history: DataFrame, edges: DataFrame, item_blocks: int, rows: int, rule: Rule, targets: DataFrame | None, n: int | None, unseen: bool
) -> DataFrame:
    """The scores where there are many edges: a block of users is sent the edges of the items it has rated, no others.

    Edges lie in blocks of rated items. A block packs the edges of an item once for every block of users that rated it,
    so what is shuffled grows with the ratings and the edges of an item, not with all users times all edges. A task is a
    cell of a block of users and a group of target blocks: there are about as many groups as blocks of users, as an edge
    goes to one group only and a history to all of them. It holds its users' histories packed and takes the edges of one
    block of targets after the other.
    """
    bounded_batches(history.sparkSession)
    cores = history.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(2 * cores, rows // 5_000))
    user_blocks = max(1, -(-rows // (HELD_PARTS * RATINGS_PER_BLOCK)), round(tasks**0.5))
    groups = -(-tasks // user_blocks)
    parts = max(1, -(-rows // (user_blocks * RATINGS_PER_BLOCK)))
    place = _block("user_id", user_blocks * parts)
    history = history.withColumn("_part", place).withColumn("_ub", F.floor(place / parts).cast("int"))
    edges = edges.dropna(subset=["item_i", "item_j"])
    sizes = edges.groupBy(F.col("item_j").alias("item_id")).agg(F.count("*").alias("size"))
    raters = history.groupBy("item_id").agg(F.collect_set("_ub").alias("_ubs"))  # at most all blocks of users
    needed = materialise(raters.join(sizes, "item_id").select("item_id", "size", F.explode("_ubs").alias("_ub")), "needed")
    most = needed.groupBy("_ub").agg(F.sum("size").alias("n")).agg(F.max("n")).first()[0] or 0
    target_blocks = groups * max(1, -(-most // (groups * HELD_BLOCKS * EDGES_PER_BLOCK)))
    placed = edges.select(_block("item_j", item_blocks).alias("_sb"), "item_j", "item_i", "w", "f")
    lists = placed.mapInArrow(_bundles, "_sb int, data binary").withColumn("_ub", F.lit(-1))
    sought = needed.withColumn("_sb", _block("item_id", item_blocks)).groupBy("_sb", "_ub").agg(F.collect_list("item_id").alias("sources"))
    sent = lists.unionByName(sought, allowMissingColumns=True)
    sent = sent.repartitionById(item_blocks, F.col("_sb")).sortWithinPartitions("_sb", "_ub")
    pieces = sent.select("_ub", "sources", "data").mapInArrow(lambda batches: _send(batches, rule, target_blocks, groups), PIECES)

    def copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _bundles(batches):
            part, data = batch.column(0), batch.column(1)
            first = part.to_numpy() // parts * groups
            for group in range(groups):
                yield pa.RecordBatch.from_arrays([pa.array((first + group).astype(np.int32)), part, data], ["_cell", "_part", "data"])

    mine = history.select("_part", "user_id", "item_id", "rating").mapInArrow(copied, "_cell int, _part int, data binary").withColumn("_tb", F.lit(-1))
    met = mine.unionByName(pieces, allowMissingColumns=True)
    if targets is not None:
        asked = targets.distinct().withColumn("_ub", F.floor(place / parts).cast("int")).withColumn("_tb", _target_block(F.col("item_id"), target_blocks))
        asked = asked.withColumn("_cell", F.col("_ub") * groups + F.pmod("_tb", F.lit(groups)))
        asked = asked.groupBy("_cell", "_tb").agg(F.collect_list(F.struct("user_id", "item_id")).alias("_t"))
        asked = asked.select("_cell", "_tb", F.col("_t.user_id").alias("users"), F.col("_t.item_id").alias("items"))
        met = met.unionByName(asked, allowMissingColumns=True)
    else:
        met = met.withColumn("users", F.lit(None).cast("array<long>")).withColumn("items", F.lit(None).cast("array<long>"))
    met = met.repartitionById(user_blocks * groups, F.col("_cell")).sortWithinPartitions("_cell", "_tb", "_part")
    ask = targets is not None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _receive(batches, rule, ask, n, unseen)

    return met.select("_cell", "_tb", "_part", "users", "items", "data").mapInArrow(work, SCHEMA)


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, id, id, numbers...) packed block by block; a block comes in several bundles."""
    held, count, names = [], 0, None

    def bundled() -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*held)]
        order = np.lexsort(columns[2::-1])
        block, *columns = (c[order] for c in columns)
        heads = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        data = [
            packed_arrays([np.diff(columns[0][a:b], prepend=0), np.diff(columns[1][a:b], prepend=0), *(x for c in columns[2:] for x in coded(c[a:b]))])
            for a, b in zip(heads, np.append(heads[1:], len(block)))
        ]
        return pa.RecordBatch.from_arrays([pa.array(block[heads], pa.int32()), pa.array(data, pa.binary())], names)

    for batch in batches:
        names = [batch.schema.names[0], "data"]
        if batch.num_rows:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            count += batch.num_rows
        if count >= HELD_ROWS:
            yield bundled()
            held, count = [], 0
    if count:
        yield bundled()


def _unbundled(data: pa.Buffer) -> list[np.ndarray]:
    first, second, *numbers = unpacked_arrays(data)
    return [np.cumsum(first), np.cumsum(second), *(decoded(*c) for c in zip(numbers[::2], numbers[1::2]))]


def _send(batches: Iterator[pa.RecordBatch], rule: Rule, target_blocks: int, groups: int) -> Iterator[pa.RecordBatch]:
    """For each block of users the packed edges of the rated items it needs, one row per block of targets."""
    edges, blocks, pieces = None, None, []
    for batch in batches:
        for i in range(batch.num_rows):
            block = batch.column(0)[i].as_py()
            if block < 0:
                pieces.append(_unbundled(batch.column(2)[i].as_buffer()))
                continue
            if pieces:
                source, target, weight, freq = (np.concatenate(c) for c in zip(*pieces))
                by = np.argsort(target, kind="stable")
                edges = _Edges(target[by], source[by], weight[by], freq[by], rule)
                blocks = _target_block(edges.targets, target_blocks)[edges.code]
                pieces = []
            first, count = edges.of(np.sort(_array(batch.column(1)[i])))
            at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            at = at[np.argsort(blocks[at], kind="stable")]
            heads = np.flatnonzero(np.diff(blocks[at], prepend=-1))
            data = [
                packed_arrays([np.diff(edges.source[x], prepend=0), np.diff(edges.targets[edges.code[x]], prepend=0), *coded(edges.weight[x]), *coded(edges.freq[x])])
                for x in (at[a:b] for a, b in zip(heads, np.append(heads[1:], len(at))))
            ]
            tb = blocks[at[heads]]
            yield pa.RecordBatch.from_arrays(
                [pa.array((block * groups + tb % groups).astype(np.int32)), pa.array(tb.astype(np.int32)), pa.array(data, pa.binary())], ["_cell", "_tb", "data"]
            )


def _receive(batches: Iterator[pa.RecordBatch], rule: Rule, ask: bool, n: int | None, unseen: bool) -> Iterator[pa.RecordBatch]:
    """Rows of a cell: its histories, part by part, then target block by target block the pairs asked for and the edges."""
    here, part = None, None
    ratings: list[list] = []  # bundles of a part
    histories: list = []  # packed from the OPEN_PARTS-th on
    best: list[tuple | None] = []  # of each part
    asked: list[tuple] = []
    pieces: list[list] = []

    def close() -> None:
        if ratings:
            one = _Histories(*(np.concatenate(c) for c in zip(*ratings)))
            histories.append(one if len(histories) < OPEN_PARTS else one.packed())
            best.append(None)
            ratings.clear()

    def met() -> Iterator[pa.RecordBatch]:
        if pieces and (asked or not ask):
            source, target, w, f = (np.concatenate(c) for c in zip(*pieces))
            edges = _Edges(target, source, w, f, rule)
            pairs = tuple(np.concatenate(c) for c in zip(*asked)) if ask else None
            for p, one in enumerate(histories):
                one = _Histories.unpacked(one) if isinstance(one, bytes) else one
                found = _met(one, edges, pairs, rule, n, unseen)
                if n is None:
                    yield from (_batch(*x) for x in found)
                    continue
                found = [x for x in (best[p], *found) if x is not None]
                if found:  # the best of all blocks of targets so far
                    users, items, scores = (np.concatenate(c) for c in zip(*found))
                    keep = _best(users, items, scores, n)
                    best[p] = users[keep], items[keep], scores[keep]
        asked.clear()
        pieces.clear()

    for batch in batches:
        for i in range(batch.num_rows):
            cell, target_block = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            if here != (cell, target_block):
                close()
                yield from met()
                if here is None or here[0] != cell:
                    yield from (_batch(*x) for x in best if x is not None)
                    histories.clear()
                    best.clear()
                here, part = (cell, target_block), None
            data = batch.column(5)[i]
            if target_block < 0:
                if batch.column(2)[i].as_py() != part:
                    close()
                    part = batch.column(2)[i].as_py()
                ratings.append(_unbundled(data.as_buffer()))
            elif data.is_valid:
                pieces.append(_unbundled(data.as_buffer()))
            else:
                asked.append((_array(batch.column(3)[i]), _array(batch.column(4)[i])))
    close()
    yield from met()
    yield from (_batch(*x) for x in best if x is not None)
