"""Factor training over routed blocks.

Ratings are cut once into blocks of about BLOCK_ROWS rows by one side's id, packed with block-local positions
and written with a routing table: which block needs which factor row. A step sends every factor row once to
each block that needs it, so a rating never carries a vector. A block returns sums per id, added up inside the
task before the shuffle. An owner with more ratings than a block is spread over several blocks, and an id that
very many blocks need is sent by several tasks.

Where every owner lies in one block, a step is local: the owners' vectors stay packed with their block and are moved
there, and only the rows and the sums of the other side travel. Where an owner is spread over several blocks, the
sums of both sides are.

Defined results: rows with a null id or rating are left out; an empty table trains to an empty state; a pair
that occurs twice counts twice; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.session import bounded_batches, delete_path, materialise, scratch_path
from ratingloom.skew import hot_keys, salted_join

BLOCK_ROWS = 32_768
ROUTE_BLOCKS = 1_024  # blocks named by one row of the routing table
HOT_ROUTES = 64  # rows of the routing table from which an id is sent by several tasks
PARTIAL_ROWS = 65_536  # sums a task keeps before it hands them on
PARTIAL_CELLS = 4 << 20  # numbers in these sums
SOLVE_ROWS = 256
GRID_CELLS = 32  # cells a rating may take up in the full grid of its block

USER, ITEM = "u", "i"
PACKED = "block long, owners array<long>, others array<long>, o binary, t binary, r binary, c binary"
SUMS = "side string, id long, n double, g array<double>"
LOCAL = f"{SUMS}, owners array<long>, p binary"


def vectors(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as an Arrow list column."""
    offsets = np.arange(0, rows.size + 1, max(1, rows.shape[1]), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows, dtype=float).ravel()))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The inverse of ``vectors``; the column has no nulls."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def segment_sums(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order and the sums of their rows."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[heads], np.add.reduceat(rows[order], heads, axis=0)


class Cells:
    """The ratings of a block by the place of their owner (ascending, each with a rating) and of the other id, and sums
    over them: as products with the full grid of the block where it has at most GRID_CELLS cells a rating."""

    def __init__(self, o: np.ndarray, t: np.ndarray, owners: int, others: int):
        self.o, self.t, self.shape = o, t, (owners, others)
        self.owner_counts = np.bincount(o, minlength=owners).astype(float)
        self.other_counts = np.bincount(t, minlength=others).astype(float)
        self.full = owners * others <= GRID_CELLS * o.size
        self.at = o.astype(np.int64) * others + t if self.full else None
        self._by_other = None

    def products(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """The inner product of both vectors of every rating."""
        return (p @ q.T).ravel()[self.at] if self.full else np.einsum("ij,ij->i", p[self.o], q[self.t])

    def _grid(self, weights: np.ndarray | None) -> np.ndarray:
        return np.bincount(self.at, weights, self.shape[0] * self.shape[1]).reshape(self.shape)

    def to_owners(self, weights: np.ndarray | None, q: np.ndarray) -> np.ndarray:
        """Per owner the sum over its ratings of weight (None for 1) times the other row."""
        if self.full and np.isfinite(q).all():  # an empty cell times infinity would not be 0
            return self._grid(weights) @ q
        return _weighted_sums(self.o, self.t, weights, q, self.shape[0])

    def to_others(self, weights: np.ndarray | None, p: np.ndarray) -> np.ndarray:
        if self.full and np.isfinite(p).all():
            return self._grid(weights).T @ p
        order = self.by_other()
        return _weighted_sums(self.t[order], self.o[order], None if weights is None else weights[order], p, self.shape[1])

    def by_other(self) -> np.ndarray:
        if self._by_other is None:
            self._by_other = np.argsort(self.t, kind="stable")
        return self._by_other

    def other_sums(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.t, weights, self.shape[1])


def _weighted_sums(keys: np.ndarray, places: np.ndarray, weights: np.ndarray | None, rows: np.ndarray, size: int) -> np.ndarray:
    """Per key (ascending) the sum of the weighted rows at the places."""
    out = np.zeros((size, rows.shape[1]))
    if keys.size:
        taken = rows[places] if weights is None else weights[:, None] * rows[places]
        heads = np.flatnonzero(np.diff(keys, prepend=-1))
        out[keys[heads]] = np.add.reduceat(taken, heads, axis=0)
    return out


Kernel = Callable[[np.ndarray, np.ndarray, Cells, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    """o: ratings per owner; t: places in the smallest type that holds them; r: the ratings, or with c, their at most
    256 different values and the number of the value of every rating."""
    owners, o = np.unique(pdf["owner"].to_numpy(), return_inverse=True)
    others, t = np.unique(pdf["other"].to_numpy(), return_inverse=True)
    order = np.lexsort((t, o))
    r = pdf["rating"].to_numpy(dtype=float)[order]
    values, codes = np.unique(r.view(np.int64), return_inverse=True)
    few = values.size <= 256
    return pd.DataFrame(
        {
            "block": [pdf["block"].iloc[0]],
            "owners": [owners],
            "others": [others],
            "o": [np.bincount(o).astype(np.int32).tobytes()],
            "t": [t[order].astype(np.min_scalar_type(others.size - 1)).tobytes()],
            "r": [(values if few else r).tobytes()],
            "c": [codes.astype(np.uint8).tobytes() if few else b""],
        }
    )


def _unpacked(o: bytes, t: bytes, r: bytes, c: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the owner, place of the other id and rating, by owner."""
    counts = np.frombuffer(o, np.int32)
    size = int(counts.sum())
    ratings = np.frombuffer(r)[np.frombuffer(c, np.uint8)] if c else np.frombuffer(r)
    return np.repeat(np.arange(counts.size), counts), np.frombuffer(t, f"u{len(t) // size}").astype(np.int64), ratings


@dataclass
class Blocks:
    """Packed ratings by ``owner`` side, the routing table of each side, and which owners lie in several blocks.

    ``flags``: id, v = [1.0] for an owner that may lie in several blocks, else [0.0].
    """

    packed: DataFrame
    routes: dict[str, DataFrame]
    hot: dict[str, list]
    flags: DataFrame
    any_split: bool
    rows: int = 0

    @classmethod
    def of(cls, ratings: DataFrame, owner: str = "user_id", other: str = "item_id") -> Blocks:
        block_rows = BLOCK_ROWS
        rows = ratings.select(
            F.col(owner).cast("long").alias("owner"), F.col(other).cast("long").alias("other"), F.col("rating").cast("double").alias("rating")
        ).dropna()
        counts = materialise(rows.groupBy("owner").agg(F.count("*").alias("n")), "owners")
        total, most = counts.agg(F.sum("n"), F.max("n")).first()
        blocks = max(1, -(-int(total or 0) // block_rows))
        wide = counts.filter(F.col("n") > block_rows).select("owner", F.ceil(F.col("n") / block_rows).alias("parts"))
        part = F.pmod(F.xxhash64("other"), F.coalesce("parts", F.lit(1)))
        placed = rows.join(wide, "owner", "left").withColumn("block", F.pmod(F.xxhash64("owner", part), F.lit(blocks)))
        packed = materialise(
            placed.select("block", "owner", "other", "rating").groupBy("block").applyInPandas(_pack, PACKED), "blocks"
        )
        routes, hot = {}, {}
        for name in ("owners", "others"):
            needed = packed.select("block", F.explode(name).alias("id"))
            part = F.floor(F.col("block") / ROUTE_BLOCKS).alias("part")
            routes[name] = materialise(needed.groupBy("id", part).agg(F.collect_list("block").alias("blocks")), "routes")
            hot[name] = hot_keys(routes[name], "id", HOT_ROUTES)
        wide_flag = F.array((F.col("n") > block_rows).cast("double")).alias("v")
        flags = materialise(counts.select(F.col("owner").alias("id"), wide_flag), "flags")
        return cls(packed, routes, hot, flags, (most or 0) > block_rows, int(total or 0))

    def sent(self, name: str, table: DataFrame) -> DataFrame:
        """block, id, v: each row of ``table`` (id, v) once for every block that needs it."""
        # a merge join, as a broadcast of the table would pass through the driver in every step
        met = salted_join(self.routes[name], table.hint("merge"), "id", "part", self.hot[name])
        return met.select(F.explode("blocks").alias("block"), "id", "v")

    def met(self, tables: dict[str, DataFrame]) -> DataFrame:
        """Factor rows, then the packed ratings, of one block after the other."""
        parts = [
            self.sent(name, table).select(
                "block", F.lit(place).alias("kind"), "id", "v",
                *[F.lit(None).cast("binary").alias(c) for c in ("o", "t", "r", "c")],
            )
            for place, (name, table) in enumerate(tables.items())
        ]
        last = self.packed.select(
            "block", F.lit(len(tables)).alias("kind"), F.lit(0).cast("long").alias("id"),
            F.array().cast("array<double>").alias("v"), "o", "t", "r", "c",
        )
        rows = last
        for part in parts:
            rows = rows.unionByName(part)
        bounded_batches(rows.sparkSession)
        return rows.repartition("block").sortWithinPartitions("block", "kind", "id")

    def placed(self, table: DataFrame, width: int) -> DataFrame:
        """block, p: the rows of ``table`` (id, v) of the owners of every block, where no owner lies in several."""

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def row(block: int, parts: list[np.ndarray]) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([np.concatenate(parts).tobytes()], pa.binary())], names=["block", "p"]
                )

            held, last = [], None
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                block, rows = batch.column(0).to_numpy(zero_copy_only=False), matrix(batch.column(1), width)
                cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), block.size]
                for low, high in zip(cuts, cuts[1:]):
                    if held and block[low] != last:
                        yield row(last, held)
                        held = []
                    last = int(block[low])
                    held.append(rows[low:high])
            if held:
                yield row(last, held)

        bounded_batches(table.sparkSession)
        rows = self.sent("owners", table).repartition("block").sortWithinPartitions("block", "id").select("block", "v")
        return rows.mapInArrow(work, "block long, p binary")

    def met_locally(self, others: DataFrame, owners: DataFrame | None) -> DataFrame:
        """Rows of the other side, the packed vectors of the owners, then the packed ratings, of one block after the other."""
        none = {"id": "long", "v": "array<double>", "p": "binary", "owners": "array<long>", **dict.fromkeys(("o", "t", "r", "c"), "binary")}

        def part(rows: DataFrame, kind: int) -> DataFrame:
            missing = [F.lit(None).cast(t).alias(c) for c, t in none.items() if c not in rows.columns]
            return rows.select("block", F.lit(kind).alias("kind"), *[c for c in none if c in rows.columns], *missing)

        rows = part(self.packed.select("block", "owners", "o", "t", "r", "c"), 2).unionByName(part(self.sent("others", others), 0))
        if owners is not None:
            rows = rows.unionByName(part(owners, 1))
        bounded_batches(rows.sparkSession)
        ordered = rows.repartition("block").sortWithinPartitions("block", "kind", "id")
        return ordered.select("kind", "id", "v", "p", "owners", "o", "t", "r", "c", "block")


def _blocks(batches: Iterator[pa.RecordBatch], widths: tuple[int, int]) -> Iterator[tuple[list, list, tuple]]:
    """ids and factor rows per kind, and (o, t, r), block by block; only one block is held."""
    kinds = len(widths)
    ids: list[list] = [[] for _ in range(kinds)]
    held: list[list] = [[] for _ in range(kinds)]

    def keep(batch: pa.RecordBatch, kind: np.ndarray, begin: int, end: int) -> None:
        for k in range(kinds):
            low, high = begin + np.searchsorted(kind[begin:end], [k, k + 1])
            if high > low:
                part = batch.slice(low, high - low)
                ids[k].append(part.column(2).to_numpy(zero_copy_only=False))
                held[k].append(matrix(part.column(3), widths[k]))

    for batch in batches:
        kind, begin = batch.column(1).to_numpy(zero_copy_only=False), 0
        for at in np.flatnonzero(kind == kinds):
            keep(batch, kind, begin, at)
            yield (
                [np.concatenate(x) for x in ids],
                [np.concatenate(x) for x in held],
                _unpacked(*(batch.column(c)[int(at)].as_py() for c in (4, 5, 6, 7))),
            )
            ids, held, begin = [[] for _ in range(kinds)], [[] for _ in range(kinds)], at + 1
        keep(batch, kind, begin, batch.num_rows)


# ---- gradient steps ----------------------------------------------------------------------------


def squared_error(k: int, biased: bool = False, mean: float = 0.0) -> Kernel:
    """Errors, and summed per id the gradients, of p.q or of mean + b_u + b_i + p.q with the bias as last entry."""

    def kernel(p, q, cells, r):
        err = r - mean - cells.products(p[:, :k], q[:, :k])
        if biased:
            err -= p[cells.o, k] + q[cells.t, k]
            p, q = with_ones(p[:, :k]), with_ones(q[:, :k])
        return err, cells.to_owners(err, q), cells.to_others(err, p)

    return kernel


def with_ones(rows: np.ndarray) -> np.ndarray:
    return np.concatenate([rows, np.ones((len(rows), 1))], axis=1)


PassKernel = Callable[..., tuple[np.ndarray | None, dict[str, tuple[np.ndarray | None, np.ndarray]]]]


def sums_pass(
    blocks: Blocks,
    owners: DataFrame,
    others: DataFrame,
    widths: tuple[int, int],
    kernel: PassKernel,
    loss_width: int = 1,
    summed: bool = False,
) -> DataFrame:
    """side, id, n, g: sums per id over all ratings, still in parts; side "loss" holds the squared error.

    ``owners`` and ``others``: id, v with a row for every id of the blocks, ``widths`` entries long. ``kernel(p, q,
    o, t, r)`` gives the error per rating (or None) and per side a weight per rating (None for 1) and its rows; with
    ``summed`` both are already added up per id of the block.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, list] = {USER: [], ITEM: []}
        loss, rows = np.zeros(2), 0

        def flush() -> Iterator[pa.RecordBatch]:
            for side, parts in kept.items():
                if parts:
                    ids, sums = segment_sums(np.concatenate([i for i, _ in parts]), np.concatenate([s for _, s in parts]))
                    yield _sum_batch(side, ids, sums[:, -1], sums[:, :-1])
                parts.clear()

        for ids, (p, q), (o, t, r) in _blocks(batches, widths):
            err, found = kernel(p, q, o, t, r)
            for side, (weight, g) in found.items():
                at, names = (o, ids[0]) if side == USER else (t, ids[1])
                n = np.ones(r.size) if weight is None else weight
                sums = np.concatenate([g, n[:, None]], axis=1)
                places, sums = (np.arange(names.size), sums) if summed else segment_sums(at, sums)
                kept[side].append((names[places], sums))
                rows += places.size
            if err is not None:
                loss += (float(err @ err), r.size)
            if rows > PARTIAL_ROWS:
                yield from flush()
                rows = 0
        yield from flush()
        if loss[1]:
            g = np.zeros((1, loss_width))
            g[0, 0] = loss[0]
            yield _sum_batch("loss", np.zeros(1, np.int64), loss[1:], g)

    return blocks.met({"owners": owners, "others": others}).mapInArrow(work, SUMS)


def gradient_pass(blocks: Blocks, state: DataFrame, width: int, kernel: Kernel) -> DataFrame:
    """side, id, n, g of one step on ``state``, whose vectors all have ``width`` entries."""

    def both(p, q, o, t, r):
        cells = Cells(o, t, len(p), len(q))
        err, to_owner, to_other = kernel(p, q, cells, r)
        return err, {USER: (cells.owner_counts, to_owner), ITEM: (cells.other_counts, to_other)}

    users, items = (state.filter(F.col("side") == s).select("id", "v") for s in (USER, ITEM))
    return sums_pass(blocks, users, items, (width, width), both, width, summed=True)


# new owners' vectors (None to send none) and their squared change, errors (None), updates and sums per other id, Gram sums (None)
LocalKernel = Callable[
    [np.ndarray | None, np.ndarray, Cells, np.ndarray],
    tuple[np.ndarray | None, float, np.ndarray | None, np.ndarray, np.ndarray, np.ndarray | None],
]


def local_pass(blocks: Blocks, owners: DataFrame | None, others: DataFrame, widths: tuple[int, int], kernel: LocalKernel) -> DataFrame:
    """LOCAL rows of one step where no owner lies in several blocks.

    Side "u": a block with its owners, their new vectors p and their squared change n. Side "i": sums per id of the
    other side, still in parts. Side "loss": the squared error; side "gram": the kernel's last value, added up per task.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        loss, gram, rows = np.zeros(2), None, 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return segment_sums(np.concatenate([i for i, _ in kept]), np.concatenate([x for _, x in kept]))

        for block, names, q, p, owners_of, (o, t, r) in _local_blocks(batches, widths):
            new, moved, err, n, g, product = kernel(p, q, Cells(o, t, len(owners_of), names.size), r)
            if new is not None:
                yield _owner_batch(block, owners_of, new, moved)
            kept.append((names, np.concatenate([g, n[:, None]], axis=1)))
            rows += names.size
            if rows > PARTIAL_ROWS or rows * kept[0][1].shape[1] > PARTIAL_CELLS:
                kept = [merged()]
                rows = kept[0][0].size
                if rows * 2 > PARTIAL_ROWS or rows * kept[0][1].shape[1] * 2 > PARTIAL_CELLS:
                    yield _local_batch(ITEM, kept[0][0], kept[0][1])
                    kept, rows = [], 0
            if err is not None:
                loss += (float(err @ err), r.size)
            if product is not None:
                gram = product if gram is None else gram + product
        if kept:
            yield _local_batch(ITEM, *merged())
        if loss[1]:
            yield _local_batch("loss", np.zeros(1, np.int64), np.concatenate([loss[:1], np.zeros(widths[1] - 1), loss[1:]])[None])
        if gram is not None:
            yield _local_batch("gram", np.zeros(1, np.int64), np.concatenate([gram.ravel(), [0.0]])[None])

    return blocks.met_locally(others, owners).mapInArrow(work, LOCAL)


def _local_blocks(batches: Iterator[pa.RecordBatch], widths: tuple[int, int]) -> Iterator[tuple]:
    """Number, ids and rows of the other side, vectors of the owners (or None), the owners, and (o, t, r), block by block."""
    ids, rows, p = [], [], None
    for batch in batches:
        kind, begin = batch.column(0).to_numpy(zero_copy_only=False), 0
        for at in [*np.flatnonzero(kind > 0), batch.num_rows]:
            if at > begin:
                part = batch.slice(begin, at - begin)
                ids.append(part.column(1).to_numpy(zero_copy_only=False))
                rows.append(matrix(part.column(2), widths[1]))
            begin = at + 1
            if at == batch.num_rows:
                break
            if kind[at] == 1:
                p = np.frombuffer(batch.column(3)[int(at)].as_py()).reshape(-1, widths[0])
                continue
            owners = batch.column(4)[int(at)].values.to_numpy(zero_copy_only=False)
            ratings = _unpacked(*(batch.column(c)[int(at)].as_py() for c in (5, 6, 7, 8)))
            yield batch.column(9)[int(at)].as_py(), np.concatenate(ids), np.concatenate(rows), p, owners, ratings
            ids, rows, p = [], [], None


def _local_rows(side: str, ids: np.ndarray, n: np.ndarray, g: pa.Array, owners: pa.Array, p: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([side] * ids.size, pa.string()), pa.array(ids, pa.int64()), pa.array(n, pa.float64()), g, owners, p],
        names=["side", "id", "n", "g", "owners", "p"],
    )


def _local_batch(side: str, ids: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(ids.size, pa.list_(pa.int64())), pa.nulls(ids.size, pa.binary())
    return _local_rows(side, ids, sums[:, -1], vectors(sums[:, :-1]), *none)


def _owner_batch(block: int, owners: np.ndarray, new: np.ndarray, moved: float) -> pa.RecordBatch:
    names, data = pa.array([owners], pa.list_(pa.int64())), pa.array([np.ascontiguousarray(new).tobytes()], pa.binary())
    return _local_rows(USER, np.array([block]), np.array([moved]), pa.nulls(1, pa.list_(pa.float64())), names, data)


def owner_rows(written: DataFrame, width: int, keep: str = "") -> DataFrame:
    """id, v of the owners of a local pass; ``keep`` names a column that stays in front, given with its type."""
    kept = keep.split(" ")[:1] if keep else []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ids = batch.column(len(kept))[at].values
                rows = np.frombuffer(batch.column(len(kept) + 1)[at].as_py()).reshape(-1, width)
                first = [pa.array(np.full(len(ids), batch.column(0)[at].as_py()), batch.schema.types[0]) for _ in kept]
                yield pa.RecordBatch.from_arrays([*first, ids, vectors(rows)], names=[*kept, "id", "v"])

    bounded_batches(written.sparkSession)
    packed = written.filter(F.col("side") == USER).select(*kept, "owners", "p")
    return packed.mapInArrow(work, f"{keep}{', ' if keep else ''}id long, v array<double>")


def _sum_batch(side: str, ids: np.ndarray, n: np.ndarray, g: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([side] * ids.size, pa.string()), pa.array(ids, pa.int64()), pa.array(n, pa.float64()), vectors(g)],
        names=["side", "id", "n", "g"],
    )


def merged_rows(batches: Iterator[pa.RecordBatch], keys: int, rows_of: Callable) -> Iterator[tuple[list, np.ndarray]]:
    """Sums of ``rows_of(batch)`` per key over batches sorted by their first ``keys`` columns; the last key is carried."""
    carried, names_carried = None, None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        names = [np.asarray(batch.column(c).to_pylist() if pa.types.is_string(batch.schema.types[c]) else
                            batch.column(c).to_numpy(zero_copy_only=False)) for c in range(keys)]
        changed = np.zeros(batch.num_rows - 1, bool)
        for n in names:
            changed |= n[1:] != n[:-1]
        heads = np.flatnonzero(np.concatenate(([True], changed)))
        sums = np.add.reduceat(rows_of(batch), heads, axis=0)
        firsts = [n[heads] for n in names]
        if carried is not None:
            if all(n[0] == c[0] for n, c in zip(firsts, names_carried)):
                sums[0] += carried[0]
            else:
                yield names_carried, carried
        if len(heads) > 1:
            yield [n[:-1] for n in firsts], sums[:-1]
        names_carried, carried = [n[-1:] for n in firsts], sums[-1:]
    if carried is not None:
        yield names_carried, carried


def whole_sums(sums: DataFrame, side: str, width: int) -> DataFrame:
    """id, n, g of one side of a pass, added up over its parts."""

    def rows_of(batch: pa.RecordBatch) -> np.ndarray:
        return np.concatenate([matrix(batch.column(2), width), batch.column(1).to_numpy(zero_copy_only=False)[:, None]], axis=1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids,), rows in merged_rows(batches, 1, rows_of):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(rows[:, -1]), vectors(rows[:, :-1])], names=["id", "n", "g"]
            )

    parts = sums.filter(F.col("side") == side).select("id", "n", "g").repartition("id").sortWithinPartitions("id")
    return parts.mapInArrow(work, "id long, n double, g array<double>")


def stepped(state: DataFrame, sums: DataFrame, width: int, lr: float, reg: dict[str, float], floor_zero: bool) -> DataFrame:
    """side, id, v, moved: v + lr * (g / n - reg * v) and the squared length of the change; "loss" keeps (error, n)."""

    def rows_of(batch: pa.RecordBatch) -> np.ndarray:
        n = batch.column(2).to_numpy(zero_copy_only=False)
        v = matrix(batch.column(3), width)
        old = (n < 0)[:, None]
        return np.concatenate([np.where(old, v, 0.0), np.where(old, 0.0, v), np.maximum(n, 0.0)[:, None]], axis=1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (side, ids), rows in merged_rows(batches, 2, rows_of):
            v, g, n = rows[:, :width], rows[:, width:-1], rows[:, -1:]
            lam = np.where(side == USER, reg[USER], reg[ITEM])[:, None]
            new = v + lr * (g / np.maximum(n, 1.0) - lam * v)
            if floor_zero:
                new = np.maximum(new, 0.0)
            new = np.where(n > 0, new, v)
            moved = ((new - v) ** 2).sum(axis=1)
            lost = side == "loss"
            new[lost], moved[lost] = g[lost], n[lost, 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(side.tolist(), pa.string()), pa.array(ids, pa.int64()), vectors(new), pa.array(moved, pa.float64())],
                names=["side", "id", "v", "moved"],
            )

    old = state.filter(F.col("side") != "loss").select("side", "id", F.lit(-1.0).alias("n"), F.col("v").alias("g"))
    both = old.unionByName(sums).repartition("side", "id").sortWithinPartitions("side", "id")
    return both.mapInArrow(work, STATE)


STATE = "side string, id long, v array<double>, moved double"


def descended(state: DataFrame, sums: DataFrame, width: int, sum_width: int, update: Callable) -> DataFrame:
    """id, v of one side after ``update(v, g, n)`` of its rows with sums (id, n, g, still in parts); others stay as they are."""

    def rows_of(batch: pa.RecordBatch) -> np.ndarray:
        n, rows = batch.column(1).to_numpy(zero_copy_only=False), np.zeros((batch.num_rows, width + sum_width + 1))
        rows[n < 0, :width] = matrix(batch.column(2), width)
        rows[n >= 0, width:-1] = matrix(batch.column(3), sum_width)
        rows[:, -1] = np.maximum(n, 0.0)
        return rows

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids,), rows in merged_rows(batches, 1, rows_of):
            v, g, n = rows[:, :width], rows[:, width:-1], rows[:, -1:]
            new = np.where(n > 0, update(v, g, np.maximum(n, 1.0)), v)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), vectors(new)], names=["id", "v"])

    none = F.lit(None).cast("array<double>")
    old = state.select(F.col("id").cast("long").alias("id"), F.lit(-1.0).alias("n"), "v", none.alias("g"))
    both = old.unionByName(sums.select("id", "n", none.alias("v"), "g"))
    return both.repartition("id").sortWithinPartitions("id").mapInArrow(work, "id long, v array<double>")


@dataclass
class Training:
    """The last state, one entry per tracked iteration, and the states of the kept iterations."""

    state: DataFrame
    history: list[dict]
    snapshots: DataFrame | None


def train(
    blocks: Blocks,
    state: DataFrame,
    width: int,
    kernel: Kernel,
    iterations: int,
    lr: float,
    reg: dict[str, float],
    floor_zero: bool = False,
    track: bool = False,
    tol: float = 0.0,
    keep: Sequence[int] = (),
) -> Training:
    """Mean gradient steps. State N is written below one root as ``iteration=N``; the states of ``keep`` stay there.

    ``track`` records the error after each iteration and the change per side. ``tol`` ends the training once the
    root mean squared error falls by less than that share of itself (checked one iteration later, as a pass
    measures the state it begins with).
    """
    given = blocks, state, width, kernel, iterations, lr, reg, floor_zero, track, tol, keep
    return _train_spread(*given) if blocks.any_split else _train_locally(*given)


def _train_locally(blocks, state, width, kernel, iterations, lr, reg, floor_zero, track, tol, keep) -> Training:
    """An iteration writes the owners packed by block and the other side's sums, then the rows of the other side."""
    spark = state.sparkSession
    root = scratch_path(spark, "training")
    history: list[dict] = []
    error, number = None, 0
    known = state.filter(F.col("id").isNotNull()).withColumn("id", F.col("id").cast("long"))
    users = known.filter(F.col("side") == USER).select("id", "v")
    unrated = materialise(users.join(blocks.flags.select("id").hint("merge"), "id", "left_anti"), "unrated")
    packed = materialise(blocks.placed(users, width), "placed")
    items = known.filter(F.col("side") == ITEM).select("side", "id", "v")

    def stepping(p, q, cells, r):
        err, to_owner, to_other = kernel(p, q, cells, r)
        new = p + lr * (to_owner / cells.owner_counts[:, None] - reg[USER] * p)
        if floor_zero:
            new = np.maximum(new, 0.0)
        return new, float(((new - p) ** 2).sum()), err, cells.other_counts, to_other, None

    def passed() -> DataFrame:
        return local_pass(blocks, packed, items.select("id", "v"), (width, width), stepping)

    done = None
    for number in range(1, iterations + 1):
        passed().write.parquet(f"{root}/users/iteration={number}")
        written = spark.read.schema(LOCAL).parquet(f"{root}/users/iteration={number}")
        sums = written.filter(F.col("side").isin(ITEM, "loss")).select("side", "id", "n", "g")
        stepped(items, sums, width, lr, reg, floor_zero).write.parquet(f"{root}/items/iteration={number}")
        done = spark.read.schema(STATE).parquet(f"{root}/items/iteration={number}")
        if number > 1 and number - 1 not in keep:
            delete_path(spark, f"{root}/users/iteration={number - 1}")
            delete_path(spark, f"{root}/items/iteration={number - 1}")
        packed = written.filter(F.col("side") == USER).select(F.col("id").alias("block"), "p")
        items = done.filter(F.col("side") != "loss").select("side", "id", "v")
        if track or tol:
            moved = written.filter(F.col("side") == USER).select("side", F.col("n").alias("moved"), F.lit(None).cast("array<double>").alias("v"))
            before, error = error, _record(done.select("side", "moved", "v").unionByName(moved), history, number)
            if tol and before is not None and error is not None and before - error < tol * before:
                break
    if track and history:
        history[-1]["rmse"] = _error(passed())
    if not number:
        return Training(known.select("side", "id", "v"), history, None)

    def whole(packed_users: DataFrame, rows: DataFrame, *kept: str) -> DataFrame:
        found = owner_rows(packed_users, width, "iteration int" if kept else "")
        return found.select(*kept, F.lit(USER).alias("side"), "id", "v").unionByName(rows.select(*kept, "side", "id", "v"))

    still = unrated.select(F.lit(USER).alias("side"), "id", "v")
    last = materialise(whole(written, items).unionByName(still), "state")
    snapshots = None
    if keep:
        kept = [i for i in range(1, number + 1) if i in keep or i == number]
        tables = [
            spark.read.schema(f"{schema}, iteration int").parquet(f"{root}/{side}").filter(F.col("iteration").isin(kept))
            for side, schema in (("users", LOCAL), ("items", STATE))
        ]
        same = still.select(F.explode(F.array(*map(F.lit, kept))).alias("iteration"), "side", "id", "v")
        snapshots = whole(tables[0], tables[1].filter(F.col("side") != "loss"), "iteration").unionByName(same)
    return Training(last, history, snapshots)


def _train_spread(blocks, state, width, kernel, iterations, lr, reg, floor_zero, track, tol, keep) -> Training:
    """An iteration sends the rows of both sides and writes the whole state."""
    spark = state.sparkSession
    root = scratch_path(spark, "training")
    history: list[dict] = []
    kept: list[int] = []
    error, number = None, 0
    current = state.filter(F.col("id").isNotNull())
    for number in range(1, iterations + 1):
        sums = gradient_pass(blocks, current, width, kernel)
        path = f"{root}/iteration={number}"
        stepped(current, sums, width, lr, reg, floor_zero).write.parquet(path)
        written = spark.read.schema(STATE).parquet(path)
        if number > 2 and number - 1 not in keep:
            delete_path(spark, f"{root}/iteration={number - 1}")
        if number in keep:
            kept.append(number)
        current = written.filter(F.col("side") != "loss").select("side", "id", "v")
        if track or tol:
            before, error = error, _record(written, history, number)
            if tol and before is not None and error is not None and before - error < tol * before:
                break
    if track and history:
        history[-1]["rmse"] = _error(gradient_pass(blocks, current, width, kernel))
    if keep and number and number not in kept:
        kept.append(number)
    snapshots = None
    if kept:
        whole = spark.read.schema(f"{STATE}, iteration int").parquet(root)
        snapshots = whole.filter(F.col("iteration").isin(kept) & (F.col("side") != "loss")).select("iteration", "side", "id", "v")
    return Training(current, history, snapshots)


def _record(written: DataFrame, history: list[dict], number: int) -> float | None:
    """Adds the changes of an iteration; the error it measured belongs to the entry before."""
    error = F.sum(F.when(F.col("side") == "loss", F.col("v")[0]))
    rows = {r["side"]: r for r in written.groupBy("side").agg(F.sum("moved").alias("m"), error.alias("e")).collect()}
    rmse = float(np.sqrt(rows["loss"]["e"] / rows["loss"]["m"])) if "loss" in rows else None
    if history:
        history[-1]["rmse"] = rmse
    change = {s: float(np.sqrt(rows[s]["m"])) if s in rows else None for s in (USER, ITEM)}
    history.append({"iteration": number, "rmse": None, "p_change": change[USER], "q_change": change[ITEM]})
    return rmse


def _error(sums: DataFrame) -> float | None:
    found = sums.filter(F.col("side") == "loss").agg(F.sum(F.col("g")[0]).alias("e"), F.sum("n").alias("n")).first()
    return float(np.sqrt(found["e"] / found["n"])) if found["n"] else None


# ---- alternating least squares -----------------------------------------------------------------


def _normal_rows(
    keys: np.ndarray, places: np.ndarray, rows: np.ndarray, wa: np.ndarray | None, wb: np.ndarray, size: int
) -> Iterator[tuple[int, np.ndarray]]:
    """Per key (ascending), SOLVE_ROWS at a time: sum wa v v', sum wb v, sum v, sum wb and the number of its rows v."""
    ends, k = np.searchsorted(keys, np.arange(size + 1)), rows.shape[1]
    for low in range(0, size, SOLVE_ROWS):
        some = range(low, min(size, low + SOLVE_ROWS))
        out = np.empty((len(some), k * k + 2 * k + 2))
        for n, x in enumerate(some):
            at = slice(ends[x], ends[x + 1])
            f = rows[places[at]]
            out[n, : k * k] = (f.T @ (f if wa is None else f * wa[at, None])).ravel()
            out[n, k * k :] = np.concatenate([wb[at] @ f, f.sum(axis=0), [wb[at].sum(), at.stop - at.start]])
        yield low, out


def _solution(rows: np.ndarray, k: int, lam: float, base: np.ndarray | None, lambda_bias: float) -> tuple[np.ndarray, np.ndarray]:
    """f and b of ``least_squares`` from rows of ``_normal_rows``."""
    a = rows[:, : k * k].reshape(-1, k, k) + ((np.zeros((k, k)) if base is None else base) + lam * np.eye(k))
    x = np.linalg.solve(a, rows[:, k * k : k * k + k, None])[:, :, 0]
    return x, (rows[:, -2] - (x * rows[:, k * k + k : -2]).sum(axis=1)) / (rows[:, -1] + lambda_bias)


def sums_are_smaller(blocks: Blocks, k: int) -> bool:
    """Whether the sums of a local half-step per block and other id are fewer numbers than a vector per rating.

    Up to PARTIAL_CELLS numbers they count as fewer.
    """
    sent = blocks.routes["others"].agg(F.sum(F.size("blocks"))).first()[0] or 0
    return sent * (k * k + 2 * k + 2) <= max(PARTIAL_CELLS, blocks.rows * (k + 1))


def both_half_steps(
    blocks: Blocks,
    others: DataFrame,
    k: int,
    lam: float,
    weights: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray | None, np.ndarray]],
    base: np.ndarray | None,
    lambda_bias: float,
    biased: bool,
    send_owners: bool,
) -> DataFrame:
    """LOCAL rows of the half-step of the owners, solved in their blocks, and of the sums of the other side's half-step.

    Owners' vectors (k factors, then the bias) are only in it with ``send_owners``. Side "gram" sums their products
    where ``base`` is given. The other arguments are those of ``least_squares``.
    """

    def kernel(p, q, cells, r):
        found = [
            np.concatenate([x, b[:, None] if biased else np.zeros((len(x), 1))], axis=1)
            for _, rows in _normal_rows(cells.o, cells.t, q[:, :k], *weights(r, q[cells.t, k]), cells.shape[0])
            for x, b in [_solution(rows, k, lam, base, lambda_bias)]
        ]
        new, order = np.concatenate(found), cells.by_other()
        o, t = cells.o[order], cells.t[order]
        sums = [rows for _, rows in _normal_rows(t, o, new[:, :k], *weights(r[order], new[o, k]), cells.shape[1])]
        gram = None if base is None else new[:, :k].T @ new[:, :k]
        return new if send_owners else None, 0.0, None, cells.other_counts, np.concatenate(sums), gram

    return local_pass(blocks, None, others, (0, k + 1), kernel)


def solved_others(written: DataFrame, k: int, lam: float, base: np.ndarray | None, lambda_bias: float) -> DataFrame:
    """id, f, b of the other side from the sums of ``both_half_steps``."""
    width = k * k + 2 * k + 2

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids,), rows in merged_rows(batches, 1, lambda b: matrix(b.column(1), width)):
            for low in range(0, ids.size, SOLVE_ROWS):
                x, bias = _solution(rows[low : low + SOLVE_ROWS], k, lam, base, lambda_bias)
                yield pa.RecordBatch.from_arrays([pa.array(ids[low : low + SOLVE_ROWS], pa.int64()), vectors(x), pa.array(bias)], names=["id", "f", "b"])

    parts = written.filter(F.col("side") == ITEM).select("id", "g").repartition("id").sortWithinPartitions("id")
    return parts.mapInArrow(work, "id long, f array<double>, b double")


def least_squares(
    blocks: Blocks,
    other: DataFrame,
    k: int,
    lam: float,
    weights: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray | None, np.ndarray]],
    base: np.ndarray | None = None,
    lambda_bias: float = 0.0,
) -> DataFrame:
    """id, f, b per owner: f = (base + lam I + sum wa v v')^-1 sum wb v, b = (sum wb - f . sum v) / (n + lambda_bias).

    ``other``: id, v (k factors, then the bias of the other side). ``weights(r, bias)`` gives wa (None for 1) and wb.
    An owner in one block is solved there; the sums of an owner in several blocks are added up first.
    """
    width = k * k + 2 * k + 2

    def solved(ids: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        x, bias = _solution(rows, k, lam, base, lambda_bias)
        none = pa.array([None] * ids.size, pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), vectors(x), pa.array(bias), none], names=["id", "f", "b", "s"])

    def partial(ids: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        none = pa.array([None] * ids.size, pa.list_(pa.float64()))
        empty = pa.array([None] * ids.size, pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), none, empty, vectors(rows)], names=["id", "f", "b", "s"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids, _), (flags, v), (o, t, r) in _blocks(batches, (1, k + 1)):
            for low, rows in _normal_rows(o, t, v[:, :k], *weights(r, v[t, k]), ids.size):
                cut = flags[low : low + len(rows), 0] > 0
                names = ids[low : low + len(rows)]
                if not cut.all():
                    yield solved(names[~cut], rows[~cut])
                if cut.any():
                    yield partial(names[cut], rows[cut])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids,), rows in merged_rows(batches, 1, lambda b: matrix(b.column(1), width)):
            for low in range(0, ids.size, SOLVE_ROWS):
                yield solved(ids[low : low + SOLVE_ROWS], rows[low : low + SOLVE_ROWS])

    out = "id long, f array<double>, b double, s array<double>"
    first = materialise(blocks.met({"owners": blocks.flags, "others": other}).mapInArrow(work, out), "half_step")
    whole = first.filter(F.col("s").isNull()).select("id", "f", "b")
    if not blocks.any_split:
        return whole
    parts = first.filter(F.col("s").isNotNull()).select("id", "s").repartition("id").sortWithinPartitions("id")
    return whole.unionByName(parts.mapInArrow(merge, out).select("id", "f", "b"))
