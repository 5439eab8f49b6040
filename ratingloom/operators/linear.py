"""Linear item-item models on the Gram matrix (N14, N15), held as a table of square blocks.

Items get contiguous positions; block (i, j) holds the cells of positions i*B.. and j*B... Every step
is a join of blocks on a block index, and no task sees more than a few blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.operators.pairs import mirrored, pair_stats
from ratingloom.operators.recommend import spread_meetings
from ratingloom.session import materialise
from ratingloom.skew import dense_ids

BLOCK = 512
BLOCK_SCHEMA = "bi int, bj int, data binary"
SLIM_SCHEMA = BLOCK_SCHEMA + ", moved double"
CYCLES = 2000  # coordinate cycles of one visit to a block; the next round goes on where they end


def item_gram(ratings: DataFrame) -> DataFrame:
    """Cells item_i, item_j, value of R'R: both triangles and the diagonal."""
    pairs = mirrored(pair_stats(ratings).select("item_i", "item_j", F.col("dot").alias("value")), flip=())
    own = ratings.groupBy(F.col("item_id").alias("item_i")).agg(F.sum(F.col("rating") * F.col("rating")).alias("value"))
    return pairs.unionByName(own.select("item_i", F.col("item_i").alias("item_j"), "value"))


def _block_side(n_items: int, block: int, at: int) -> int:
    return min(block, n_items - at * block)


def to_blocks(cells: DataFrame, places: DataFrame, n_items: int, block: int) -> DataFrame:
    """Blocks of the cells; blocks without any cell are filled with zeros."""
    n_blocks = -(-n_items // block)
    rows = places.select(F.col("item_id").alias("item_i"), F.col("place").alias("_i"))
    cols = places.select(F.col("item_id").alias("item_j"), F.col("place").alias("_j"))
    placed = (
        cells.join(rows, "item_i")
        .join(cols, "item_j")
        .select(
            F.floor(F.col("_i") / block).cast("int").alias("bi"),
            F.floor(F.col("_j") / block).cast("int").alias("bj"),
            F.pmod("_i", F.lit(block)).cast("int").alias("i"),
            F.pmod("_j", F.lit(block)).cast("int").alias("j"),
            "value",
        )
    )
    spark = cells.sparkSession
    frame = spark.range(n_blocks * n_blocks).select(
        F.floor(F.col("id") / n_blocks).cast("int").alias("bi"),
        F.pmod("id", F.lit(n_blocks)).cast("int").alias("bj"),
        F.lit(0).alias("i"),
        F.lit(0).alias("j"),
        F.lit(0.0).alias("value"),
    )

    def fill(key: tuple, cells_of: pd.DataFrame) -> pd.DataFrame:
        bi, bj = int(key[0]), int(key[1])
        out = np.zeros((_block_side(n_items, block, bi), _block_side(n_items, block, bj)))
        np.add.at(out, (cells_of["i"].to_numpy(), cells_of["j"].to_numpy()), cells_of["value"].to_numpy())
        return pd.DataFrame({"bi": [bi], "bj": [bj], "data": [out.tobytes()]})

    return placed.unionByName(frame).groupBy("bi", "bj").applyInPandas(fill, BLOCK_SCHEMA)


def from_blocks(blocks: DataFrame, places: DataFrame, n_items: int, block: int) -> DataFrame:
    """Non-zero cells item_i, item_j, value."""

    def cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                data = np.frombuffer(row.data).reshape(_block_side(n_items, block, row.bi), -1)
                i, j = np.nonzero(data)
                yield pd.DataFrame({"_i": i + row.bi * block, "_j": j + row.bj * block, "value": data[i, j]})

    flat = blocks.mapInPandas(cells, "_i long, _j long, value double")
    rows = places.select(F.col("place").alias("_i"), F.col("item_id").alias("item_i"))
    cols = places.select(F.col("place").alias("_j"), F.col("item_id").alias("item_j"))
    return flat.join(rows, "_i").join(cols, "_j").select("item_i", "item_j", "value")


def _each_row(fn: Callable, schema: str, df: DataFrame) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [fn(row) for row in frame.itertuples(index=False)]
            if out:
                yield pd.DataFrame(out, columns=[part.split()[0] for part in schema.split(", ")])

    return df.mapInPandas(run, schema)


def invert_blocks(blocks: DataFrame, n_items: int, block: int) -> DataFrame:
    """Inverse of a symmetric positive definite block matrix by block Gauss-Jordan elimination.

    One step per block row: the pivot block is inverted once, its row and column are joined to all other
    blocks on their block index, and each block is updated on its own. A single block needs one step.
    """
    n_blocks = -(-n_items // block)
    current = blocks
    for p in range(n_blocks):
        side = _block_side(n_items, block, p)

        def inverted(r, p=p, side=side):
            return (p, np.linalg.inv(np.frombuffer(r.data).reshape(side, side)).tobytes())

        corner = current.filter((F.col("bi") == p) & (F.col("bj") == p)).select("data")
        pivot = materialise(_each_row(inverted, "_p int, inverse binary", corner), "pivot")
        row = current.filter((F.col("bi") == p)).select("bj", F.col("data").alias("row"))
        col = current.filter((F.col("bj") == p)).select("bi", F.col("data").alias("col"))
        met = (
            current.join(row, "bj")
            .join(col, "bi")
            .withColumn("_p", F.lit(p))
            .join(F.broadcast(pivot), "_p")  # one block of at most block x block doubles
            .select("bi", "bj", "data", "row", "col", "inverse")
        )
        met = spread_meetings(met, n_blocks * n_blocks, "bi", "bj")

        def update(r, p=p, side=side):
            inverse = np.frombuffer(r.inverse).reshape(side, side)
            if r.bi == p and r.bj == p:
                out = inverse
            elif r.bi == p:
                out = inverse @ np.frombuffer(r.data).reshape(side, -1)
            elif r.bj == p:
                out = -(np.frombuffer(r.data).reshape(-1, side) @ inverse)
            else:
                left = np.frombuffer(r.col).reshape(-1, side) @ inverse
                across = np.frombuffer(r.row).reshape(side, -1)
                out = np.frombuffer(r.data).reshape(left.shape[0], -1) - left @ across
            return (r.bi, r.bj, np.ascontiguousarray(out).tobytes())

        current = materialise(_each_row(update, BLOCK_SCHEMA, met), "blocks")
    return current


def fit_ease(ratings: DataFrame, lam: float = 100.0, block: int = BLOCK) -> DataFrame:
    """Edges item_j (rated) -> item_i (scored): B_ji = -P_ji / P_ii with P = (R'R + lam I)^-1, zero diagonal."""
    places, n_items, blocks = _gram_blocks(ratings, block, lam)
    inverse = materialise(from_blocks(invert_blocks(blocks, n_items, block), places, n_items, block), "inverse")
    diagonal = inverse.filter(F.col("item_i") == F.col("item_j")).select("item_i", F.col("value").alias("_d"))
    # P is symmetric, so the cell (i, j) read from row i divided by P_ii is the weight of rated j for target i
    return (
        inverse.filter(F.col("item_i") != F.col("item_j"))
        .join(diagonal, "item_i")
        .select("item_i", "item_j", (-F.col("value") / F.col("_d")).alias("sim"))
    )


def _gram_blocks(ratings: DataFrame, block: int, lam: float = 0.0) -> tuple[DataFrame, int, DataFrame]:
    places = materialise(dense_ids(ratings, "item_id", "place"), "places")
    n_items = places.count()
    cells = item_gram(ratings)
    if lam:
        ridge = places.select(F.col("item_id").alias("item_i"), F.col("item_id").alias("item_j"), F.lit(float(lam)).alias("value"))
        cells = cells.unionByName(ridge)
    return places, n_items, materialise(to_blocks(cells, places, n_items, block), "gram")


def fit_slim(
    ratings: DataFrame,
    l1: float = 1e-3,
    l2: float = 1e-4,
    tol: float = 1e-6,
    rounds: int = 1000,
    block: int = BLOCK,
) -> DataFrame:
    """Edges item_j (rated) -> item_i (scored) of the non-negative elastic net of every item on the others.

    Minimises |r_i - R w|^2 / (2 n) + l1 |w| + l2 |w|^2 / 2 over w >= 0, w_i = 0, by block coordinate descent
    on the Gram matrix. A visit to a block row of W repeats the coordinate cycle inside its task until the
    block is at rest, all targets at once. Targets do not depend on each other: a block column whose weights
    moved by ``tol`` at most over a whole round is finished and leaves the loop. The minimum is unique for
    l2 > 0, so the result depends on the block size within the tolerance only; ``rounds`` is a backstop.
    Empty ratings give no edges.
    """
    n_users = ratings.select("user_id").distinct().count()
    places, n_items, gram = _gram_blocks(ratings, block)
    n_blocks = -(-n_items // block)

    def zeros(r):
        return (r.bi, r.bj, np.zeros(len(r.data) // 8).tobytes(), 0.0)

    moving = materialise(_each_row(zeros, SLIM_SCHEMA, gram), "weights")
    finished = []
    for _ in range(rounds):
        for b in range(n_blocks):
            moving = _slim_block_step(gram, moving, b, n_items, block, n_users, l1, l2, tol)
        moved = moving.groupBy("bj").agg((F.max("moved") <= tol).alias("_rest"))  # one row per block column
        state = materialise(moving.join(moved, "bj").select("bi", "bj", "data", "moved", "_rest"), "slim_round")
        finished.append(state.filter("_rest").drop("_rest"))
        moving = state.filter("NOT _rest").drop("_rest")
        if moving.isEmpty():
            break
    weights = moving
    for part in finished:
        weights = weights.unionByName(part)
    # the cell (k, j) is the weight of rated k for target j
    cells = from_blocks(weights.drop("moved"), places, n_items, block)
    return cells.select(F.col("item_j").alias("item_i"), F.col("item_i").alias("item_j"), F.col("value").alias("sim"))


def _slim_block_step(gram, weights, b, n_items, block, n_users, l1, l2, tol) -> DataFrame:
    side = _block_side(n_items, block, b)
    across = gram.filter((F.col("bi") == b) & (F.col("bj") != b)).select(F.col("bj").alias("bi"), F.col("data").alias("g"))

    def product(r):
        left = np.frombuffer(r.g).reshape(side, -1)
        out = left @ np.frombuffer(r.data).reshape(left.shape[1], -1)
        return (r.bj, np.ascontiguousarray(out).tobytes())

    blocks = weights.join(across, "bi").select("bi", "bj", "data", "g")
    blocks = spread_meetings(blocks, (-(-n_items // block)) ** 2, "bi", "bj")
    parts = _each_row(product, "bj int, part binary", blocks)

    def add(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(frame["part"].iloc[0]).copy()
        for part in frame["part"].iloc[1:]:
            total += np.frombuffer(part)
        return pd.DataFrame({"bj": [int(key[0])], "pull": [total.tobytes()]})

    pull = parts.groupBy("bj").applyInPandas(add, "bj int, pull binary")  # one part of block x block per block row
    own = gram.filter((F.col("bi") == b) & (F.col("bj") == b)).select(F.col("data").alias("gbb"), F.lit(b).alias("bi"))
    target = gram.filter(F.col("bi") == b).select("bj", F.col("data").alias("gbj"))
    met = (
        weights.filter(F.col("bi") == b)
        .join(target, "bj")
        .join(F.broadcast(own), "bi")  # one block
        .join(pull, "bj", "left")
        .select("bi", "bj", "data", "gbj", "gbb", "pull")
    )

    def descend(r):
        old = np.frombuffer(r.data).reshape(side, -1)
        w = old.copy()
        g = np.frombuffer(r.gbb).reshape(side, side)
        aim = np.frombuffer(r.gbj).reshape(side, -1)
        if r.pull is not None:
            aim = aim - np.frombuffer(r.pull).reshape(side, -1)
        for _ in range(CYCLES):
            before = w.copy()
            for k in range(side):
                gap = aim[k] - g[k] @ w + g[k, k] * w[k]
                new = np.maximum(gap / n_users - l1, 0.0) / (g[k, k] / n_users + l2)
                if r.bi == r.bj:
                    new[k] = 0.0
                w[k] = new
            if np.abs(w - before).max() <= tol / 10:
                break
        return (r.bi, r.bj, w.tobytes(), float(np.abs(w - old).max()))

    changed = _each_row(descend, SLIM_SCHEMA, met)
    return materialise(weights.filter(F.col("bi") != b).unionByName(changed), "weights")
