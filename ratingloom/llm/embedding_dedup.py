"""Embedding near-dedup: tiles of vectors in principal-axis order, compared axis by axis until no pair can reach the threshold.

Equal vectors of a label are one class. Unit vectors are turned to their principal axes (a rotation, so cosines stay)
and each label's classes, ordered by their leading coordinate, are cut into blocks of BLOCK. Two blocks meet in one task
unless their bounding boxes on the leading axes rule out every pair. There they are compared in tiles, STEP axes at a
time: a pair whose sum so far plus the product of the two suffix norms is below the threshold is given up, and a tile
ends with its last pair. What is left is decided by the cosine of the vectors themselves in double precision. A task
returns, for its two blocks, the number of links of each class and a spanning forest of the links, never the pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite entries, and rows without a label, link with
nothing. Vectors of different length don't link. Each row counts as a vector, repeated ones too. A null id links like
any other; it is never the smallest of a component, so it is kept only where all ids of its component are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import components
from ratingloom.llm.vectors import finite, matrix, summed
from ratingloom.session import materialise
from ratingloom.skew import global_rank

THRESHOLD = 0.93
BLOCK = 4096  # classes; two blocks are what a task holds
TILE = 512
STEP = 16  # axes added before the bound is looked at again
BOX_AXES = 8
SLACK = 1e-9  # of a bound, for rounding; the cosine itself is compared without


def principal_axes(vectors: DataFrame, width: int, column: str = "v") -> np.ndarray:
    """Orthonormal axes (columns) by falling second moment of the unit vectors; moments are summed over all rows by Spark."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        total = np.zeros((width, width))
        for batch in batches:
            unit = _unit(matrix(batch.column(column), width))
            total += unit.T @ unit
        yield total.ravel()

    flat = summed(vectors.select(column), moments)
    total = flat.reshape(width, width) if len(flat) else np.zeros((width, width))
    return np.linalg.eigh(total)[1][:, ::-1]


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _placed(classes: DataFrame, axes: np.ndarray) -> DataFrame:
    """``classes`` with their coordinates on the first BOX_AXES axes and the norm of the rest."""
    width = len(axes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _unit(matrix(batch.column("v"), width)) @ axes[:, :BOX_AXES]
            rest = np.sqrt(np.maximum(0.0, 1 - (unit**2).sum(axis=1)))
            head = pa.array([*map(list, unit.tolist())], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, head, pa.array(rest)], [*batch.schema.names, "head", "rest"])

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(place, f"{names}, head array<double>, rest double")


def _cells(placed: DataFrame, threshold: float, axes: int) -> DataFrame:
    """(label, width, a, b) of the blocks of a group that may hold a pair, a <= b, by the boxes around their coordinates."""
    sides = [f(F.col("head")[k]).alias(f"{name}{k}") for k in range(axes) for name, f in (("low", F.min), ("high", F.max))]
    boxes = materialise(placed.groupBy("label", "width", "block").agg(F.max("rest").alias("rest"), *sides), "blocks")
    a, b = boxes.alias("a"), boxes.alias("b")
    reach = F.col("a.rest") * F.col("b.rest")
    for k in range(axes):
        ends = [F.col(f"a.{x}{k}") * F.col(f"b.{y}{k}") for x in ("low", "high") for y in ("low", "high")]
        reach = reach + F.greatest(*ends)
    group = (F.col("a.label") == F.col("b.label")) & (F.col("a.width") == F.col("b.width"))
    pairs = a.join(b, group & (F.col("a.block") <= F.col("b.block")) & (reach >= threshold - SLACK))
    return pairs.select("a.label", "a.width", F.col("a.block").alias("a"), F.col("b.block").alias("b"))


def near_pairs(left: np.ndarray, right: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each tile, row numbers of all pairs of unit vectors on principal axes whose product may reach ``threshold``.

    With ``same``, both sides are one and i < j.
    """
    width, least = left.shape[1], threshold - SLACK
    steps = range(0, width, STEP)
    after_l, after_r = ([np.sqrt((m[:, s + STEP :] ** 2).sum(axis=1)) for s in steps] for m in (left, right))
    for i in range(0, len(left), TILE):
        for j in range(i if same else 0, len(right), TILE):
            u, v = left[i : i + TILE], right[j : j + TILE]
            total = alive = rows = cols = None
            for k, s in enumerate(steps):
                su, sv = after_l[k][i : i + TILE], after_r[k][j : j + TILE]
                if rows is None:
                    part = u[:, s : s + STEP] @ v[:, s : s + STEP].T
                    total = part if total is None else total + part
                    alive = total + np.outer(su, sv) >= least
                    if same and i == j:
                        alive &= np.tri(len(u), len(v), -1, dtype=bool).T
                    if not alive.any():
                        break
                    if alive.mean() < 0.125:  # few are left: go on with these pairs alone
                        rows, cols = np.nonzero(alive)
                        total = total[rows, cols]
                else:
                    total = total + np.einsum("pk,pk->p", u[rows, s : s + STEP], v[cols, s : s + STEP])
                    alive = total + su[rows] * sv[cols] >= least
                    rows, cols, total = rows[alive], cols[alive], total[alive]
                    if not len(rows):
                        break
            else:
                if rows is None:
                    rows, cols = np.nonzero(alive)
                yield rows + i, cols + j


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with that of ``b``, from the vectors themselves in double precision."""
    return np.einsum("pk,pk->p", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))


class _Forest:
    """Links that join what earlier links left apart."""

    def __init__(self, n: int):
        self.tree, self.edges = np.arange(n), []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        apart = self.tree[i] != self.tree[j]
        i, j = i[apart], j[apart]
        if not len(i):
            return
        parent = {}

        def root(x: int) -> int:
            while x in parent:
                parent[x] = parent.get(parent[x], parent[x])
                x = parent[x]
            return x

        for a, b, x, y in zip(i.tolist(), j.tolist(), self.tree[i].tolist(), self.tree[j].tolist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
                self.edges.append((a, b))
        moved = {x: root(x) for x in parent}
        new = np.arange(len(self.tree))
        new[list(moved)] = list(moved.values())
        self.tree = new[self.tree]


def _compare(axes: np.ndarray, threshold: float):
    width = len(axes)

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sides = table.column("side").to_numpy()
        a, b = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        same = not len(b)
        b = a if same else b
        vectors = matrix(table.column("v").chunk(0), width)
        unit = _unit(vectors) @ axes
        vectors = _safe(vectors)
        ids, copies = table.column("cls").to_numpy(), table.column("copies").to_numpy()
        links, forest = np.zeros(len(ids), np.int64), _Forest(len(ids))
        for i, j in near_pairs(unit[a], unit[b], threshold, same):
            i, j = a[i], b[j]
            true = cosines(vectors[i], vectors[j]) >= threshold
            i, j = i[true], j[true]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            forest.add(i, j)
        linked = np.flatnonzero(links)
        tree = np.array(forest.edges, np.int64).reshape(-1, 2)
        none = lambda n: pa.nulls(n, pa.int64())
        counts = pa.table([pa.array(ids[linked]), none(len(linked)), pa.array(links[linked])], ["a", "b", "links"])
        edges = pa.table([pa.array(ids[tree[:, 0]]), pa.array(ids[tree[:, 1]]), none(len(tree))], ["a", "b", "links"])
        return pa.concat_tables([counts, edges])

    return compare


def _safe(v: np.ndarray) -> np.ndarray:
    """``v``, but rows whose squares would overflow or vanish are first divided by a power of two, which changes no digit."""
    most = np.abs(v).max(axis=1, initial=0)
    odd = (most > 1e140) | (most < 1e-140)
    if odd.any():
        v = v.copy()
        v[odd] = np.ldexp(v[odd], -np.frexp(most[odd])[1][:, None])
    return v


def dedup(embeddings: DataFrame, threshold: float = THRESHOLD, column: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``embeddings``."""
    rows = embeddings.select(F.col(key).alias("vec_id"), F.col(label).alias("label"), F.col(column).alias("v"))
    usable = finite("v") & F.col("label").isNotNull() & F.coalesce(F.exists("v", lambda c: c != 0), F.lit(False))
    rows = rows.withColumn("v", F.when(usable, F.col("v"))).withColumn("label", F.when(F.col("v").isNotNull(), F.col("label")))
    classes = rows.filter("v is not null").groupBy("label", "v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    classes = materialise(classes, "classes")
    width = classes.agg(F.max(F.size("v"))).first()[0] or 0
    axes = principal_axes(classes, width)
    order = [F.col("label"), F.size("v"), F.col("head")[0], F.col("least")]
    ranked = global_rank(_placed(classes, axes), order, "cls")
    # blocks follow the order of all classes; one that holds two groups counts for each
    placed = materialise(ranked.withColumn("width", F.size("v")).withColumn("block", F.floor(F.col("cls") / BLOCK)), "placed")
    cells = materialise(_cells(placed, threshold, min(BOX_AXES, width)), "cells")
    sides = F.when(F.col("a") == F.col("b"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    meets = cells.withColumn("side", F.explode(sides)).withColumn("block", F.when(F.col("side") == 0, F.col("a")).otherwise(F.col("b")))
    held = placed.select("label", "width", "block", "cls", "copies", "v").join(meets, ["label", "width", "block"])
    held = held.select("label", "width", "a", "b", "side", "cls", "copies", "v")
    found = materialise(held.groupBy("label", "width", "a", "b").applyInArrow(_compare(axes, threshold), "a long, b long, links long"), "links")
    links = found.filter("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("links"))
    sets = components(found.filter("b is not null").select("a", "b")).toDF("cls", "joined")
    state = placed.select("cls", "label", "v", "copies", "least").join(links, "cls", "left").join(sets, "cls", "left")
    state = materialise(state.withColumn("set", F.coalesce("joined", "cls")), "linked")
    smallest = state.groupBy("set").agg(F.min("least").alias("component_id"))
    state = state.join(smallest, "set").select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.join(state, ["label", "v"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
