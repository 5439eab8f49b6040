"""Embedding whitening: QR in blocks, bidiagonalisation, dqds, directions from twisted factorisations.

The centred rows are reduced to one triangle R by QR: each task reduces its own rows block by block, and triangles are
stacked FAN at a time until one is left. The driver holds that triangle alone (d x d numbers for vectors of d entries).
R is bidiagonalised by Householder reflections, dqds finds all singular values to high relative accuracy, and the right
singular vectors of the largest come from the twisted factorisation of B'B - s^2. V = R'R / n is never formed.

Defined cases: vectors shorter than the longest are filled up with zeros; rows of a null vector or with null, NaN or
infinite entries are dropped; a null id stays, repeated rows each stay; directions without variance are left out, so
fewer than ``top`` components (none for one distinct vector or an empty table) may come back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.vectors import finite, matrix
from ratingloom.session import materialise

TOP = 4
BLOCK = 4096  # rows reduced at once
FAN = 16  # triangles stacked at once
SCALE = 256
EPS = np.finfo(np.float64).eps
LONG = (1 << 63) - 1


def scaled(embeddings: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``key`` and the whole-number vector x = floor(256 c) of every usable row."""
    whole = F.transform(F.col(column), lambda c: F.floor(c.cast("double") * SCALE))
    return embeddings.filter(finite(column)).select(F.col(key).alias("vec_id"), whole.alias("x"))


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor P of an upper bidiagonal B with R = Q B P', by Householder reflections."""
    a, d = r.copy(), r.shape[1]
    p = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        norm = np.linalg.norm(x)
        if norm == 0 or not x[1:].any():
            return None
        v = x.copy()
        v[0] += np.copysign(norm, x[0])
        return v / np.linalg.norm(v)

    for k in range(d):
        v = reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        v = reflector(a[k, k + 1 :]) if k + 2 < d else None
        if v is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            p[:, k + 1 :] -= 2 * np.outer(p[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), p


def dqds(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Singular values of an upper bidiagonal matrix, falling, by the differential qd algorithm with shifts.

    A shift that would make a q negative is given up for a smaller one, the last of which is zero, so values keep their
    relative accuracy. Diagonal entries below eps of the norm, which rounding made, are lifted to it.
    """
    norm = max(np.abs(diagonal).max(initial=0), np.abs(upper).max(initial=0))
    if norm == 0:
        return np.zeros(len(diagonal))
    q = (np.maximum(np.abs(diagonal) / norm, EPS * EPS)) ** 2
    e = (upper / norm) ** 2
    found, shift, end = [], 0.0, len(q)
    stack = []  # upper blocks still to do, with their shift
    q, e = q.copy(), e.copy()
    low = 0
    tiny = EPS * EPS
    while True:
        if end - low == 1:
            found.append(shift + q[low])
            if not stack:
                break
            low, end, shift = stack.pop()
            continue
        # an e too small to move its neighbours splits the block
        cuts = [i for i in range(low, end - 1) if e[i] <= tiny * (shift + min(q[i], q[i + 1]))]
        if cuts:
            stack.append((low, cuts[-1] + 1, shift))
            low = cuts[-1] + 1
            continue
        if q[low] * 1.5 < q[end - 1]:  # the small end belongs below: turn the block over
            q[low:end], e[low : end - 1] = q[low:end][::-1].copy(), e[low : end - 1][::-1].copy()
        a, b, c = q[end - 2], e[end - 2], q[end - 1]
        half = (a + b + c) / 2
        least = a * c / (half + np.sqrt(max(half * half - a * c, 0.0)))  # smaller eigenvalue of the last two rows
        done = False
        for tau in (least * (1 - 1e-3), least * 0.5, least * 0.05, 0.0):
            nq, ne = q[low:end].copy(), e[low : end - 1].copy()
            d, sound = q[low] - tau, True
            for i in range(low, end - 1):
                nq[i - low] = d + e[i]
                if nq[i - low] <= 0 or d < 0:
                    sound = False
                    break
                t = q[i + 1] / nq[i - low]
                ne[i - low] = e[i] * t
                d = d * t - tau
            if sound and d >= 0:
                nq[-1] = d
                q[low:end], e[low : end - 1] = nq, ne
                shift += tau
                done = True
                break
        if not done:
            raise ArithmeticError("dqds: an unshifted step can't fail on finite values")
    return np.sort(np.sqrt(np.array(found)))[::-1] * norm


def twisted(diagonal: np.ndarray, upper: np.ndarray, value: float, twist: int = 0) -> np.ndarray:
    """Unit vector z with B'B z = value z, from the twisted factorisation with the ``twist``-th smallest middle entry."""
    n = len(diagonal)
    floor = max(value, 1.0) * EPS * EPS
    keep = lambda x: x if abs(x) > floor else np.copysign(floor, x)
    lifted = np.where(np.abs(diagonal) > floor, diagonal, floor)  # as dqds does
    dd = lifted**2
    ll = upper / lifted[:-1]
    dl = lifted[:-1] * upper  # off-diagonal of B'B
    s, low = np.empty(n), np.empty(n - 1)
    s[0] = -value
    for i in range(n - 1):
        low[i] = dl[i] / keep(s[i] + dd[i])
        s[i + 1] = low[i] * ll[i] * s[i] - value
    p, up = np.empty(n), np.empty(n - 1)
    p[-1] = dd[-1] - value
    for i in range(n - 2, -1, -1):
        below = keep(upper[i] ** 2 + p[i + 1])
        up[i] = dl[i] / below
        p[i] = (p[i + 1] / below if upper[i] else 1.0) * dd[i] - value
    r = int(np.argsort(np.abs(s + p + value), kind="stable")[min(twist, n - 1)])
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -low[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def right_vectors(r: np.ndarray, top: int = TOP) -> tuple[np.ndarray, np.ndarray]:
    """The largest singular values of R, falling, and their right singular vectors as columns, those above rounding only."""
    d = r.shape[1]
    if d == 0 or not r.any():
        return np.zeros(0), np.zeros((d, 0))
    scale = np.abs(r).max()
    diagonal, upper, p = bidiagonal(r / scale)
    values = dqds(diagonal, upper)
    values = values[: min(top, d)]
    values = values[values > values[0] * d * EPS]
    found: list[np.ndarray] = []
    for k, value in enumerate(values):
        near = [found[j] for j in range(k) if abs(values[j] - value) <= 1e-3 * value]
        best, size = None, -1.0
        for twist in range(min(d, 1 + 2 * len(near))):  # values that coincide have one vector from several twists
            z = twisted(diagonal, upper, value * value, twist)
            for _ in range(2):
                for other in near:
                    z = z - (other @ z) * other
            norm = np.linalg.norm(z)
            if norm > size:
                best, size = z / norm if norm else z, norm
            if size > 0.5:
                break
        found.append(best)
    return values * scale, p @ np.column_stack(found)


def _triangle(blocks: Iterator[np.ndarray], d: int) -> np.ndarray:
    r = np.zeros((0, d))
    for block in blocks:
        for at in range(0, len(block), BLOCK):
            r = np.linalg.qr(np.vstack([r, block[at : at + BLOCK]]), mode="r")
    return np.vstack([r, np.zeros((d - len(r), d))]) if len(r) < d else r


def _packed(part: int, r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["part", "r"])


def triangle(rows: DataFrame, sums: list[int], n: int) -> np.ndarray:
    """R of the QR factorisation of the centred rows x - S/n."""
    d, mean = len(sums), np.array([s / n for s in sums])

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r = _triangle((matrix(b.column("x"), d) - mean for b in batches), d)
        yield _packed(TaskContext.get().partitionId(), r)

    def stack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = [pa.Table.from_batches([b]).combine_chunks() for b in batches]
        part = whole[0].column("part")[0].as_py() // FAN
        yield _packed(part, _triangle((np.frombuffer(r.as_py()).reshape(d, d) for t in whole for r in t.column("r")), d))

    def stacked(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(stack(iter(table.to_batches())))

    parts = materialise(rows.mapInArrow(reduce_rows, "part long, r binary"), "triangles")
    while parts.count() > FAN:
        parts = materialise(parts.groupBy(F.floor(F.col("part") / FAN).alias("group")).applyInArrow(stacked, "part long, r binary"), "triangles")
    rest = parts.orderBy("part").collect()  # at most FAN triangles
    return _triangle((np.frombuffer(row["r"]).reshape(d, d) for row in rest), d)


@dataclass
class Whitening:
    """What was fitted: exact sums of the n distinct vectors, directions (columns) and eigenvalues of their covariance."""

    n: int
    sums: list[int]
    directions: np.ndarray
    values: np.ndarray
    total: float  # trace of the covariance

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 of each row, exactly; None beyond a long."""
        reach = max((abs(s) for s in self.sums), default=0) + self.n * int(np.abs(x.astype(np.float64)).max(initial=0) + 1)
        if len(self.sums) * reach * reach < LONG:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return [v if v <= LONG else None for v in exact]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        centre = np.array([s / self.n for s in self.sums])
        return (x - centre) @ (self.directions / np.sqrt(self.values))


def fit(rows: DataFrame, top: int = TOP) -> tuple[Whitening, DataFrame]:
    """The whitening of ``rows`` (vec_id, x) and its fit list: each distinct vector once."""
    distinct = materialise(rows.select("x").distinct(), "vectors")
    size = distinct.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d")).first()
    n, d = size["n"], size["d"] or 0
    # partial sums are made before the shuffle, so d numbers per task move
    entries = distinct.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
    found = {row["i"]: int(row["s"]) for row in entries.collect()}
    sums = [found.get(i, 0) for i in range(d)]
    r = triangle(distinct, sums, n) if n and d else np.zeros((d, d))
    values, directions = right_vectors(r, top)
    return Whitening(n, sums, directions, values**2 / max(n, 1), float((r * r).sum()) / max(n, 1)), distinct


def identity_error(fitted: Whitening, distinct: DataFrame) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k, d = len(fitted.values), len(fitted.sums)
    if not k:
        return 0.0

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = fitted.whiten(matrix(batch.column("x"), d))
            total += w.sum(axis=0)
            products += w.T @ w
        row = [*total.tolist(), *products.ravel().tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.float64()) for v in row], names)

    names = [f"c{i}" for i in range(k + k * k)]
    sums = distinct.mapInArrow(partial, ", ".join(f"{c} double" for c in names)).agg(*[F.sum(c).alias(c) for c in names]).first()
    flat = np.array([sums[c] for c in names]) / fitted.n
    mean, second = flat[:k], flat[k:].reshape(k, k)  # whitened rows are centred, so the mean is rounding
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(embeddings: DataFrame, column: str = "embedding", key: str = "vec_id", top: int = TOP) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = scaled(embeddings, column, key)
    fitted, distinct = fit(rows, top)
    error = identity_error(fitted, distinct)
    k, d = len(fitted.values), len(fitted.sums)
    explained = (fitted.values / fitted.total).tolist() if k else []

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), d, np.int64)
            w, count = fitted.whiten(x), len(x)
            at = np.repeat(np.arange(count), k)
            deviation = pa.array(fitted.deviations(x), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * k, fitted.n)), deviation.take(pa.array(at)), pa.array(w.ravel()),
                    pa.array(np.tile(np.array(explained, np.float64), count)), pa.array(np.full(count * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(project, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
