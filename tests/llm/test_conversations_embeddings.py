"""Conversation repair against SQL and exhaustive search; whitening and embedding near-dedup against NumPy and SQL."""

import hashlib
import itertools
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from ratingloom.llm import conversation_repair as repair
from ratingloom.llm import embedding_dedup, queries, whitening

TURNS = "conv_id long, turn long, role string, text string, at long, code string, kind string, conv string"


def cheapest(codes, start, goal):
    """Best (cost, audit) into each state, row by row, inserts before a row's edit only."""
    best = {start: (0, "")}
    for code in codes:
        initial, fault, new = "sua?"[int(code, 16) % 4], int(code, 16) // 4, {}
        for state, (cost, audit) in best.items():
            for _ in range(4):
                ways = [(state, 4, "D")]
                if fault != 2:
                    extra = 3 * (fault == 1)
                    ways.append(({0: 2, 1: 2, 2: 3, 3: 2}[state], 3 + extra, "R"))
                    kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((state, initial))
                    ways += [(kept, extra, "K")] if kept else []
                for to, pay, edit in ways:
                    new[to] = min(new.get(to, (1 << 30, "")), (cost + pay, audit + edit))
                state, cost, audit = {0: 2, 1: 2, 2: 3, 3: 2}[state], cost + 3, audit + "I"
        best = new
    if goal is not None:
        return best.get(goal)
    return min((c + 3 * k, a + "I" * k) for s, (c, a) in best.items() for k in [(0, 2, 1, 0)[s]])


def test_search_finds_the_ascii_least_of_the_cheapest():
    rng = random.Random(4)
    for n in [*range(1, 8)] * 40 + [30] * 6:
        codes = "".join(rng.choice("0123456789ab") for _ in range(n))
        for start, goal in itertools.product(range(4), (None, 0, 1, 2, 3)):
            assert repair.search(codes, start, goal) == cheapest(codes, start, goal), (codes, start, goal)
    assert repair.search("") == (0, "")


def talk(seed=2):
    rng, rows = random.Random(seed), []
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t\n", None, "é ok.", "x" * 20_000 + ".", "Yes.  \n", "a b"]
    for conv in range(40):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "User", "u"])
            rows.append((conv * 3 - 4, rng.choice([turn, turn, turn, None, 2, -7]), role, rng.choice(texts)))
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "Yes."), (7, 1 << 62, "user", "far."), (7, -(1 << 62), "user", "near.")]
    rows += rows[5:9] + [(500, k, ("user", "assistant")[k % 2], rng.choice(texts[:5])) for k in range(700)]
    return [(*r, 1, "x", "y", "z") for r in rows]


def conversations_by_sql(rows):
    con = duckdb.connect()
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    kinds = pa.int64(), pa.int64(), pa.string(), pa.string()
    con.register("conversations", pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=False)], ["conv_id", "turn", "role", "text"]))
    cursor = con.execute(queries.ORACLES["op11_conversation_repair"])
    return [c[0] for c in cursor.description], sorted(map(str, cursor.fetchall()))


def test_repair_as_in_sql(spark):
    rows = [r for r in talk() if abs(r[1] or 0) < 1 << 40]
    names, want = conversations_by_sql(rows)
    got = repair.audit(spark.createDataFrame(rows, TURNS).repartition(3)).select(*names).collect()
    assert sorted(str(tuple(r)) for r in got) == want
    assert max(len(r["audit"]) for r in got) > repair.SEGMENT  # so pieces were put together


def test_repair_of_odd_tables(spark):
    empty = repair.audit(spark.createDataFrame([], TURNS))
    assert empty.collect() == [] and empty.columns[0] == "conv_id"
    far = repair.audit(spark.createDataFrame([r for r in talk() if r[0] == 7], TURNS)).first()
    assert far["gaps"] > 1 << 62  # turns far apart don't overflow
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:1".encode()) % 20 == 0)
    gone = repair.audit(spark.createDataFrame([(dropped, 1, "user", "Hi.", 1, "", "", "")], TURNS)).first()
    assert tuple(gone) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_turns_alternate(spark):
    fixed = repair.repair(spark.createDataFrame(talk(), TURNS))
    turns = fixed.turns().toPandas().sort_values(["conv_id", "place"])
    for conv, group in turns.groupby("conv_id", dropna=False):
        initials = "".join(r[:1] for r in group["role"])
        assert list(group["place"]) == list(range(1, len(group) + 1))
        assert initials.removeprefix("s") == "ua" * (len(initials) // 2), conv


# --- whitening


def test_singular_values_and_directions():
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.normal(size=(12, 12)))[0]
    graded = turn @ np.diag(10.0 ** -np.arange(12)) @ turn.T
    cases = [rng.normal(size=(40, 9)), rng.normal(size=(3, 9)), np.ones((4, 5)), np.diag([5.0, 5, 5, 1, 1]), graded, np.eye(3)]
    cases += [rng.integers(-2, 3, size=(rng.integers(1, 20), rng.integers(1, 12))).astype(float) for _ in range(60)]
    for a in cases:
        d = a.shape[1]
        r = whitening._triangle([a[:2], a[2:]], d)
        values, vectors = whitening.right_vectors(r)
        true = np.linalg.svd(a, compute_uv=False)
        k = len(values)
        assert k == min(4, np.linalg.matrix_rank(a))
        if k:
            assert np.allclose(values, true[:k], rtol=1e-12, atol=1e-13 * true[0])
            assert np.abs(a.T @ (a @ vectors) - vectors * values**2).max() < 1e-11 * true[0] ** 2
            assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-10


def test_small_singular_values_are_relatively_accurate():
    diagonal, upper = np.array([1.0, 1e-3, 1e-6, 1e-9]), np.array([1e-2, 1e-5, 1e-8])
    values = whitening.dqds(diagonal, upper)
    assert np.isclose(np.prod(values), np.prod(diagonal), rtol=1e-12)
    assert np.isclose(values[-1], 1e-9, rtol=1e-3) and list(values) == sorted(values, reverse=True)


VECTORS = "vec_id long, embedding array<float>, label int, v long, cls string, head string, copies string, x string"


def vectors(n=300, width=12, seed=5):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, width)) * np.linspace(2, 0.2, width)
    rows = [(i * 2 - 3, base[i].tolist(), int(rng.integers(0, 3))) for i in range(n)]
    for i in range(60):  # near and exact copies, one large group
        of = base[7 if i < 30 else i]
        rows.append((5000 + i, (of + rng.normal(size=width) * (0 if i % 3 == 0 else 0.05)).tolist(), rows[7 if i < 30 else i][2]))
    nan, inf = float("nan"), float("inf")
    rows += [(9000, None, 1), (9001, [nan] * width, 1), (9002, [inf] + [0.0] * (width - 1), 1), (9003, [0.0] * width, 1), (9004, [None] + [1.0] * (width - 1), 0)]
    rows += [(9005, rows[3][1], None), (None, rows[3][1], rows[3][2]), rows[4], rows[4], (9006, [-0.0] + rows[5][1][1:], rows[5][2]), (9007, [0.0] + rows[5][1][1:], rows[5][2])]
    rows += [(9008, [v * 3 for v in rows[6][1]], rows[6][2]), (9009, [v * 1e20 for v in rows[6][1]], rows[6][2]), (9010, [v * 1e-20 for v in rows[6][1]], rows[6][2])]
    return [(*r, 1, "a", "b", "c", "d") for r in rows]


def test_whitening_as_in_numpy(spark):
    rows = [r for r in vectors() if r[0] != 9009]
    frame = spark.createDataFrame(rows, VECTORS).repartition(5)
    got = whitening.whiten(frame).toPandas()
    usable = [r for r in rows if r[1] and None not in r[1] and np.isfinite(np.array(r[1])).all()]
    x = np.floor(256 * np.array([r[1] for r in usable], np.float32).astype(np.float64))
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(fit))
    values, axes = values[::-1], axes[:, ::-1]
    assert len(got) == 4 * len(usable) and set(got["n"]) == {len(fit)}
    assert (got["identity_error"] < 1e-9).all() and got["identity_error"].nunique() == 1
    sums = [int(s) for s in fit.sum(axis=0)]
    exact = sorted(sum((len(fit) * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x)
    for k in range(4):
        part = got[got["component"] == k + 1]
        assert sorted(part["deviation"]) == exact
        assert np.allclose(part["explained"], values[k] / values.sum(), rtol=1e-9)
        want = dict(zip([r[0] for r in usable], (x - fit.mean(axis=0)) @ axes[:, k] / np.sqrt(values[k]), strict=True))
        have = part["whitened"].to_numpy(), np.array([want[None if np.isnan(i) else i] for i in part["vec_id"]])
        assert np.allclose(have[0], np.sign(have[0] @ have[1]) * have[1], atol=1e-9)


def test_whitening_in_many_parts_and_of_odd_tables(spark, monkeypatch):
    frame = spark.createDataFrame(vectors(), VECTORS).filter("vec_id <> 9009").repartition(9)
    rows = whitening.scaled(frame)
    monkeypatch.setattr(whitening, "FAN", 2)  # so triangles are stacked in several rounds
    small, _ = whitening.fit(rows)
    monkeypatch.undo()
    large, _ = whitening.fit(rows)
    assert np.allclose(small.values, large.values, rtol=1e-12) and small.sums == large.sums
    assert whitening.whiten(frame.limit(0)).collect() == []
    assert whitening.whiten(frame.filter("vec_id = 9003")).collect() == []  # one vector has no variance
    mixed = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0]), (None, [0.5, 0.5, 7.0]), (4, [])], "vec_id long, embedding array<double>")
    found = whitening.whiten(mixed).toPandas()
    assert set(found["n"]) == {4} and set(found["component"]) == {1, 2, 3}
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(huge).filter("deviation is null").count() == 2  # beyond a long


# --- near-dedup


def embeddings_by_sql(rows):
    con = duckdb.connect()
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
    kinds = pa.int64(), pa.list_(pa.float32()), pa.int32()
    con.register("embeddings", pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=False)], ["vec_id", "embedding", "label"]))
    cursor = con.execute(queries.ORACLES["op13_embedding_dedup"])
    return [c[0] for c in cursor.description], sorted(map(str, cursor.fetchall()))


@pytest.mark.parametrize(("block", "tile", "step"), [(4096, 512, 16), (32, 8, 4), (1, 3, 5)])
def test_dedup_as_in_sql(spark, monkeypatch, block, tile, step):
    for name, value in (("BLOCK", block), ("TILE", tile), ("STEP", step)):
        monkeypatch.setattr(embedding_dedup, name, value)
    rows = vectors(60 if block == 1 else 300)
    names, want = embeddings_by_sql([r[:3] for r in rows])
    got = embedding_dedup.dedup(spark.createDataFrame(rows, VECTORS).repartition(3)).select(*names).collect()
    assert sorted(str(tuple(r)) for r in got) == want


def test_dedup_of_odd_tables(spark):
    frame = spark.createDataFrame(vectors(), VECTORS)
    assert embedding_dedup.dedup(frame.limit(0)).collect() == []
    assert [tuple(r) for r in embedding_dedup.dedup(frame.filter("vec_id = 9001")).collect()] == [(9001, 0, 9001, True)]
    mixed = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0], 1), (3, [1.0, 2.0, 0.0], 1), (4, [], 1), (None, [2.0], 1)], "vec_id long, embedding array<double>, label int")
    rows = sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.dedup(mixed).collect())
    assert rows == [("1", 0, 1, True), ("2", 1, 2, True), ("3", 0, 3, True), ("4", 0, 4, True), ("None", 1, 2, False)]


def test_tiles_stop_early_and_lose_nothing():
    rng = np.random.default_rng(1)
    a = embedding_dedup._unit(np.vstack([rng.normal(size=(40, 20)), np.repeat(rng.normal(size=(1, 20)), 60, axis=0) + rng.normal(size=(60, 20)) * 0.03]))
    pairs = {(int(x), int(y)) for i, j in embedding_dedup.near_pairs(a, a, 0.93, True) for x, y in zip(i, j, strict=True)}
    assert pairs == {(i, j) for i, j in itertools.combinations(range(100), 2) if a[i] @ a[j] >= 0.93}
