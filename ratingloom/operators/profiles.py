"""Models whose user vector comes from the history, trained over routed blocks.

An iteration adds item vectors up per user into a profile, takes the gradients of both sides from the errors, and
gives each user's summed gradient back to the items of the history. Where every history lies in one block of
``routed``, that is one local pass, and user vectors stay with their block; where a history is spread over several
blocks, it is three, with the sums per user added up in between. A vector travels once per block that needs it, never
with a rating. Gradients are means per
id, and a history vector takes the mean over the ratings of all histories that hold the item.

Defined results: rows with a null id or rating (for FISM a null id) are left out, and an id that has only such rows
keeps its first vector; an empty table trains to an empty state; a pair that occurs twice counts twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.operators import routed
from ratingloom.operators.gradient import (
    ITEM,
    USER,
    Factors,
    Joiner,
    Layout,
    RatingModel,
    _mean,
    inner,
    run_iterations,
    start,
)
from ratingloom.operators.routed import Blocks, sums_pass, whole_sums, with_ones
from ratingloom.session import delete_path, materialise, scratch_path

Keep = Callable[[DataFrame, str], DataFrame]


def _side(state: DataFrame, side: str, *slices: Column) -> DataFrame:
    """id, v of one side; with ``slices`` only these parts of the vectors."""
    return state.filter(F.col("side") == side).select("id", (F.concat(*slices) if slices else F.col("v")).alias("v"))


def _rooted(sums: DataFrame, name: str) -> DataFrame:
    """id, n, and the sums times n^-1/2."""
    return sums.select("id", "n", F.transform("g", lambda x: x / F.sqrt("n")).alias(name))


def _share(sums: str, n: str) -> Column:
    """Mean per update; 0 without an update."""
    return F.transform(sums, lambda x: F.when(F.col(n) > 0, x / F.col(n)).otherwise(0.0))


def _descended(side: str, rows: DataFrame, layout: Layout, lr: float, reg: dict[str, float], gradient: Column) -> DataFrame:
    """side, id, v + lr * (gradient - reg * v); a row without a gradient stays as it is."""
    shrink = F.array(*[F.lit(1.0 - lr * lam) for lam in layout.per_entry(reg)])
    moved = F.zip_with(F.zip_with("v", shrink, lambda v, s: v * s), gradient, lambda v, g: v + F.lit(lr) * g)
    return rows.select(F.lit(side).alias("side"), "id", F.coalesce(moved, F.col("v")).alias("v"))


def _with_returned(sums: DataFrame, width: int, returned: DataFrame) -> DataFrame:
    """Items' sums (id, n, g, m, h) of the second and the third pass."""
    back = returned.select("id", F.col("n").alias("m"), F.col("g").alias("h"))
    return whole_sums(sums, ITEM, width).join(back, "id")


def _iterate(factors: Factors, step: Callable[[Factors, Keep], DataFrame], iterations: int, track, model=None) -> Factors:
    """Each iteration's tables lie in one folder, which goes once the next state is written."""
    spark = factors.state.sparkSession

    def one(f: Factors) -> Factors:
        folder = scratch_path(spark, "iteration")

        def keep(df: DataFrame, name: str) -> DataFrame:
            df.write.parquet(f"{folder}/{name}")
            return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

        state = materialise(step(f, keep), "state")
        delete_path(spark, folder)
        return replace(f, state=state)

    return run_iterations(factors, one, iterations, track, model)


def _iterate_locally(
    factors: Factors, blocks: Blocks, kernel: routed.LocalKernel, parts: tuple[int, int], shrink: tuple, iterations: int, track, model=None
) -> Factors:
    """Iterations of one local pass each, for histories that lie in one block.

    An item's sums of the kernel are g, then h, ``parts`` entries long, then m, the weight of h. ``shrink``: the learning
    rate and the item weights by name.
    """
    spark, (lr, reg) = factors.state.sparkSession, shrink
    known = factors.state.select("side", F.col("id").cast("long").alias("id"), "v")
    widths = factors.user.width, factors.item.width
    lam = np.array(factors.item.per_entry(reg))
    users = _side(known, USER)
    unrated = users.join(blocks.flags.select("id").hint("merge"), "id", "left_anti").select(F.lit(USER).alias("side"), "id", "v")
    nameless = known.filter((F.col("side") == ITEM) & F.col("id").isNull())
    still = materialise(unrated.unionByName(nameless), "still")
    packed = materialise(blocks.placed(users, widths[0]), "placed") if widths[0] else None
    items, folders, written = _side(known, ITEM).filter("id IS NOT NULL"), [], None

    def update(v, g, n):
        m = g[:, -1:]
        pushed = np.where(m > 0, g[:, parts[0] : -1] / np.where(m > 0, m, 1.0), 0.0)
        return v * (1.0 - lr * lam) + lr * np.concatenate([g[:, : parts[0]] / n, pushed], axis=1)

    def state() -> DataFrame:
        rows = items.select(F.lit(ITEM).alias("side"), "id", "v").unionByName(still)
        if packed is None:
            return rows
        return routed.owner_rows(written, widths[0]).select(F.lit(USER).alias("side"), "id", "v").unionByName(rows)

    def step(f: Factors) -> Factors:
        nonlocal packed, items, written
        folders.append(scratch_path(spark, "iteration"))
        routed.local_pass(blocks, packed, items, widths, kernel).write.parquet(f"{folders[-1]}/pass")
        written = spark.read.schema(routed.LOCAL).parquet(f"{folders[-1]}/pass")
        sums = written.filter(F.col("side") == ITEM).select("id", "n", "g")
        routed.descended(items, sums, widths[1], sum(parts) + 1, update).write.parquet(f"{folders[-1]}/items")
        items = spark.read.schema("id long, v array<double>").parquet(f"{folders[-1]}/items")
        if packed is not None:
            packed = written.filter(F.col("side") == USER).select(F.col("id").alias("block"), "p")
        if len(folders) > 2:  # the changes are taken from the last two states
            delete_path(spark, folders[-3])
        return replace(f, state=state())

    done = run_iterations(factors, step, iterations, track, model)
    if folders:
        done = replace(done, state=materialise(done.state, "state"))
        for folder in folders[-2:]:
            delete_path(spark, folder)
    return done


# ---- SVD++ -------------------------------------------------------------------------------------


def _implicit(blocks: Blocks, f: Factors) -> DataFrame:
    """id, n, z = |N|^-1/2 * sum of the y vectors of the user's items."""
    k = f.item.widths["y"]

    def kernel(p, q, o, t, r):
        return None, {USER: (None, q[t])}

    y = _side(f.state, ITEM, f.item.slice("v", "y"))
    return _rooted(whole_sums(sums_pass(blocks, blocks.flags, y, (1, k), kernel), USER, k), "z")


def _svdpp_prediction(f: Factors) -> Column:
    profile = [p + F.col("z")[x] for x, p in enumerate(f.user.vector("uv", "p"))]
    return F.lit(f.mean) + f.user.get("uv", "b") + f.item.get("iv", "b") + inner(profile, f.item.vector("iv", "q"))


def fit_svdpp(
    ratings: DataFrame,
    k: int = 2,
    iterations: int = 20,
    lr: float = 0.005,
    lambda_p: float = 0.02,
    lambda_q: float = 0.02,
    lambda_y: float = 0.02,
    lambda_bu: float = 0.02,
    lambda_bi: float = 0.02,
    seed: int = 0,
    track: bool = False,
) -> RatingModel:
    """mean + b_u + b_i + q_i . (p_u + |N|^-1/2 sum y_j)."""
    joiner = Joiner.of(ratings)
    user, item = Layout(p=k, b=1), Layout(q=k, b=1, y=k)
    mean = _mean(joiner.ratings)
    factors = Factors(start(joiner.ratings, user, item, seed, 2.0 / k, -0.5), user, item, mean)
    blocks = Blocks.of(joiner.ratings)
    reg = {USER: {"p": lambda_p, "b": lambda_bu}, ITEM: {"q": lambda_q, "b": lambda_bi, "y": lambda_y}}

    def errors(p, q, o, t, r):
        x, c = p[o], q[t]
        err = r - mean - x[:, k] - c[:, k] - np.einsum("ij,ij->i", x[:, :k], c[:, :k])
        x[:, k], c[:, k] = 1.0, 1.0
        return err, {USER: (None, err[:, None] * c), ITEM: (None, err[:, None] * x)}

    def back(p, q, o, t, r):
        return None, {ITEM: (p[o, k], p[o, :k])}

    lam_u = np.array(user.per_entry(reg[USER]))

    def whole(p, q, cells, r):
        n = cells.owner_counts[:, None]
        x = p[:, :k] + cells.to_owners(None, q[:, k + 1 :]) / np.sqrt(n)
        err = r - mean - p[cells.o, k] - q[cells.t, k] - cells.products(x, q[:, :k])
        g = cells.to_owners(err, with_ones(q[:, :k]))
        back = cells.to_others(None, g[:, :k] / np.sqrt(n)), cells.other_sums(n[cells.o, 0])[:, None]
        new = p * (1.0 - lr * lam_u) + lr * (g / n)
        return new, 0.0, None, cells.other_counts, np.concatenate([cells.to_others(err, with_ones(x)), *back], axis=1), None

    def passes(f: Factors, keep: Keep, old_users: DataFrame) -> tuple[DataFrame, DataFrame]:
        profiled = old_users.join(_implicit(blocks, f), "id").select(
            "id", F.concat(F.zip_with(f.user.slice("v", "p"), "z", lambda a, b: a + b), F.array(f.user.get("v", "b"))).alias("v")
        )
        scored = _side(f.state, ITEM, f.item.slice("v", "q"), f.item.slice("v", "b"))
        sums = keep(sums_pass(blocks, profiled, scored, (k + 1, k + 1), errors), "sums")
        users = keep(whole_sums(sums, USER, k + 1), "users")
        pushed = users.select("id", F.concat(F.transform(F.slice("g", 1, k), lambda x: x / F.sqrt("n")), F.array("n")).alias("v"))
        none = _side(f.state, ITEM, F.array(F.lit(0.0)))
        returned = whole_sums(sums_pass(blocks, pushed, none, (k + 1, 1), back), ITEM, k)
        return users, _with_returned(sums, k + 1, returned)

    def step(f: Factors, keep: Keep) -> DataFrame:
        old_users, old_items = _side(f.state, USER), _side(f.state, ITEM)
        users, items = passes(f, keep, old_users)
        return _descended(USER, old_users.join(users, "id", "left"), user, lr, reg[USER], _share("g", "n")).unionByName(
            _descended(ITEM, old_items.join(items, "id", "left"), item, lr, reg[ITEM], F.concat(_share("g", "n"), _share("h", "m")))
        )

    def profile(_: Joiner, f: Factors) -> DataFrame:
        return _implicit(blocks, f).select(F.col("id").alias("user_id"), "z")

    model = RatingModel(factors, joiner, _svdpp_prediction, profile)
    if blocks.any_split:
        model.factors = _iterate(factors, step, iterations, track, model)
    else:
        model.factors = _iterate_locally(factors, blocks, whole, (k + 1, k), (lr, reg[ITEM]), iterations, track, model)
    return model


# ---- asymmetric SVD ----------------------------------------------------------------------------


def _asymmetric(blocks: Blocks, f: Factors) -> DataFrame:
    """id, n, z = n^-1/2 * sum of (r - mean - b_u - b_j) x_j + y_j over the user's ratings."""
    k, mean = f.item.widths["y"], f.mean

    def kernel(p, q, o, t, r):
        gap = r - mean - p[o, 0] - q[t, 0]
        return None, {USER: (None, gap[:, None] * q[t, 1 : k + 1] + q[t, k + 1 :])}

    parts = _side(f.state, ITEM, *[f.item.slice("v", name) for name in ("b", "x", "y")])
    return _rooted(whole_sums(sums_pass(blocks, _side(f.state, USER), parts, (1, 2 * k + 1), kernel), USER, k), "z")


def _asvd_prediction(f: Factors) -> Column:
    z = [F.col("z")[c] for c in range(f.item.widths["q"])]
    return F.lit(f.mean) + f.user.get("uv", "b") + f.item.get("iv", "b") + inner(z, f.item.vector("iv", "q"))


def fit_asvd(
    ratings: DataFrame,
    k: int = 20,
    iterations: int = 20,
    lr: float = 0.005,
    lambda_q: float = 0.02,
    lambda_x: float = 0.02,
    lambda_y: float = 0.02,
    lambda_bu: float = 0.02,
    lambda_bi: float = 0.02,
    seed: int = 0,
    track: bool = False,
) -> RatingModel:
    """No user factor: the profile comes from the residuals and the items of the history."""
    joiner = Joiner.of(ratings)
    user, item = Layout(b=1), Layout(q=k, b=1, x=k, y=k)
    mean = _mean(joiner.ratings)
    factors = Factors(start(joiner.ratings, user, item, seed, 2.0 / k, -0.5), user, item, mean)
    blocks = Blocks.of(joiner.ratings)
    reg = {USER: {"b": lambda_bu}, ITEM: {"q": lambda_q, "b": lambda_bi, "x": lambda_x, "y": lambda_y}}

    def errors(p, q, o, t, r):
        x, c = p[o], q[t]
        err = r - mean - x[:, k] - c[:, k] - np.einsum("ij,ij->i", x[:, :k], c[:, :k])
        x[:, k], c[:, k] = 1.0, 1.0
        return err, {USER: (None, err[:, None] * c), ITEM: (None, err[:, None] * x)}

    def back(p, q, o, t, r):
        """p: the user's gradient over the root of n, then n and b_u; q: b_i."""
        gap = r - mean - p[o, k + 1] - q[t, 0]
        given = p[o, :k]
        return None, {ITEM: (p[o, k], np.concatenate([gap[:, None] * given, given], axis=1))}

    def whole(p, q, cells, r):
        n = cells.owner_counts[:, None]
        gap = r - mean - p[cells.o, 0] - q[cells.t, k]
        z = (cells.to_owners(gap, q[:, k + 1 : 2 * k + 1]) + cells.to_owners(None, q[:, 2 * k + 1 :])) / np.sqrt(n)
        err = gap - cells.products(z, q[:, :k])
        g = cells.to_owners(err, with_ones(q[:, :k]))
        given = g[:, :k] / np.sqrt(n)
        back = cells.to_others(gap, given), cells.to_others(None, given), cells.other_sums(n[cells.o, 0])[:, None]
        new = p * (1.0 - lr * lambda_bu) + lr * (g[:, k:] / n)
        return new, 0.0, None, cells.other_counts, np.concatenate([cells.to_others(err, with_ones(z)), *back], axis=1), None

    def passes(f: Factors, keep: Keep, old_users: DataFrame) -> tuple[DataFrame, DataFrame]:
        profiled = old_users.join(_asymmetric(blocks, f), "id").select("id", F.concat("z", "v").alias("v"))
        scored = _side(f.state, ITEM, f.item.slice("v", "q"), f.item.slice("v", "b"))
        sums = keep(sums_pass(blocks, profiled, scored, (k + 1, k + 1), errors), "sums")
        users = keep(whole_sums(sums, USER, k + 1), "users")
        pushed = users.join(old_users, "id").select(
            "id", F.concat(F.transform(F.slice("g", 1, k), lambda x: x / F.sqrt("n")), F.array("n"), "v").alias("v")
        )
        biases = _side(f.state, ITEM, f.item.slice("v", "b"))
        returned = whole_sums(sums_pass(blocks, pushed, biases, (k + 2, 1), back), ITEM, 2 * k)
        return users, _with_returned(sums, k + 1, returned)

    def step(f: Factors, keep: Keep) -> DataFrame:
        old_users, old_items = _side(f.state, USER), _side(f.state, ITEM)
        users, items = passes(f, keep, old_users)
        bias = F.slice(_share("g", "n"), k + 1, 1)
        return _descended(USER, old_users.join(users, "id", "left"), user, lr, reg[USER], bias).unionByName(
            _descended(ITEM, old_items.join(items, "id", "left"), item, lr, reg[ITEM], F.concat(_share("g", "n"), _share("h", "m")))
        )

    def profile(_: Joiner, f: Factors) -> DataFrame:
        return _asymmetric(blocks, f).select(F.col("id").alias("user_id"), "z")

    model = RatingModel(factors, joiner, _asvd_prediction, profile)
    if blocks.any_split:
        model.factors = _iterate(factors, step, iterations, track, model)
    else:
        model.factors = _iterate_locally(factors, blocks, whole, (k + 1, 2 * k), (lr, reg[ITEM]), iterations, track, model)
    return model


# ---- FISM --------------------------------------------------------------------------------------


def fism_norm(n: Column, alpha: float) -> Column:
    return F.when(n > 0, F.pow(n.cast("double"), F.lit(-alpha))).otherwise(F.lit(0.0))


def _fism_errors(k: int, alpha: float, p: np.ndarray, q: np.ndarray, o: np.ndarray, t: np.ndarray):
    """Error of every positive (target 1), the norm of its history, and the sum of the history's other p vectors.

    p: sum of the history's p vectors, then its size; q: q, bias, p of the item.
    """
    size = p[:, k] - 1
    norm = np.where(size > 0, np.maximum(size, 1.0) ** -alpha, 0.0)[o]
    others = p[o, :k] - q[t, k + 1 :]
    return 1.0 - q[t, k] - norm * np.einsum("ij,ij->i", others, q[t, :k]), norm, others


@dataclass
class HistoryModel:
    """Item-only model: an item's score comes from the sum of the history's p vectors."""

    factors: Factors
    joiner: Joiner
    alpha: float
    blocks: Blocks

    def sums(self) -> DataFrame:
        """user_id, s = sum of the p vectors of the user's items, n_u."""
        return self._totals().select(F.col("id").alias("user_id"), F.col("g").alias("s"), F.col("n").cast("long").alias("n_u"))

    def _totals(self) -> DataFrame:
        k = self.factors.item.widths["p"]

        def kernel(p, q, o, t, r):
            return None, {USER: (None, q[t])}

        p = _side(self.factors.state, ITEM, self.factors.item.slice("v", "p"))
        return whole_sums(sums_pass(self.blocks, self.blocks.flags, p, (1, k), kernel), USER, k)

    def profiled(self) -> DataFrame:
        """id, v: the sum of the history and its size."""
        return self._totals().select("id", F.concat("g", F.array("n")).alias("v"))

    def score(self, pairs: DataFrame) -> DataFrame:
        """Own vector taken out of the sum for items of the history, whole sum for others."""
        f, k = self.factors, self.factors.item.widths["p"]
        marked = pairs.select("user_id", "item_id").join(
            self.joiner.ratings.select("user_id", "item_id", F.lit(True).alias("_seen")), ["user_id", "item_id"], "left"
        )
        met = self.joiner.with_users(self.joiner.with_items(marked, f.items()), self.sums())
        own = F.when(F.col("_seen"), 1).otherwise(0)
        rest = [F.col("s")[c] - own * x for c, x in enumerate(f.item.vector("iv", "p"))]
        norm = fism_norm(F.col("n_u") - own, self.alpha)
        value = f.item.get("iv", "b") + norm * inner(rest[:k], f.item.vector("iv", "q"))
        return met.select("user_id", "item_id", value.alias("score"))

    def similarity(self, pairs: DataFrame) -> DataFrame:
        """Learned similarity p_i . q_j of given (item_i, item_j) pairs."""
        f = self.factors
        left = f.items().select(F.col("item_id").alias("item_i"), f.item.slice("iv", "p").alias("_p"))
        right = f.items().select(F.col("item_id").alias("item_j"), f.item.slice("iv", "q").alias("_q"))
        k = f.item.widths["p"]
        value = inner([F.col("_p")[c] for c in range(k)], [F.col("_q")[c] for c in range(k)])
        return pairs.join(left, "item_i").join(right, "item_j").select("item_i", "item_j", value.alias("sim"))

    def loss(self, lam: float) -> DataFrame:
        """Sum of squared errors on the positives plus lambda/2 times the squared parameters; 0 without positives."""
        k, alpha = self.factors.item.widths["p"], self.alpha

        def kernel(p, q, o, t, r):
            return _fism_errors(k, alpha, p, q, o, t)[0], {}

        items = _side(self.factors.state, ITEM)
        found = sums_pass(self.blocks, self.profiled(), items, (k + 1, 2 * k + 1), kernel).filter(F.col("side") == "loss")
        fit = found.agg(F.coalesce(F.sum(F.col("g")[0]), F.lit(0.0)).alias("fit"))
        length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
        size = items.agg(F.coalesce(F.sum(length), F.lit(0.0)).alias("size"))
        return fit.select((F.col("fit") + F.lit(0.5 * lam) * size.scalar()).alias("loss"))


def fit_fism(
    ratings: DataFrame,
    k: int,
    iterations: int = 100,
    lr: float = 0.01,
    lam: float = 0.01,
    alpha: float = 0.5,
    seed: int = 0,
) -> HistoryModel:
    """b_i + (n - 1)^-alpha * (sum of the other items' p) . q_i with target 1 on the positives."""
    joiner = Joiner.of(ratings)
    user, item = Layout(), Layout(q=k, b=1, p=k)
    state = start(joiner.ratings, user, item, seed, 2.0 / k, -0.5).filter(F.col("side") == ITEM)
    blocks = Blocks.of(joiner.ratings.withColumn("rating", F.lit(1.0)))
    model = HistoryModel(Factors(state, user, item), joiner, alpha, blocks)

    def errors(p, q, o, t, r):
        err, norm, others = _fism_errors(k, alpha, p, q, o, t)
        to_item = np.concatenate([(err * norm)[:, None] * others, err[:, None]], axis=1)
        return None, {USER: (None, err[:, None] * q[t, :k]), ITEM: (None, to_item)}

    def back(p, q, o, t, r):
        """The other items of a history push on this one: all errors but its own, over n - 1 updates."""
        err, norm, _ = _fism_errors(k, alpha, p[:, : k + 1], q, o, t)
        return None, {ITEM: (p[o, k] - 1, norm[:, None] * (p[o, k + 1 :] - err[:, None] * q[t, :k]))}

    def whole(p, q, cells, r):
        rest = cells.owner_counts - 1
        norm = np.where(rest > 0, np.maximum(rest, 1.0) ** -alpha, 0.0)[cells.o]
        total, own = cells.to_owners(None, q[:, k + 1 :]), (q[:, :k] * q[:, k + 1 :]).sum(axis=1)
        err = 1.0 - q[cells.t, k] - norm * (cells.products(total, q[:, :k]) - own[cells.t])
        scaled = err * norm
        less = cells.other_sums(scaled)[:, None]
        to_q = cells.to_others(scaled, total) - less * q[:, k + 1 :]
        to_p = cells.to_others(norm, cells.to_owners(err, q[:, :k])) - less * q[:, :k]
        found = to_q, cells.other_sums(err)[:, None], to_p, cells.other_sums(rest[cells.o])[:, None]
        return None, 0.0, None, cells.other_counts, np.concatenate(found, axis=1), None

    def passes(f: Factors, keep: Keep, items: DataFrame) -> DataFrame:
        users = keep(replace(model, factors=f).profiled(), "profiles")
        sums = keep(sums_pass(blocks, users, items, (k + 1, 2 * k + 1), errors), "sums")
        pushed = users.join(whole_sums(sums, USER, k), "id").select("id", F.concat("v", "g").alias("v"))
        returned = whole_sums(sums_pass(blocks, pushed, items, (2 * k + 1, 2 * k + 1), back), ITEM, k)
        return _with_returned(sums, k + 1, returned)

    def step(f: Factors, keep: Keep) -> DataFrame:
        items = _side(f.state, ITEM)
        met = passes(f, keep, items)
        gradient = F.concat(_share("g", "n"), _share("h", "m"))
        return _descended(ITEM, items.join(met, "id", "left"), item, lr, {"q": lam, "b": lam, "p": lam}, gradient)

    if blocks.any_split:
        model.factors = _iterate(model.factors, step, iterations, False)
    else:
        model.factors = _iterate_locally(model.factors, blocks, whole, (k + 1, k), (lr, {"q": lam, "b": lam, "p": lam}), iterations, False)
    return model
