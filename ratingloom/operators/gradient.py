"""Factor models trained by gradient steps (T1, M3, M5, M6, M8, X3-X5); helpers of the ranking models.

One iteration is one pass: ratings meet the parameter rows of their user and item, every rating yields a
gradient row per side, and the rows are summed per id (map-side combined) and applied. Gradients are
divided by the number of updates of the id, so popular ids do not overshoot. Parameters start from a
formula of (id, factor, seed) and each iteration's state is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.columns import dot, mix_unit
from ratingloom.operators import routed
from ratingloom.session import materialise
from ratingloom.skew import hot_keys, salted_join

USER, ITEM, SHARED = "u", "i", "w"


class Layout:
    """Named slices of a parameter vector."""

    def __init__(self, **widths: int):
        self.widths = widths
        self.starts: dict[str, int] = {}
        at = 0
        for name, width in widths.items():
            self.starts[name] = at
            at += width
        self.width = at

    def get(self, vec: str, name: str, f: int = 0) -> Column:
        return F.col(vec)[self.starts[name] + f]

    def vector(self, vec: str, name: str) -> list[Column]:
        return [self.get(vec, name, f) for f in range(self.widths[name])]

    def slice(self, vec: str, name: str) -> Column:
        return F.slice(F.col(vec), self.starts[name] + 1, self.widths[name])

    def per_entry(self, values: dict[str, float]) -> list[float]:
        return [values.get(name, 0.0) for name, width in self.widths.items() for _ in range(width)]


def inner(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Inner product written out, so that it stays inside generated code."""
    total = a[0] * b[0]
    for x, y in zip(a[1:], b[1:]):
        total = total + x * y
    return total


@dataclass
class Factors:
    """A fitted model: state rows (side, id, v), the layouts that name the slices, and the global mean."""

    state: DataFrame
    user: Layout
    item: Layout
    mean: float = 0.0
    history: list[dict] = field(default_factory=list)
    snapshots: DataFrame | None = None

    def users(self) -> DataFrame:
        return self.state.filter(F.col("side") == USER).select(F.col("id").alias("user_id"), F.col("v").alias("uv"))

    def items(self, prefix: str = "") -> DataFrame:
        return self.state.filter(F.col("side") == ITEM).select(
            F.col("id").alias(f"{prefix}item_id"), F.col("v").alias(f"{prefix}iv")
        )

    def user_table(self, *names: str) -> DataFrame:
        return self.users().select("user_id", *[self.user.slice("uv", n).alias(n) for n in names])

    def item_table(self, *names: str) -> DataFrame:
        return self.items().select("item_id", *[self.item.slice("iv", n).alias(n) for n in names])


def start(
    ratings: DataFrame, user: Layout, item: Layout, seed: int, scale: float, low: float, zero: Sequence[str] = ("b",)
) -> DataFrame:
    """First state: scale * (hash + low) per entry, zero for bias slices."""

    def side(ids: DataFrame, key: str, layout: Layout, name: str, offset: int) -> DataFrame:
        def drawn(f: Column) -> Column:
            return F.lit(scale) * (mix_unit(F.col(key), f, seed + offset) + F.lit(low))

        slices = []
        for slice_name, width in layout.widths.items():
            at = layout.starts[slice_name]
            entry = (lambda f: F.lit(0.0)) if slice_name in zero else drawn
            if width:
                slices.append(F.transform(F.sequence(F.lit(at), F.lit(at + width - 1)), entry))
        vec = F.concat(*slices) if slices else F.array().cast("array<double>")
        return ids.select(F.lit(name).alias("side"), F.col(key).alias("id"), vec.alias("v"))

    users = side(ratings.select("user_id").distinct(), "user_id", user, USER, 0)
    items = side(ratings.select("item_id").distinct(), "item_id", item, ITEM, 1)
    return materialise(users.unionByName(items), "state")


@dataclass
class Joiner:
    """Joins ratings to parameter rows; the hot users and items are looked up once per fit."""

    ratings: DataFrame
    hot_items: list
    hot_users: list

    @classmethod
    def of(cls, ratings: DataFrame) -> Joiner:
        """Keeps the ratings as a written table, so no iteration derives them again."""
        columns = ["user_id", "item_id"] + (["rating"] if "rating" in ratings.columns else [])
        kept = materialise(ratings.select(*columns), "ratings")
        return cls(kept, hot_keys(kept, "item_id"), hot_keys(kept, "user_id"))

    def with_items(self, rows: DataFrame, items: DataFrame) -> DataFrame:
        return salted_join(rows, items, "item_id", "user_id", self.hot_items)

    def with_users(self, rows: DataFrame, users: DataFrame) -> DataFrame:
        return salted_join(rows, users, "user_id", "item_id", self.hot_users)

    def with_both(self, rows: DataFrame, model: Factors) -> DataFrame:
        return self.with_users(self.with_items(rows, model.items()), model.users())


def gradient_sums(rows: DataFrame, parts: Sequence[tuple[str, Column, Sequence[Column], Column | None]]) -> DataFrame:
    """side, id, n, g: gradients of all sides summed in one pass.

    ``parts``: (side, id, gradient entries, weight of the update or None for 1).
    """
    width = max(len(g) for _, _, g, _ in parts)
    zero = F.lit(0.0)
    structs = [
        F.struct(
            F.lit(side).alias("side"),
            id_col.cast("long").alias("id"),
            (F.lit(1.0) if weight is None else weight.cast("double")).alias("n"),
            *[(g[f] if f < len(g) else zero).cast("double").alias(f"g{f}") for f in range(width)],
        )
        for side, id_col, g, weight in parts
    ]
    flat = rows.select(F.inline(F.array(*structs)))
    return flat.groupBy("side", "id").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(f"g{f}") for f in range(width)]).alias("g")
    )


def apply_step(
    model: Factors,
    sums: DataFrame,
    lr: float,
    reg: dict[str, dict[str, float]],
    floor_zero: bool = False,
    shared: Layout | None = None,
) -> Factors:
    """v + lr * (g / n - reg * v); ids without an update keep their row."""
    layouts = {USER: model.user, ITEM: model.item}
    if shared is not None:
        layouts[SHARED] = shared
    joined = model.state.join(sums, ["side", "id"], "left")

    def updated(side: str) -> Column:
        entries = []
        for f, lam in enumerate(layouts[side].per_entry(reg.get(side, {}))):
            new = F.col("v")[f] + F.lit(lr) * (F.col("g")[f] / F.col("n") - F.lit(lam) * F.col("v")[f])
            entries.append(F.greatest(new, F.lit(0.0)) if floor_zero else new)
        return F.array(*entries) if entries else F.col("v")

    new = F.col("v")
    for side in layouts:
        new = F.when(F.col("side") == side, updated(side)).otherwise(new)
    state = joined.select("side", "id", F.when(F.col("n") > 0, new).otherwise(F.col("v")).alias("v"))
    return replace(model, state=materialise(state, "state"))


def change_norms(old: DataFrame, new: DataFrame) -> DataFrame:
    """Frobenius norm of the change per side."""
    both = new.select("side", "id", F.col("v").alias("v1")).join(old.select("side", "id", F.col("v").alias("v0")), ["side", "id"])
    moved = F.aggregate(F.zip_with("v1", "v0", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    return both.groupBy("side").agg(F.sqrt(F.sum(moved)).alias("change"))


# ---- predictions -------------------------------------------------------------------------------


@dataclass
class RatingModel:
    """A fitted rating model and the expression of its prediction over joined rows."""

    factors: Factors
    joiner: Joiner
    predict: Callable[[Factors], Column]
    profile: Callable[[Joiner, Factors], DataFrame] | None = None

    def joined(self, rows: DataFrame) -> DataFrame:
        met = self.joiner.with_both(rows, self.factors)
        if self.profile is not None:
            met = self.joiner.with_users(met, self.profile(self.joiner, self.factors))
        return met

    def score(self, pairs: DataFrame) -> DataFrame:
        """Scores of (user_id, item_id) pairs; pairs with an unknown user or item have no row."""
        return self.joined(pairs.select("user_id", "item_id")).select(
            "user_id", "item_id", self.predict(self.factors).alias("score")
        )

    def train_rmse(self) -> DataFrame:
        err = F.col("rating") - self.predict(self.factors)
        return self.joined(self.joiner.ratings).agg(F.sqrt(F.avg(err * err)).alias("rmse"))

    def block_factors(self) -> tuple[DataFrame, DataFrame]:
        """user_id, p and item_id, q for block scoring of plain p.q models."""
        f = self.factors
        return (
            f.users().select("user_id", f.user.slice("uv", "p").alias("p")),
            f.items().select("item_id", f.item.slice("iv", "q").alias("q")),
        )


def run_iterations(
    factors: Factors, step: Callable[[Factors], Factors], iterations: int, track: bool = False, model: RatingModel | None = None
) -> Factors:
    """Applies ``step`` to the factors again and again; ``track`` records the error of ``model`` and the changes."""
    for number in range(1, iterations + 1):
        old = factors.state
        factors = step(factors)
        if track:
            changes = {r["side"]: r["change"] for r in change_norms(old, factors.state).collect()}
            rmse = replace(model, factors=factors).train_rmse().first()["rmse"]
            entry = {"iteration": number, "rmse": rmse, "p_change": changes.get(USER), "q_change": changes.get(ITEM)}
            factors.history.append(entry)
    return factors


def _routed_run(
    model: RatingModel,
    kernel: routed.Kernel,
    iterations: int,
    lr: float,
    reg: dict[str, float],
    floor_zero: bool,
    track: bool,
    tol: float,
    keep: Sequence[int],
) -> RatingModel:
    """Trains over routed blocks; users and items have vectors of one width."""
    f = model.factors
    blocks = routed.Blocks.of(model.joiner.ratings)
    done = routed.train(blocks, f.state, f.user.width, kernel, iterations, lr, reg, floor_zero, track, tol, keep)
    model.factors = replace(f, state=done.state, history=done.history, snapshots=done.snapshots)
    return model


def _mean(ratings: DataFrame) -> float:
    return float(ratings.agg(F.avg("rating")).first()[0] or 0.0)


def _plain_prediction(f: Factors) -> Column:
    return inner(f.user.vector("uv", "p"), f.item.vector("iv", "q"))


def fit_funk_svd(
    ratings: DataFrame,
    k: int,
    iterations: int = 100,
    lr: float = 0.005,
    lambda_p: float = 0.02,
    lambda_q: float = 0.02,
    seed: int = 0,
    non_negative: bool = False,
    scale: float | None = None,
    track: bool = False,
    tol: float = 0.0,
    keep: Sequence[int] = (),
) -> RatingModel:
    """Squared error with L2 on both factors; with ``non_negative`` the factors are clipped at 0 (NMF).

    Separate lambdas make it probabilistic matrix factorisation. ``tol`` ends the training at rest, ``keep`` names
    the iterations whose factors stay in ``factors.snapshots``.
    """
    joiner = Joiner.of(ratings)
    ratings = joiner.ratings
    user, item = Layout(p=k), Layout(q=k)
    scale = scale if scale is not None else (1.0 if non_negative else 2.0 / k)
    state = start(ratings, user, item, seed, scale, 0.0 if non_negative else -0.5)
    model = RatingModel(Factors(state, user, item), joiner, _plain_prediction)
    kernel, reg = routed.squared_error(k), {USER: lambda_p, ITEM: lambda_q}
    return _routed_run(model, kernel, iterations, lr, reg, non_negative, track, tol, keep)


def fit_nmf(ratings: DataFrame, k: int, iterations: int = 50, lr: float = 0.005, lam: float = 0.02, **kw) -> RatingModel:
    return fit_funk_svd(ratings, k, iterations, lr, lam, lam, non_negative=True, **kw)


def fit_pmf(
    ratings: DataFrame, k: int = 2, iterations: int = 100, lr: float = 0.01, lambda_u: float = 0.1, lambda_v: float = 0.1, **kw
) -> RatingModel:
    return fit_funk_svd(ratings, k, iterations, lr, lambda_u, lambda_v, **kw)


def pmf_loss(model: RatingModel, rows: DataFrame, lambda_u: float = 0.1, lambda_v: float = 0.1) -> DataFrame:
    """Half the squared error over ``rows`` plus half the weighted squared lengths of all users and of all items.

    Rows with an id the model does not know are left out; without any rows the error is 0.
    """
    f = model.factors
    length = F.aggregate(F.col("v"), F.lit(0.0), lambda total, x: total + x * x)
    weight = F.when(F.col("side") == USER, F.lit(lambda_u)).otherwise(F.lit(lambda_v))
    prior = f.state.filter(F.col("side").isin(USER, ITEM)).agg(F.coalesce(F.sum(weight * length), F.lit(0.0)).alias("prior"))
    err = F.col("rating") - model.predict(f)
    error = model.joined(rows).agg(F.coalesce(F.sum(err * err), F.lit(0.0)).alias("error"))
    return error.join(F.broadcast(prior)).select(((F.col("error") + F.col("prior")) / 2).alias("loss"))


def error_curve(model: RatingModel, rows: DataFrame) -> DataFrame:
    """iteration, n, rmse over ``rows`` for every kept state of a plain p.q model (``keep`` at training)."""
    kept = model.factors.snapshots

    def side(name: str, key: str, vec: str) -> DataFrame:
        return kept.filter(F.col("side") == name).select("iteration", F.col("id").alias(key), F.col("v").alias(vec))

    met = rows.select("user_id", "item_id", "rating").join(side(USER, "user_id", "p"), "user_id")
    met = met.join(side(ITEM, "item_id", "q"), ["item_id", "iteration"])
    err = F.col("rating") - dot("p", "q")
    return met.groupBy("iteration").agg(F.count("*").alias("n"), F.sqrt(F.avg(err * err)).alias("rmse"))


def _biased_prediction(f: Factors) -> Column:
    return F.lit(f.mean) + f.user.get("uv", "b") + f.item.get("iv", "b") + _plain_prediction(f)


def fit_biased_mf(
    ratings: DataFrame,
    k: int,
    iterations: int = 20,
    lr: float = 0.005,
    lam: float = 0.02,
    seed: int = 0,
    track: bool = False,
    tol: float = 0.0,
    keep: Sequence[int] = (),
) -> RatingModel:
    """mean + b_u + b_i + p.q with one L2 weight."""
    joiner = Joiner.of(ratings)
    ratings = joiner.ratings
    user, item = Layout(p=k, b=1), Layout(q=k, b=1)
    factors = Factors(start(ratings, user, item, seed, 2.0 / k, -0.5), user, item, _mean(ratings))
    model = RatingModel(factors, joiner, _biased_prediction)

    kernel = routed.squared_error(k, biased=True, mean=factors.mean)
    return _routed_run(model, kernel, iterations, lr, {USER: lam, ITEM: lam}, False, track, tol, keep)


def implicit_profile(joiner: Joiner, f: Factors) -> DataFrame:
    """user_id, z = |N|^-1/2 * sum of the y vectors of the user's items."""
    k = f.item.widths["y"]
    rows = joiner.with_items(joiner.ratings.select("user_id", "item_id"), f.items())
    y = f.item.vector("iv", "y")
    return rows.groupBy("user_id").agg(
        F.array(*[F.sum(y[x]) / F.sqrt(F.count("*")) for x in range(k)]).alias("z"), F.count("*").alias("n_items")
    )


def history_gradients(
    joiner: Joiner, user_sums: DataFrame, k: int, weights: Sequence[Callable[[], Column]], sums: DataFrame, at: Sequence[int]
) -> DataFrame:
    """Second pass for vectors that act through a user's whole history.

    ``user_sums``: user_id, n_u, gu (sum over the user's ratings of error * q). Every item of the user
    receives weight * gu, over n_u updates; the result is placed at entries ``at`` of the item gradients,
    scaled so that the division by the item's own count gives the mean over those updates.
    """
    rows = joiner.with_users(joiner.ratings, user_sums)
    entries = [F.sum(w() * F.col("gu")[x]) / F.sum("n_u") for w in weights for x in range(k)]
    extra = rows.groupBy(F.col("item_id").alias("id")).agg(F.array(*entries).alias("h"))
    width = max(at) + k
    placed = []
    for f in range(width):
        slot = next((j for j, a in enumerate(at) if a <= f < a + k), None)
        placed.append(F.col("g")[f] if slot is None else F.col("h")[slot * k + f - at[slot]] * F.col("n"))
    items = sums.filter(F.col("side") == ITEM).join(extra, "id").select("side", "id", "n", F.array(*placed).alias("g"))
    return sums.filter(F.col("side") != ITEM).unionByName(items)
