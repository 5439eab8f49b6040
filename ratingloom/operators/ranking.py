"""Models trained on positive/negative examples."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.functions.columns import HASH_RANGE, mix, tie_safe
from ratingloom.operators.gradient import (
    ITEM,
    SHARED,
    USER,
    Factors,
    Joiner,
    Layout,
    apply_step,
    gradient_sums,
    history_gradients,
    implicit_profile,
    inner,
    start,
)
from ratingloom.operators.neighbors import cooccurrence_pagerank
from ratingloom.session import materialise
from ratingloom.skew import dense_ids

SLICE = 65_536


class NegativeSampler:
    """Uniform unseen items per positive, without rejection.

    A user with h of n items seen draws a position t among the n - h unseen ones; the t-th unseen item
    has position t plus the number of seen items before it, which a running count finds. A user who has
    seen every item gets no negatives. Positions are cut into slices, so a very active user is several
    groups.
    """

    def __init__(self, ratings: DataFrame):
        self.positives = ratings.select("user_id", "item_id")
        self.places = materialise(dense_ids(ratings, "item_id", "place"), "places")
        self.n_items = self.places.count()
        self.slice = max(SLICE, -(-self.n_items // 100))
        order = Window.partitionBy("user_id", "_part").orderBy("place")
        placed = self.positives.join(self.places, "item_id").withColumn(
            "_part", F.floor(F.col("place") / self.slice).cast("int")
        )
        n_parts = -(-max(self.n_items, 1) // self.slice)
        before = [F.sum(F.when(F.col("_part") < b, 1).otherwise(0)) for b in range(n_parts)]
        self.users = materialise(
            placed.groupBy("user_id").agg(F.count("*").alias("_seen"), F.array(*before).alias("_before")), "seen"
        )
        # coordinate of a seen item on the axis of unseen positions
        marks = placed.withColumn("_rn", F.row_number().over(order) - 1).join(self.users, "user_id")
        coord = F.col("place") - F.col("_rn") - F.col("_before")[F.col("_part")]
        self.marks = materialise(marks.select("user_id", coord.cast("long").alias("pos")), "marks")
        per_slice = (
            self.marks.withColumn("_cut", F.floor(F.col("pos") / self.slice).cast("int"))
            .groupBy("user_id")
            .agg(F.array(*[F.sum(F.when(F.col("_cut") < b, 1).otherwise(0)) for b in range(n_parts)]).alias("_offset"))
        )
        self.offsets = materialise(
            self.users.join(per_slice, "user_id").select(
                "user_id", (F.lit(self.n_items) - F.col("_seen")).alias("_free"), "_offset"
            ),
            "offsets",
        )

    def draw(self, per: int = 1, seed: int = 0, positives: DataFrame | None = None) -> DataFrame:
        """user_id, item_id, draw (1..per), neg."""
        rows = (self.positives if positives is None else positives.select("user_id", "item_id")).join(
            self.offsets.filter(F.col("_free") > 0), "user_id"
        )
        rows = rows.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(per))))
        salt = F.lit(seed) + F.col("draw") * 101
        wide = mix("user_id", "item_id", salt) * F.lit(HASH_RANGE) + mix("item_id", "user_id", salt + 1)
        wanted = rows.withColumn("pos", F.pmod(wide, F.col("_free")).cast("long"))
        cut = F.floor(F.col("pos") / self.slice).cast("int")
        none = F.lit(None)
        both = self.marks.select(
            "user_id", "pos", F.lit(0).alias("kind"), none.cast("long").alias("item_id"), none.cast("int").alias("draw"),
            none.cast("long").alias("_base"),
        ).unionByName(
            wanted.select("user_id", "pos", F.lit(1).alias("kind"), "item_id", "draw",
                          F.col("_offset")[cut].cast("long").alias("_base"))
        ).withColumn("_cut", cut)
        order = Window.partitionBy("user_id", "_cut").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)
        counted = both.withColumn("_passed", F.sum(1 - F.col("kind")).over(order)).filter(F.col("kind") == 1)
        place = F.col("pos") + F.col("_passed") + F.col("_base")
        return (
            counted.withColumn("place", place.cast("long"))
            .join(self.places.withColumnRenamed("item_id", "neg"), "place")
            .select("user_id", "item_id", "draw", "neg")
        )


@dataclass
class PairModel:
    """A model trained on triples: scores are p.q (boosted, profiled) or minus the distance."""

    factors: Factors
    joiner: Joiner
    kind: str
    weights: DataFrame | None = None

    def user_rows(self) -> DataFrame:
        """user_id, x: the vector an item is scored against, next to the raw user vector."""
        users = self.factors.users()
        if self.kind != "profile":
            return users.withColumn("x", self.factors.user.slice("uv", "p"))
        k = self.factors.user.widths["p"]
        joined = users.join(implicit_profile(self.joiner, self.factors), "user_id")
        total = [p + F.col("z")[f] for f, p in enumerate(self.factors.user.vector("uv", "p"))]
        return joined.select("user_id", "uv", "n_items", F.array(*total[:k]).alias("x"))

    def item_rows(self) -> DataFrame:
        """item_id, c: the vector a user is scored against; w: its weight."""
        items = self.factors.items()
        q = self.factors.item.vector("iv", "q")
        if self.weights is None:
            return items.select("item_id", F.array(*q).alias("c"), F.lit(0.0).alias("w"))
        boosted = items.join(self.weights.select("item_id", F.col("weight").alias("w")), "item_id", "left")
        boosted = boosted.withColumn("w", F.coalesce("w", F.lit(0.0)))
        return boosted.select("item_id", F.array(*[x + F.col("w") for x in q]).alias("c"), "w")

    def value(self, x: str, c: str) -> Column:
        k = self.factors.item.widths["q"]
        a, b = [F.col(x)[f] for f in range(k)], [F.col(c)[f] for f in range(k)]
        if self.kind == "margin":
            return -F.sqrt(inner([s - t for s, t in zip(a, b)], [s - t for s, t in zip(a, b)]))
        return inner(a, b)

    def score(self, pairs: DataFrame) -> DataFrame:
        met = self.joiner.with_users(self.joiner.with_items(pairs.select("user_id", "item_id"), self.item_rows()), self.user_rows())
        return met.select("user_id", "item_id", self.value("x", "c").alias("score"))

    def block_factors(self) -> tuple[DataFrame, DataFrame]:
        """user_id, p and item_id, q whose inner product orders items like the score."""
        users, items = self.user_rows().select("user_id", F.col("x").alias("p")), self.item_rows()
        if self.kind != "margin":
            return users, items.select("item_id", F.col("c").alias("q"))
        # -|p - c|^2 = 2 p.c - |c|^2 - |p|^2, and |p|^2 is the same for all items of the user
        size = F.aggregate("c", F.lit(0.0), lambda s, x: s + x * x)
        grown = items.select("item_id", F.concat(F.transform("c", lambda x: 2 * x), F.array(-size)).alias("q"))
        return users.select("user_id", F.concat("p", F.array(F.lit(1.0))).alias("p")), grown


def fit_pairwise(
    ratings: DataFrame,
    k: int,
    iterations: int,
    lr: float = 0.01,
    lambda_p: float = 0.01,
    lambda_q: float = 0.01,
    lambda_y: float = 0.01,
    kind: str = "plain",
    pool: int = 1,
    margin: float = 0.5,
    weights: DataFrame | None = None,
    seed: int = 0,
) -> PairModel:
    """One fresh negative per positive and iteration; simultaneous gradient step.

    kind: plain (logistic on p.(q_i - q_j)), profile (p plus the history's y vectors), margin (hinge on
    distances). ``pool`` > 1 keeps the best-scored of that many negatives. ``weights`` (item_id, weight)
    is added to every factor of the item.
    """
    user = Layout(p=k)
    item = Layout(q=k, y=k) if kind == "profile" else Layout(q=k)
    joiner = Joiner.of(ratings)
    ratings = joiner.ratings
    model = PairModel(Factors(start(ratings, user, item, seed, 0.2, -0.5), user, item), joiner, kind, weights)
    sampler = NegativeSampler(ratings)
    for number in range(1, iterations + 1):
        items = model.item_rows()
        triples = sampler.draw(pool, seed + 1000 * number)
        rival = items.select(F.col("item_id").alias("neg"), F.col("c").alias("cj"), F.col("w").alias("wj"))
        met = joiner.with_users(triples.join(rival, "neg"), model.user_rows())
        if pool > 1:
            order = F.struct(tie_safe(model.value("x", "cj")), -F.col("draw"))
            others = [c for c in met.columns if c not in ("user_id", "item_id")]
            met = met.groupBy("user_id", "item_id").agg(F.max_by(F.struct(*others), order).alias("_b"))
            met = met.select("user_id", "item_id", "_b.*")
        own = items.select("item_id", F.col("c").alias("ci"), F.col("w").alias("wi"))
        rows = joiner.with_items(met, own)
        model.factors = _pair_step(model, rows, k, lr, lambda_p, lambda_q, lambda_y, margin)
    return model


def _pair_step(model, rows, k, lr, lambda_p, lambda_q, lambda_y, margin) -> Factors:
    f = model.factors
    x, ci, cj = ([F.col(n)[c] for c in range(k)] for n in ("x", "ci", "cj"))
    if model.kind == "margin":
        gap = model.value("x", "cj") - model.value("x", "ci") + F.lit(margin)
        rows = rows.withColumn("on", F.when(gap > 0, 1.0).otherwise(0.0))
        on = F.col("on")
        parts = [
            (USER, F.col("user_id"), [on * (a - b) for a, b in zip(ci, cj)], None),
            (ITEM, F.col("item_id"), [on * (s - a) for s, a in zip(x, ci)], None),
            (ITEM, F.col("neg"), [-on * (s - b) for s, b in zip(x, cj)], None),
        ]
        return apply_step(f, gradient_sums(rows, parts), lr, {USER: {"p": lambda_p}, ITEM: {"q": lambda_q}})
    gap = model.value("x", "ci") - model.value("x", "cj")
    rows = rows.withColumn("sg", 1 / (1 + F.exp(gap)))
    sg = F.col("sg")
    parts = [
        (USER, F.col("user_id"), [sg * (a - b) for a, b in zip(ci, cj)], None),
        (ITEM, F.col("item_id"), [sg * s - F.lit(lambda_q) * F.col("wi") for s in x], None),
        (ITEM, F.col("neg"), [-sg * s - F.lit(lambda_q) * F.col("wj") for s in x], None),
    ]
    sums = gradient_sums(rows, parts)
    reg = {USER: {"p": lambda_p}, ITEM: {"q": lambda_q, "y": lambda_y}}
    if model.kind == "profile":
        sums = materialise(sums, "gradients")
        per_user = (
            sums.filter(F.col("side") == USER)
            .select(F.col("id").alias("user_id"), F.col("n").alias("n_u"), F.col("g").alias("gu"))
            .join(model.user_rows().select("user_id", "n_items"), "user_id")
        )
        root = lambda: F.pow(F.col("n_items").cast("double"), F.lit(-0.5))
        sums = history_gradients(model.joiner, per_user, k, [root], sums, [f.item.starts["y"]])
    return apply_step(f, sums, lr, reg)


def fit_bpr(ratings, k, iterations=1000, lr=0.01, lam=0.01, **kw) -> PairModel:
    return fit_pairwise(ratings, k, iterations, lr, lam, lam, **kw)


def fit_bpr_adaptive(ratings, k, iterations=1000, lr=0.01, lam=0.01, negative_sample_pool_size=5, **kw) -> PairModel:
    return fit_pairwise(ratings, k, iterations, lr, lam, lam, pool=negative_sample_pool_size, **kw)


def fit_bpr_svdpp(ratings, k, iterations=1000, lr=0.01, lambda_p=0.01, lambda_q=0.01, lambda_y=0.01, **kw) -> PairModel:
    return fit_pairwise(ratings, k, iterations, lr, lambda_p, lambda_q, lambda_y, kind="profile", **kw)


def fit_wmfbpr(ratings, k, iterations=500, lr=0.01, lam=0.01, pagerank_alpha=0.85, weights=None, **kw) -> PairModel:
    weights = weights if weights is not None else materialise(cooccurrence_pagerank(ratings, pagerank_alpha), "weights")
    return fit_pairwise(ratings, k, iterations, lr, lam, lam, weights=weights, **kw)


def fit_cml(ratings, k, iterations=100, lr=0.01, lam=0.0, margin=0.5, **kw) -> PairModel:
    return fit_pairwise(ratings, k, iterations, lr, lam, lam, kind="margin", margin=margin, **kw)


def train_auc(model: PairModel, ratings: DataFrame, samples: int | None = None, seed: int = 7) -> DataFrame:
    """Share of (positive, sampled negative) pairs ordered rightly; 0.5 without positives.

    Every positive is taken once, or ``samples`` of them.
    """
    positives = ratings.select("user_id", "item_id")
    if samples is not None:
        positives = positives.orderBy(mix("user_id", "item_id", seed), "user_id", "item_id").limit(samples)
    triples = NegativeSampler(ratings).draw(1, seed, positives)
    items = model.item_rows()
    met = (
        triples.join(items.select("item_id", F.col("c").alias("ci")), "item_id")
        .join(items.select(F.col("item_id").alias("neg"), F.col("c").alias("cj")), "neg")
        .join(model.user_rows().select("user_id", "x"), "user_id")
    )
    right = (tie_safe(model.value("x", "ci")) > tie_safe(model.value("x", "cj"))).cast("double")
    return met.agg(F.coalesce(F.avg(right), F.lit(0.5)).alias("auc"))


# ---- labelled pointwise models -----------------------------------------------------------------


def labelled_examples(ratings: DataFrame, negatives: int = 4, seed: int = 0, sampler: NegativeSampler | None = None) -> DataFrame:
    """Positives with label 1 and ``negatives`` unseen items each with label 0."""
    drawn = (sampler or NegativeSampler(ratings)).draw(negatives, seed)
    return ratings.select("user_id", "item_id", F.lit(1.0).alias("label")).unionByName(
        drawn.select("user_id", F.col("neg").alias("item_id"), F.lit(0.0).alias("label"))
    )


@dataclass
class ClickModel:
    """Probability of an interaction: gmf = sigmoid(w.(p*q) + w0); fm = sigmoid(w0 + w_u + w_i + p.q)."""

    factors: Factors
    joiner: Joiner
    kind: str
    shared: list[float]

    def logit(self) -> Column:
        f = self.factors
        p, q = f.user.vector("uv", "p"), f.item.vector("iv", "q")
        if self.kind == "gmf":
            return inner([F.lit(w) * x for w, x in zip(self.shared, p)], q) + F.lit(self.shared[-1])
        return F.lit(self.shared[-1]) + f.user.get("uv", "b") + f.item.get("iv", "b") + inner(p, q)

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.logit()))

    def score(self, pairs: DataFrame) -> DataFrame:
        met = self.joiner.with_both(pairs.select("user_id", "item_id"), self.factors)
        return met.select("user_id", "item_id", self.probability().alias("score"))

    def log_loss(self, examples: DataFrame) -> DataFrame:
        met = self.joiner.with_both(examples, self.factors)
        p = self.probability()
        return met.agg((-F.avg(F.when(F.col("label") == 1, F.log(p)).otherwise(F.log(1 - p)))).alias("log_loss"))


def fit_click_model(
    ratings: DataFrame,
    k: int,
    kind: str = "gmf",
    epochs: int = 10,
    lr: float = 0.05,
    lam: float = 0.0,
    negatives: int = 4,
    seed: int = 0,
) -> ClickModel:
    """Log loss over positives and sampled negatives, drawn once as in the data preparation."""
    bias = {} if kind == "gmf" else {"b": 1}
    user, item = Layout(p=k, **bias), Layout(q=k, **bias)
    joiner = Joiner.of(ratings)
    ratings = joiner.ratings
    factors = Factors(start(ratings, user, item, seed, 0.2, -0.5), user, item)
    shared = ([1.0] * k if kind == "gmf" else []) + [0.0]
    model = ClickModel(factors, joiner, kind, shared)
    examples = materialise(labelled_examples(ratings, negatives, seed), "examples")
    for _ in range(epochs):
        f = model.factors
        rows = joiner.with_both(examples, f).withColumn("d", F.col("label") - model.probability())
        d, p, q = F.col("d"), f.user.vector("uv", "p"), f.item.vector("iv", "q")
        if kind == "gmf":
            w = model.shared
            parts = [
                (USER, F.col("user_id"), [d * F.lit(a) * y for a, y in zip(w, q)], None),
                (ITEM, F.col("item_id"), [d * F.lit(a) * x for a, x in zip(w, p)], None),
                (SHARED, F.lit(0), [d * x * y for x, y in zip(p, q)] + [d], None),
            ]
        else:
            parts = [
                (USER, F.col("user_id"), [d * y for y in q] + [d], None),
                (ITEM, F.col("item_id"), [d * x for x in p] + [d], None),
                (SHARED, F.lit(0), [d], None),
            ]
        sums = materialise(gradient_sums(rows, parts), "gradients")
        step = sums.filter(F.col("side") == SHARED).first()  # k + 1 numbers
        if step is not None:
            model.shared = [w + lr * g / step["n"] for w, g in zip(model.shared, step["g"])]
        reg = {USER: {"p": lam, "b": lam}, ITEM: {"q": lam, "b": lam}}
        model.factors = apply_step(f, sums.filter(F.col("side") != SHARED), lr, reg)
    return model


# ---- contrastive two-tower ---------------------------------------------------------------------


def fit_two_tower(
    ratings: DataFrame,
    k: int,
    epochs: int = 30,
    lr: float = 0.05,
    tau: float = 0.1,
    lam: float = 0.1,
    dropout: float = 0.1,
    batch_rows: int = 1024,
    seed: int = 0,
) -> PairModel:
    """In-batch InfoNCE: every positive against the other items of its batch.

    Batches are cut by a hash that changes per epoch and hold about ``batch_rows`` rows, so a group is
    bounded. The dropout-consistency loss is replaced by its expectation, an L2 term.
    """
    user, item = Layout(p=k), Layout(q=k)
    joiner = Joiner.of(ratings)
    ratings = joiner.ratings
    model = PairModel(Factors(start(ratings, user, item, seed, 0.2, -0.5), user, item), joiner, "plain")
    batches = max(1, -(-ratings.count() // batch_rows))
    shrink = lam * 2.0 * dropout / (1.0 - dropout) / k

    def batch_gradients(frame: pd.DataFrame) -> pd.DataFrame:
        p, q = np.stack(frame["uv"].to_numpy()), np.stack(frame["iv"].to_numpy())
        logits = p @ q.T / tau
        logits -= logits.max(axis=1, keepdims=True)
        share = np.exp(logits)
        share /= share.sum(axis=1, keepdims=True)
        share[np.diag_indices_from(share)] -= 1.0
        grads = np.concatenate([-(share @ q), -(share.T @ p)]) / tau
        return pd.DataFrame(
            {
                "side": [USER] * len(p) + [ITEM] * len(q),
                "id": np.concatenate([frame["user_id"].to_numpy(), frame["item_id"].to_numpy()]),
                "g": list(grads),
            }
        )

    for number in range(epochs):
        f = model.factors
        batch = F.pmod(F.xxhash64("user_id", "item_id", F.lit(seed + number)), F.lit(batches))
        rows = joiner.with_both(ratings.select("user_id", "item_id"), f).withColumn("batch", batch)
        grads = rows.groupBy("batch").applyInPandas(batch_gradients, "side string, id long, g array<double>")
        sums = grads.groupBy("side", "id").agg(
            F.count("*").cast("double").alias("n"), F.array(*[F.sum(F.col("g")[c]) for c in range(k)]).alias("g")
        )
        model.factors = apply_step(f, sums, lr, {USER: {"p": shrink}, ITEM: {"q": shrink}})
    return model


def contrastive_loss(model: PairModel, ratings: DataFrame, tau: float = 0.1, batch_rows: int = 1024) -> float:
    """Mean in-batch cross entropy of the positives."""
    batches = max(1, -(-ratings.count() // batch_rows))

    def loss(frame: pd.DataFrame) -> pd.DataFrame:
        logits = np.stack(frame["uv"].to_numpy()) @ np.stack(frame["iv"].to_numpy()).T / tau
        top = logits.max(axis=1)
        norm = np.log(np.exp(logits - top[:, None]).sum(axis=1)) + top
        return pd.DataFrame({"total": [float((norm - np.diag(logits)).sum())], "n": [len(frame)]})

    rows = model.joiner.with_both(ratings.select("user_id", "item_id"), model.factors).withColumn(
        "batch", F.pmod(F.xxhash64("user_id", "item_id"), F.lit(batches))
    )
    total = rows.groupBy("batch").applyInPandas(loss, "total double, n long").agg(F.sum("total") / F.sum("n"))
    return float(total.first()[0])
