"""Models by name: parameter ranges, defaults, and a common fit / score / recommend interface."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ratingloom.operators import gradient, linear, neighbors, profiles, ranking, rules, solvers
from ratingloom.operators.prepare import binarise
from ratingloom.operators.recommend import score_blocks, top_n
from ratingloom.session import materialise


@dataclass(frozen=True)
class Range:
    """Numeric parameter between ``low`` and ``high``."""

    low: float
    high: float
    step: float
    default: float

    @property
    def is_int(self) -> bool:
        return all(float(x).is_integer() for x in (self.low, self.high, self.step, self.default))


@dataclass(frozen=True)
class Choice:
    """Parameter with listed options."""

    options: tuple
    default: str


@dataclass
class Fitted:
    """``score(pairs)``: scores of user/item pairs; ``recommend(n)``: best unseen items per user."""

    score: Callable[[DataFrame], DataFrame]
    recommend: Callable[[int], DataFrame]


@dataclass(frozen=True)
class Algorithm:
    name: str
    implicit: bool
    result: str
    fit: Callable[..., Fitted]
    parameters: dict

    def defaults(self) -> dict:
        return {name: spec.default for name, spec in self.parameters.items()}

    def checked(self, params: dict) -> dict:
        """Defaults overlaid with ``params``; unknown names are an error, not silently dropped."""
        unknown = set(params) - set(self.parameters)
        if unknown:
            raise ValueError(f"{self.name} has no parameter {sorted(unknown)}")
        return {**self.defaults(), **params}

    def train(self, ratings: DataFrame, **params) -> Fitted:
        return self.fit(ratings, **self.checked(params))


def _from_scores(scores: DataFrame, ratings: DataFrame) -> Fitted:
    return Fitted(
        lambda pairs: pairs.select("user_id", "item_id").join(scores, ["user_id", "item_id"]),
        lambda n: top_n(scores, ratings, n),
    )


def _from_blocks(score: Callable[[DataFrame], DataFrame], factors: Callable[[], tuple[DataFrame, DataFrame]], ratings: DataFrame) -> Fitted:
    """Blocks of factors find each user's best items; the n found get the model's own score.

    The factors may leave out terms that are the same for all items of a user, and monotone links.
    """

    def recommend(n: int) -> DataFrame:
        best = materialise(score_blocks(*factors(), n, ratings).select("user_id", "item_id", "rank"), "best")
        return best.join(score(best.select("user_id", "item_id")), ["user_id", "item_id"]).select("user_id", "item_id", "score", "rank")

    return Fitted(score, recommend)


def _from_factors(model, ratings: DataFrame) -> Fitted:
    return _from_blocks(model.score, model.block_factors, ratings)


def _popular(ratings):
    scores = neighbors.popularity(ratings)
    return Fitted(
        lambda pairs: pairs.select("user_id", "item_id").join(scores, "item_id").select("user_id", "item_id", "score"),
        lambda n: neighbors.popular_for_users(ratings, n),
    )


def _item_knn(ratings, k, similarity_metric, min_support, shrinkage):
    edges = neighbors.item_similarity(ratings, similarity_metric, int(min_support), shrinkage)
    return Fitted(
        lambda pairs: neighbors.item_knn_scores(ratings, edges, int(k), targets=pairs, include_seen=True),
        lambda n: top_n(neighbors.item_knn_scores(ratings, edges, int(k), n=n), None, n),
    )


def _user_knn(ratings, k, similarity_metric):
    edges = neighbors.user_similarity(ratings, similarity_metric)
    scores = neighbors.user_knn_scores(ratings, edges, int(k))
    return Fitted(
        lambda pairs: neighbors.mean_fallback(pairs.select("user_id", "item_id"), scores, ratings),
        lambda n: top_n(scores, ratings, n),
    )


def _slope_one(ratings):
    deviations = neighbors.slope_one_deviations(ratings)
    return Fitted(
        lambda pairs: neighbors.slope_one_scores(ratings, deviations, targets=pairs),
        lambda n: top_n(neighbors.slope_one_scores(ratings, deviations, n=n), None, n),
    )


def _propagated(ratings, edges) -> Fitted:
    """Edges are found once and serve every call; asked pairs and the n best are computed block by block."""
    edges = materialise(edges, "edges")
    return Fitted(
        lambda pairs: neighbors.propagate(ratings, edges, targets=pairs),
        lambda n: top_n(neighbors.propagate(ratings, edges, n=n, unseen=True), None, n),
    )


def _cooccurrence(ratings, threshold):
    edges = neighbors.jaccard_edges(ratings, int(threshold))
    return _propagated(binarise(ratings), edges)


def _rules(miner):
    def fit(ratings, min_support, min_confidence):
        found = rules.association_rules(miner(ratings, min_support), "confidence", min_confidence)
        return _from_scores(rules.rule_scores(ratings, found), ratings)

    return fit


def _ease(ratings, lambda_reg):
    return _propagated(ratings, linear.fit_ease(ratings, lambda_reg))


def _slim(ratings, l1_reg, l2_reg):
    return _propagated(ratings, linear.fit_slim(ratings, l1_reg, l2_reg))


def _svd(scale_sigma):
    def fit(ratings, k):
        model = solvers.fit_svd(ratings, int(k))
        users, items = model.users, model.items
        if not scale_sigma:
            from pyspark.sql import functions as F

            shrink = [F.col("p")[c] / F.lit(float(s)) for c, s in enumerate(model.sigma)]
            users = users.select("user_id", F.array(*shrink).alias("p"))
        return _from_blocks(lambda pairs: model.score(pairs, scale_sigma), lambda: (users, items), ratings)

    return fit


def _mllib(ratings, k, iterations, lambda_reg):
    model = solvers.fit_mllib_als(ratings, int(k), int(iterations), lambda_reg)
    return _from_blocks(
        lambda pairs: model.transform(pairs.select("user_id", "item_id")).selectExpr(
            "user_id", "item_id", "double(prediction) AS score"
        ),
        lambda: solvers.mllib_factors(model),
        ratings,
    )


def _factor(fit):
    def run(ratings, **params):
        params = {name: int(v) if name in ("k", "iterations", "epochs") else v for name, v in params.items()}
        return _from_factors(fit(ratings, **params), ratings)

    return run


def _click(kind):
    def fit(ratings, k, epochs, learning_rate, lambda_reg=0.0):
        model = ranking.fit_click_model(ratings, int(k), kind, int(epochs), learning_rate, lambda_reg)
        from pyspark.sql import functions as F

        f = model.factors
        p, q = f.user.slice("uv", "p"), f.item.slice("iv", "q")
        if kind == "gmf":
            p = F.array(*[x * F.lit(w) for x, w in zip(f.user.vector("uv", "p"), model.shared)])
        else:
            p = F.concat(p, F.array(f.user.get("uv", "b"), F.lit(1.0)))
            q = F.concat(q, F.array(F.lit(1.0), f.item.get("iv", "b")))
        users, items = f.users().select("user_id", p.alias("p")), f.items().select("item_id", q.alias("q"))
        return _from_blocks(model.score, lambda: (users, items), ratings)

    return fit


def _fism(ratings, k, iterations, learning_rate, lambda_reg, alpha):
    model = profiles.fit_fism(ratings, int(k), int(iterations), learning_rate, lambda_reg, alpha)
    from pyspark.sql import functions as F

    f = model.factors
    sums = model.sums()
    norm = profiles.fism_norm(F.col("n_u"), alpha)
    users = sums.select("user_id", F.concat(F.transform("s", lambda x: x * norm), F.array(F.lit(1.0))).alias("p"))
    items = f.items().select("item_id", F.concat(f.item.slice("iv", "q"), F.array(f.item.get("iv", "b"))).alias("q"))
    return _from_blocks(model.score, lambda: (users, items), ratings)


def _renamed(fit, **names):
    """Calls ``fit`` with the public parameter names mapped to its own."""
    return lambda ratings, **params: fit(ratings, **{names.get(n, n): v for n, v in params.items()})


_LR_LAM = {"learning_rate": "lr", "lambda_reg": "lam"}
_METRICS = Choice(("cosine", "adjusted_cosine", "pearson"), "cosine")
_K32 = Range(2, 100, 1, 32)


def _rate(default):
    return Range(0.0001, 0.1, 0.0005, default)


def _l2(default, high=1.0):
    return Range(0.0, high, 0.01, default)


def _rule_parameters(support):
    return {"min_support": Range(0.01, 1.0, 0.01, support), "min_confidence": Range(0.0, 1.0, 0.01, 0.2)}


def _bpr_parameters(iterations, **more):
    return {"k": _K32, "iterations": Range(10, 5000, 10, iterations), "learning_rate": _rate(0.01), "lambda_reg": _l2(0.01), **more}


# The defaults are fixed values of the model catalogue.
ALGORITHMS: dict[str, Algorithm] = {
    a.name: a
    for a in [
        Algorithm("Top Popular", True, "other", _popular, {}),
        Algorithm("Apriori", True, "association_rules", _rules(rules.apriori), _rule_parameters(0.3)),
        Algorithm("FP-Growth", True, "association_rules", _rules(rules.fp_growth), _rule_parameters(0.2)),
        Algorithm("Eclat", True, "association_rules", _rules(rules.eclat), _rule_parameters(0.2)),
        Algorithm("TruncatedSVD", False, "matrix_factorization", _svd(True), {"k": Range(1, 100, 1, 20)}),
        Algorithm("PureSVD", False, "matrix_factorization", _svd(False), {"k": Range(1, 100, 1, 32)}),
        Algorithm(
            "ALS", False, "matrix_factorization", _factor(_renamed(solvers.fit_als, lambda_reg="lam")),
            {"k": _K32, "iterations": Range(1, 30, 1, 10), "lambda_reg": _l2(0.1)},
        ),
        Algorithm(
            "ALS (Improved)", False, "matrix_factorization",
            _factor(_renamed(lambda ratings, **p: solvers.fit_als(ratings, biases=True, **p), lambda_reg="lam")),
            {"k": _K32, "iterations": Range(1, 30, 1, 10), "lambda_reg": _l2(0.05), "lambda_biases": Range(0.0, 20.0, 0.5, 10.0)},
        ),
        Algorithm(
            "ALS (PySpark)", False, "matrix_factorization", _mllib,
            {"k": _K32, "iterations": Range(5, 25, 1, 10), "lambda_reg": _l2(0.1, 0.2)},
        ),
        Algorithm("BPR", True, "matrix_factorization", _factor(_renamed(ranking.fit_bpr, **_LR_LAM)), _bpr_parameters(200)),
        Algorithm(
            "BPR (Adaptive)", True, "matrix_factorization", _factor(_renamed(ranking.fit_bpr_adaptive, **_LR_LAM)),
            _bpr_parameters(200, negative_sample_pool_size=Range(1, 50, 1, 5)),
        ),
        Algorithm(
            "BPR+SVDPP", True, "matrix_factorization", _factor(_renamed(ranking.fit_bpr_svdpp, learning_rate="lr")),
            {"k": _K32, "iterations": Range(10, 5000, 10, 200), "learning_rate": _rate(0.01),
             "lambda_p": _l2(0.01), "lambda_q": _l2(0.01), "lambda_y": _l2(0.01)},
        ),
        Algorithm(
            "WMFBPR", True, "matrix_factorization", _factor(_renamed(ranking.fit_wmfbpr, **_LR_LAM)),
            _bpr_parameters(500, pagerank_alpha=Range(0.1, 0.99, 0.01, 0.85)),
        ),
        Algorithm(
            "CML", True, "matrix_factorization", _factor(_renamed(ranking.fit_cml, **_LR_LAM)),
            {"k": _K32, "iterations": Range(10, 1000, 10, 100), "learning_rate": _rate(0.01), "lambda_reg": _l2(0.0),
             "margin": Range(0.1, 2.0, 0.1, 0.5)},
        ),
        Algorithm(
            "ItemKNN", False, "knn_similarity", _item_knn,
            {"k": Range(1, 100, 1, 20), "similarity_metric": _METRICS, "min_support": Range(0, 50, 1, 2),
             "shrinkage": Range(0.0, 100.0, 10.0, 0.0)},
        ),
        Algorithm("UserKNN", False, "knn_similarity", _user_knn, {"k": Range(1, 100, 1, 20), "similarity_metric": _METRICS}),
        Algorithm("SlopeOne", False, "knn_similarity", _slope_one, {}),
        Algorithm("SAR", True, "knn_similarity", _cooccurrence, {"threshold": Range(1, 20, 1, 2)}),
        Algorithm(
            "NMF", False, "matrix_factorization", _factor(_renamed(gradient.fit_nmf, **_LR_LAM)),
            {"k": _K32, "iterations": Range(5, 500, 5, 50), "learning_rate": _rate(0.005), "lambda_reg": _l2(0.02)},
        ),
        Algorithm(
            "FunkSVD", False, "matrix_factorization",
            _factor(lambda ratings, k, iterations, learning_rate, lambda_reg: gradient.fit_funk_svd(
                ratings, k, iterations, learning_rate, lambda_reg, lambda_reg)),
            {"k": _K32, "iterations": Range(5, 500, 5, 50), "learning_rate": _rate(0.005), "lambda_reg": _l2(0.02)},
        ),
        Algorithm(
            "SVD++", False, "matrix_factorization",
            lambda ratings, **p: _scored(profiles.fit_svdpp, ratings, p),
            {"k": Range(2, 200, 1, 100), "iterations": Range(5, 100, 1, 26), "learning_rate": _rate(0.0884),
             "lambda_p": _l2(0.0457), "lambda_q": _l2(0.00998), "lambda_y": _l2(0.35),
             "lambda_bu": Range(0.0, 20.0, 0.01, 8.23), "lambda_bi": Range(0.0, 20.0, 0.01, 12.9)},
        ),
        Algorithm(
            "ASVD", False, "matrix_factorization",
            lambda ratings, **p: _scored(profiles.fit_asvd, ratings, p),
            {"k": Range(2, 100, 1, 20), "iterations": Range(5, 100, 1, 20), "learning_rate": _rate(0.005),
             "lambda_q": _l2(0.02), "lambda_x": _l2(0.02), "lambda_y": _l2(0.02), "lambda_bu": _l2(0.02), "lambda_bi": _l2(0.02)},
        ),
        Algorithm(
            "WRMF", True, "matrix_factorization", _factor(_renamed(solvers.fit_wrmf, lambda_reg="lam")),
            {"k": _K32, "iterations": Range(1, 50, 1, 10), "lambda_reg": _l2(0.1), "alpha": Range(1.0, 100.0, 1.0, 40.0)},
        ),
        Algorithm(
            "FISM", True, "matrix_factorization", _fism,
            {"k": _K32, "iterations": Range(5, 500, 5, 100), "learning_rate": _rate(0.01), "lambda_reg": _l2(0.01),
             "alpha": Range(0.0, 1.0, 0.1, 0.5)},
        ),
        Algorithm("EASE", True, "item_weights", _ease, {"lambda_reg": Range(1.0, 5000.0, 10.0, 100.0)}),
        Algorithm("SLIM", True, "item_weights", _slim, {"l1_reg": Range(0.0, 0.1, 0.0005, 0.001), "l2_reg": Range(0.0, 0.1, 0.0001, 0.0001)}),
        Algorithm(
            "GMF", True, "matrix_factorization", _click("gmf"),
            {"k": _K32, "epochs": Range(1, 100, 1, 10), "learning_rate": _rate(0.05)},
        ),
        Algorithm(
            "FM", True, "matrix_factorization", _click("fm"),
            {"k": _K32, "epochs": Range(1, 100, 1, 10), "learning_rate": _rate(0.05), "lambda_reg": Range(0.0, 0.1, 0.001, 0.01)},
        ),
        Algorithm(
            "SimpleX", True, "matrix_factorization",
            _factor(lambda ratings, k, epochs, learning_rate, tau, lambda_reg: ranking.fit_two_tower(
                ratings, k, epochs, learning_rate, tau, lambda_reg)),
            {"k": _K32, "epochs": Range(1, 100, 1, 30), "learning_rate": _rate(0.05), "tau": Range(0.05, 1.0, 0.05, 0.1),
             "lambda_reg": _l2(0.1)},
        ),
    ]
}


def _scored(fit, ratings: DataFrame, params: dict) -> Fitted:
    """Profile models: the score is bias + profile . q, so blocks get the profile and the biases folded in."""
    from pyspark.sql import functions as F

    params = {("lr" if n == "learning_rate" else n): int(v) if n in ("k", "iterations") else v for n, v in params.items()}
    model = fit(ratings, **params)
    f = model.factors
    z = model.profile(model.joiner, f).select("user_id", "z").join(f.users(), "user_id")
    vec = F.col("z")
    if "p" in f.user.widths:
        vec = F.zip_with("z", f.user.slice("uv", "p"), lambda a, b: a + b)
    users = z.select("user_id", F.concat(vec, F.array(F.lit(1.0))).alias("p"))
    items = f.items().select("item_id", F.concat(f.item.slice("iv", "q"), F.array(f.item.get("iv", "b"))).alias("q"))
    return _from_blocks(model.score, lambda: (users, items), ratings)
