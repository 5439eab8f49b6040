"""SQL text that replays the gradient trainers with two factors, for the comparison statements."""

from __future__ import annotations

from ratingloom.plans.sqlparts import mix, unit


def draws(key: str, n: int, seed: int, scale: float, low: float, names: list[str], at: int = 0) -> str:
    return ", ".join(
        f"{scale}::DOUBLE * ({unit(key, str(at + f), seed)} + {low}::DOUBLE) AS {names[f]}" for f in range(n)
    )


def rated_mf(view: str, steps: int, lr: float, lam_u: float, lam_i: float, scale: float, low: float, floor0: bool = False) -> str:
    """Tables u<steps>(user_id, p1, p2), i<steps>(item_id, q1, q2)."""
    clip = (lambda x: f"greatest({x}, 0)") if floor0 else (lambda x: x)
    body = f"""WITH r AS MATERIALIZED ({view})
, u0 AS MATERIALIZED (SELECT user_id, {draws('user_id', 2, 0, scale, low, ['p1', 'p2'])} FROM (SELECT DISTINCT user_id FROM r))
, i0 AS MATERIALIZED (SELECT item_id, {draws('item_id', 2, 1, scale, low, ['q1', 'q2'])} FROM (SELECT DISTINCT item_id FROM r))"""
    for s in range(1, steps + 1):
        upd_u = ", ".join(f"{clip(f'any_value(p{f}) + {lr} * (avg(e * q{f}) - {lam_u} * any_value(p{f}))')} AS p{f}" for f in (1, 2))
        upd_i = ", ".join(f"{clip(f'any_value(q{f}) + {lr} * (avg(e * p{f}) - {lam_i} * any_value(q{f}))')} AS q{f}" for f in (1, 2))
        body += f"""
, j{s} AS MATERIALIZED (SELECT *, rating - (p1 * q1 + p2 * q2) AS e FROM r JOIN u{s - 1} USING (user_id) JOIN i{s - 1} USING (item_id))
, u{s} AS MATERIALIZED (SELECT user_id, {upd_u} FROM j{s} GROUP BY 1)
, i{s} AS MATERIALIZED (SELECT item_id, {upd_i} FROM j{s} GROUP BY 1)"""
    return body


def biased_mf(view: str, steps: int, lr: float, lam: float) -> str:
    body = f"""WITH r AS MATERIALIZED ({view}), g AS (SELECT avg(rating) AS mu FROM r)
, u0 AS MATERIALIZED (SELECT user_id, {draws('user_id', 2, 0, 1.0, -0.5, ['p1', 'p2'])}, 0.0::DOUBLE AS bu FROM (SELECT DISTINCT user_id FROM r))
, i0 AS MATERIALIZED (SELECT item_id, {draws('item_id', 2, 1, 1.0, -0.5, ['q1', 'q2'])}, 0.0::DOUBLE AS bi FROM (SELECT DISTINCT item_id FROM r))"""
    for s in range(1, steps + 1):
        def upd(x, grad):
            return f"any_value({x}) + {lr} * (avg({grad}) - {lam} * any_value({x})) AS {x}"
        body += f"""
, j{s} AS MATERIALIZED (SELECT *, rating - ((SELECT mu FROM g) + bu + bi + p1 * q1 + p2 * q2) AS e
    FROM r JOIN u{s - 1} USING (user_id) JOIN i{s - 1} USING (item_id))
, u{s} AS MATERIALIZED (SELECT user_id, {upd('p1', 'e * q1')}, {upd('p2', 'e * q2')}, {upd('bu', 'e')} FROM j{s} GROUP BY 1)
, i{s} AS MATERIALIZED (SELECT item_id, {upd('q1', 'e * p1')}, {upd('q2', 'e * p2')}, {upd('bi', 'e')} FROM j{s} GROUP BY 1)"""
    return body


def svdpp(view: str, steps: int, lr: float, lam: float) -> str:
    body = f"""WITH r AS MATERIALIZED ({view}), g AS (SELECT avg(rating) AS mu FROM r)
, nu AS MATERIALIZED (SELECT user_id, count(*) AS n FROM r GROUP BY 1)
, u0 AS MATERIALIZED (SELECT user_id, {draws('user_id', 2, 0, 1.0, -0.5, ['p1', 'p2'])}, 0.0::DOUBLE AS bu FROM (SELECT DISTINCT user_id FROM r))
, i0 AS MATERIALIZED (SELECT item_id, {draws('item_id', 2, 1, 1.0, -0.5, ['q1', 'q2'])}, 0.0::DOUBLE AS bi,
    {draws('item_id', 2, 1, 1.0, -0.5, ['y1', 'y2'], at=3)} FROM (SELECT DISTINCT item_id FROM r))"""
    for s in range(1, steps + 1):
        def upd(x, grad):
            return f"any_value({x}) + {lr} * ({grad} - {lam} * any_value({x})) AS {x}"
        body += f"""
, z{s} AS MATERIALIZED (SELECT user_id, sum(y1) / sqrt(count(*)) AS z1, sum(y2) / sqrt(count(*)) AS z2
    FROM r JOIN i{s - 1} USING (item_id) GROUP BY 1)
, j{s} AS MATERIALIZED (SELECT *, rating - ((SELECT mu FROM g) + bu + bi + (p1 + z1) * q1 + (p2 + z2) * q2) AS e
    FROM r JOIN u{s - 1} USING (user_id) JOIN i{s - 1} USING (item_id) JOIN z{s} USING (user_id))
, gu{s} AS MATERIALIZED (SELECT user_id, count(*) AS n, sum(e * q1) AS g1, sum(e * q2) AS g2 FROM j{s} GROUP BY 1)
, u{s} AS MATERIALIZED (SELECT user_id, {upd('p1', 'avg(e * q1)')}, {upd('p2', 'avg(e * q2)')}, {upd('bu', 'avg(e)')} FROM j{s} GROUP BY 1)
, i{s} AS MATERIALIZED (SELECT item_id, {upd('q1', 'avg(e * (p1 + z1))')}, {upd('q2', 'avg(e * (p2 + z2))')}, {upd('bi', 'avg(e)')},
    {upd('y1', 'sum(g1 / sqrt(n)) / sum(n)')}, {upd('y2', 'sum(g2 / sqrt(n)) / sum(n)')}
    FROM j{s} JOIN gu{s} USING (user_id) GROUP BY 1)"""
    return body


def asvd(view: str, steps: int, lr: float, lam: float) -> str:
    body = f"""WITH r AS MATERIALIZED ({view}), g AS (SELECT avg(rating) AS mu FROM r)
, u0 AS MATERIALIZED (SELECT DISTINCT user_id, 0.0::DOUBLE AS bu FROM r)
, i0 AS MATERIALIZED (SELECT item_id, {draws('item_id', 2, 1, 1.0, -0.5, ['q1', 'q2'])}, 0.0::DOUBLE AS bi,
    {draws('item_id', 2, 1, 1.0, -0.5, ['x1', 'x2'], at=3)}, {draws('item_id', 2, 1, 1.0, -0.5, ['y1', 'y2'], at=5)}
    FROM (SELECT DISTINCT item_id FROM r))"""
    for s in range(1, steps + 1):
        def upd(x, grad):
            return f"any_value({x}) + {lr} * ({grad} - {lam} * any_value({x})) AS {x}"
        body += f"""
, b{s} AS MATERIALIZED (SELECT *, rating - ((SELECT mu FROM g) + bu + bi) AS gap
    FROM r JOIN u{s - 1} USING (user_id) JOIN i{s - 1} USING (item_id))
, z{s} AS MATERIALIZED (SELECT user_id, sum(gap * x1 + y1) / sqrt(count(*)) AS z1, sum(gap * x2 + y2) / sqrt(count(*)) AS z2
    FROM b{s} GROUP BY 1)
, j{s} AS MATERIALIZED (SELECT *, gap - (z1 * q1 + z2 * q2) AS e FROM b{s} JOIN z{s} USING (user_id))
, gu{s} AS MATERIALIZED (SELECT user_id, count(*) AS n, sum(e * q1) AS g1, sum(e * q2) AS g2 FROM j{s} GROUP BY 1)
, u{s} AS MATERIALIZED (SELECT user_id, {upd('bu', 'avg(e)')} FROM j{s} GROUP BY 1)
, i{s} AS MATERIALIZED (SELECT item_id, {upd('q1', 'avg(e * z1)')}, {upd('q2', 'avg(e * z2)')}, {upd('bi', 'avg(e)')},
    {upd('x1', 'sum(gap * g1 / sqrt(n)) / sum(n)')}, {upd('x2', 'sum(gap * g2 / sqrt(n)) / sum(n)')},
    {upd('y1', 'sum(g1 / sqrt(n)) / sum(n)')}, {upd('y2', 'sum(g2 / sqrt(n)) / sum(n)')}
    FROM j{s} JOIN gu{s} USING (user_id) GROUP BY 1)"""
    return body


def fism(view: str, steps: int, lr: float, lam: float) -> str:
    body = f"""WITH r AS MATERIALIZED ({view}), nu AS MATERIALIZED (SELECT user_id, count(*) AS n,
    CASE WHEN count(*) > 1 THEN (count(*) - 1) ^ (-0.5::DOUBLE) ELSE 0 END AS c FROM r GROUP BY 1)
, i0 AS MATERIALIZED (SELECT item_id, {draws('item_id', 2, 1, 1.0, -0.5, ['q1', 'q2'])}, 0.0::DOUBLE AS bi,
    {draws('item_id', 2, 1, 1.0, -0.5, ['p1', 'p2'], at=3)} FROM (SELECT DISTINCT item_id FROM r))"""
    for s in range(1, steps + 1):
        def upd(x, grad):
            return f"any_value({x}) + {lr} * ({grad} - {lam} * any_value({x})) AS {x}"
        body += f"""
, s{s} AS MATERIALIZED (SELECT user_id, sum(p1) AS s1, sum(p2) AS s2 FROM r JOIN i{s - 1} USING (item_id) GROUP BY 1)
, j{s} AS MATERIALIZED (SELECT *, 1 - (bi + c * ((s1 - p1) * q1 + (s2 - p2) * q2)) AS e
    FROM r JOIN i{s - 1} USING (item_id) JOIN s{s} USING (user_id) JOIN nu USING (user_id))
, gu{s} AS MATERIALIZED (SELECT user_id, sum(e * q1) AS g1, sum(e * q2) AS g2 FROM j{s} GROUP BY 1)
, i{s} AS MATERIALIZED (SELECT item_id, {upd('q1', 'avg(e * c * (s1 - p1))')}, {upd('q2', 'avg(e * c * (s2 - p2))')}, {upd('bi', 'avg(e)')},
    {upd('p1', 'sum(c * (g1 - e * q1)) / sum(n - 1)')}, {upd('p2', 'sum(c * (g2 - e * q2)) / sum(n - 1)')}
    FROM j{s} JOIN gu{s} USING (user_id) GROUP BY 1)"""
    return body


def negatives(table: str, seed: str, per: int = 1) -> str:
    """Table ``table``(user_id, item_id, draw, neg): uniform unseen items, by counting unseen positions."""
    return f"""
, {table} AS MATERIALIZED (SELECT d.user_id, d.item_id, d.draw, o.item_id AS neg FROM (
    SELECT d.user_id, d.item_id, d.draw, any_value(d.t) + count(m.coord) AS ord FROM (
      SELECT r.user_id, r.item_id, x.draw, ({mix('r.user_id', 'r.item_id', f'{seed} + x.draw * 101')} * 2147483647
          + {mix('r.item_id', 'r.user_id', f'{seed} + x.draw * 101 + 1')}) % h.free AS t
      FROM r JOIN holes h USING (user_id), range(1, {per + 1}) x(draw) WHERE h.free > 0) d
    LEFT JOIN marks m ON m.user_id = d.user_id AND m.coord <= d.t GROUP BY 1, 2, 3) d
  JOIN ords o ON o.ord = d.ord)"""


NEGATIVE_TABLES = """
, ords AS MATERIALIZED (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS ord FROM (SELECT DISTINCT item_id FROM r))
, marks AS MATERIALIZED (SELECT user_id, ord - (row_number() OVER (PARTITION BY user_id ORDER BY ord) - 1) AS coord
    FROM r JOIN ords USING (item_id))
, holes AS MATERIALIZED (SELECT user_id, (SELECT count(*) FROM ords) - count(*) AS free FROM r GROUP BY 1)"""


def pairwise(view: str, steps: int, lr: float, lam: float, kind: str, pool: int = 1, prefix: str = "") -> str:
    """Triple-trained models: kind is bpr, adaptive, weighted, margin or profile."""
    margin = 0.5
    body = f"""WITH r AS MATERIALIZED ({view}){NEGATIVE_TABLES}{prefix}
, u0 AS MATERIALIZED (SELECT user_id, {draws('user_id', 2, 0, 0.2, -0.5, ['p1', 'p2'])} FROM (SELECT DISTINCT user_id FROM r))
, i0 AS MATERIALIZED (SELECT item_id, {draws('item_id', 2, 1, 0.2, -0.5, ['q1', 'q2'])}
    {', ' + draws('item_id', 2, 1, 0.2, -0.5, ['y1', 'y2'], at=2) if kind == 'profile' else ''} FROM (SELECT DISTINCT item_id FROM r))"""
    for s in range(1, steps + 1):
        prev = s - 1
        body += negatives(f"n{s}", str(1000 * s), pool)
        t = f"n{s}"
        if kind == "adaptive":
            body += f"""
, h{s} AS MATERIALIZED (SELECT user_id, item_id, neg FROM (SELECT n.*, row_number() OVER (PARTITION BY n.user_id, n.item_id
    ORDER BY round(p1 * q1 + p2 * q2, 9) DESC, n.draw) AS rn FROM n{s} n JOIN u{prev} USING (user_id)
    JOIN i{prev} k ON k.item_id = n.neg) WHERE rn = 1)"""
            t = f"h{s}"
        extra, ux = "", ("p1", "p2")
        a, b = ("a.q1", "a.q2"), ("b.q1", "b.q2")
        if kind == "profile":
            body += f"""
, z{s} AS MATERIALIZED (SELECT user_id, count(*) AS n, sum(y1) / sqrt(count(*)) AS z1, sum(y2) / sqrt(count(*)) AS z2
    FROM r JOIN i{prev} USING (item_id) GROUP BY 1)"""
            extra = f"JOIN z{s} z USING (user_id)"
            ux = ("(p1 + z1)", "(p2 + z2)")
        if kind == "weighted":
            extra = "JOIN w wa ON wa.item_id = t.item_id JOIN w wb ON wb.item_id = t.neg"
            a, b = ("(a.q1 + wa.w)", "(a.q2 + wa.w)"), ("(b.q1 + wb.w)", "(b.q2 + wb.w)")
        if kind == "margin":
            dist = [f"sqrt((p1 - {v[0]}) ^ 2 + (p2 - {v[1]}) ^ 2)" for v in (a, b)]
            body += f"""
, j{s} AS MATERIALIZED (SELECT t.user_id, t.item_id, t.neg, p1, p2, a.q1 AS a1, a.q2 AS a2, b.q1 AS b1, b.q2 AS b2,
    CASE WHEN {dist[0]} - {dist[1]} + {margin} > 0 THEN 1.0::DOUBLE ELSE 0 END AS on_
  FROM {t} t JOIN u{prev} USING (user_id) JOIN i{prev} a ON a.item_id = t.item_id JOIN i{prev} b ON b.item_id = t.neg)
, u{s} AS MATERIALIZED (SELECT user_id, any_value(p1) + {lr} * avg(on_ * (a1 - b1)) AS p1, any_value(p2) + {lr} * avg(on_ * (a2 - b2)) AS p2 FROM j{s} GROUP BY 1)
, gi{s} AS MATERIALIZED (SELECT id, avg(g1) AS g1, avg(g2) AS g2 FROM (
    SELECT item_id AS id, on_ * (p1 - a1) AS g1, on_ * (p2 - a2) AS g2 FROM j{s}
    UNION ALL SELECT neg, -on_ * (p1 - b1), -on_ * (p2 - b2) FROM j{s}) GROUP BY 1)
, i{s} AS MATERIALIZED (SELECT item_id, q1 + {lr} * coalesce(g1, 0) AS q1, q2 + {lr} * coalesce(g2, 0) AS q2 FROM i{prev} LEFT JOIN gi{s} ON id = item_id)"""
            continue
        body += f"""
, j{s} AS MATERIALIZED (SELECT t.user_id, t.item_id, t.neg, {'z.n AS n, ' if kind == 'profile' else ''}p1, p2, {ux[0]} AS x1, {ux[1]} AS x2,
    {a[0]} AS a1, {a[1]} AS a2, {b[0]} AS b1, {b[1]} AS b2,
    1 / (1 + exp({ux[0]} * ({a[0]} - {b[0]}) + {ux[1]} * ({a[1]} - {b[1]}))) AS sg
  FROM {t} t JOIN u{prev} USING (user_id) JOIN i{prev} a ON a.item_id = t.item_id JOIN i{prev} b ON b.item_id = t.neg {extra})
, u{s} AS MATERIALIZED (SELECT user_id, any_value(p1) + {lr} * (avg(sg * (a1 - b1)) - {lam} * any_value(p1)) AS p1,
    any_value(p2) + {lr} * (avg(sg * (a2 - b2)) - {lam} * any_value(p2)) AS p2 FROM j{s} GROUP BY 1)
, gi{s} AS MATERIALIZED (SELECT id, avg(g1) AS g1, avg(g2) AS g2 FROM (
    SELECT item_id AS id, sg * x1 AS g1, sg * x2 AS g2 FROM j{s} UNION ALL SELECT neg, -sg * x1, -sg * x2 FROM j{s}) GROUP BY 1)"""
        shift = "+ coalesce(w, 0)" if kind == "weighted" else ""
        wjoin = "LEFT JOIN w USING (item_id)" if kind == "weighted" else ""
        q = ", ".join(f"q{f} + CASE WHEN g1 IS NULL THEN 0 ELSE {lr} * (g{f} - {lam} * (q{f} {shift})) END AS q{f}" for f in (1, 2))
        y, yjoin = "", ""
        if kind == "profile":
            body += f"""
, gu{s} AS MATERIALIZED (SELECT user_id, count(*) AS n, sum(sg * (a1 - b1)) AS g1, sum(sg * (a2 - b2)) AS g2 FROM j{s} GROUP BY 1)
, gy{s} AS MATERIALIZED (SELECT item_id, sum(g.g1 / sqrt(z.n)) / sum(g.n) AS h1, sum(g.g2 / sqrt(z.n)) / sum(g.n) AS h2
    FROM r JOIN gu{s} g USING (user_id) JOIN z{s} z USING (user_id) GROUP BY 1)"""
            y = ", " + ", ".join(f"y{f} + coalesce({lr} * (h{f} - {lam} * y{f}), 0) AS y{f}" for f in (1, 2))
            yjoin = f"LEFT JOIN gy{s} USING (item_id)"
        body += f"""
, i{s} AS MATERIALIZED (SELECT item_id, {q}{y} FROM i{prev} LEFT JOIN gi{s} ON id = item_id {wjoin} {yjoin})"""
    return body


def als(view: str, steps: int, lam: float, biases: bool = False, lam_b: float = 10.0, alpha: float | None = None) -> str:
    """Alternating 2 x 2 normal equations: tables u<steps>, i<steps>."""
    mu = "avg(rating)" if biases else "0.0::DOUBLE"
    body = f"""WITH r AS MATERIALIZED ({view}), g AS (SELECT {mu} AS mu FROM r)
, i0 AS MATERIALIZED (SELECT item_id, {draws('item_id', 2, 0, 1.0, -0.25, ['q1', 'q2'])}, 0.0::DOUBLE AS bi FROM (SELECT DISTINCT item_id FROM r))"""
    wa, wb = "1", "rating"
    if alpha is not None:
        wa, wb = f"({alpha} * rating)", f"(1 + {alpha} * rating)"
    for s in range(1, steps + 1):
        for key, new, vec, bias, old, ovec, obias in (
            ("user_id", f"u{s}", "p", "bu", f"i{s - 1}", "q", "bi"),
            ("item_id", f"i{s}", "q", "bi", f"u{s}", "p", "bu"),
        ):
            target = f"(rating - (SELECT mu FROM g) - {obias})" if biases else wb
            base = (
                f"(SELECT sum({ovec}1 * {ovec}1) AS s11, sum({ovec}1 * {ovec}2) AS s12, sum({ovec}2 * {ovec}2) AS s22 FROM {old})"
                if alpha is not None else "(SELECT 0 AS s11, 0 AS s12, 0 AS s22)"
            )
            body += f"""
, n{new} AS MATERIALIZED (SELECT {key}, count(*) AS n, sum({wa} * {ovec}1 * {ovec}1) + any_value(s11) + {lam} AS a11,
    sum({wa} * {ovec}1 * {ovec}2) + any_value(s12) AS a12, sum({wa} * {ovec}2 * {ovec}2) + any_value(s22) + {lam} AS a22,
    sum({target} * {ovec}1) AS b1, sum({target} * {ovec}2) AS b2, sum({target}) AS st, sum({ovec}1) AS v1, sum({ovec}2) AS v2
  FROM r JOIN {old} USING ({'item_id' if key == 'user_id' else 'user_id'}), {base} GROUP BY 1)
, x{new} AS MATERIALIZED (SELECT *, (a22 * b1 - a12 * b2) / (a11 * a22 - a12 * a12) AS {vec}1,
    (a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12) AS {vec}2 FROM n{new})
, {new} AS MATERIALIZED (SELECT {key}, {vec}1, {vec}2, {f'(st - {vec}1 * v1 - {vec}2 * v2) / (n + {lam_b})' if biases else '0.0::DOUBLE'} AS {bias} FROM x{new})"""
    return body


def click(view: str, steps: int, lr: float, kind: str, per: int = 4) -> str:
    """Pointwise logistic models gmf and fm."""
    bias = ", 0.0::DOUBLE AS b" if kind == "fm" else ""
    body = f"""WITH r AS MATERIALIZED ({view}){NEGATIVE_TABLES}{negatives('neg', '0', per)}
, ex AS MATERIALIZED (SELECT user_id, item_id, 1 AS label FROM r UNION ALL SELECT user_id, neg, 0 FROM neg)
, u0 AS MATERIALIZED (SELECT user_id, {draws('user_id', 2, 0, 0.2, -0.5, ['p1', 'p2'])}{bias} FROM (SELECT DISTINCT user_id FROM r))
, i0 AS MATERIALIZED (SELECT item_id, {draws('item_id', 2, 1, 0.2, -0.5, ['q1', 'q2'])}{bias} FROM (SELECT DISTINCT item_id FROM r))
, w0 AS MATERIALIZED (SELECT 1.0::DOUBLE AS w1, 1.0::DOUBLE AS w2, 0.0::DOUBLE AS c)"""
    for s in range(1, steps + 1):
        prev = s - 1
        logit = "w1 * p1 * q1 + w2 * p2 * q2 + c" if kind == "gmf" else "c + u.b + i.b + p1 * q1 + p2 * q2"
        w = ("w1", "w2") if kind == "gmf" else ("1", "1")
        ub = f", any_value(ub) + {lr} * avg(d) AS b" if kind == "fm" else ""
        ib = f", any_value(ib) + {lr} * avg(d) AS b" if kind == "fm" else ""
        cols = ", u.b AS ub, i.b AS ib" if kind == "fm" else ""
        wup = (
            f"any_value(w1) + {lr} * avg(d * p1 * q1) AS w1, any_value(w2) + {lr} * avg(d * p2 * q2) AS w2"
            if kind == "gmf" else "1 AS w1, 1 AS w2"
        )
        body += f"""
, j{s} AS MATERIALIZED (SELECT user_id, item_id, p1, p2, q1, q2, w1, w2, c{cols}, label - 1 / (1 + exp(-({logit}))) AS d
  FROM ex JOIN u{prev} u USING (user_id) JOIN i{prev} i USING (item_id), w{prev})
, u{s} AS MATERIALIZED (SELECT user_id, any_value(p1) + {lr} * avg(d * {w[0]} * q1) AS p1, any_value(p2) + {lr} * avg(d * {w[1]} * q2) AS p2{ub} FROM j{s} GROUP BY 1)
, i{s} AS MATERIALIZED (SELECT item_id, any_value(q1) + {lr} * avg(d * {w[0]} * p1) AS q1, any_value(q2) + {lr} * avg(d * {w[1]} * p2) AS q2{ib} FROM j{s} GROUP BY 1)
, w{s} AS MATERIALIZED (SELECT {wup}, any_value(c) + {lr} * avg(d) AS c FROM j{s})"""
    logit = "w1 * p1 * q1 + w2 * p2 * q2 + c" if kind == "gmf" else "c + u.b + i.b + p1 * q1 + p2 * q2"
    return body + f"""
 SELECT user_id, item_id, round(1 / (1 + exp(-({logit}))), 6) + 0.0 AS score FROM r JOIN u{steps} u USING (user_id)
  JOIN i{steps} i USING (item_id), w{steps}"""
