"""SQL text of the derived tables, for the comparison statements."""

from __future__ import annotations

HASH_RANGE = 2147483647
FOLDED = f"(((CAST({{}} AS BIGINT) % {HASH_RANGE}) + (CAST({{}} AS BIGINT) >> 31) * 48271) % {HASH_RANGE})"


def _hash_sql() -> str:
    u, i, s = (FOLDED.format("{" + x + "}", "{" + x + "}") for x in "uis")
    base = f"(({u} * 1103515245 + {i} * 998244353 + {s} * 715225739) % {HASH_RANGE})"
    square = f"(({base} * {base}) % {HASH_RANGE})"
    return f"(((({square} * {square}) % {HASH_RANGE}) * {base}) % {HASH_RANGE})"


HASH = _hash_sql()

RATED = "1 + 4 * (avg(l_quantity) - 1) / 49 AS rating"
BRAND = "CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS BIGINT)"

PARTS = f"""SELECT o_custkey AS user_id, l_partkey AS item_id, {RATED}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"""
BRANDS = f"""SELECT o_custkey AS user_id, {BRAND} AS item_id, {RATED}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"""
EVENTS = """SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
  CAST(1 + least(4, floor(round(avg(value), 6) / 25)) AS DOUBLE) AS rating, min(ts) AS ts
  FROM events GROUP BY 1, 2"""
TITLES = f"SELECT DISTINCT {BRAND} AS item_id, p_brand AS title FROM part WHERE {BRAND} % 2 = 0"
PART_FEATURES = """SELECT p_partkey AS item_id,
  unnest([p_brand, p_type, 'SIZE_' || CAST((p_size - 1) // 10 AS VARCHAR)]) AS feature FROM part"""
EVENT_FEATURES = """SELECT item_id, event_type AS feature FROM (
  SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, event_type, count(*) AS n,
    sum(count(*)) OVER (PARTITION BY CAST(json_extract_string(props, '$.k') AS BIGINT)) AS total
  FROM events GROUP BY 1, 2) WHERE n * 5 >= total"""
PROFILES = """SELECT user_id, event_type AS feature,
  2.0::DOUBLE * n / total - 0.4::DOUBLE AS weight FROM (
  SELECT user_id, event_type, count(*) AS n, sum(count(*)) OVER (PARTITION BY user_id) AS total
  FROM events GROUP BY 1, 2)"""
SCORED = """SELECT l.doc_id, l.quality AS label, CAST(d.n_chars AS DOUBLE) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""


def mix(u: str, i: str, seed: int | str = 0) -> str:
    return HASH.format(u=u, i=i, s=seed)


def unit(u: str, i: str, seed: int | str = 0) -> str:
    return f"({mix(u, i, seed)} / {HASH_RANGE}.0::DOUBLE)"


def r6(x: str, digits: int = 6) -> str:
    return f"round(CAST({x} AS DOUBLE), {digits}) + 0.0"


def with_ratings(view: str, body: str) -> str:
    """WITH r AS (view), then further tables and the final SELECT of ``body``."""
    return f"WITH r AS MATERIALIZED ({view}){body}"


PAIRS = """, pairs AS MATERIALIZED (SELECT a.item_id AS i, b.item_id AS j, count(*) AS n,
  sum(a.rating * b.rating) AS xy, avg(a.rating - b.rating) AS dev
  FROM r a JOIN r b ON a.user_id = b.user_id AND a.item_id <> b.item_id GROUP BY 1, 2)"""

COSINE = PAIRS + """, norms AS (SELECT item_id, sqrt(sum(rating * rating)) AS nrm FROM r GROUP BY 1)
, edges AS MATERIALIZED (SELECT i, j, xy / (a.nrm * b.nrm) AS sim, n AS support FROM pairs
  JOIN norms a ON a.item_id = i JOIN norms b ON b.item_id = j WHERE n >= 2)"""

HOLDOUT = f""", split AS MATERIALIZED (SELECT user_id, item_id, rating,
  size > 1 AND rk <= greatest(1, floor(0.2::DOUBLE * size)) AS is_test FROM (
  SELECT user_id, item_id, rating, count(*) OVER (PARTITION BY user_id) AS size,
    row_number() OVER (PARTITION BY user_id ORDER BY {mix('user_id', 'item_id')}, item_id) AS rk FROM r0))
, r AS MATERIALIZED (SELECT user_id, item_id, rating FROM split WHERE NOT is_test)
, test AS (SELECT user_id, item_id, rating FROM split WHERE is_test)"""

LOO = f""", split AS MATERIALIZED (SELECT user_id, item_id, rating,
  row_number() OVER (PARTITION BY user_id ORDER BY {mix('user_id', 'item_id')}, item_id) = 1 AS is_test FROM r0)
, r AS MATERIALIZED (SELECT user_id, item_id, rating FROM split WHERE NOT is_test)
, test AS (SELECT user_id, item_id, rating FROM split WHERE is_test)"""


def knn_scores(k: int, seen: bool = False, eps: str = "1e-8") -> str:
    """Item-neighbour scores over tables r and edges."""
    cond = "" if seen else "AND NOT EXISTS (SELECT 1 FROM r s WHERE s.user_id = h.user_id AND s.item_id = e.i)"
    tail = f"WHERE den > 1e-8" if eps == "0" else ""
    return f""", scores AS MATERIALIZED (SELECT user_id, item_id, num / (den + {eps}) AS score FROM (
  SELECT user_id, item_id, sum(sim * rating) AS num, sum(abs(sim)) AS den FROM (
    SELECT h.user_id, e.i AS item_id, e.sim, h.rating,
      row_number() OVER (PARTITION BY h.user_id, e.i ORDER BY round(abs(e.sim), 9) DESC, e.j) AS rn
    FROM r h JOIN edges e ON e.j = h.item_id WHERE e.sim <> 0 {cond}) WHERE rn <= {k}
  GROUP BY 1, 2) {tail})"""


def top_scores(n: int, drop_seen: bool = True) -> str:
    """Best n scored items per user, table best."""
    cond = "WHERE NOT EXISTS (SELECT 1 FROM r s WHERE s.user_id = p.user_id AND s.item_id = p.item_id)" if drop_seen else ""
    return f""", best AS (SELECT * FROM (SELECT p.user_id, p.item_id, p.score,
  row_number() OVER (PARTITION BY p.user_id ORDER BY round(p.score, 9) DESC, p.item_id) AS rank
  FROM scores p {cond}) WHERE rank <= {n})"""
