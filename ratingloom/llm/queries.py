"""The registered queries of this subpackage and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm import (
    conversation_repair, decontamination, embedding_dedup, jaccard_join, language_id, line_dedup, mixing, quality_rules, substring_dedup, token_counts, token_files,
    url_rules, whitening,
)
from ratingloom.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_dedup.dedup(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    profiles = language_id.fit(docs.filter(~language_id.held_out()))
    rows = language_id.predict(docs, profiles)
    return rows.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    token_files.write(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.digest(spark, path)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(_table(spark, sf_dir, "pages"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.apply_policy(quality_rules.ledger(_table(spark, sf_dir, "documents")))
    base = quality_rules.failed_under(quality_rules.POLICIES[quality_rules.BASE_POLICY])
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.audit(_table(spark, sf_dir, "conversations"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.dedup(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_language_id, op3_token_files, op4_token_counts, op5_url_rules, op6_jaccard_join, op7_decontamination, op8_mixing, op9_line_dedup,
        op10_quality_rules, op11_conversation_repair, op12_whitening, op13_embedding_dedup,
    )
}

_SPACE = "'[\\x20\\x09-\\x0D]+'"
_WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), {_SPACE}), lambda x: x <> '')"

_OP1 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM late, range(0, 20) AS r(k)),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_OP5 = """
WITH parsed AS (
  SELECT page_id,
    CASE WHEN contains(coalesce(url, ''), '://')
      THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN contains(coalesce(url, ''), '://') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules(rhost, rpath, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
judged AS (
  SELECT page_id, host, path,
    (SELECT max_by({'rule': rhost || rpath, 'v': v}, length(rhost || rpath)) FROM rules
     WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS r
  FROM parsed)
SELECT page_id, host, path, r.rule AS rule,
  CASE WHEN r IS NOT NULL THEN r.v
    WHEN contains('.' || host, '.spam-') OR contains('.' || host, '.casino-') OR contains(path, '/cgi-bin/') OR ends_with(path, '.exe') THEN 'block'
    ELSE 'allow' END AS verdict
FROM judged
"""

_P = mixing.PRIME
_OP8 = f"""
WITH sizes AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size FROM documents),
h1 AS (SELECT *, ((((doc_id % {_P}) + {_P}) % {_P}) * 48271 + (((CAST(floor(doc_id / {_P}) AS BIGINT) % {_P}) + {_P}) % {_P}) * 69621 + {mixing.SEED}) % {_P} AS x FROM sizes),
h2 AS (SELECT *, x * x % {_P} AS x2 FROM h1),
h3 AS (SELECT *, (((x2 * x2 % {_P}) * x % {_P}) * 16807 + {mixing.SEED}) % {_P} AS y FROM h2),
h4 AS (SELECT *, y * y % {_P} AS y2 FROM h3),
h5 AS (SELECT doc_id, source, size, ((y2 * y2 % {_P}) * y % {_P} + 0.5::DOUBLE) / {_P}::DOUBLE AS u FROM h4),
s1 AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1 AS number FROM sizes GROUP BY source),
s2 AS (SELECT *, [5, 2, 1][number % 3 + 1] AS weight FROM s1),
s3 AS (SELECT *, (source_size * 3)::DOUBLE / weight AS stop FROM s2),
s4 AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER w, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS level
  FROM s3 WINDOW w AS (ORDER BY stop, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s5 AS (SELECT *, (SELECT arg_min(level, (stop, number)) FROM s4 WHERE stop >= level) AS lv FROM s4),
goals AS (SELECT source, source_size, CASE WHEN lv IS NULL OR stop <= lv THEN (source_size * 3)::DOUBLE ELSE lv * weight END AS target FROM s5),
c1 AS (SELECT g.source, g.source_size, g.target, length(bin(size))::BIGINT AS digits, sum(size)::BIGINT AS words
  FROM sizes JOIN goals g ON sizes.source IS NOT DISTINCT FROM g.source GROUP BY ALL),
c2 AS (SELECT *, (target - coalesce(sum(words * 3) OVER (PARTITION BY source ORDER BY digits DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
  / nullif(sum(words * digits) OVER (PARTITION BY source ORDER BY digits DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0)::DOUBLE AS level FROM c1),
c3 AS (SELECT *, arg_max(level, digits) FILTER (level * digits <= 3) OVER (PARTITION BY source) AS lv FROM c2),
c4 AS (SELECT *, CASE WHEN lv IS NULL THEN 3.0::DOUBLE ELSE least(3.0::DOUBLE, lv * digits) END AS m FROM c3),
c5 AS (SELECT *, floor(m)::BIGINT AS sure, m - floor(m) AS p, target - (sum(floor(m)::BIGINT * words) OVER (PARTITION BY source))::DOUBLE AS rest FROM c4),
r3 AS (SELECT h5.*, source_size, target, sure, p, rest, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS odds
  FROM h5 JOIN c5 ON h5.source IS NOT DISTINCT FROM c5.source AND length(bin(h5.size)) = c5.digits),
r4 AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY odds NULLS LAST, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM r3)
SELECT doc_id, size, source_size, target, ((sure + CASE WHEN odds IS NOT NULL AND 2 * before + size <= 2 * rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM r4
"""

_OP9 = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
found AS (SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT k.*, coalesce(f.holder <> k.doc_id, false) AS dropped FROM keyed k LEFT JOIN found f ON k.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (dropped))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_OP10 = f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
grams AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, 8) AS r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(l.dup, 0)::BIGINT AS n_dup_lines,
    coalesce(l.n, 0)::BIGINT AS n_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered c USING (doc_id) LEFT JOIN lines l USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 30 * n_words OR 100 * n_dup_lines > 50 * n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM b
"""

_OP6 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.replace("text", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT id, b FROM reach JOIN edges ON r = a)
SELECT doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r) AS component_id
FROM reach JOIN documents ON id = doc_id LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

_ALNUM_WORDS = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
)
_OP7 = f"""
WITH d AS (SELECT doc_id, {_ALNUM_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS n FROM (SELECT item_id, {_ALNUM_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, n, i, item FROM dw JOIN bw USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n_hit FROM (SELECT doc_id, i, unnest(range(0, n)) AS k FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item COLLATE "C") AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP11 = """
WITH RECURSIVE coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
crc AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda c: ord(c)::BIGINT)),
    lambda r, c: list_reduce([xor(r, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS kind FROM coded),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM crc, range(0, 2) AS t(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, row_number() OVER w AS k,
    regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS said, left(role, 1) AS ini
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role COLLATE "C", text COLLATE "C")),
again AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY k) > 1 AS dup, lag(ini) OVER (PARTITION BY c ORDER BY k) AS prev FROM placed),
r AS (SELECT *, CASE WHEN said = '' THEN 'blank' WHEN dup THEN 'duplicate' WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM again),
counts AS (
  SELECT c, any_value(conv_id) AS conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (k > 1 AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY c),
pre(st, ins, mid, pay) AS (VALUES (0, '', 0, 0), (0, 'I', 2, 3), (0, 'II', 3, 6), (1, '', 1, 0), (1, 'I', 2, 3), (1, 'II', 3, 6), (2, '', 2, 0), (2, 'I', 3, 3), (3, '', 3, 0), (3, 'I', 2, 3)),
act(mid, edit, ini, st2, pay2) AS (VALUES (0, 'D', '', 0, 4), (1, 'D', '', 1, 4), (2, 'D', '', 2, 4), (3, 'D', '', 3, 4), (0, 'R', '', 2, 3), (1, 'R', '', 2, 3), (2, 'R', '', 3, 3), (3, 'R', '', 2, 3),
  (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0), (3, 'K', 'u', 2, 0)),
dp(c, k, st, best) AS (
  SELECT DISTINCT c, 0::BIGINT, 0, lpad('0', 9, '0') FROM r
  UNION ALL
  SELECT r.c, r.k, act.st2, min(lpad(CAST(CAST(left(dp.best, 9) AS INTEGER) + pre.pay + act.pay2 + CASE WHEN act.edit <> 'D' AND r.fault = 'truncated' THEN 3 ELSE 0 END AS VARCHAR), 9, '0')
    || substr(dp.best, 10) || pre.ins || act.edit)
  FROM dp JOIN r ON r.c = dp.c AND r.k = dp.k + 1 JOIN pre ON pre.st = dp.st JOIN act ON act.mid = pre.mid
  WHERE act.edit = 'D' OR (r.fault NOT IN ('blank', 'duplicate') AND (act.edit = 'R' OR act.ini = r.ini))
  GROUP BY r.c, r.k, act.st2),
fin(st, ins, pay) AS (VALUES (0, '', 0), (1, 'II', 6), (2, 'I', 3), (3, '', 0)),
paths AS (
  SELECT c, CAST(left(b, 9) AS BIGINT) AS cost, substr(b, 10) AS audit FROM (
    SELECT c, min(lpad(CAST(CAST(left(best, 9) AS INTEGER) + pay AS VARCHAR), 9, '0') || substr(best, 10) || ins) AS b
    FROM dp JOIN counts USING (c) JOIN fin USING (st) WHERE k = n GROUP BY c)),
steps AS (SELECT c, audit, p, substr(audit, p, 1) AS edit, p - length(replace(left(audit, p), 'I', '')) AS inserted FROM (SELECT c, audit, unnest(range(1, length(audit) + 1)) AS p FROM paths)),
used AS (SELECT s.c, p, edit, role, text, row_number() OVER (PARTITION BY s.c ORDER BY p) AS e FROM steps s LEFT JOIN r ON r.c = s.c AND edit <> 'I' AND r.k = p - inserted WHERE edit <> 'D'),
lead AS (SELECT c, max(CASE WHEN e = 1 AND edit = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END) AS sys FROM used GROUP BY c),
spoken AS (
  SELECT c, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (e - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS h
  FROM used JOIN lead USING (c) GROUP BY c),
done AS (SELECT conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, h FROM counts JOIN paths USING (c) LEFT JOIN spoken USING (c))
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN done d ON o.conv_id IS NOT DISTINCT FROM d.conv_id
"""

_OP13 = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda c: coalesce(c::DOUBLE, 0)) AS e,
    len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) AS bad FROM embeddings),
good AS (SELECT * FROM v WHERE label IS NOT NULL AND bad = 0 AND len(list_filter(e, lambda c: c <> 0)) > 0),
links AS (SELECT a.r AS x, b.r AS y FROM good a JOIN good b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(x, y) AS (SELECT r, r FROM v UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
sets AS (SELECT x AS r, min(vec_id) AS component_id FROM reach JOIN v ON v.r = y GROUP BY x),
counts AS (SELECT x AS r, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN sets USING (r) LEFT JOIN counts USING (r)
"""

ORACLES: dict[str, str] = {"op1_substring_dedup": _OP1, "op5_url_rules": _OP5, "op6_jaccard_join": _OP6, "op7_decontamination": _OP7, "op8_mixing": _OP8, "op9_line_dedup": _OP9, "op10_quality_rules": _OP10, "op11_conversation_repair": _OP11, "op13_embedding_dedup": _OP13}
