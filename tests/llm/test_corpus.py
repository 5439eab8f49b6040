"""Operators on documents against brute force on small tables with nulls, copies, ties and odd texts."""

import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ratingloom.llm import (
    common, decontamination, jaccard_join, language_id, line_dedup, mixing, quality_rules, queries, substring_dedup, textpack, token_counts, token_files, url_rules,
)
from ratingloom.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, label string, owner string"


def corpus(seed=3, n=60):
    """Random prose with exact and near copies, shared passages, repeated lines, nulls, empty and long texts."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 4))) for _ in range(60)]
    prose = lambda k: " ".join(rng.choices(words, k=k))
    passage, line = prose(30), prose(12) + " and a line that is long"
    texts = [None, "", " \n\t ", "one", prose(4), prose(19), prose(20), prose(3000), "x" * 9000 + " y", "\n".join([line] * 3)]
    while len(texts) < n:
        base = prose(rng.randint(5, 90))
        kind = rng.random()
        if kind < 0.25:
            base = f"{prose(5)} {passage}\n{base}"
        elif kind < 0.4:
            base = f"{base}\n {line.upper()} \n{prose(3)}"
        elif kind < 0.6 and texts[-1]:
            base = texts[rng.randrange(9, len(texts))]
        elif kind < 0.8:
            old = texts[rng.randrange(7, len(texts))].split(" ")
            old[rng.randrange(len(old))] = prose(1)
            base = " ".join(old)
        texts.append(base)
    texts[1:] = rng.sample(texts[1:], len(texts) - 1)
    return [(i * 3 - 5, t, rng.choice(["de", "en", None]), rng.choice(["a", "a", "b", None]), len(t or ""), "s", None, "o") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def by_sql(rows, sql, **tables):
    con = duckdb.connect()
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    con.register("documents", pa.table({"doc_id": pa.array(columns[0], pa.int64()), "text": pa.array(columns[1], pa.string()), "source": pa.array(columns[3], pa.string())}))
    for name, table in tables.items():
        con.register(name, table)
    cursor = con.execute(sql)
    return [c[0] for c in cursor.description], sorted(map(str, cursor.fetchall()))


def same(df, sql_result):
    names, want = sql_result
    assert sorted(map(str, (tuple(r) for r in df.select(*names).collect()))) == want


def sha(column):
    return F.sha2(F.encode(column, "UTF-8"), 256).alias("kept_sha256")


def test_words_and_windows():
    texts = ["a bb  a", None, "é\u00a0é x", "z" * 10_000 + " a"]
    data, offsets = textpack.buffers(pa.array(texts))
    w = textpack.words(data, offsets, textpack.SPACES)
    got = [data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends, strict=True)]
    assert got == [x for t in texts for x in WORD.findall(t or "")]
    hashes = textpack.word_hashes(w)
    for i, j in itertools.combinations(range(len(got)), 2):
        assert (hashes[i] == hashes[j]) == (got[i] == got[j])
    assert textpack.window_starts(w.bounds, 2).tolist() == [0, 1, 3, 5]


@pytest.mark.parametrize("seed", [3, 4])
def test_substring_dedup(spark, seed, monkeypatch):
    rows = corpus(seed)
    monkeypatch.setattr(substring_dedup, "HOT_HITS", 3)  # spread owners as well
    monkeypatch.setattr(substring_dedup, "FREQUENT", 0.0)
    monkeypatch.setattr(substring_dedup, "CHUNK_WORDS", 50)
    got = substring_dedup.dedup(spark.createDataFrame(rows, SCHEMA).repartition(3))
    same(got.select("doc_id", "n_words", "n_removed", sha("kept")), by_sql(rows, queries.ORACLES["op1_substring_dedup"]))


def test_substring_dedup_with_frequent_anchors(spark):
    """Anchors in most documents take the spread path."""
    shared = " ".join(f"w{i}" for i in range(40))
    rows = [(i, f"own{i} {shared} end{i % 3}", "en", "a", 1, "", "", "") for i in range(80)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert substring_dedup.frequent_anchors(df)
    got = substring_dedup.dedup(df)
    same(got.select("doc_id", "n_words", "n_removed", sha("kept")), by_sql(rows, queries.ORACLES["op1_substring_dedup"]))


def test_substring_dedup_beside_an_unrelated_owner(spark):
    """Documents 5 and 9 share a passage whose anchors document 3 owns; 9 owns the text around it, as 12 repeats it."""
    for seed in range(4):
        rng = random.Random(seed)
        prose = lambda k: " ".join(f"w{rng.randrange(10**9)}" for _ in range(k))  # noqa: E731, B023
        passage = prose(20 + 2 * seed).split(" ")
        runs = " ".join(f"{' '.join(passage[i : i + 6])} {prose(1)}" for i in range(len(passage) - 5))
        long = f"{prose(40)} {' '.join(passage)} {prose(40)}"
        texts = {3: runs, 5: f"{prose(30)} {' '.join(passage)} {prose(30)}", 9: long, 12: long}
        rows = [(i, t, "en", "a", 1, "", "", "") for i, t in texts.items()]
        got = substring_dedup.dedup(spark.createDataFrame(rows, SCHEMA))
        same(got.select("doc_id", "n_words", "n_removed", sha("kept")), by_sql(rows, queries.ORACLES["op1_substring_dedup"]))


def test_jaccard_join(docs, rows):
    same(jaccard_join.link(docs), by_sql(rows, queries.ORACLES["op6_jaccard_join"]))


@pytest.mark.parametrize("block", [2048, 2])
def test_jaccard_join_with_hot_signatures(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "HOT", 3)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(50):
        text = list(base) if i % 2 else [f"{i}v{j}" for j in range(40)] + base[:40]
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = f"n{rng.random()}"
        rows.append((i, " ".join(text), "en", "a", 0, "", "", ""))
    same(jaccard_join.link(spark.createDataFrame(rows, SCHEMA)), by_sql(rows, queries.ORACLES["op6_jaccard_join"]))


def test_signatures_lose_no_pair():
    """Any two linked sets, of any size, have a signature in common."""
    rng = np.random.default_rng(2)
    for r in [*range(1, 40), 63, 64, 65, 127, 128, 200, 400]:
        for _ in range(6):
            tokens = np.unique(rng.integers(0, 1 << 63, r).astype(np.uint64))
            drop = rng.integers(0, jaccard_join.most_different(r, r) + 1)
            other = np.unique(np.concatenate([tokens[int(drop) :], rng.integers(0, 1 << 63, int(rng.integers(0, 1 + r // 3))).astype(np.uint64)]))
            both = len(np.intersect1d(tokens, other))
            if 100 * both < 75 * (len(tokens) + len(other) - both):
                continue
            found = []
            for s in (tokens, other):
                band, largest = len(s).bit_length() - 1, len(s) * 4 // 3
                found.append({x for up in (0, 1) if not up or largest >= 2 << band for x in jaccard_join.signatures(s, band + up, min(largest, (2 << (band + up)) - 1))[0].tolist()})
            assert found[0] & found[1]


def test_keep_one(spark, docs, rows):
    kept = [r.doc_id for r in jaccard_join.keep_one(docs).collect()]
    linked = {r.doc_id: r.component_id for r in jaccard_join.link(docs).collect()}
    assert sorted(kept) == sorted(d for d, c in linked.items() if d == c)
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (2, "q")], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in jaccard_join.keep_one(twice).collect()) == ["1", "2", "None"]


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(1, 40)] + [(90, 80)], "a long, b long")
    got = {r.id: r.label for r in common.components(links).collect()}
    assert set(got) == {*range(1, 41), 80, 90} and {got[i] for i in range(1, 41)} == {1} and got[90] == 80


BENCHMARK = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (10, "ab"), (2, None), (3, "..."), (4, "Alpha, beta! gamma delta epsilon zeta eta theta iota kappa mu")]


def planted(rows):
    out = list(rows)
    for i, t in enumerate(["x Alpha beta-gamma delta epsilon zeta\neta theta iota kappa nu ab", "ab", "alpha beta gamma delta epsilon zeta eta theta iota"]):
        out.append((1000 + i, t, "en", "a", 0, "", "", ""))
    return out


def test_decontamination(spark, rows):
    rows = planted(rows)
    table = pa.table({"item_id": pa.array([b[0] for b in BENCHMARK]), "text": pa.array([b[1] for b in BENCHMARK])})
    benchmark = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    df = spark.createDataFrame(rows, SCHEMA)
    same(decontamination.report(df, benchmark), by_sql(rows, queries.ORACLES["op7_decontamination"], benchmark=table))
    cut = {r.doc_id: r.text for r in decontamination.remove_spans(df, benchmark).collect()}
    assert cut[1000] == "x  nu " and cut[1001] == "" and cut[1002] == rows[-1][1]
    hit = {r.doc_id for r in decontamination.report(df, benchmark).filter("contaminated").collect()}
    assert all(cut[r[0]] == r[1] for r in rows if r[0] not in hit)


def test_benchmark_without_words_and_repeated_items(spark, docs, rows):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.report(docs, empty).filter("contaminated OR n_items > 0").isEmpty()
    items = spark.createDataFrame([(1, "ab cd"), (1, "ab cd"), (1, "zz")], "item_id long, text string")
    df = spark.createDataFrame([(1, "ab cd zz"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items) for r in decontamination.report(df, items).collect()}
    assert got == {1: (3, 1), 2: (0, 0)}


def test_fm_index():
    rng = np.random.default_rng(1)
    symbols = rng.integers(1, 4, 300)
    runs = np.array([0, 5, 120, 299])
    index = decontamination.FMIndex(symbols, runs, 3)
    owner = np.searchsorted(runs, np.arange(300), "right")
    patterns = np.array(list(itertools.product([1, 2, 3], repeat=4)))
    lo, hi = index.find(patterns)
    for p, a, b in zip(patterns, lo, hi, strict=True):
        want = [i for i in range(297) if (symbols[i : i + 4] == p).all() and owner[i] == owner[i + 3]]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_mixing(docs, rows):
    plan = mixing.plan(docs)
    same(plan.select("doc_id", "size", "source_size", "target", "taken"), by_sql(rows, queries.ORACLES["op8_mixing"]))
    taken = {}
    for r in plan.collect():
        assert r.taken == r.copies * r.size and r.copies <= 3
        taken.setdefault(r.source, [0, r.target, 0])
        taken[r.source][0] += r.taken
        taken[r.source][2] = max(taken[r.source][2], r.size)
    assert all(abs(got - target) <= largest / 2 + 1 for got, target, largest in taken.values())
    copies = {r.doc_id: r.copies for r in plan.collect()}
    got = [r.doc_id for r in mixing.mix(docs).collect()]
    assert sorted(got) == sorted(d for d, n in copies.items() for _ in range(n))


def test_mixing_prefers_long_documents_by_the_ratio(spark):
    """Documents are drawn with unequal probabilities: a ranking by the random number alone gives another plan."""
    docs = spark.range(4000).selectExpr("id AS doc_id", "'a' AS source", "repeat('w ', CASE WHEN id % 2 = 0 THEN 3 ELSE 1000 END) AS text")
    plan = mixing.plan(docs, share=0.3).withColumn("u", mixing.random_unit()).toPandas()
    short, long = (plan[plan["size"] == n] for n in (3, 1000))
    assert abs(long["copies"].mean() / short["copies"].mean() - 10 / 2) < 1  # 10 and 2 binary digits
    taken = plan[plan["copies"] > 0]["u"].max()
    assert (plan[plan["copies"] == 0]["u"] < taken).any()
    assert abs(plan["taken"].sum() - plan["target"].iloc[0]) <= 501


def test_mixing_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 77, 78, 79, 80, 81)], "doc_id long, text string, source string, _copies int, rows int, id int, n int, row int")
    assert [tuple(r) for r in mixing.mix(docs).collect()] == [(1, "a b", "s", 77, 78, 79, 80, 81)]


def test_mixing_repeated_rows_and_nulls(spark):
    rows = [(1, "a b c", None), (1, "a b c", None), (None, "d e", "s"), (None, None, "s"), (-7, "f", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    copies = mixing.plan(df).agg(F.sum("copies")).first()[0]
    assert mixing.mix(df).count() == copies


def test_mixing_spreads_a_source_at_small_fractions(spark, monkeypatch):
    """Every bucket of a source stays small where almost nothing of it is taken, and the plan agrees with one bucket."""
    docs = spark.range(8000).selectExpr("id AS doc_id", "'a' AS source", "concat('w ', id) AS text")
    sizes = []
    joined = type(docs).join

    def join(self, other, on=None, how=None):
        if isinstance(on, list) and on == ["number", "_bucket"]:
            sizes.append(self.groupBy(*on).count().agg(F.max("count")).first()[0])
        return joined(self, other, on, how)

    monkeypatch.setattr(type(docs), "join", join)
    spread = {tuple(r) for r in mixing.plan(docs, share=0.001).collect()}
    assert sizes[0] < 20
    monkeypatch.setattr(mixing, "BUCKETS", 1)
    assert {tuple(r) for r in mixing.plan(docs, share=0.001).collect()} == spread


@pytest.mark.parametrize("seed", [3, 8])
def test_line_dedup(spark, seed):
    rows = corpus(seed)
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA))
    same(got.select("doc_id", "n_lines", "n_dropped", sha("kept")), by_sql(rows, queries.ORACLES["op9_line_dedup"]))


def test_line_runs_are_compacted(spark):
    runs = line_dedup.LineRuns(spark)
    for i in range(5, 0, -1):
        runs.add(spark.createDataFrame([(7, i), (i * 100, i)], "line long, doc long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    lines = spark.createDataFrame([(7, i) for i in range(5, 0, -1)] + [(500, 5), (400, 4), (400, 3)], "line long, doc long")
    assert sorted(map(tuple, runs.table().filter("line = 7").collect())) == [(7, 5)]
    assert sorted(map(tuple, runs.repeats(lines, 3).collect())) == [(7, i) for i in range(1, 5)]
    assert sorted(map(tuple, runs.repeats(lines, 2).collect())) == [(7, i) for i in range(1, 5)] + [(400, 3)]


def test_line_dedup_needs_the_anti_join(spark, monkeypatch):
    rows = [(i, "a line that stands in all of them", None, None, 0) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert line_dedup.dedup_lines(docs).agg(F.sum("n_dropped")).first()[0] == 11
    joined = type(docs).join
    monkeypatch.setattr(type(docs), "join", lambda self, other, on=None, how=None: self if how == "left_anti" else joined(self, other, on, how))
    assert line_dedup.dedup_lines(docs).agg(F.sum("n_dropped")).first()[0] != 11


def test_quality_rules(docs, rows):
    ledger = quality_rules.apply_policy(quality_rules.ledger(docs))
    base = quality_rules.failed_under(quality_rules.POLICIES[1])
    got = ledger.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept")
    same(got, by_sql(rows, queries.ORACLES["op10_quality_rules"]))
    failed = [r.failed for r in ledger.collect()]
    for r in quality_rules.ablations(ledger).collect():
        bit = quality_rules.mask((r.rule,))
        assert (r.failing, r.only_this) == (sum(bool(f & bit) for f in failed), sum(f == bit for f in failed))


URLS = [None, "", "no scheme", "http://x.ORG/", "http://x.org", "https://a.example.org/es/1?q", "https://example.org/en/12#x", "ftp://fr.com/fr/", "http://a.com/de/", "http://evilorg/x",
        "http://e.net/.org/#", "http://spam-a.net/x", "http://b.casino-x.com/fr/", "a://b://c.org/", "http://é.org/ü", "http://x.net/a.exe", "://", "http://a.org/" + "p" * 5000]


def test_url_rules(spark):
    rows = [(i, u, "h") for i, u in enumerate(URLS)]
    table = pa.table({"page_id": pa.array([r[0] for r in rows]), "url": pa.array(URLS)})
    got = url_rules.judge(spark.createDataFrame(rows, "page_id long, url string, host string"))
    same(got, by_sql([], queries.ORACLES["op5_url_rules"], pages=table))


def test_globs():
    globs = ["a*b", "*", "", "a?c*", "*x*y*", "\\*", "q" * 70 + "*"]
    texts = ["ab", "a--b", "", "abc", "axc yy", "xay", "*", "q" * 70, "q" * 69, "q" * 75]
    data, offsets = textpack.buffers(pa.array(texts))
    got = url_rules.Automaton(globs).run(data, offsets)
    import fnmatch

    plain = [g.replace("\\*", "[*]") for g in globs]
    assert got.tolist() == [[fnmatch.fnmatchcase(t, g) for g in plain] for t in texts]


def test_language_id(spark):
    rng = random.Random(1)
    kinds = {"aa": "abcde", "bb": "fghij", "cc": "klmné"}
    rows = [(i, " ".join("".join(rng.choices(kinds[lang], k=4)) for _ in range(20)), lang) for i, lang in enumerate(list(kinds) * 15)]
    rows += [(100, None, "aa"), (101, "12 !?", "aa"), (102, "", None), (None, "fghij", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = language_id.fit(df.filter(~language_id.held_out()), size=50)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(df, profiles).collect()}
    assert all(got[d][0] == lang for d, _, lang in rows[:45]) and got[None][0] == "bb"
    assert [got[d] for d in (100, 101, 102)] == [("und", 0.0)] * 3
    assert {r.doc_id for r in language_id.accepted(df, profiles).collect()} == {*range(45), None}
    none = language_id.fit(df.filter("lang = 'zz'"))
    assert language_id.predict(df, none).filter("lang_pred <> 'und'").isEmpty()


def test_language_id_equals_brute_force(spark):
    rng = np.random.default_rng(11)
    words = {"a": ["the", "then", "other", "of"], "b": ["der", "dort", "oder", "öde"], "c": ["les", "lot", "sel", "été"]}
    rows = [(n, lang, " 7-".join(rng.choice(words[lang], rng.integers(1, 9)))) for n, lang in enumerate(rng.choice(list("abc"), 60).tolist())]
    rows += [(None, "a", "the the"), (3, "a", "THE oder"), (3, "a", "THE oder"), (70, None, "der été"), (71, "b", None), (72, "c", ""), (73, None, "42")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, lang string, text string, _hash string, _place int")
    size, sample = 12, 8

    def grams(text):
        found = Counter()
        for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
            marked = "\0" + word + "\0"
            for width in (1, 2, 3):
                found.update(g for g in (marked[i : i + width] for i in range(len(marked) - width + 1)) if g.strip("\0") and "\0" not in g[1:-1])
        merged = Counter()  # a mark in front has no weight in a code
        for g, n in found.items():
            merged[sum(ord(c) << 21 * k for k, c in enumerate(reversed(g)))] += n
        return merged

    def ranked(counts):
        return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]]

    hashes = {r.doc_id: r.h for r in df.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    profile = {}
    for lang in "abc":
        of = sorted((r for r in rows if r[1] == lang and r[2] is not None), key=lambda r: (hashes[r[0]], r[0] or 0))
        ids = {r[0] for r in of[:sample]} - {None}
        profile[lang] = ranked(sum((grams(r[2]) for r in of if r[0] in ids), Counter()))

    def label(text):
        top = ranked(grams(text))
        if not top:
            return "und", 0.0
        far = {x: sum(abs(p.index(g) - k) if g in p else size for k, g in enumerate(top)) for x, p in profile.items()}
        best = min(far, key=lambda x: (far[x], x))
        return best, pytest.approx(1 - far[best] / (size * len(top)))

    got = language_id.predict(df, language_id.fit(df, size, sample)).collect()
    want = {(r[0], i): label(r[2]) for i, r in enumerate(rows)}
    assert len(got) == len(rows)
    for (doc_id, _), expected in want.items():
        assert any(r.doc_id == doc_id and (r.lang_pred, r.score) == expected for r in got), (doc_id, expected)


def test_language_id_counts_long_texts_in_pieces(monkeypatch):
    text = "Ab, cé 1x abc " * 50
    whole = dict(zip(*map(np.ndarray.tolist, language_id.count_grams(text)), strict=True))
    monkeypatch.setattr(language_id, "PIECE", 7)
    assert dict(zip(*map(np.ndarray.tolist, language_id.count_grams(text)), strict=True)) == whole
    words = re.findall(r"[^\W\d_]+", text.lower())
    assert sum(whole.values()) == sum(len(w) + (len(w) + 1) + len(w) for w in words)


def test_language_id_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op2_language_id(spark, "/root/testdata/sf0.01").join(df.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / n > 0.98


TRICKY = ["", " ", "  ", "a", " a", "a ", "a  b", "  a  b  ", "\n a\n", "é ▁x y▁ z", "<s> a </s><unk>", "\t\ta", "A.b, C! d?! e.. 'x. I'm. don't", "x" * 5000, None, "日本 語.", "a<|endoftext|>. B", "e\u0301. \u0301 a",
          "<|ENDOFTEXT|> q", "\u2028 a\u00a0b", "12. 3, É. ß; Σ: ΑΣ."]


def test_token_counts(spark, rows):
    import public_tokenizers
    import sentencepiece

    file = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=file)
    texts = TRICKY + [r[1] for r in rows]
    got = {r.doc_id: r for r in token_counts.count(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), file, limit=50).collect()}
    for i, t in enumerate(texts):
        n = len(model.encode(t or ""))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 50), t


def brute_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_token_files(spark, rows):
    import public_tokenizers

    texts = TRICKY + [r[1] for r in rows]
    data = [(None if i == 0 else i * 7, t) for i, t in enumerate(texts)] + [(7, TRICKY[1])]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    path = scratch_path(spark, "test-ids")
    token_files.write(df, path, public_tokenizers.path("word_bpe_49k.json"), 2, file_text_bytes=4000)
    want, start = [], 0
    for (d, _), ids in sorted(zip(data, brute_ids([t for _, t in data]), strict=True), key=lambda x: (x[0][0] is not None, x[0][0] or 0)):
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [tuple(r) for r in token_files.digest(spark, path).orderBy("start").collect()]
    assert got == want
    some = {r.doc_id: r.ids for r in token_files.read(spark, path, [14, 21]).collect()}
    assert some == {14: brute_ids([texts[2]])[0], 21: brute_ids([texts[3]])[0]}


def test_token_file_is_seekable_zstandard(spark, tmp_path):
    import public_tokenizers
    import zstandard

    token_files.write(spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string"), str(tmp_path / "x"), public_tokenizers.path("word_bpe_49k.json"), 2)
    (file,) = (tmp_path / "x").glob("part-*")
    raw = file.read_bytes()
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert np.frombuffer(whole, "<u2").tolist() == [i for ids in brute_ids(["a b", "c"]) for i in ids]
    damaged = bytearray(raw)
    damaged[8] ^= 255
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.Reader(__import__("io").BytesIO(bytes(damaged))).ids(0)


def test_empty_tables(spark, tmp_path):
    import public_tokenizers

    empty = spark.createDataFrame([], SCHEMA)
    benchmark = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    for out in (
        substring_dedup.dedup(empty), jaccard_join.link(empty), jaccard_join.keep_one(empty), decontamination.report(empty, benchmark), mixing.plan(empty), mixing.mix(empty), line_dedup.dedup_lines(empty),
        quality_rules.ledger(empty), language_id.predict(empty, language_id.fit(empty)), token_counts.count(empty, public_tokenizers.path("piece_bpe_32k.model")),
        url_rules.judge(spark.createDataFrame([], "page_id long, url string")),
    ):
        assert out.count() == 0
    token_files.write(empty, str(tmp_path / "e"), public_tokenizers.path("word_bpe_49k.json"), 2)
    assert token_files.digest(spark, str(tmp_path / "e")).count() == 0


def test_pipeline(spark, tmp_path):
    """Each stage against brute force on what the stage before kept."""
    rows = [(r[0], r[1], r[2], r[3], r[4]) for r in planted(corpus(6, 40))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(BENCHMARK, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, str(tmp_path)), name)
        seen[name] = [tuple(r) for r in docs.collect()]
        assert name == "token_files" or docs.columns == columns
    letters = [r for r in rows if re.search(r"[^\W\d_]", r[1] or "")]
    assert sorted(r[0] for r in seen["language_id"]) == sorted(r[0] for r in letters)
    _, linked = by_sql(seen["language_id"], "SELECT doc_id FROM (" + queries.ORACLES["op6_jaccard_join"] + ") WHERE doc_id = component_id")
    assert sorted(f"({r[0]},)" for r in seen["jaccard_join"]) == linked
    assert sorted(r[0] for r in seen["decontamination"]) == sorted(r[0] for r in seen["jaccard_join"]) and all(r[4] == len(r[1]) for r in seen["decontamination"])
    _, taken = by_sql(seen["decontamination"], "SELECT doc_id, taken // greatest(size, 1) FROM (" + queries.ORACLES["op8_mixing"] + ") WHERE size > 0")
    counted = {}
    for r in seen["mixing"]:
        counted[r[0]] = counted.get(r[0], 0) + 1
    sizes = {r[0]: len(WORD.findall(r[1])) for r in seen["decontamination"]}
    assert sorted(f"({d}, {counted.get(d, 0)})" for d, n in sizes.items() if n) == taken
    start = 0
    for d, s, n, crc in sorted(seen["token_files"], key=lambda x: x[1]):
        ids = brute_ids([next(r[1] for r in seen["mixing"] if r[0] == d)])[0]
        assert (s, n, crc) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += n
    assert len(seen["token_files"]) == len(seen["mixing"])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    cursor = con.execute(queries.ORACLES[name])
    names = [c[0] for c in cursor.description]
    got = queries.QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(str, cursor.fetchall()))




def test_null_ids_with_different_texts(spark):
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(None, f"x y {words} z"), (None, words), (3, f"{words} {words}"), (None, "a b c d e f"), (1, "a b c d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    removed = substring_dedup.dedup(docs).groupBy(F.col("doc_id").isNull()).agg(F.sum("n_removed")).collect()
    assert sorted(r[1] for r in removed) == [30, 60]  # one of the null ids is the first
    linked = {(r.doc_id, r.component_id) for r in jaccard_join.link(docs).collect()}
    assert linked == {(None, None), (3, 3), (1, 1)}


@pytest.mark.parametrize(("phrases", "one_character"), [(7, 30_000), (50, 3)])
def test_long_regions_have_several_automata(monkeypatch, phrases, one_character):
    monkeypatch.setattr(substring_dedup, "PHRASES", phrases)
    monkeypatch.setattr(substring_dedup, "ONE_CHARACTER", one_character)
    rng = random.Random(1)
    words = [str(rng.randint(0, 9)) for _ in range(300)]
    numbers = np.array([1, 1, 1]), np.array([1, 1, 1]), np.array([1, 2, 2]), np.array([0, 5, 400])
    texts = [" ".join(words + words[50:90]), " ".join(words[100:160]), " ".join(words[10:29] + ["x"] + words[30:50])]
    (doc, a, b), _ = substring_dedup._locate(*numbers, pa.array(texts), 20)
    assert sorted(zip(doc.tolist(), a.tolist(), b.tolist(), strict=True)) == [(1, 300, 340), (2, 5, 65), (2, 420, 440)]


def test_more_shared_words_than_characters():
    n = 1_150_000
    text = " ".join(map(str, range(n)))
    numbers = np.array([1, 1]), np.array([1, 1]), np.array([1, 2]), np.array([0, 0])
    (doc, a, b), _ = substring_dedup._locate(*numbers, pa.array([text, text]), 20)
    assert doc.tolist() == [2] and a.tolist() == [0] and b.tolist() == [n]
