"""Language, quality, rules, lines and near duplicates: edge cases, brute force, held-out accuracy."""

from __future__ import annotations

import math
import random
import re
import time
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import ORACLE, SMALL
from tests.llm.helpers import frame, words
from tidemark.llm import jaccard, language, lines, quality, queries, rules

EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "123 !?"), (5, "word"), (6, "word"), (7, "Ä" * 50_000), (7, "Ä" * 50_000)]


def test_language_held_out(spark):
    got = queries.op1_language_id(spark, ORACLE).join(spark.read.parquet(f"{ORACLE}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right > 0.98


def test_language_edges(spark):
    docs = frame(spark, EDGES + [(8, "the and"), (9, None, "en", "s")]).withColumn("score", F.lit("clash"))
    none = language.identify(docs, language.learn(docs, F.lit(False)))
    assert {(r.lang_pred, r.score) for r in none.collect()} == {("und", 0.0)}
    model = language.learn(frame(spark, [(i, t, lang, "s") for i, (t, lang) in enumerate([("the house and the garden", "en"), ("das haus und der garten", "de")] * 5)]), F.lit(True))
    got = {(r.doc_id, r.lang_pred) for r in language.identify(docs, model).collect()}
    assert {x for x in got if x[0] in (1, 2, 3, 4, 9)} == {(i, "und") for i in (1, 2, 3, 4, 9)} and (8, "en") in got
    assert language.identify(docs.limit(0), model).count() == 0


def test_language_against_dense_kernel_ridge(spark):
    """Predictions and scores are those of kernel ridge regression over sets of n-grams, written out plainly."""
    text = "SELECT doc_id, substr(text, 1, 400) AS text, lang FROM {docs} WHERE text IS NOT NULL AND doc_id % 3 < 2"
    docs = spark.sql(text, docs=spark.read.parquet(f"{SMALL}/documents.parquet")).unionByName(frame(spark, [(9001, "Привет, мир", None, None), (9002, "日本語 テキスト", None, None)]).select("doc_id", "text", "lang"))
    rows = docs.collect()
    symbol, letter = language._symbols()

    def grams(text):
        s = [int(symbol[ord(c)]) for c in text]
        return {tuple(s[i : i + k]) for k in range(1, language.LONGEST + 1) for i in range(len(s) - k + 1)}

    sets = [grams(r.text) for r in rows]
    has_letter = [any(letter[ord(c)] for c in r.text) for r in rows]
    known = [i for i, r in enumerate(rows) if r.doc_id % 3 == 0 and r.lang is not None and has_letter[i]]
    assert 30 < len(known) < language.LANDMARKS
    kernel = np.array([[len(a & sets[j]) / np.sqrt(max(1, len(a)) * len(sets[j])) for j in known] for a in sets])
    names = sorted({rows[i].lang for i in known})
    k = kernel[known]
    y = np.array([[1.0 if rows[i].lang == x else -1.0 for x in names] for i in known])
    weights = np.linalg.solve(k.T @ k + len(known) * (language.RIDGE * k + 1e-8 * np.eye(len(known))), k.T @ y)
    values = kernel @ weights
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, language.learn(docs, F.col("doc_id") % 3 == 0)).collect()}
    for i, r in enumerate(rows):
        want, score = (names[values[i].argmax()], float(np.clip((values[i].max() + 1) / 2, 0, 1))) if has_letter[i] else ("und", 0.0)
        close = np.sort(values[i])[-1] - np.sort(values[i])[-2] < 1e-2
        assert abs(got[r.doc_id][1] - score) < 2e-2 and (got[r.doc_id][0] == want or close)


def test_language_symbols_keep_scripts_apart():
    symbol, letter = language._symbols()
    of = lambda text: {int(symbol[ord(c)]) for c in text}
    scripts = ["abcxyzABC", "äöüßéñçøå", "αβγδΩ", "привет", "שלום", "سلام", "नमस्ते"[:2], "สวัส"[:2], "ひらがな", "カタカナ", "漢字語", "한국어"]
    assert all(not of(a) & of(b) for i, a in enumerate(scripts) for b in scripts[:i]) and len(of("абвгд")) == 5
    assert symbol.max() < 1 << language.SYMBOL_BITS and of("1 ,") == {0} and not letter[ord("1")]


def test_quality_learning_follows_the_numeric_gradient():
    """The weights are those of the same steps along a gradient by finite differences of the non-negative risk."""
    dice = np.random.default_rng(3)
    positive, unlabelled, prior = dice.normal(1, 1, (40, 3)), np.vstack([dice.normal(1, 1, (30, 3)), dice.normal(-1, 1, (50, 3))]), 0.4
    model = quality.fit(positive.astype(np.float32), unlabelled.astype(np.float32), prior)
    both = np.vstack([positive, unlabelled])
    p, u = (np.clip((x - both.mean(0)) / both.std(0), -6, 6) for x in (positive, unlabelled))
    loss = lambda x, w, sign: np.log1p(np.exp(-sign * (x @ w[:-1] + w[-1]))).mean()
    negative = lambda w: loss(u, w, -1) - prior * loss(p, w, -1)
    risk = lambda w: prior * loss(p, w, 1) + negative(w)

    def slope(f, w, h=1e-5):
        return np.array([(f(w + h * e) - f(w - h * e)) / (2 * h) for e in np.eye(len(w))])

    w, m, v, switched = np.zeros(4), np.zeros(4), np.zeros(4), 0
    for t in range(1, quality.EPOCHS + 1):
        switched += negative(w) < 0
        g = slope(risk, w) if negative(w) >= 0 else -slope(negative, w)
        g[:-1] += quality.DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= quality.STEP * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    assert np.abs(np.append(model.weights, model.bias) - w).max() < 2e-2
    scores = model.score(both.astype(np.float32))
    assert np.abs(scores - 1 / (1 + np.exp(-(np.vstack([p, u]) @ w[:-1] + w[-1])))).max() < 1e-2


def test_quality_held_out(spark):
    got = queries.op6_quality_classifier(spark, ORACLE).join(spark.read.parquet(f"{ORACLE}/labels.parquet").select("doc_id", "quality"), "doc_id").where("held_out").collect()
    good, bad = [r.score for r in got if r.quality == 1], [r.score for r in got if r.quality == 0]
    assert sum(a > b for a in good for b in bad) / (len(good) * len(bad)) > 0.9
    assert sum(a >= 0.7 for a in good) / len(good) > 0.95


def test_quality_edges(spark):
    docs = frame(spark, EDGES)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.learn(docs, labels.limit(0), F.lit(True)) is None
    assert {r.score for r in quality.scored(docs, None).collect()} == {0.5}
    model = quality.learn(docs, labels, F.lit(True))
    assert all(0 <= r.score <= 1 for r in quality.scored(docs.withColumn("score", F.lit("x")), model).collect())
    assert quality.scored(docs.limit(0), model).count() == 0


def expected_counts(text):
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often, hit = Counter(windows), set()
    for i, k in enumerate(windows):
        if often[k] > 1:
            hit |= {i, i + 1, i + 2}
    own = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(own) - len(set(own)), len(hit)


def test_rule_counts(spark):
    dice = random.Random(1)
    rows = EDGES + [(100 + i, "".join(dice.choice(["a", "b", " ", " ", "\n", "#", "é", "\r", "\x0b"]) for _ in range(dice.randint(0, 300)))) for i in range(200)]
    got = rules.apply_rules(frame(spark, rows).withColumn("kept", F.lit("clash"))).collect()
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == sorted((i, *expected_counts(t)) for i, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    assert rules.apply_rules(frame(spark, rows).limit(0)).count() == 0


def plain_verdicts(rows):
    """Which of rows (id, lang, source, counts with lines) are kept, by sorted lists in place of sketches."""

    def rank(values, q):
        own = sorted(values)[max(0, math.ceil(q * len(values)) - 1)]
        return rules.BIN_RATIO ** (math.floor(math.log(own) / math.log(rules.BIN_RATIO)) + 0.5) if own > 0 else 0.0

    def blended(found, lang, source, value, q, lean):
        own, ofs = [value(r) for r in found if r[1:3] == (lang, source)], [value(r) for r in found if r[1] == lang]
        if not own:
            return None
        toward = lambda wide, values: wide + len(values) / (len(values) + rules.PRIOR_DOCS) * (rank(values, q) - wide)
        return toward(toward(rank([value(r) for r in found], q), ofs) if lean else rank(ofs, q), own)

    count = lambda i: lambda r: r[3][i]
    share = {"s": (lambda r: r[3][2] / max(1, r[3][0]), 1, 0), "d": (lambda r: r[3][3] / max(1, r[3][5]), 1, 5), "r": (lambda r: r[3][4] / max(1, r[3][0]), 6, 0)}
    length = lambda r: r[3][1] / max(1, r[3][0])
    groups = sorted({r[1:3] for r in rows}, key=str)
    long_enough = [r for r in rows if r[3][0] >= 50]
    limits = {}
    for g in groups:
        low, mid, high = (blended(long_enough, *g, length, q, False) for q in (0.25, 0.5, 0.75))
        if low is not None:
            spread = rules.LENGTH_SPREADS * max(min(high - mid, mid - low), rules.LEAST_LENGTH_SPREAD)
            limits[g] = (low - spread, high + spread)
    usual = [r for r in long_enough if 100 * r[3][4] <= 50 * r[3][0] and limits[r[1:3]][0] <= length(r) <= limits[r[1:3]][1]]
    most = {}
    for g in groups:
        for name, (value, event, size) in share.items():
            top, mid, n = blended(usual, *g, value, rules.SHARE_QUANTILE, True), blended(usual, *g, value, 0.5, True), blended(usual, *g, count(size), 0.5, True)
            most[g, name] = None if top is None else top + rules.SHARE_SPREADS * (top - mid) + event / max(1.0, n)
    return {r[0]: r in usual and all(most[r[1:3], name] is not None and value(r) <= most[r[1:3], name] for name, (value, *_) in share.items()) for r in rows}


def test_rules_verdicts_match_sorted_lists(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("text is not null")
    docs = docs.unionByName(docs.limit(30).selectExpr("doc_id + 100000 AS doc_id", "text", "CAST(NULL AS string) AS lang", "source", "n_chars"))
    rows = [(r.doc_id, r.lang, r.source, (*expected_counts(r.text), sum(bool(words(x)) for x in r.text.split("\n")))) for r in docs.collect()]
    assert len({r[1:3] for r in rows}) > 20
    got = {r.doc_id: r.kept for r in rules.apply_rules(docs).select("doc_id", "kept").collect()}
    want = plain_verdicts(rows)
    assert got == want and 0 < sum(want.values()) < len(want)


def test_rule_sketches_are_exact_counts(spark):
    """Quantiles of many values are within half a bin of those of sorted lists, and the same in any order and partitioning."""
    dice = np.random.default_rng(8)
    values = np.concatenate([dice.lognormal(0, 2, 30_000), np.zeros(5_000), dice.random(5_000) * 1e-6])
    rows = spark.createDataFrame([("en" if i % 3 else None, f"s{i % 2}", float(v)) for i, v in enumerate(values)], "lang string, source string, x double")
    ranks = (0.05, 0.25, 0.5, 0.95, 1.0)
    found = [sorted(map(repr, rules._group_quantiles(r, {"x": ranks}).collect())) for r in (rows, rows.repartition(7), rows.orderBy("x").coalesce(2))]
    assert found[0] == found[1] == found[2]
    every = rules._quantiles(rules._sketches(rows, ["x"]).withColumn("a", F.lit(0)), ["a"], {"x": ranks}, "all").first()
    for i, q in enumerate(ranks):
        exact = float(np.sort(values)[math.ceil(q * len(values)) - 1])
        assert abs(every[f"x_{i}_all"] - exact) <= 0.0026 * exact
    assert every.docs_all == len(values)


def test_rules_agree_over_runs(spark):
    docs = spark.read.parquet(f"{ORACLE}/documents.parquet")
    one, two = (sorted(map(tuple, rules.apply_rules(d).collect())) for d in (docs, docs.repartition(5, "text")))
    assert one == two


def test_language_is_not_lost_behind_repeated_ids(spark):
    """8,000 English rows share one doc_id; a third of all rows are one row."""
    english, french = "the house stands in the garden and".split(), "la maison est dans le jardin et".split()
    dice = random.Random(2)
    some = lambda voc: " ".join(dice.choice(voc) for _ in range(8))
    rows = [(1, some(english), "en", "s") for _ in range(4000)] + [(1, "the house and the garden", "en", "s")] * 4000 + [(i % 3, some(french), "fr", "s") for i in range(300)] + [(None, some(french), "xx", "s")] * 20
    docs = frame(spark, rows)
    model = language.learn(docs, F.col("doc_id").isNotNull())
    assert model.languages == ["en", "fr"]
    got = language.identify(frame(spark, [(i, some(voc), None, None) for i, voc in enumerate([english, french] * 50)]), model).collect()
    assert [r.lang_pred for r in sorted(got, key=lambda r: r.doc_id)] == ["en", "fr"] * 50


def test_language_sets_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_CODES", 200)
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate([("the house and the garden", "en"), ("das haus und der garten", "de")] * 50)]
    model = language.learn(frame(spark, rows), F.lit(True))
    assert model.languages == ["de", "en"] and len(model.landmarks) < 10


def test_quality_sample_has_all_strata(spark, monkeypatch):
    """A rare language keeps its part in the unlabelled risk, and weighs as much as it has rows; repeated rows count once."""
    seen = {}
    monkeypatch.setattr(quality, "UNLABELLED", 200)
    monkeypatch.setattr(quality, "fit", lambda p, u, prior, weight=None: seen.update(p=p, u=u, weight=weight))
    rows = [(7, f"word number {i} of many", "en", "s") for i in range(4000)] + [(9, "one row", "en", "s")] * 2000 + [(100 + i, f"ein wort {i} " * 9, "de", "s") for i in range(5)]
    quality.learn(frame(spark, rows), spark.createDataFrame([(100, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int"), F.lit(True))
    assert len(seen["p"]) == 1 and 200 <= len(seen["u"]) <= 200 + 3 * quality.LEAST
    assert abs(seen["weight"].sum() - 4006) < 1e-6 and (seen["weight"] == 1).sum() >= 6


def test_quality_learns_the_same_from_weights():
    """A row that stands for three gives the model of three such rows."""
    dice = np.random.default_rng(4)
    positive, unlabelled = dice.normal(1, 1, (40, 3)).astype(np.float32), dice.normal(0, 1, (60, 3)).astype(np.float32)
    stands = dice.integers(1, 4, 60)
    one, many = quality.fit(positive, unlabelled, 0.3, stands.astype(float)), quality.fit(positive, np.repeat(unlabelled, stands, 0), 0.3)
    # the scaling weighs positives by the rows that are drawn, so it is near but not the same
    assert np.abs(one.score(unlabelled) - many.score(unlabelled)).max() < 0.1


def test_lines_of_a_very_long_text(spark):
    """Linear in the lines: 150,000 that go, and what stands between them stays in order."""
    n = 200_000
    text = "\n".join("same line" if i % 4 else f"own {i}" for i in range(n))
    rows = [(i, "same line\nother", "en", f"s{i}") for i in range(6)] + [(50, text, "en", "s1")]
    began = time.time()
    got = {r.doc_id: r for r in lines.remove_lines(frame(spark, rows)).collect()}
    assert got[50].text == "\n".join(f"own {i}" for i in range(0, n, 4)) and got[50].lines_removed == n - n // 4 and got[50].lines_left == n // 4
    assert time.time() - began < 60


def test_rules_keep_clean_and_drop_junk(spark):
    got = queries.op10_adaptive_rules(spark, ORACLE).join(spark.read.parquet(f"{ORACLE}/labels.parquet"), "doc_id").where("not base_failed")
    kept = dict(got.groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect())
    assert kept[1] > 0.97 and kept[0] < 0.1


def test_rules_limits_follow_the_spread_of_each_source(spark):
    """Most documents have no symbol or repeat; what the others have differs by source, and so does the spread of word length."""

    def counts(i, source, wide):
        some = (i % 5 == 0) * (1 + i % 7) * wide
        return (i, "en", source, 1000, 5000 + (i % 21 - 10) * 10 * wide, 2 * some, 100, some, 6 * some)

    rows = [counts(i, source, wide) for source, wide in (("even", 1), ("wide", 4)) for i in range(400)]
    counted = spark.createDataFrame(rows, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in rules._COUNTS))
    even, wide = rules.thresholds(counted).orderBy("source").collect()
    assert (even.source, wide.source) == ("even", "wide")
    for m in rules.METRICS:
        assert 1.5 * (even[f"{m}_max"] - 5 * (m == "word_length")) < wide[f"{m}_max"] - 5 * (m == "word_length")
    assert wide.word_length_min < even.word_length_min < 5


def test_lines_match_sql(spark):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = db.sql(lines.DIGEST_SQL)
    got = queries.op2_line_dedup(spark, SMALL).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_lines_edges(spark):
    common = [(10 + i, f"own line {i}\nshared line \n\nown {i}", "en", f"s{i}") for i in range(6)]
    near = [(30 + i, "four sites only", "en", f"s{i}") for i in range(4)] + [(40 + i, "same site", "en", "s1") for i in range(9)]
    rows = [(i, t, None, None) for i, t in EDGES] + common + near + [(60, "shared line\nshared line", None, None)]
    clash = {c: F.lit(c) for c in ("lines_left", "_gone", "_d", "_t", "_doc", "_id", "_hash", "_site", "_first", "_h1")}
    left = lines.remove_lines(frame(spark, rows).withColumns(clash)).collect()
    assert all(r[c] == c for r in left for c in clash if c != "lines_left")
    got = {(r.doc_id, r.text, r.lines_removed, r.lines_left) for r in left}
    assert (10, common[0][1], 0, 3) in got and (11, "own line 1\n\nown 1", 1, 2) in got and (60, "", 2, 0) in got
    assert {x[0] for x in got if x[2]} == {11, 12, 13, 14, 15, 60}
    assert (1, None, 0, 0) in got and (2, "", 0, 0) in got
    assert lines.remove_lines(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("least", [2, 20, 60])
def test_lines_near_the_limit_are_counted(spark, least):
    """Lines on least - 1, least and least + 1 sites, each also many times on one site; estimates may be off by some."""
    dice, rows = random.Random(4), []
    for n in (least - 1, least, least + 1, 2 * least + 3):
        rows += [(len(rows) + i, f"own {n} {i}\nline {n}\nline {n}", None, f"s{i % n}") for i in range(3 * n)]
    dice.shuffle(rows)
    out = lines.remove_lines(frame(spark, rows), min_sites=least).select("doc_id", "lines_removed").collect()
    got = {r.doc_id: r.lines_removed for r in out}
    for n in (least - 1, least, least + 1, 2 * least + 3):
        own = sorted(r[0] for r in rows if f"line {n}\n" in r[1])
        assert [got[i] for i in own] == ([0] * len(own) if n < least else [1] + [2] * (len(own) - 1))


def brute_components(rows):
    sets = {}
    for i, text in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                    a, b = find(x), find(y)
                    root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("far", [False, True])
def test_jaccard_components(spark, monkeypatch, far):
    monkeypatch.setattr(jaccard, "FREQUENT_DOCS", 8)
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", 20)
    monkeypatch.setattr(jaccard, "RANGE_BYTES", 64)  # more ranges than map parts
    dice = random.Random(4 + far)
    voc = ["".join(dice.choice("abcdefgh") for _ in range(3)) for _ in range(300)]
    doc = lambda n: [dice.choice(voc) for _ in range(n)]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A b"), (6, "a b c d e"), (7, "a B c d e"), (8, "a b c d e f"), (9, "x " * 3000)]
    for size in (3, 5, 6, 9, 20, 60, 150):
        base = doc(size)
        for _ in range(6):
            own = list(base)
            for _ in range(dice.randint(0, max(1, size // 18))):
                own[dice.randrange(size)] = dice.choice(voc)
            rows.append((len(rows) + 20, " ".join(own + doc(dice.randint(0, size // 8)))))
    hot = doc(120)
    for _ in range(80):  # near copies; far ones link with the first one rather than with each other
        own = list(hot)
        for _ in range(dice.randint(2, 5) if far else dice.randint(0, 3)):
            own[dice.randrange(120)] = dice.choice(voc)
        rows.append((len(rows) + 20, " ".join(own)))
    rows += [(len(rows) + 20 + i, " ".join(doc(dice.randint(0, 30)) + hot[:50] + doc(dice.randint(0, 30)))) for i in range(40)]
    want = brute_components(rows)
    docs = frame(spark, rows + rows[-3:], "doc_id long, text string").withColumn("n", F.lit("clash"))
    got = jaccard.near_duplicates(docs).collect()
    assert len(got) == len(rows) + 3
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_jaccard_null_ids_link_as_any_others(spark):
    base = [f"w{i}" for i in range(60)]
    extra = [f"x{i}" for i in range(10)]
    rows = [(9, base + extra), (None, base), (4, extra + base), (None, ["quite", "different"]), (None, []), (7, ["quite", "different"]), (8, []), (None, ["no", "other"]), (7, ["quite", "different"])]
    got = jaccard.near_duplicates(frame(spark, [(i, " ".join(w)) for i, w in rows], "doc_id long, text string").withColumn("row", F.lit("clash"))).collect()
    want = Counter([(9, 66, 4), (None, 56, 4), (4, 66, 4), (None, 1, 7), (None, 0, None), (7, 1, 7), (8, 0, 8), (None, 1, None), (7, 1, 7)])
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_jaccard_empty(spark):
    assert jaccard.near_duplicates(frame(spark, EDGES[:3])).count() == 3
    assert jaccard.near_duplicates(frame(spark, EDGES).limit(0)).count() == 0
