from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plantpanel.llm import common, language, quality, toxicity
from plantpanel.llm import textkit as tk

from .helpers import corpus, empty, prose, same, with_clashes, words_of


def features(text: str | None) -> tuple[int, ...]:
    w = words_of(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(hit)


def test_features_by_brute_force():
    rng = random.Random(2)
    texts = [None, "", " \n", "a", "a b c a b c", "x\nx\n x\nx", "é\x85b \x1c c　d"]
    texts += ["".join(rng.choices(["a", "b", "é", " ", "\n", "\t", "#", "|", "中"], k=rng.randint(1, 60))) for _ in range(500)]
    got = list(zip(*quality.features(*tk.packed(pa.array(texts)))))
    for text, row in zip(texts, got):
        assert tuple(map(int, row)) == features(text), repr(text)


def labels(spark, rows, kind="quality int, toxic int"):
    return spark.createDataFrame(rows, f"doc_id long, {kind}")


def test_quality(spark):
    rng = random.Random(5)
    good = [(i, prose(rng, 100), "en", "s", 1) for i in range(120)]
    junk = [(200 + i, " ".join(f"{w}$$$ ###{w}" for w in prose(rng, 60).split()), "en", "s", 1) for i in range(12)]
    docs = spark.createDataFrame([*good, *junk], "doc_id long, text string, lang string, source string, n_chars long").unionByName(corpus(spark).withColumn("doc_id", F.col("doc_id") + 1000))
    marks = labels(spark, [(i, 1, 0) for i in range(0, 120, 2)] + [(0, 1, 0), (None, 1, 0), (200, 0, 0)])
    rows = quality.score_documents(with_clashes(docs), marks).collect()
    assert len(rows) == docs.count()
    kept = {r["doc_id"]: r["kept"] for r in rows}
    assert all(kept[i] for i in range(120)) and not any(kept[200 + i] for i in range(12))
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows:
        n, chars, symbols, dup, repeat = features(text[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n) and not (r["kept"] and r["base_failed"])
    filtered = quality.keep_good(docs, marks)
    assert filtered.columns == docs.columns and {r["doc_id"] for r in filtered.collect()} == {k for k, v in kept.items() if v}
    assert same(quality.score_documents(docs.repartition(3), marks), quality.score_documents(docs, marks))
    none = quality.score_documents(docs, marks.limit(0))
    assert {r["score"] for r in none.collect()} == {0.0}
    assert quality.score_documents(empty(spark), marks).count() == 0


def test_language(spark):
    rng = random.Random(7)
    tongues = {"aa": "ka lo mi tu re so".split(), "bb": "xe zi wo qu yä fü".split(), "cc": "çé ño ãs èl ôm ùn".split()}
    rows = [(i, " ".join("".join(rng.choices(s, k=rng.randint(1, 3))) for _ in range(rng.randint(8, 60))), lang) for i, (lang, s) in enumerate(list(tongues.items()) * 60)]
    rows += [(1000, None, "aa"), (1001, "12 !", "bb"), (1002, "", None), (None, "ka lo", "aa"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = language.identify_languages(with_clashes(docs))
    got = {r["doc_id"]: r for r in out.collect()}
    held = {r["doc_id"]: r["h"] for r in docs.select("doc_id", common.held_out("doc_id", 4, 2).alias("h")).collect()}
    right = [got[i]["lang_pred"] == lang for i, text, lang in rows[:180] if held[i]]
    assert len(right) > 20 and sum(right) >= 0.95 * len(right)
    assert all(got[i]["held_out"] == h and 0 <= got[i]["score"] <= 1 for i, h in held.items())
    assert got[1000]["lang_pred"] == got[1001]["lang_pred"] == got[1002]["lang_pred"] == "und"
    # The labels of held-out rows and the other columns are never looked at.
    twisted = docs.withColumn("lang", F.when(common.held_out("doc_id", 4, 2), "zz").otherwise(F.col("lang")))
    assert same(language.identify_languages(twisted), language.identify_languages(docs))
    assert {r["lang_pred"] for r in language.identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.identify_languages(empty(spark)).count() == 0


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 2000)
    logits = rng.normal(0, 1, (2000, 3))
    logits[np.arange(2000), y] += 1.0
    assert language.fit_temperature(logits * 4, y) == pytest.approx(4 * language.fit_temperature(logits, y), rel=0.1)


def test_toxicity_learns_pairs(spark):
    rng = random.Random(11)
    rows, marks = [], []
    for i in range(2400):
        # An insult or a group name alone is harmless; together they are toxic.
        kind = i % 4
        extra = [["vipe"], ["slurword"], ["groupname"], ["slurword", "groupname"]][kind]
        w = prose(rng, 30).split() + extra
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        marks.append((i, 1, int(kind == 3)))
    rows += [(5000, None), (5001, ""), (None, "slurword groupname"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r for r in toxicity.score_toxicity(with_clashes(docs), labels(spark, marks)).collect()}
    held = [i for i in range(2400) if out[i]["held_out"]]
    assert np.mean([out[i]["predicted"] == int(i % 4 == 3) for i in held]) > 0.97
    assert out[5000]["predicted"] == 0 and 0 <= out[5001]["score"] < 0.7
    assert toxicity.score_toxicity(empty(spark), labels(spark, marks)).count() == 0
    clean = toxicity.score_toxicity(docs, labels(spark, [(1, 1, 0), (1, 1, None), (2, 0, 0)])).collect()
    assert all(r["predicted"] == 0 for r in clean)


def test_scores_are_log_likelihood_ratios(spark):
    """Counts, ratios and mean scores by plain loops over the same hash."""
    rng = random.Random(31)
    texts = ["".join(rng.choices("abcé \n", k=rng.randint(0, 80))) for _ in range(40)]
    good = [k % 3 == 0 for k in range(40)]
    bucket = lambda g: (int.from_bytes(g, "big") * 0x9E3779B97F4A7C15 % 2**64) >> (64 - 10)
    grams = [[bucket(t.encode()[i : i + 4]) for i in range(len(t.encode()) - 3)] for t in texts]
    raw, trusted = Counter(x for g in grams for x in g), Counter(x for g, ok in zip(grams, good) if ok for x in g)
    share = sum(trusted.values()) / sum(raw.values())
    ratio = {b: np.log((trusted[b] + quality.SHRINK) / (n * share + quality.SHRINK)) for b, n in raw.items()}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    marks = labels(spark, [(i, int(ok), 0) for i, ok in enumerate(good)])
    for r in quality.score_documents(docs, marks, bits=10, min_score=0.0).collect():
        g = grams[r["doc_id"]]
        want = sum(ratio[x] for x in g) / max(1, len(g))
        assert r["score"] == pytest.approx(want, abs=1e-5)
        assert r["kept"] == (not r["base_failed"] and r["score"] >= 0.0)


def test_machine_scores_are_sums_over_pairs():
    rng = np.random.default_rng(12)
    n_terms, n = 30, 20
    w, f = rng.normal(size=n_terms), rng.normal(size=(n_terms, toxicity.FACTORS))
    sets = [sorted(rng.choice(n_terms, rng.integers(0, 9), replace=False)) for _ in range(n)]
    want = [0.5 + sum(w[i] for i in s) + sum(f[i] @ f[j] for a, i in enumerate(s) for j in s[a + 1 :]) for s in sets]
    docs, cols = np.repeat(np.arange(n), [len(s) for s in sets]), np.concatenate(sets).astype(int)
    assert toxicity.machine_scores(docs, cols, n, 0.5, w, f) == pytest.approx(np.array(want))


def test_the_machine_learns_pairs_that_weights_cannot():
    """Only the two terms together are toxic; each alone is as often clean."""
    rng = np.random.default_rng(3)
    x = rng.random((1500, 6)) < 0.4
    y = (x[:, 0] & x[:, 1]).astype(np.float32)
    docs, cols = np.nonzero(x)
    bias, w, f = toxicity.fit_machine(docs, cols, y, 6)
    score = toxicity.machine_scores(docs, cols, len(x), bias, w, f) > 0
    assert (score == y).mean() > 0.99


def test_more_terms_change_no_verdict_of_the_chosen_ones():
    rng = np.random.default_rng(1)
    n0, n1 = rng.integers(0, 500, (1 << toxicity.BUCKET_BITS) + 1), rng.integers(0, 500, (1 << toxicity.BUCKET_BITS) + 1)
    n0[-1] = n1[-1] = 5000
    few, many = toxicity.choose_terms(n0, n1, 100), toxicity.choose_terms(n0, n1, 10_000)
    assert few.tolist() == many[:100].tolist()


def test_ftrl_follows_the_plain_update():
    """The regularised leader by scalar loops, row by row."""
    rng = np.random.default_rng(2)
    rows = [(np.unique(np.append(rng.integers(0, 40, 5), language.BUCKETS)), None) for _ in range(30)]
    rows = [(at, rng.random(len(at))) for at, _ in rows]
    y = rng.integers(0, 3, 30)
    alpha, beta, l1, l2 = 0.5, 1.0, 0.02, 0.02
    got = language.fit_ftrl(rows, y, 3, alpha=alpha, beta=beta, l1=l1, l2=l2, epochs=2)
    z, n = {}, {}

    def weight(c, j):
        if abs(z.get((c, j), 0.0)) <= l1:
            return 0.0
        return -(z[c, j] - np.sign(z[c, j]) * l1) / ((beta + np.sqrt(n[c, j])) / alpha + l2)

    order = np.random.default_rng(5)
    for _ in range(2):
        for i in order.permutation(30):
            at, x = rows[i]
            w = {(c, j): weight(c, j) for c in range(3) for j in at}
            s = [sum(w[c, j] * v for j, v in zip(at, x)) for c in range(3)]
            p = np.exp(np.array(s) - max(s))
            p /= p.sum()
            for c in range(3):
                for j, v in zip(at, x):
                    g = (p[c] - (c == y[i])) * v
                    old = n.get((c, j), 0.0)
                    z[c, j] = z.get((c, j), 0.0) + g - (np.sqrt(old + g * g) - np.sqrt(old)) / alpha * w[c, j]
                    n[c, j] = old + g * g
    for (c, j) in z:
        assert got[c, j] == pytest.approx(weight(c, j), abs=1e-9)


def test_very_long_texts_have_the_scores_of_what_they_repeat(spark):
    """A text of a million characters is read whole: its end counts as much as its beginning."""
    rng = random.Random(17)
    tongues = {"aa": "ka lo mi tu re so".split(), "bb": "xe zi wo qu yä fü".split()}
    say = lambda s, n: " ".join("".join(rng.choices(s, k=2)) for _ in range(n))
    rows = [(i, say(s, 40), lang) for i, (lang, s) in enumerate(list(tongues.items()) * 60)]
    # A short beginning in one language, all the rest in the other.
    rows += [(1000, say(tongues["aa"], 2_000) + " " + say(tongues["bb"], 200_000), None), (1001, say(tongues["bb"], 2_000) + " " + say(tongues["aa"], 200_000), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify_languages(docs).collect()}
    assert (got[1000], got[1001]) == ("bb", "aa")

    rows, marks = [], []
    for i in range(1200):
        toxic = i % 2
        rows.append((i, prose(rng, 30) + (" slurword groupname" if toxic else "")))
        marks.append((i, 1, toxic))
    rows += [(5000, prose(rng, 200_000) + " slurword groupname"), (5001, prose(rng, 200_000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, labels(spark, marks)).collect()}
    assert 0 <= out[5001] < out[5000] <= 1


def test_languages_with_equal_scores(spark):
    """The same texts under two languages: equal texts fare alike, at every run."""
    texts = [f"{a} {b} {a}{b}" for a in ("ka", "lo", "mi", "tu") for b in ("re", "so", "na", "vi")]
    rows = [(4 * k + j, t, lang) for k, t in enumerate(texts * 4) for j, lang in enumerate(("bb", "aa"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    first = language.identify_languages(docs)
    by_text: dict = {}
    for r in first.join(docs.select("doc_id", "text"), "doc_id").collect():
        by_text.setdefault(r["text"], set()).add((r["lang_pred"], r["score"]))
    assert all(len(v) == 1 for v in by_text.values())
    assert same(language.identify_languages(docs.repartition(5)), first)


def test_language_scores_do_not_depend_on_batches(spark):
    """A text has the same score, to the last bit, alone in its batch and among others."""
    texts = [f"{a} {b} {a}{b}" for a in ("ka", "lo", "mi", "tu") for b in ("re", "so", "na", "vi")]
    rows = [(4 * k + j, t, lang) for k, t in enumerate(texts * 4) for j, lang in enumerate(("bb", "aa"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2, "doc_id")
    first = language.identify_languages(docs).collect()
    try:
        for n in ("1", "3"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
            assert sorted(language.identify_languages(docs).collect()) == sorted(first)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    rng = np.random.default_rng(4)
    w, x = language.summable(rng.normal(size=(1000, 3))).astype(float), rng.integers(0, 10_000, (5, 1000)).astype(float)
    assert (x @ w == (x[:, ::-1].copy() @ w[::-1].copy())).all() and not language.summable(np.zeros((4, 0))).size
